"""Spark-native knowledge-graph construction: DataFrame in, DataFrame out."""
