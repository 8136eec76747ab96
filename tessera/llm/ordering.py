"""Places of rows in the order of their group, for groups of any size.

Rows are range-partitioned by group and order, so a group of a third of all rows lies over many
partitions. A staged table keeps each row's partition and place in it; what is before a partition is
summed over one row for each (partition, group), of which there are no more than groups and partitions
together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def sorted_parts(df: DataFrame, group: list[str], order: list[str], stage, keep: list | None = None) -> DataFrame:
    """df, or its columns `keep`, with _part and _pos, staged: rows of a group ascend by order (nulls first) along (_part, _pos).

    Equal rows are dealt by their place in the input, so that a table of one row repeated is split too.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group, *order, "_tie"]
    dealt = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    return stage(dealt.select(*(keep or df.columns), F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_pos")), "sorted")


def part_starts(placed: DataFrame, group: list[str], more: dict | None = None) -> DataFrame:
    """(_part, group, _first, _n, more, _before, _total): first place, rows here, given aggregates, rows of the group in earlier partitions and in all."""
    here = placed.groupBy("_part", *group).agg(F.min("_pos").alias("_first"), F.count("*").alias("_n"), *[v.alias(k) for k, v in (more or {}).items()])
    whole = W.partitionBy(*group)
    before = F.sum("_n").over(whole.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    return here.withColumns({"_before": F.coalesce(before, F.lit(0)), "_total": F.sum("_n").over(whole)})


def numbered(placed: DataFrame, group: list[str]) -> DataFrame:
    """placed with idx (long, from 0 in each group) and n (rows of the group); groups are not null."""
    starts = part_starts(placed, group).select("_part", *group, "_first", "_before", F.col("_total").alias("n"))
    return placed.join(starts, ["_part", *group]).withColumn("idx", F.col("_pos") - F.col("_first") + F.col("_before")).drop("_part", "_pos", "_first", "_before")
