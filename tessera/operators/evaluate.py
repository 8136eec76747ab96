"""Scoring predictions against gold: exact and semantic precision, recall and F1."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalized(c: str):
    return F.lower(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))))


def prf(counts: DataFrame) -> DataFrame:
    """tp, fp, fn with precision, recall and f1; 0 where undefined."""
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    out = counts.withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    return out.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))


def exact_prf(gold: DataFrame, pred: DataFrame, keys: list[str], row: str = "row_id") -> DataFrame:
    """Micro scores of sets of normalized keys in each row."""
    def side(df, name):
        return df.select(F.col(row).alias("_row"), *[normalized(k).alias(k) for k in keys]).distinct().withColumn(name, F.lit(True))

    both = side(gold, "_g").join(side(pred, "_p"), ["_row", *keys], "full")
    return prf(both.agg(F.count_if(F.expr("_g and _p")).alias("tp"), F.count_if(F.expr("_p and _g is null")).alias("fp"), F.count_if(F.expr("_g and _p is null")).alias("fn")))


def event_keys(events: DataFrame, row: str = "row_id") -> DataFrame:
    """events with one key: type, anchor and the set of argument values."""
    values = F.array_sort(F.array_distinct(F.transform("arguments", lambda a: F.lower(F.trim(a.value)))))
    return events.select(row, F.concat_ws("|", normalized("event_type"), normalized("anchor_entity"), F.array_join(values, ",")).alias("key"))


def set_scores(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """(side, ...) rows in both, only predicted, only gold; sets."""
    tag = lambda df, name: df.withColumn("side", F.lit(name))
    return tag(gold.intersect(pred), "both").union(tag(pred.subtract(gold), "predicted")).union(tag(gold.subtract(pred), "gold"))


def semantic_prf(gold: DataFrame, pred: DataFrame, keys: list[str], value: str, similarity: DataFrame, threshold: float = 0.9, row: str = "row_id", seq: str = "seq") -> DataFrame:
    """Keys must be equal; predictions in order take the most similar gold value still free.

    similarity(a, b, score) has pairs of different normalized values; equal ones score 1. Rows and keys are
    independent, so each group is matched alone.
    """
    def side(df, name):
        return df.select(F.col(row).alias("_row"), *[normalized(k).alias(k) for k in keys], normalized(value).alias(name), F.col(seq).alias(f"{name}_seq"))

    g, p = side(gold, "g"), side(pred, "p")
    pairs = p.join(g, ["_row", *keys]).join(similarity.select(F.col("a").alias("p"), F.col("b").alias("g"), "score"), ["p", "g"], "left")
    pairs = pairs.withColumn("score", F.when(F.col("p") == F.col("g"), 1.0).otherwise(F.coalesce("score", F.lit(0.0)))).where(F.col("score") >= threshold)

    group = ["_row", *keys]
    options = pairs.groupBy(*group, "p_seq").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "g_seq"))).alias("o"))
    turns = options.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("p_seq", "o"))).alias("l"))
    free = lambda used, o: F.filter(F.transform(o, lambda x: x.g_seq), lambda x: ~F.array_contains(used, x))
    taken = F.aggregate("l", F.array().cast(f"array<{g.schema['g_seq'].dataType.simpleString()}>"), lambda used, x: F.concat(used, F.slice(free(used, x.o), 1, 1)))
    tp = turns.select(F.size(taken).alias("tp")).agg(F.coalesce(F.sum("tp"), F.lit(0)).alias("tp"))
    counts = tp.join(g.agg(F.count("*").alias("_g"))).join(p.agg(F.count("*").alias("_p")))
    return prf(counts.select("tp", (F.col("_p") - F.col("tp")).alias("fp"), (F.col("_g") - F.col("tp")).alias("fn")))
