"""Chat formatting after cumulative-snapshot collapse.

Logs often hold a conversation again after each turn. A rolling hash over its turns gives each
conversation one hash for each prefix; one whose hash over all its turns is the prefix hash of a longer
conversation is a snapshot and goes, by an anti-join. Of equal conversations the smallest conv_id stays.
What is left is rendered by turn, with each segment's place in the conversation's text, so that a
conversation of any length is rendered by windows that spill and never sits in one row.

The hashes are two 64-bit ones of (index, role, text), XORed along the turns.

Defined cases: turns are ordered by turn, role and text, nulls first; repeated turns count each; turns
without conv_id are one conversation; null role or text renders empty but is not equal to an empty one;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def indexed_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn_index from 0, n_turns, role, text, h1, h2): the prefix hashes up to each turn."""
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far, whole = order.rowsBetween(W.unboundedPreceding, W.currentRow), W.partitionBy("conv_id")
    turns = conversations.select("conv_id", "turn", "role", "text").withColumns({"_i": F.row_number().over(order), "n_turns": F.count("*").over(whole)})
    parts = [F.col("_i"), F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit(""))]
    turns = turns.withColumns({"_x1": F.xxhash64(F.lit(1), *parts), "_x2": F.xxhash64(F.lit(2), *parts)})
    return turns.select("conv_id", (F.col("_i") - 1).alias("turn_index"), "n_turns", "role", "text", F.bit_xor("_x1").over(so_far).alias("h1"), F.bit_xor("_x2").over(so_far).alias("h2"))


def turns_of_maximal(conversations: DataFrame) -> DataFrame:
    """The indexed turns of conversations that are no prefix of another."""
    turns = indexed_turns(conversations)
    last = F.col("turn_index") + 1 == F.col("n_turns")
    whole = turns.where(last).groupBy("n_turns", "h1", "h2").agg(F.min("conv_id").alias("conv_id"))
    prefixes = turns.where(~last).select((F.col("turn_index") + 1).cast("long").alias("n_turns"), "h1", "h2").distinct()
    kept = whole.join(prefixes, ["n_turns", "h1", "h2"], "left_anti").select(F.col("conv_id").alias("_kept"))
    return turns.join(kept, F.col("conv_id").eqNullSafe(F.col("_kept")), "left_semi")


def render(turns: DataFrame, head: str = "<|", tail: str = "|>\n", end: str = "<|end|>\n") -> DataFrame:
    """(conv_id, turn_index, n_turns, start, segment): start is where the segment begins in the conversation's text, in characters."""
    segment = F.concat(F.lit(head), F.coalesce("role", F.lit("")), F.lit(tail), F.trim(F.coalesce("text", F.lit(""))), F.lit(end))
    turns = turns.select("conv_id", "turn_index", "n_turns", segment.alias("segment"))
    before = W.partitionBy("conv_id").orderBy("turn_index").rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("segment").cast("long")).over(before), F.lit(0)).cast("long")
    return turns.select("conv_id", "turn_index", "n_turns", start.alias("start"), "segment")
