"""Connected components of an edge table, by alternating large and small stars.

Each round is two grouped minima and joins; a node with very many edges is pre-aggregated before the
shuffle and its rows in a join may be split. The edges of a round are staged.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Staging, staged


def _contract(batches):
    """Edges of a partition as stars around their smallest node."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.get(top, top)) != top:
            top = up
        while (up := root.get(x, x)) != top:
            root[x], x = top, up
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            low, high = min(a, b), max(a, b)
            root[high] = root.setdefault(low, low)
    nodes = [x for x in root if find(x) != x]
    for i in range(0, len(nodes), 50_000):
        some = nodes[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([find(x) for x in some], pa.int64())], names=["a", "b"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (a > b), each once."""
    both = edges.union(edges.select("b", "a")) if large else edges
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(low, "a")
    out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) if large else joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
    return out.where("a != b").distinct()


def components(edges: DataFrame, keep: Staging | None = None, max_rounds: int = 60) -> DataFrame:
    """(node, root) for the nodes of edges(a long, b long): root is the smallest node that is linked. Nulls and loops are left out. The result is a table of keep's, or one that stays."""
    edges = edges.select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")).where("a != b")
    with Staging(edges.sparkSession) as stage:
        edges = stage(edges.mapInArrow(_contract, "a long, b long").distinct(), "edges")
        for _ in range(max_rounds):
            # done when every node has one edge, to a node that has none to a smaller one
            ends = edges.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("b"))
            if ends.where("n > 1").isEmpty() and edges.select("a").join(edges.select(F.col("b").alias("a")), "a", "left_semi").isEmpty():
                break
            before, edges = edges, stage(_star(_star(edges, True), False), "edges")
            stage.drop(before)
        else:
            raise RuntimeError("components did not settle")
        return (keep or staged)(edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()), "components")
