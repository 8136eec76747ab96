"""Connected components of an undirected graph, by contraction.

Each round a vertex points to the neighbour of smallest hash, if that is smaller than its own; pointers go
down, so they have no cycles. Vertices move to where four steps lead, edges are renamed, and those within
one vertex go. Hashes differ by round, so about a third of the vertices are left each time, on chains too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stage import Staging, staged


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(vertex, component) of edges(x, y); vertices without an edge have no row. A component is named by one of its vertices."""
    stage = Staging(edges.sparkSession)
    both = lambda e: e.where("x != y").select("x", "y").union(e.where("x != y").select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct()
    moves, live = [], stage(both(edges), "edges")
    vertices = edges.select(F.explode(F.array("x", "y")).alias("vertex")).where("vertex is not null").distinct()
    for n in range(max_rounds):
        if live.isEmpty():
            break
        hashed = lambda c: F.struct(F.xxhash64(F.lit(n), c).alias("h"), F.col(c).alias("v"))
        least = live.groupBy("x").agg(F.min(hashed("y")).alias("m")).select(F.col("x").alias("v"), F.when(F.col("m") < hashed("x"), F.col("m.v")).otherwise(F.col("x")).alias("to"))
        step = stage(least, "pointers")
        for _ in range(2):  # to where two, then four steps lead
            step = step.join(step.select(F.col("v").alias("to"), F.col("to").alias("_to")), "to").select("v", F.col("_to").alias("to"))
        step = stage(step, "moves")
        moves.append(step)
        renamed = live.join(step.select(F.col("v").alias("x"), F.col("to").alias("_x")), "x").join(step.select(F.col("v").alias("y"), F.col("to").alias("_y")), "y").select(F.col("_x").alias("x"), F.col("_y").alias("y"))
        older, live = live, stage(renamed.where("x != y").distinct(), "edges")
        stage.drop(older)
    else:
        raise RuntimeError("components did not settle")
    out = vertices.withColumn("component", F.col("vertex"))
    for step in moves:
        out = out.join(step.select(F.col("v").alias("component"), F.col("to").alias("_to")), "component", "left").select("vertex", F.coalesce("_to", "component").alias("component"))
    out = staged(out, "components")
    stage.drop(live, *moves)
    return out
