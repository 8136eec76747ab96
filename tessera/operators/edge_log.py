"""Versioned edges as a log: a batch of claims is folded in the JVM and appends what it changes.

    folder/log/v<n>/...         (src, predicate, cur, ev, version, run) of the keys that batch n claims: the
                                current edges after it, and its events
    folder/current/v<n>/...     (src, predicate, cur) of all keys after batch n, for every `gather`th batch

A batch reads the current edges of its keys, from what was gathered last and the batches since; past edges
are never read. Edges are put together when they are asked for: the last event of each, with its last begin
and end. A batch is there once all of it is written; done again it changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .graph import EDGE, begun, edges_of_events, fold_claims
from .stage import delete_path

_KEY = ["src", "predicate"]


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the batches in folder that are wholly written, ascending."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [str(s.getPath().getName()) for s in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(int(n[1:]) for n in names if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS")))


def _log(spark: SparkSession, folder: str, numbers: list[int]) -> DataFrame:
    return spark.read.parquet(*[f"{folder}/log/v{n}" for n in numbers])


def current(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame | None:
    """(src, predicate, cur) after the batches under number `before`, or after all; None without one."""
    known = [n for n in versions(spark, f"{folder}/log") if before is None or n < before]
    if not known:
        return None
    whole = [n for n in versions(spark, f"{folder}/current") if n <= known[-1]][-1:]
    since = [n for n in known if not whole or n > whole[0]]
    at = F.struct("version", "run")
    parts = [_log(spark, folder, since).select(*_KEY, "cur", "version", "run")] if since else []
    parts += [spark.read.parquet(f"{folder}/current/v{n}").select(*_KEY, "cur", F.lit(n).cast("bigint").alias("version"), F.lit(-1).alias("run")) for n in whole]
    rows = parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]
    return rows.groupBy(*_KEY).agg(F.max_by("cur", at).alias("cur"))


def append(claims: DataFrame, folder: str, version: int, existing: DataFrame | None = None, gather: int = 8, **fold) -> None:
    """Writes batch `version`: claims(src, predicate, dst, cs, ts, seq), folded in order of seq over the batches before it, and the first one over existing edges."""
    spark = claims.sparkSession
    known = versions(spark, f"{folder}/log")
    if version in known:
        return
    if not known and existing is not None:
        begun(existing).withColumns({"version": F.lit(-1).cast("bigint"), "run": F.lit(0)}).write.mode("overwrite").parquet(f"{folder}/log/v-1")
    runs = fold_claims(claims, current(spark, folder, version), **fold)
    rows = None
    for i, r in enumerate(runs):
        r = r.select(*_KEY, "cur", "ev", F.lit(version).cast("bigint").alias("version"), F.lit(i).alias("run"))
        rows = r if rows is None else rows.unionByName(r)
    rows.write.mode("overwrite").parquet(f"{folder}/log/v{version}")
    if version % gather == gather - 1:
        current(spark, folder, version + 1).write.mode("overwrite").parquet(f"{folder}/current/v{version}")
        for n in versions(spark, f"{folder}/current")[:-2]:
            delete_path(spark, f"{folder}/current/v{n}")


def read_edges(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The edges after batch `version`, the last one by default."""
    known = [n for n in versions(spark, f"{folder}/log") if version is None or n <= version]
    if not known:
        return spark.createDataFrame([], EDGE)
    events = _log(spark, folder, known).select(*_KEY, "version", F.inline("ev"))
    return edges_of_events(events, F.struct("version", "at"))
