"""A table of nodes in hash buckets, with a manifest for each version: an upsert reads and writes the buckets it touches.

    folder/data/v<n>/bucket=<b>/...     the buckets that version n has written
    folder/manifest/v<n>/...            (bucket, version): where each bucket of version n lies

A version is there once its manifest is; writing one again gives the same, so a repeated batch does no
harm. A bucket row is (id, facts): for each attribute its value and the seq that set it. The value of the
greatest seq stands, whatever the order in which they come; of equal ones the greater value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .stage import delete_path

_MANIFEST = "bucket int, version long"


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Versions with a manifest, ascending."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifest")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [str(s.getPath().getName()) for s in fs.listStatus(root)]
    return sorted(int(n[1:]) for n in names if n[1:].isdigit() and _exists(spark, f"{folder}/manifest/{n}/_SUCCESS"))


def _manifest(spark: SparkSession, folder: str, version: int) -> dict[int, int]:
    return {r["bucket"]: r["version"] for r in spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest/v{version}").collect()}  # one row a bucket


def _facts_type(seq_type: str) -> str:
    return f"id string, facts map<string,struct<value:string,seq:{seq_type}>>"


def _bucket_rows(spark: SparkSession, folder: str, places: dict[int, int], seq_type: str) -> DataFrame:
    paths = [f"{folder}/data/v{v}/bucket={b}" for b, v in sorted(places.items())]
    return spark.read.schema(_facts_type(seq_type)).parquet(*paths) if paths else spark.createDataFrame([], _facts_type(seq_type))


def read_nodes(spark: SparkSession, folder: str, version: int | None = None, seq_type: str = "bigint") -> DataFrame:
    """(id, attributes) of a version, the last one by default."""
    known = versions(spark, folder)
    version = version if version is not None else known[-1] if known else None
    places = _manifest(spark, folder, version) if version is not None else {}
    return _bucket_rows(spark, folder, places, seq_type).select("id", F.transform_values("facts", lambda _, v: v.value).alias("attributes"))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")


def upsert(nodes: DataFrame, folder: str, version: int, buckets: int = 64, keep: int = 2) -> None:
    """Writes version `version` of the table in folder: the version before with nodes(id, attributes, seq) upserted.

    Without a seq column a later version wins. Each node has its id as its name. `buckets` must not change
    between versions. Versions before the last `keep` are dropped, with the buckets that only they have.
    """
    spark = nodes.sparkSession
    known = versions(spark, folder)
    if version in known:
        return
    before = [v for v in known if v < version]
    places = _manifest(spark, folder, before[-1]) if before else {}
    seq = F.col("seq") if "seq" in nodes.columns else F.lit(version).cast("bigint")
    named = nodes.where("id is not null").select("id", F.coalesce("attributes", F.expr("map()").cast("map<string,string>")).alias("attributes"), seq.alias("seq"))
    seq_type = named.schema["seq"].dataType.simpleString()
    new = named.select("id", F.explode_outer(F.map_filter("attributes", lambda k, v: k != "name")).alias("attr", "value"), "seq")
    touched = [r[0] for r in new.select(_bucket(buckets).alias("b")).distinct().collect()]  # at most `buckets` rows
    if touched:
        old = _bucket_rows(spark, folder, {b: places[b] for b in touched if b in places}, seq_type)
        old = old.select("id", F.explode_outer(F.map_filter("facts", lambda k, v: k != "name")).alias("attr", "f")).select("id", "attr", "f.value", "f.seq")
        last = new.unionByName(old).groupBy("id", "attr").agg(F.max(F.struct("seq", "value")).alias("f")).select("id", "attr", F.struct("f.value", "f.seq").alias("f"))
        name = F.array(F.struct(F.lit("name").alias("attr"), F.struct(F.col("id").alias("value"), F.lit(None).cast(seq_type).alias("seq")).alias("f")))
        facts = F.concat(name, F.collect_list(F.when(F.col("attr").isNotNull(), F.struct("attr", "f"))))
        merged = last.groupBy("id").agg(F.map_from_entries(facts).alias("facts")).select("id", "facts", _bucket(buckets).alias("bucket"))
        merged.repartition(len(touched), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/data/v{version}")
    now = places | {b: version for b in touched}
    spark.createDataFrame(sorted(now.items()), _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest/v{version}")
    kept = [v for v in (*before, version)][-keep:]
    needed = {(b, v) for k in kept for b, v in (now if k == version else _manifest(spark, folder, k)).items()}
    for gone in (v for v in before if v not in kept):
        for b, v in _manifest(spark, folder, gone).items():
            if (b, v) not in needed:
                delete_path(spark, f"{folder}/data/v{v}/bucket={b}")
        delete_path(spark, f"{folder}/manifest/v{gone}")
