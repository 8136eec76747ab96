"""Writing an intermediate table to the shared folder and reading it again, and deleting it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local: dict[str, str] = {}


def stage_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a temporary folder for local masters without it, or else one in the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and spark.sparkContext.master.startswith("local"):
        app = spark.sparkContext.applicationId
        if app not in _local:
            _local[app] = "file://" + tempfile.mkdtemp(prefix="spark-stage-")
        root = _local[app]
    return root or spark.conf.get("spark.sql.warehouse.dir") + "/_staging"


def delete_path(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stage(df: DataFrame, label: str, clean: bool = False) -> tuple[DataFrame, str]:
    """(df written to the shared folder and read again, its folder). With clean, what was shuffled for it is deleted once it is written."""
    spark = df.sparkSession
    path = f"{stage_root(spark)}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN, None)
    if clean:
        spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        if clean:
            spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path), path


def staged(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared folder and read again: cuts lineage. The table stays."""
    return stage(df, label)[0]


class Staging:
    """Tables staged for the length of a with block, or until they are dropped: once all made from them is written."""

    def __init__(self, spark: SparkSession):
        self._spark, self._tables = spark, []

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        self._tables.append(stage(df, label))
        return self._tables[-1][0]

    def drop(self, *tables: DataFrame) -> None:
        for table, path in self._tables:
            if any(table is t for t in tables):
                delete_path(self._spark, path)
        self._tables = [x for x in self._tables if not any(x[0] is t for t in tables)]

    def __enter__(self) -> "Staging":
        return self

    def __exit__(self, *_) -> None:
        self.drop(*[t for t, _ in self._tables])
