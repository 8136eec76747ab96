"""What the corpus operators share: tables, staging in the shared folder, exact word rules."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the quality and join contracts: everything but ASCII white space.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_local_stage: dict[str, str] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage_root(spark: SparkSession) -> str:
    """The shared folder for staged tables.

    ``spark.checkpoint.dir`` where the cluster names it; without it, a temporary folder for local
    masters and the warehouse, which is shared too, for others.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        return spark.conf.get("spark.sql.warehouse.dir") + "/_staging"
    app = spark.sparkContext.applicationId
    if app not in _local_stage:
        _local_stage[app] = "file://" + tempfile.mkdtemp(prefix="spark-stage-")
    return _local_stage[app]


def _stage(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{stage_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def staged(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared folder and read again: cuts lineage, survives lost executors. The table stays."""
    return _stage(df, label)[0]


class Staging:
    """Tables staged for the length of a with block, or until they are dropped.

    A table may go once all that is made from it is written.
    """

    def __init__(self, spark: SparkSession):
        self._spark, self._paths = spark, []

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        out, path = _stage(df, label)
        self._paths.append((out, path))
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes the folders of these tables."""
        gone = [x for x in self._paths if any(x[0] is t for t in tables)]
        self._paths = [x for x in self._paths if not any(x[0] is t for t in tables)]
        for _, path in gone:
            where = self._spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(where, True)

    def close(self) -> None:
        """Deletes all that is left."""
        self.drop(*[t for t, _ in self._paths])

    def __enter__(self) -> "Staging":
        return self

    def __exit__(self, *_) -> None:
        self.close()


def text_keys(text: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes that stand for a text."""
    return F.xxhash64(F.lit(1), text), F.xxhash64(F.lit(2), text)


def broadcast_within(df: DataFrame, rows: int, limit: int = 1_000_000) -> DataFrame:
    """df to be broadcast if it has at most limit rows; beyond that Spark shuffles."""
    return F.broadcast(df) if rows <= limit else df


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else.

    ``lower`` would also change É; it is used where the text has no other character with case, as it
    is several times faster than ``translate``.
    """
    other = text.rlike(r"[\p{Lu}\p{Lt}\p{Nl}\p{So}&&[^\x00-\x7F]]")
    return F.when(other, F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))


def words(text: Column, pattern: str = SPACE_WORD) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def sliced(batches, rows: int = 500):
    """Arrow batches in slices of at most so many rows, so that few of their values are Python objects at once."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def give_back() -> None:
    """Memory that this process has freed goes back to the system, as far as its allocators can."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another libc
        pass


def lean(run):
    """run(batches) for mapInArrow or mapInPandas, after which its worker keeps no freed memory.

    Spark uses its workers again, which else hold what earlier tasks have freed.
    """

    def step(batches):
        yield from run(batches)
        give_back()

    return step


def chunks_of(values, limit: int):
    """(start, stop) of runs of values whose summed length is about limit; one long value is a run."""
    return runs_of([0 if v is None else len(v) for v in values], limit)


def runs_of(sizes, limit: int):
    """(start, stop) of runs of sizes (null: 0) whose sum is about limit; one large size is a run."""
    start = total = 0
    for i, n in enumerate(sizes):
        n = n or 0
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
