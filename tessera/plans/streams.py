"""Registered queries of the streaming jobs: the given tables, staged as files, run through once; and candidate pairs."""

from __future__ import annotations

import uuid

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import buckets, edge_log, vectors
from ..operators.quality import TERMS, signature
from ..operators.stage import delete_path, stage, stage_root
from ..streaming import jobs
from . import sql as D
from .registry import oracle_sql, query
from .structured import _FOLD
from .tables import TRIPLES, derive, plain, price_claims, table, triples


def _stream(df, name: str, parts: int = 3, part=None):
    """(stream over df's rows as files, a batch for each of `parts` parts, in order; folder). part is an int column, a hash of the row by default."""
    spark, root = df.sparkSession, f"{stage_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    files = max(4, spark.sparkContext.defaultParallelism)  # of a batch
    dealt, path = stage(df.withColumn("_part", part if part is not None else F.pmod(F.xxhash64(*[F.to_json(F.struct(*df.columns))]), F.lit(parts)).cast("int")), name)
    for i in range(parts):  # files are read by age
        dealt.where(F.col("_part") == i).drop("_part").repartition(files).write.mode("append").parquet(f"{root}/in")
    delete_path(spark, path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/in"), root


def _run(stream, root: str, mode: str, key: list[str] | None = None):
    """The rows of a stream that runs until its input is read; the last batch's for each key."""
    def write(batch, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{root}/out/batch={number}")

    stream.writeStream.outputMode(mode).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    out = stream.sparkSession.read.parquet(f"{root}/out").drop("batch")
    if key:
        out = out.withColumn("_k", F.row_number().over(W.partitionBy(*key).orderBy(F.desc("_batch")))).where("_k = 1").drop("_k")
    return out.drop("_batch")


_SIGS = ", ".join(f"lower({D.component(c)}) AS sig_{c}" for c in TERMS)
#: Three batches; times within half an hour, but for rows of the last batch that come two hours late.
_PART, _LATE = "length(subject) % 3", "length(subject) % 3 = 2 AND length(object) % 4 = 0"


@query(f"WITH t AS ({plain(TRIPLES)}) SELECT DISTINCT {_SIGS} FROM t WHERE {D.reason()} = 'valid' AND NOT ({_LATE})")
def stream_quality_gate(spark, sf_dir):
    late = F.when(F.expr(_LATE), -7200).otherwise(F.pmod(F.xxhash64("seq"), F.lit(1800)))
    stream, root = _stream(triples(spark, sf_dir).withColumn("ts", F.timestamp_seconds(1_700_000_000 + late)), "gate", part=F.expr(_PART).cast("int"))
    return _run(jobs.stream_quality_gate(stream), root, "append").select(*signature())


@query(f"WITH RECURSIVE {_FOLD} SELECT * FROM edges")
def stream_versioned_edges(spark, sf_dir):
    """Three batches in order of time: those of one batch are folded by seq, those of the next over their edges."""
    stream, root = _stream(price_claims(spark, sf_dir), "claims", part=F.when(F.col("ts") < 1.02e9, 0).when(F.col("ts") < 1.06e9, 1).otherwise(2))
    jobs.stream_edge_log(stream, f"{root}/edges", f"{root}/checkpoint").awaitTermination()
    return edge_log.read_edges(spark, f"{root}/edges")


@query("SELECT s_name AS id, s_name AS name, CAST(max(l_orderkey) AS varchar) AS last_order, CAST(max(CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS varchar) AS last_return FROM supplier JOIN lineitem ON l_suppkey = s_suppkey GROUP BY 1, 2")
def stream_upsert_graph(spark, sf_dir):
    """Rows in no order of seq over the batches; a return sets an attribute that other rows leave alone."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("id"))
    li, key = table(spark, sf_dir, "lineitem").join(s, "l_suppkey"), F.col("l_orderkey").cast("string")
    facts = F.map_filter(F.create_map(F.lit("last_order"), key, F.lit("last_return"), F.when(F.col("l_returnflag") == "R", key)), lambda k, v: v.isNotNull())
    stream, root = _stream(li.select("id", facts.alias("attributes"), F.col("l_orderkey").alias("seq")), "nodes")
    jobs.stream_upsert_graph(stream, f"{root}/graph", f"{root}/checkpoint", buckets=8).awaitTermination()
    return buckets.read_nodes(spark, f"{root}/graph").select("id", *[F.try_element_at("attributes", F.lit(k)).alias(k) for k in ("name", "last_order", "last_return")])


def _vectors(sql: str) -> str:
    """The embedding query's SQL without its rounding, of types instead of names."""
    return sql.replace("round(w / sqrt(sum(w * w) OVER (PARTITION BY term)), 6) AS w", "w / sqrt(sum(w * w) OVER (PARTITION BY term)) AS w").replace("SELECT DISTINCT p_name AS term FROM part", "SELECT p_type AS term FROM part UNION SELECT concat(p_type, ' ', p_brand) FROM part")


def register_pairs() -> None:
    """Needs the embedding query's SQL, which the catalogue registers first."""
    v = _vectors(oracle_sql()["hash_embed_terms"])

    @query(f"SELECT a.term AS a, b.term AS b, round(sum(a.w * b.w), 6) AS score FROM ({v}) a JOIN ({v}) b ON a.idx = b.idx WHERE a.term <> b.term GROUP BY 1, 2 HAVING round(sum(a.w * b.w), 9) >= 0.4")
    def candidate_pairs(spark, sf_dir):
        terms = derive(spark, sf_dir, "SELECT p_type AS term FROM {part} UNION SELECT concat(p_type, ' ', p_brand) FROM {part}")
        vec = vectors.sparse_embedding(terms)
        return vectors.sparse_candidates(vec, vec, 0.4).where("a != b").withColumn("score", F.round("score", 6))

    typed = "SELECT p_type AS meta, concat(p_type, ' ', p_brand) AS term FROM {part} UNION SELECT p_brand, concat(p_brand, ' ', p_type, ' ', p_name) FROM {part}"
    w = oracle_sql()["hash_embed_terms"].replace("round(w / sqrt(sum(w * w) OVER (PARTITION BY term)), 6) AS w", "w / sqrt(sum(w * w) OVER (PARTITION BY term)) AS w").replace("SELECT DISTINCT p_name AS term FROM part", f"SELECT DISTINCT term FROM ({plain(typed)})")

    @query(f"WITH v AS MATERIALIZED (SELECT v.*, meta FROM ({w}) v JOIN ({plain(typed)}) USING (term)) SELECT a.term AS a, b.term AS b, round(sum(a.w * b.w), 6) AS score FROM v a JOIN v b ON a.idx = b.idx AND a.meta = b.meta WHERE a.term < b.term GROUP BY 1, 2 HAVING round(sum(a.w * b.w), 9) >= 0.75")
    def candidate_pairs_filtered(spark, sf_dir):
        """Pairs of equal metadata only: of one type, or of one brand."""
        terms = derive(spark, sf_dir, typed)
        vec = vectors.sparse_embedding(terms).join(terms, "term")
        return vectors.sparse_candidates(vec, vec, 0.75, equal=("meta",)).where("a < b").withColumn("score", F.round("score", 6))
