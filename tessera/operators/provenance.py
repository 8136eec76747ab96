"""Where facts come from: source dictionary, authority, confidence gates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scores as S
from ..functions.text import preview


def source_id(text) -> "F.Column":
    return F.substring(F.md5(F.col(text) if isinstance(text, str) else text), 1, 16)


def source_dictionary(facts: DataFrame, seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """(facts with source_id instead of source_text, source_texts(source_id, text) where the last wins)."""
    keyed = facts.withColumn("source_id", F.when(F.col("source_text") != "", source_id("source_text")))
    texts = keyed.where("source_id is not null").groupBy("source_id").agg(F.max_by("source_text", seq).alias("text"))
    return keyed.drop("source_text"), texts


def recover_source_text(facts: DataFrame, blocks: DataFrame) -> DataFrame:
    """Missing or empty source_text from blocks(block_index, text) at source_block_index, else the preview."""
    joined = facts.join(blocks.select(F.col("block_index").alias("source_block_index"), F.col("text").alias("_text")), "source_block_index", "left")
    return joined.withColumn("source_text", F.coalesce(F.nullif("source_text", F.lit("")), "_text", "preview")).drop("_text")


def confidence_split(facts: DataFrame, threshold: float = 0.9) -> DataFrame:
    return facts.withColumn("band", F.when(F.coalesce("confidence", F.lit(0.0)) >= threshold, "high").otherwise("low"))


def confidence_rate(facts: DataFrame, threshold: float = 0.9) -> DataFrame:
    """One row: n_high, n_low, high_rate."""
    high = F.coalesce("confidence", F.lit(0.0)) >= threshold
    return facts.agg(F.count_if(high).alias("n_high"), F.count_if(~high).alias("n_low"), F.coalesce(F.avg(high.cast("double")), F.lit(0.0)).alias("high_rate"))


def source_meta_join(facts: DataFrame, documents: DataFrame, prefix: int | None = 200, seq: str = "doc_seq") -> DataFrame:
    """facts(source_id) with documents' source_url, source_type and page_title by hash of the text, or else of the first prefix characters of a longer one; the last wins."""
    whole = F.struct(source_id("text").alias("source_id"), F.lit(True).alias("_whole"))
    keys = [whole] + ([F.when(F.length("text") > prefix, F.struct(source_id(preview("text", prefix)).alias("source_id"), F.lit(False).alias("_whole")))] if prefix else [])
    hashed = documents.where("text is not null").select(F.explode(F.array(*keys)).alias("_k"), seq, "source_url", "source_type", "page_title").where("_k is not null").select("_k.*", seq, "source_url", "source_type", "page_title")
    meta = hashed.groupBy("source_id").agg(F.max_by(F.struct("source_url", "source_type", "page_title"), F.struct("_whole", seq)).alias("m")).select("source_id", "m.*")
    return facts.join(meta, "source_id", "left")


def enrich_for_conflicts(facts: DataFrame, documents: DataFrame, now: float, rules: str = "B") -> DataFrame:
    """source_authority, authority_score and confidence_score from the documents' addresses; now is a parameter."""
    out = source_meta_join(facts, documents, 200 if rules == "B" else None)
    out = out.withColumn("source_authority", S.source_authority("source_url", "source_type", rules)).withColumn("authority_score", S.authority_weight("source_authority"))
    score = S.confidence_score_b("authority_score", "timestamp", now) if rules == "B" else S.confidence_score_a("authority_score", "timestamp", "confidence")
    return out.withColumn("confidence_score", score)


def annotate_origin(chunks: DataFrame, plan: DataFrame) -> DataFrame:
    """chunks(tool, query, text, ...) of a plan(tool, query, origin_type, origin_value): origins where missing, plain texts as unknown."""
    p = plan.select("tool", "query", F.col("origin_type").alias("_t"), F.col("origin_value").alias("_v"))
    out = chunks.join(p, ["tool", "query"], "left")
    return out.withColumns({"origin_type": F.coalesce("origin_type", "_t"), "origin_value": F.coalesce("origin_value", "_v"), "source_type": F.coalesce("source_type", F.lit("unknown"))}).drop("_t", "_v")


def extraction_stats(documents: DataFrame, attributes: DataFrame, relations: DataFrame, events: DataFrame, threshold: float = 0.9) -> DataFrame:
    """One row: totals, facts a document, events by confidence."""
    one = documents.agg(F.count("*").alias("n_documents"))
    for name, df in (("attributes", attributes), ("relations", relations)):
        one = one.join(df.agg(F.count("*").alias(f"n_{name}")))
    one = one.join(events.agg(F.count("*").alias("n_events"), F.count_if(F.coalesce("confidence", F.lit(0.0)) >= threshold).alias("n_events_high")))
    return one.select("*", *[F.coalesce(F.try_divide(F.col(f"n_{k}").cast("double"), F.col("n_documents")), F.lit(0.0)).alias(f"{k}_per_document") for k in ("attributes", "relations", "events")])
