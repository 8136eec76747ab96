"""From raw documents to packed training sequences: five stages, each on all that its predecessor kept.

The stages take (spark, docs, sf_dir). All but the last return the columns of documents; each result is
written as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.common import Staging, broadcast_within, read_table, staged, text_keys
from tessera.llm.decontamination import contaminated_texts
from tessera.llm.jaccard_join import jaccard_components
from tessera.llm.language_id import UNDETERMINED, identify_language, train_prototypes
from tessera.llm.packing import best_fit_packing
from tessera.llm.secrets import redact, train


#: Labelled texts that a threshold of the language stage needs at least, and its share of their median cosine.
LEAST_TEXTS, LEAST_SHARE = 100, 0.2


def _size_class():
    return F.floor(F.log2(F.length("text"))).cast("int")


def least_scores(named):
    """{language: [(size class, threshold)]} of named(k, lang, lang_pred, score).

    A class holds texts of 2^k characters up to twice that. Its threshold is a fifth of the median cosine of
    all labelled texts that got their own language, at least LEAST_TEXTS. That is above other scripts and
    letter noise (about 0, with a deviation of 1/32) and under texts of the language that repeat a word;
    a language never learned that shares most trigrams with a learned one isn't told apart by it.
    """
    right = named.where("lang = lang_pred").groupBy("lang_pred", "k")
    found = right.agg(F.count("*").alias("n"), F.percentile_approx("score", 0.5).alias("mid")).where(F.col("n") >= LEAST_TEXTS).collect()
    return {x: sorted((r.k, r.mid * LEAST_SHARE) for r in found if r.lang_pred == x) for x in {r.lang_pred for r in found}}


def language(spark, docs, sf_dir):
    """Texts without a letter go, and those whose cosine is under the threshold of their language and size.

    Prototypes are learned from two thirds of the documents, thresholds from the scores of all labelled
    ones (least_scores). A size class without a threshold has that of the next smaller class (longer texts
    score higher); where there is none either, or no document has a lang, texts with a letter stay.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    prototypes = train_prototypes(docs.select("doc_id", "text", "lang").where(~held_out))
    if not prototypes:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    least = F.lit(0.0)
    labelled = docs.where("lang is not null").select("text", "lang", _size_class().alias("k"))
    for lang, classes in least_scores(identify_language(labelled, prototypes, keep=("lang", "k"))).items():
        for k, cut in classes:
            least = F.when((F.col("lang_pred") == lang) & (_size_class() >= k), cut).otherwise(least)
    named = identify_language(docs, prototypes, keep=tuple(docs.columns))
    return named.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)).select(*docs.columns)


def near_duplicates(spark, docs, sf_dir):
    """Of each component of near copies one row stays, that with the smallest doc_id (null ones last; of equal ones that with the smallest hash). Rows go by their text alone: others of the same or a null doc_id stay.

    A row is known by two hashes of its doc_id and text. Of rows that have both in common, the first in the order of the other columns stays.
    """
    columns, keys = docs.columns, ["_k1", "_k2"]
    named = docs.withColumns({k: F.xxhash64(F.lit(i), "doc_id", F.col("text").isNull(), "text") for i, k in enumerate(keys)})
    found = jaccard_components(named.select(F.col("_k1").alias("doc_id"), "text", F.col("doc_id").alias("id"), *keys), size=5, percent=80, carry=("id", *keys))
    with Staging(spark) as stage:
        rows = found.where("n_shingles > 0").groupBy("component_id", "id", *keys).agg(F.count("*").alias("n"))
        order = F.struct(F.col("id").isNull().alias("none"), "id", *keys)
        first = rows.groupBy("component_id").agg(F.min(order).alias("first"))
        rows = stage(rows.join(first, "component_id").withColumn("stays", order == F.col("first")).select(*keys, "n", "stays"), "rows-of-components")
        gone = staged(rows.where("not stays or n > 1").select(*keys), "near-copies")
        several = rows.where("stays and n > 1").select(*keys)
        several = None if several.isEmpty() else staged(several, "repeated-rows")
    out = named.join(broadcast_within(gone, gone.count()), keys, "left_anti").select(*columns)
    if several is None:
        return out
    again = named.join(several, keys, "left_semi").withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*columns)))
    return out.union(again.where("_n = 1").select(*columns))


def without_benchmarks(spark, docs, sf_dir):
    """Rows whose text holds a window of a benchmark item go; others of the same or a null doc_id stay."""
    with Staging(spark) as stage:
        _, texts = contaminated_texts(docs, read_table(spark, sf_dir, "benchmark"), stage)
        hit = staged(texts.select("t1", "t2"), "contaminated")
    t1, t2 = text_keys(F.coalesce("text", F.lit("")))
    hit = broadcast_within(hit.select(F.col("t1").alias("_t1"), F.col("t2").alias("_t2")), hit.count())
    return docs.withColumns({"_t1": t1, "_t2": t2}).join(hit, ["_t1", "_t2"], "left_anti").select(*docs.columns)


def without_secrets(spark, docs, sf_dir):
    """Secrets are masked; the documents stay, with n_chars counted anew."""
    masked = redact(docs, train(docs.select("doc_id", "text")))
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def packed(spark, docs, sf_dir):
    """Pieces of token ids in sequences of at most 4096."""
    return best_fit_packing(docs.select("doc_id", "text"))


STAGES = [
    ("language ID", language),
    ("near duplicates", near_duplicates),
    ("decontamination", without_benchmarks),
    ("secret scan", without_secrets),
    ("best-fit packing", packed),
]

#: SQL has no hyperdimensional profiles, forests or tokenizers; the tests use brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    with Staging(spark) as stage:
        for name, step in STAGES[:-1]:
            before, docs = docs, stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
            stage.drop(before)
        return staged(STAGES[-1][1](spark, docs, sf_dir), "packed-sequences")
