"""Quality gate for triples: reasons, signatures, counts and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import scores as S
from ..functions.text import truncate_source

TERMS = ("subject", "predicate", "object")


def first_wins(df: DataFrame, keys: list, seq: str = "seq") -> DataFrame:
    """The first row of each key in order of seq."""
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(seq))).where("_rn = 1").drop("_rn")


def with_reason(triples: DataFrame, least: float = 0.9) -> DataFrame:
    return triples.withColumn("reason", S.validity_reason(least=least))


def signature() -> list[Column]:
    return [F.lower(S.normalize_component(c)).alias(f"sig_{c}") for c in TERMS]


def normalize_triples(triples: DataFrame) -> DataFrame:
    """Terms normalized, confidence a number, source text cut."""
    out = triples.withColumns({c: S.normalize_component(c) for c in TERMS}).withColumn("confidence", S.coerce_confidence("confidence"))
    return out.withColumn("source_text", truncate_source("source_text")) if "source_text" in triples.columns else out


def process_triples(triples: DataFrame, least: float = 0.9, seq: str = "seq") -> DataFrame:
    """Valid rows, one for each signature (first wins), normalized."""
    valid = with_reason(triples, least).where("reason = 'valid'").drop("reason")
    keyed = valid.select("*", *signature())
    return normalize_triples(first_wins(keyed, ["sig_subject", "sig_predicate", "sig_object"], seq)).drop("sig_subject", "sig_predicate", "sig_object")


def filter_stats(triples: DataFrame, least: float = 0.9) -> DataFrame:
    """(reason, n) with duplicates counted apart from valid rows."""
    keyed = with_reason(triples, least).select("reason", F.when(F.col("reason") == "valid", F.struct(*signature())).alias("sig"))
    per = keyed.groupBy("reason", "sig").agg(F.count("*").alias("n"))
    kept, again = F.when((F.col("reason") != "valid"), F.col("n")).otherwise(1), F.when(F.col("reason") == "valid", F.col("n") - 1).otherwise(0)
    parts = per.select(F.explode(F.array(F.struct(F.col("reason"), kept.cast("long").alias("n")), F.struct(F.lit("duplicate").alias("reason"), again.cast("long").alias("n")))).alias("x")).select("x.*")
    return parts.groupBy("reason").agg(F.sum("n").alias("n")).where("n > 0")


def analyze(triples: DataFrame) -> DataFrame:
    """One row: nulls, self references, duplicate signatures and confidence classes."""
    sig = F.struct(*signature())
    invalid = reduce(lambda a, b: a | b, [S.is_invalid_value(c) for c in TERMS])
    conf = F.coalesce(F.col("confidence").try_cast("double"), F.lit(0.5))
    rows = triples.select(sig.alias("sig"), invalid.alias("bad"), (F.lower(F.trim("subject")) == F.lower(F.trim("object"))).alias("self"), conf.alias("c"))
    per = rows.groupBy("sig").agg(F.count("*").alias("n"), F.count_if("bad").alias("bad"), F.count_if("self").alias("self"), F.count_if(F.col("c") < 0.3).alias("low"), F.count_if((F.col("c") >= 0.3) & (F.col("c") < 0.7)).alias("medium"), F.count_if(F.col("c") >= 0.7).alias("high"))
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).alias(name)
    return per.agg(total("n", "total_count"), total("bad", "null_values"), total("self", "self_references"), total(F.col("n") - 1, "duplicate_signatures"), total("low", "low_confidence"), total("medium", "medium_confidence"), total("high", "high_confidence"))


def term_frequencies(triples: DataFrame) -> DataFrame:
    """(term_type, term, n) of valid values of all three terms, from one pass."""
    terms = triples.select(F.explode(F.array(*[F.struct(F.lit(c).alias("term_type"), F.col(c).alias("term")) for c in TERMS])).alias("x")).select("x.*")
    return terms.where(~S.is_invalid_value("term")).groupBy("term_type", "term").agg(F.count("*").alias("n"))


def quality_rates(analysis: DataFrame) -> DataFrame:
    """Validity, uniqueness and weighted confidence of an analyze() row; 0 where there are no triples."""
    n = F.col("total_count")
    rate = lambda x: F.coalesce(F.try_divide(x.cast("double"), n), F.lit(0.0))
    weighted = F.col("high_confidence") + 0.6 * F.col("medium_confidence") + 0.3 * F.col("low_confidence")
    return analysis.select("*", rate(n - F.col("null_values") - F.col("self_references")).alias("validity_rate"), rate(n - F.col("duplicate_signatures")).alias("uniqueness_rate"), rate(weighted).alias("confidence_score"))


def quality_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Reductions between two analyze() rows and the relative reduction of all issues."""
    issues = ["null_values", "duplicate_signatures", "self_references", "low_confidence"]
    b, a = before.select(*[F.col(c).alias(f"b_{c}") for c in issues]), after.select(*[F.col(c).alias(f"a_{c}") for c in issues])
    both = b.join(a)  # one row each
    total = lambda p: reduce(lambda x, y: x + y, [F.col(f"{p}_{c}") for c in issues])
    less = lambda c: F.col(f"b_{c}") - F.col(f"a_{c}")
    return both.select(less("null_values").alias("null_reduction"), less("duplicate_signatures").alias("duplicate_reduction"), less("self_references").alias("self_reference_reduction"), F.coalesce(F.try_divide((total("b") - total("a")).cast("double"), total("b")), F.lit(0.0)).alias("overall_improvement"))


#: score, threshold and advice, in order
ADVICE = [("web_content_quality", 0.6, "filter web content harder"), ("wikipedia_content_quality", 0.7, "extract articles better"), ("search_result_quality", 0.6, "rank search results better"), ("validity_rate", 0.8, "validate triples harder"), ("uniqueness_rate", 0.9, "detect more duplicates"), ("confidence_score", 0.7, "calibrate confidence")]


def overall_quality(metrics: DataFrame) -> DataFrame:
    """From one row with the six scores of ADVICE: 0.4 source mean + 0.6 triple mean, and advice below thresholds."""
    names = [a[0] for a in ADVICE]
    mean = lambda cs: reduce(lambda x, y: x + y, [F.col(c) for c in cs]) / len(cs)
    advice = F.filter(F.array(*[F.when(F.col(n) < t, F.lit(text)) for n, t, text in ADVICE]), lambda x: x.isNotNull())
    return metrics.select("*", (0.4 * mean(names[:3]) + 0.6 * mean(names[3:])).alias("overall_quality"), F.when(F.size(advice) == 0, F.array(F.lit("keep going"))).otherwise(advice).alias("advice"))


def running_mean(scores: DataFrame, kind: str = "kind", score: str = "score") -> DataFrame:
    return scores.groupBy(kind).agg(F.avg(score).alias("mean_score"), F.count(score).alias("n"))


def article_quality(articles: DataFrame) -> DataFrame:
    """articles(title, sections array<string>, infobox_size, exists) with score."""
    sizes = F.aggregate("sections", F.lit(0.0), lambda a, s: a + F.when(F.length(s) >= 100, 0.1).when(F.length(s) >= 50, 0.05).otherwise(0.0))
    parts = F.when(F.size("sections") > 0, F.least(F.size("sections") / 10, F.lit(1.0)) * 0.3 + F.least(sizes, F.lit(0.2))).otherwise(0.0)
    box = F.least(F.coalesce("infobox_size", F.lit(0)) / 20, F.lit(1.0)) * 0.3
    return articles.withColumn("score", F.least(parts + box + F.when(F.coalesce("exists", F.lit(False)), 0.2).otherwise(0.0), F.lit(1.0)))


def valid_articles(articles: DataFrame, limit: int, seq: str = "seq") -> DataFrame:
    """The first limit existing articles whose summary has over 100 characters."""
    return articles.where(F.col("exists") & (F.length("summary") > 100)).orderBy(seq).limit(limit)
