"""Search results and plans: valid links, best links by query, fallbacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import scores as S
from ..functions.fixed import BLOCKED_LINK_WORDS
from ..functions.text import contains_any
from .quality import first_wins


def score_links(links: DataFrame) -> DataFrame:
    """Valid links(query, url, title, snippet, seq) with score."""
    return links.where(S.is_valid_url("url")).withColumn("score", S.url_score("url", "title", "snippet"))


def top_links(links: DataFrame, n: int = 5, seq: str = "seq") -> DataFrame:
    """The n best links of each query, earlier ones first at equal score."""
    w = W.partitionBy("query").orderBy(F.desc("score"), seq)
    return links.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def prefer_or_all(links: DataFrame) -> DataFrame:
    """Only preferred hosts for queries that have any, else all."""
    pref = S.is_preferred_host("url")
    return links.withColumn("_any", F.max(pref).over(W.partitionBy("query"))).where(~F.col("_any") | pref).drop("_any")


def fill_with_snippets(texts: DataFrame, links: DataFrame, n: int) -> DataFrame:
    """texts(query, url, text, seq) first; for queries under n of them title and snippet (20 or more characters) of links not used, until n."""
    have = texts.groupBy("query").agg(F.count("*").alias("_have"))
    spare = links.where(F.length(F.trim("snippet")) >= 20).join(texts.select("query", "url").distinct(), ["query", "url"], "left_anti").join(have, "query", "left")
    spare = spare.withColumn("_k", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "seq"))).where(F.col("_k") + F.coalesce("_have", F.lit(0)) <= n)
    text = F.concat_ws("\n", F.trim("title"), F.trim("snippet"))
    return texts.select("query", "url", "text", F.lit("web").alias("source_type"), "seq").union(spare.select("query", "url", text, F.lit("web_snippet"), "seq"))


def fallback_queries(results: DataFrame, n: int, query_seq: str = "query_seq", seq: str = "seq") -> DataFrame:
    """Results of further queries only while those before gave under n/2; n in all. For one topic's results."""
    per = results.groupBy("topic", query_seq).agg(F.count("*").alias("_n"))
    before = per.withColumn("_before", F.coalesce(F.sum("_n").over(W.partitionBy("topic").orderBy(query_seq).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    used = results.join(before.where(F.col("_before") < n / 2).select("topic", query_seq), ["topic", query_seq], "left_semi")
    return used.withColumn("_k", F.row_number().over(W.partitionBy("topic").orderBy(query_seq, seq))).where(F.col("_k") <= n).drop("_k")


def blocked_text_filter(links: DataFrame, seq: str = "seq", n: int = 5) -> DataFrame:
    """Older form: the first n links of a query without a blocked word, whose text is no challenge page."""
    ok = links.where(~contains_any(F.lower("url"), BLOCKED_LINK_WORDS))
    ok = ok.withColumn("_k", F.row_number().over(W.partitionBy("query").orderBy(seq))).where(F.col("_k") <= n).drop("_k")
    return ok.where(~S.is_blocked_text("text"))


def dedupe_plan(plan: DataFrame, seq: str = "seq") -> DataFrame:
    return first_wins(plan, ["tool", "query"], seq)


def ensure_fallback(plan: DataFrame, topics: DataFrame, tool: str = "wikipedia_search") -> DataFrame:
    """plan and, for topics(topic) without it, the fallback tool on the topic itself."""
    missing = topics.select(F.lit(tool).alias("tool"), F.col("topic").alias("query")).distinct().join(plan.select("tool", "query"), ["tool", "query"], "left_anti")
    return plan.unionByName(missing, allowMissingColumns=True)
