"""Tables that the registered queries derive from the given ones, with the same SQL for either engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NAMES = ("region", "nation", "supplier", "customer", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "labels", "conversations")

TRIPLES = """
SELECT n_name AS subject, 'locatedIn' AS predicate, r_name AS object, CAST(1.0 AS double) AS confidence, concat('A', lpad(CAST(n_nationkey AS string), 9, '0')) AS seq
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
UNION ALL SELECT s_name, 'basedIn', n_name, CAST(0.95 AS double), concat('B', lpad(CAST(s_suppkey AS string), 9, '0')) FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
UNION ALL SELECT c_name, 'has home', n_name, CAST(CASE WHEN c_acctbal < 0 THEN 0.5 ELSE 0.9 END AS double), concat('C', lpad(CAST(c_custkey AS string), 9, '0')) FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
UNION ALL SELECT n_name, 'partOf', CASE WHEN n_nationkey % 5 = 0 THEN n_name ELSE r_name END, CAST(0.4 AS double), concat('D', lpad(CAST(n_nationkey AS string), 9, '0')) FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
UNION ALL SELECT p_name, 'brand name', CASE WHEN p_partkey % 50 = 0 THEN 'unknown' ELSE p_brand END, CAST(1.0 AS double), concat('E', lpad(CAST(p_partkey AS string), 9, '0')) FROM {part}
UNION ALL SELECT concat('Part#', CAST(l_partkey AS string)), 'suppliedBy', concat('Supplier#', CAST(l_suppkey AS string)), CAST(round(1 - l_discount * 3, 2) AS double),
  concat('F', lpad(CAST(l_orderkey AS string), 9, '0'), lpad(CAST(l_linenumber AS string), 3, '0'), lpad(CAST(l_partkey AS string), 9, '0'), lpad(CAST(l_suppkey AS string), 9, '0')) FROM {lineitem}
"""

LINKS = """
SELECT page_id % 20 AS query, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, substr(regexp_replace(html, '<[^>]+>', ' '{flag}), 1, 200) AS snippet, page_id AS seq FROM {pages}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, sql: str, **texts: str) -> DataFrame:
    """sql over the given tables, by the names in braces."""
    for k, v in texts.items():
        sql = sql.replace("{" + k + "}", v)
    for n in NAMES:
        if "{" + n + "}" in sql:
            table(spark, sf_dir, n).createOrReplaceTempView(f"given_{n}")
            sql = sql.replace("{" + n + "}", f"given_{n}")
    return spark.sql(sql)


def plain(sql: str, **texts: str) -> str:
    """The same sql by plain table names."""
    for k, v in (texts | {n: n for n in NAMES}).items():
        sql = sql.replace("{" + k + "}", v)
    return sql


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, TRIPLES)


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, LINKS, flag="")


def event_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with anchor user_<id> and arguments k, value (numbers) and channel (string)."""
    e = table(spark, sf_dir, "events")
    arg = lambda role, value, kind: F.struct(F.lit(role).alias("role"), value.alias("value"), F.lit(kind).alias("value_type"))
    args = F.array(arg("k", F.get_json_object("props", "$.k"), "number"), arg("value", F.col("value").cast("string"), "number"), arg("channel", F.col("event_type"), "string"))
    return e.select(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("anchor_entity"), "event_type", args.alias("arguments"), F.lit(1.0).alias("confidence"), F.col("event_id").alias("seq"))


#: Events as they come: types in either case, with blanks; values untrimmed, of six words, equal to the anchor; empty and null roles, a role named event_type, no arguments.
MIXED_EVENTS = """
SELECT event_id AS seq, concat('user_', CAST(user_id AS string)) AS anchor_entity,
  CASE event_id % 4 WHEN 0 THEN concat(upper(substr(event_type, 1, 1)), substr(event_type, 2), ' Seen') WHEN 1 THEN concat(event_type, ' seen') ELSE event_type END AS event_type,
  CASE WHEN event_id % 3 = 0 THEN concat('s', CAST(event_id % 5 AS string)) END AS source_id,
  concat('  ', event_type, ' ') AS channel, CAST(event_id % 17 AS string) AS k, CASE WHEN event_id % 7 = 0 THEN 'one two three four five six' WHEN event_id % 7 < 3 THEN concat('User_', CAST(user_id AS string)) ELSE concat('Page ', CAST(event_id % 23 AS string)) END AS note,
  event_id % 5 = 0 AS overridden, event_id % 11 = 0 AS bare
FROM {events}
"""


def mixed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = derive(spark, sf_dir, MIXED_EVENTS)
    arg = lambda role, value, kind: F.struct(F.lit(role).cast("string").alias("role"), value.alias("value"), F.lit(kind).alias("value_type"))
    args = F.array(arg("channel", F.lit("early"), "string"), arg("k", F.col("k"), "number"), arg("channel", F.col("channel"), "string"), arg("", F.col("k"), "string"), arg(None, F.col("k"), "string"), arg("note", F.col("note"), "string"))
    args = F.when(F.col("overridden"), F.array_append(args, arg("event_type", F.lit("Other"), "string"))).otherwise(args)
    return e.select("seq", "anchor_entity", "event_type", "source_id", F.when(~F.col("bare"), args).alias("arguments"))


def price_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims of unit prices: ts is the ship date, cs follows the supplier."""
    li = table(spark, sf_dir, "lineitem")
    order = [F.lpad(F.col(c).cast("string"), 10, "0") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    weight = F.element_at(F.array(*[F.lit(x) for x in (1.0, 0.9, 0.7, 0.5, 0.6)]), (F.col("l_suppkey") % 5 + 1).cast("int"))
    ts = F.unix_timestamp(F.col("l_shipdate").cast("timestamp"))
    price = F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100).cast("string")  # cents, as two engines round halves differently
    return li.select(F.concat(F.lit("Part#"), F.col("l_partkey").cast("string")).alias("src"), F.lit("unitPrice").alias("predicate"), price.alias("dst"), weight.alias("cs"), ts.cast("double").alias("ts"), F.concat(F.lpad(ts.cast("string"), 12, "0"), *order).alias("seq"))
