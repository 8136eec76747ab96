"""Readers and writers of the pipeline's files."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEED_TYPES = ("topic", "entity", "direct_question", "pdf")
STAGES = ("01_data_acquisition", "02_information_extraction", "03_knowledge_auditing", "04_canonicalization", "05_graph_construction")
TRIPLE = "subject string, predicate string, object string, confidence double, source_text string, text_id string, source_id string"


def seed_items(raw: DataFrame) -> DataFrame:
    """(type, value) of raw(json): an object or string for each row. {"type", "value"} and one-key objects of a known type are taken as such, any other object is a topic with its JSON text."""
    m = F.from_json("json", "map<string,string>")
    one = F.get(F.map_keys("m"), F.lit(0))
    df = raw.where("json is not null and trim(json) != ''").withColumn("m", F.when(F.col("json").startswith("{"), m))
    kind = F.when(F.map_contains_key("m", F.lit("type")) & F.map_contains_key("m", F.lit("value")), F.element_at("m", F.lit("type"))).when((F.size("m") == 1) & one.isin(*SEED_TYPES), one).otherwise("topic")
    value = F.when(F.map_contains_key("m", F.lit("type")) & F.map_contains_key("m", F.lit("value")), F.element_at("m", F.lit("value"))).when((F.size("m") == 1) & one.isin(*SEED_TYPES), F.element_at("m", one)).otherwise(F.col("json"))
    return df.select(kind.alias("type"), F.trim(value).alias("value")).where("value is not null and value != ''")


def read_seed_items(spark: SparkSession, path: str) -> DataFrame:
    """By ending: .json (list, object or string), .csv (first column) or lines of text."""
    if path.endswith(".json"):
        text = F.trim("value")
        rows = spark.read.text(path, wholetext=True).select(F.explode(F.when(text.startswith("["), F.from_json(text, "array<string>")).otherwise(F.array(text))).alias("json"))
        return seed_items(rows.withColumn("json", F.regexp_replace("json", '^"(.*)"$', "$1")))
    if path.endswith(".csv"):
        df = spark.read.csv(path, header=True)
        return seed_items(df.select(F.col(f"`{df.columns[0]}`").cast("string").alias("json")))
    return seed_items(spark.read.text(path).select(F.col("value").alias("json")))


def split_json_lines(lines: DataFrame, schema: str = TRIPLE) -> tuple[DataFrame, DataFrame]:
    """(good rows, malformed lines) of lines(value); blank lines are neither."""
    parsed = lines.where("trim(value) != ''").withColumn("_r", F.from_json("value", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    return parsed.where("_r._corrupt is null").select("_r.*").drop("_corrupt"), parsed.where("_r._corrupt is not null").select("value")


def read_triples(spark: SparkSession, path: str, schema: str = TRIPLE) -> tuple[DataFrame, DataFrame]:
    return split_json_lines(spark.read.text(path), schema)


def document_text(lines: DataFrame) -> DataFrame:
    """(text) of lines(value): content, else text, else title and summary; a plain string is its own text."""
    j = F.from_json("value", "content string, text string, title string, summary string")
    whole = F.concat_ws(" ", "j.title", "j.summary")
    text = F.coalesce("j.content", "j.text", F.nullif(whole, F.lit("")), F.when(~F.col("value").startswith("{"), F.regexp_replace("value", '^"(.*)"$', "$1")))
    return lines.withColumn("j", j).select(text.alias("text")).where("text is not null")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return document_text(spark.read.text(path))


def json_map(texts: DataFrame) -> DataFrame:
    """(key, value) of one JSON object a row of texts(value)."""
    return texts.select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "value"))


def read_json_map(spark: SparkSession, path: str) -> DataFrame:
    return json_map(spark.read.text(path, wholetext=True))


def structured_data(records: DataFrame) -> DataFrame:
    """(entity, source_kind, payload JSON) of records(value): one-key objects <entity>_(info_box|simbad|wikidata)."""
    flat = records.select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "payload"))
    pattern = "^(.*)_(info_box|simbad|wikidata)$"
    return flat.select(F.regexp_extract("key", pattern, 1).alias("entity"), F.regexp_extract("key", pattern, 2).alias("source_kind"), "payload").where("entity != ''")


def read_structured_data(spark: SparkSession, path: str) -> DataFrame:
    whole = spark.read.text(path, wholetext=True)
    return structured_data(whole.select(F.explode(F.from_json("value", "array<string>")).alias("value")))


def write_stage(df: DataFrame, root: str, stage: str, name: str, fmt: str = "parquet") -> str:
    """One folder for each fact type and stage."""
    path = f"{root}/{stage}/{name}"
    getattr(df.write.mode("overwrite"), fmt)(path)
    return path


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def resume_from_stage(spark: SparkSession, root: str, names: dict[str, str]) -> tuple[str | None, DataFrame | None]:
    """(last stage in order whose table names[stage] is there, that table)."""
    for stage in reversed(STAGES):
        if stage in names:
            try:
                return stage, spark.read.parquet(f"{root}/{stage}/{names[stage]}")
            except AnalysisException:
                continue
    return None, None


def entity_documents(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, document JSON): attributes and relationships of each node. Edges are pre-sorted lists of one source."""
    rel = edges.groupBy("src").agg(F.array_sort(F.collect_set(F.struct("predicate", F.col("dst").alias("target")))).alias("relationships"))
    both = nodes.join(rel.withColumnRenamed("src", "id"), "id", "left")
    none = F.expr("array()").cast("array<struct<predicate:string,target:string>>")
    return both.select("id", F.to_json(F.struct("id", "attributes", F.coalesce("relationships", none).alias("relationships"))).alias("document"))


def write_entity_documents(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    entity_documents(nodes, edges).select(F.col("document").alias("value")).write.mode("overwrite").text(path)


def stage_report(counts: dict[str, DataFrame]) -> DataFrame:
    """(stage, n) with each stage's share of the one before, 1 where there is none."""
    rows = [df.agg(F.count("*").alias("n")).select(F.lit(i).alias("step"), F.lit(name).alias("stage"), "n") for i, (name, df) in enumerate(counts.items())]
    all_rows = reduce(DataFrame.union, rows)
    before = all_rows.select((F.col("step") + 1).alias("step"), F.col("n").alias("_before"))
    return all_rows.join(before, "step", "left").select("stage", "n", F.coalesce(F.try_divide(F.col("n").cast("double"), F.col("_before")), F.when(F.col("_before").isNull(), 1.0).otherwise(0.0)).alias("rate"))


def union_facts(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def ingest_ie_results(texts: DataFrame) -> DataFrame:
    """(kind, subject, predicate, object, subject_type, object_type) of extraction results(value) of four shapes."""
    s = "entity_list array<struct<name:string,type:string>>, relation_list array<struct<head:string,tail:string,relation:string>>, event_list array<struct<event_type:string,event_trigger:string,event_argument:map<string,string>>>, triple_list array<struct<head:string,head_type:string,relation:string,relation_type:string,tail:string,tail_type:string>>"
    j = texts.select(F.from_json("value", s).alias("j"))
    null = F.lit(None).cast("string")
    names = ("kind", "subject", "predicate", "object", "subject_type", "object_type")
    row = lambda *cols: [c.alias(n) for c, n in zip(cols, names)]
    ent = j.select(F.inline("j.entity_list")).select(*row(F.lit("entity"), F.col("name"), null, null, F.col("type"), null))
    rel = j.select(F.inline("j.relation_list")).select(*row(F.lit("relation"), F.col("head"), F.col("relation"), F.col("tail"), null, null))
    tri = j.select(F.inline("j.triple_list")).select(*row(F.lit("triple"), F.col("head"), F.col("relation"), F.col("tail"), F.col("head_type"), F.col("tail_type")))
    eve = j.select(F.inline("j.event_list")).select("event_type", "event_trigger", F.explode_outer("event_argument").alias("role", "value")).select(*row(F.lit("event"), F.col("event_trigger"), F.col("role"), F.col("value"), F.col("event_type"), null))
    return ent.union(rel).union(tri).union(eve)


def constraint_filter(facts: DataFrame, heads: list[str] | None = None, relations: list[str] | None = None, tails: list[str] | None = None) -> DataFrame:
    """Facts whose types are in the allowed lists; a list left out allows all."""
    for column, allowed in (("subject_type", heads), ("predicate", relations), ("object_type", tails)):
        if allowed:
            table = facts.sparkSession.createDataFrame([(x,) for x in allowed], "t string")
            facts = facts.join(table.select(F.col("t").alias(column)), column, "left_semi").select(*facts.columns)
    return facts
