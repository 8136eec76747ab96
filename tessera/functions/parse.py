"""Facts out of model responses: JSON blocks, five response shapes, requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .literals import parse_literal_lists  # noqa: F401
from .scores import relation_reject_reason
from .text import col, preview

ATTRIBUTES = "struct<is_relevant:boolean,attributes:array<struct<attribute:string,value:string,confidence:double>>>"
RELATIONS = "struct<is_relevant:boolean,relations:array<struct<subject:string,predicate:string,object:string,confidence:double,attributes:string>>>"
EVENTS = "struct<is_relevant:boolean,events:array<struct<event_type:string,anchor_entity:string,arguments:array<struct<role:string,value:string>>,confidence:double>>>"
ENTITIES = "struct<is_relevant:boolean,entities:array<struct<entity_name:string,attributes:array<struct<attribute:string,value:string,confidence:double>>>>>"


def extract_json_block(text) -> Column:
    """The fenced object, else the whole text."""
    t = col(text)
    return F.coalesce(F.nullif(F.regexp_extract(t, r"(?s)```json\s*(\{.*?\})\s*```", 1), F.lit("")), t)


def extract_judge_block(text) -> Column:
    """From the first { to the last }."""
    return F.nullif(F.regexp_extract(col(text), r"(?s)\{.*\}", 0), F.lit(""))


def parse_judge_choice(text, candidates) -> Column:
    choice = F.get_json_object(extract_judge_block(text), "$.choice")
    return F.when(F.array_contains(col(candidates), choice), choice)


def unwrap_entity_name(name) -> Column:
    """Of a name that is a JSON object, its entity_name."""
    n = col(name)
    return F.when(n.startswith("{"), F.coalesce(F.get_json_object(n, "$.entity_name"), n)).otherwise(n)


def _parsed(responses: DataFrame, schema: str) -> DataFrame:
    return responses.withColumn("_j", F.from_json(extract_json_block("response"), schema)).where("_j.is_relevant is not null")


def parse_attributes(responses: DataFrame) -> DataFrame:
    """(block_id, attribute, value, confidence); items with a missing key go."""
    rows = _parsed(responses, ATTRIBUTES).select("block_id", F.inline("_j.attributes"))
    return rows.where("attribute is not null and value is not null and confidence is not null")


def parse_entities(responses: DataFrame) -> DataFrame:
    """(block_id, entity, attribute, value, confidence) of many-entity responses; names that are objects are unwrapped."""
    rows = _parsed(responses, ENTITIES).select("block_id", F.inline("_j.entities"))
    rows = rows.select("block_id", unwrap_entity_name("entity_name").alias("entity"), F.inline("attributes"))
    return rows.where("entity is not null and attribute is not null and value is not null and confidence is not null")


def parse_relations(responses: DataFrame, strict: bool = False) -> DataFrame:
    rows = _parsed(responses, RELATIONS).select("block_id", F.inline("_j.relations"))
    rows = rows.where("subject is not null and predicate is not null and object is not null and confidence is not null")
    rows = rows.where(relation_reject_reason("predicate", "object", strict).isNull())
    return rows.withColumn("attributes", F.coalesce(F.from_json("attributes", "map<string,string>"), F.expr("map()").cast("map<string,string>")))


def parse_events(responses: DataFrame) -> DataFrame:
    rows = _parsed(responses, EVENTS).select("block_id", F.inline("_j.events"))
    return rows.where("event_type is not null and anchor_entity is not null and arguments is not null and confidence is not null")


def parse_relation_map(responses: DataFrame) -> DataFrame:
    """(block_id, predicate, object) of {"relations": {predicate: object or [objects]}}."""
    m = F.from_json(F.get_json_object(extract_json_block("response"), "$.relations"), "map<string,string>")
    rows = responses.select("block_id", F.explode(m).alias("predicate", "_v"))
    many = F.coalesce(F.when(F.col("_v").startswith("["), F.from_json("_v", "array<string>")), F.array("_v"))
    rows = rows.select("block_id", F.trim("predicate").alias("predicate"), F.explode(many).alias("object")).withColumn("object", F.trim("object"))
    return rows.where("predicate != '' and object != ''")


def facts_from_responses(responses: DataFrame, chunks: DataFrame, default: float = 0.5) -> dict[str, DataFrame]:
    """attributes, relations and events with text_id block_<i> and the first 200 characters of their chunk."""
    def with_source(df):
        src = chunks.select("block_id", preview("text").alias("source_text"))
        out = df.join(src, "block_id", "left").withColumn("text_id", F.concat(F.lit("block_"), F.col("block_id").cast("string")))
        return out.withColumn("confidence", F.coalesce("confidence", F.lit(default)))

    return {"attributes": with_source(parse_attributes(responses)), "relations": with_source(parse_relations(responses)), "events": with_source(parse_events(responses))}


def render_requests(chunks: DataFrame, tasks: DataFrame) -> DataFrame:
    """(custom_id, task, prompt): each chunk with text by each of tasks(task, prefix, template with one %s). Up to 1,000 tasks are broadcast."""
    some = chunks.where(F.coalesce(F.trim("text"), F.lit("")) != "")
    both = some.crossJoin(F.broadcast(tasks) if tasks.count() <= 1000 else tasks)
    return both.select(F.concat_ws("_", "prefix", F.lit("section"), F.col("block_id").cast("string")).alias("custom_id"), "task", F.replace("template", F.lit("%s"), F.col("text")).alias("prompt"))
