"""Registered queries of readers and of response parsing. Their texts are made from the given tables, in one SQL for either engine."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed, parse
from ..functions.text import any_of
from ..sources import io
from . import sql as D
from .registry import oracle_sql, query
from .tables import derive, plain


def _json(items: str) -> str:
    """A column as an array of JSON items, in DuckDB; null where the text is no JSON."""
    return f"unnest(CAST({items} AS json[]))"


_BLOCK = "coalesce(nullif(regexp_extract(response, '(?s)```json\\s*(\\{.*?\\})\\s*```', 1), ''), response)"


def _valid(source: str) -> str:
    """b(block_id, j): the JSON of each response; null if it has none, or no is_relevant."""
    return f"r AS ({plain(source)}), s AS (SELECT block_id, {_BLOCK} AS t FROM r), j AS (SELECT block_id, CASE WHEN json_valid(t) THEN t END AS j FROM s), b AS (SELECT block_id, j FROM j WHERE json_extract(j, '$.is_relevant') IS NOT NULL)"


_ATTRIBUTES = """SELECT p_partkey AS block_id, CASE WHEN p_size = 11 THEN 'no answer' WHEN p_size = 12 THEN concat('{"attributes": [{"attribute": "brand", "value": "', p_brand, '", "confidence": 0.5}]}')
WHEN p_size < 20 THEN concat('{"is_relevant": true, "attributes": [{"attribute": "brand", "value": "', p_brand, '", "confidence": 0.75}]}')
ELSE concat('Here: ```json {"is_relevant": true, "attributes": [{"attribute": "brand", "value": "', p_brand, '", "confidence": 0.9}, {"attribute": "size", "value": "', CAST(p_size AS string), '", "confidence": 0.8}, {"attribute": "kind", "value": "', p_type, '"}]} ```') END AS response FROM {part}"""
_ATTRIBUTE_ROWS = "a AS (SELECT block_id, " + _json("json_extract(j, '$.attributes')") + " AS a FROM b), f AS (SELECT block_id, json_extract_string(a, '$.attribute') AS attribute, json_extract_string(a, '$.value') AS value, CAST(json_extract_string(a, '$.confidence') AS double) AS confidence FROM a)"


@query(f"WITH {_valid(_ATTRIBUTES)}, {_ATTRIBUTE_ROWS} SELECT * FROM f WHERE attribute IS NOT NULL AND value IS NOT NULL AND confidence IS NOT NULL")
def parse_attribute_responses(spark, sf_dir):
    return parse.parse_attributes(derive(spark, sf_dir, _ATTRIBUTES))


@query(f"WITH {_valid(_ATTRIBUTES)}, {_ATTRIBUTE_ROWS}, c AS (SELECT p_partkey AS block_id, concat(p_name, ' of ', p_brand) AS text FROM part) SELECT f.*, 'block_' || block_id AS text_id, text AS source_text FROM f JOIN c USING (block_id) WHERE attribute IS NOT NULL AND value IS NOT NULL AND confidence IS NOT NULL")
def facts_from_responses(spark, sf_dir):
    chunks = derive(spark, sf_dir, "SELECT p_partkey AS block_id, concat(p_name, ' of ', p_brand) AS text FROM {part}")
    return parse.facts_from_responses(derive(spark, sf_dir, _ATTRIBUTES), chunks)["attributes"]


_ENTITIES = """SELECT c_custkey AS block_id, concat('{"is_relevant": true, "entities": [{"entity_name": "', c_name, '", "attributes": [{"attribute": "home", "value": "', n_name, '", "confidence": 1.0}, {"attribute": "key"}]}, {"entity_name": {"entity_name": "', lower(c_name), '"}, "attributes": [{"attribute": "segment", "value": "', c_mktsegment, '", "confidence": 0.75}]}, {"entity_name": "', n_name, '", "attributes": []}]}') AS response FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"""


@query(f"WITH {_valid(_ENTITIES)}, e AS (SELECT block_id, {_json("json_extract(j, '$.entities')")} AS e FROM b), a AS (SELECT block_id, coalesce(json_extract_string(e, '$.entity_name.entity_name'), json_extract_string(e, '$.entity_name')) AS entity, {_json("json_extract(e, '$.attributes')")} AS a FROM e), f AS (SELECT block_id, entity, json_extract_string(a, '$.attribute') AS attribute, json_extract_string(a, '$.value') AS value, CAST(json_extract_string(a, '$.confidence') AS double) AS confidence FROM a) SELECT * FROM f WHERE value IS NOT NULL AND confidence IS NOT NULL")
def parse_multi_entity_responses(spark, sf_dir):
    return parse.parse_entities(derive(spark, sf_dir, _ENTITIES))


_RELATIONS = """SELECT s_suppkey AS block_id, concat('{"is_relevant": false, "relations": [{"subject": "', s_name, '", "predicate": "based in", "object": "', n_name, '", "confidence": 0.9, "attributes": {"since": "', CAST(s_suppkey AS string), '"}}, {"subject": "', s_name, '", "predicate": "near", "object": "', lower(n_name), '", "confidence": 0.5}, {"subject": "', s_name, '", "predicate": "member of", "object": "Region of ', r_name, '", "confidence": 0.25}, {"subject": "x", "predicate": "without object", "confidence": 1.0}]}') AS response FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"""
_PREDICATE = f"regexp_matches(lower(predicate), {D.q(any_of(fixed.ATTRIBUTE_WORDS + fixed.ATTRIBUTE_PREDICATES))}) OR regexp_matches(lower(predicate), {D.q(any_of(fixed.EVENT_VERBS + fixed.EVENT_TYPES))})"
_OBJECT = f"regexp_full_match(trim(object), {D.q('(?i)(?:' + '|'.join(fixed.ATTRIBUTE_VALUES) + ')')}) OR regexp_matches(object, {D.q(chr(92) + 'd')}) OR NOT (regexp_matches(trim(object), {D.q('^' + chr(92) + 'p{Lu}')}) OR regexp_matches(lower(object), {D.q(any_of(fixed.ENTITY_WORDS))}))"


@query(f"WITH {_valid(_RELATIONS)}, a AS (SELECT block_id, {_json("json_extract(j, '$.relations')")} AS a FROM b), f AS (SELECT block_id, json_extract_string(a, '$.subject') AS subject, json_extract_string(a, '$.predicate') AS predicate, json_extract_string(a, '$.object') AS object, CAST(json_extract_string(a, '$.confidence') AS double) AS confidence, json_extract_string(a, '$.attributes.since') AS since FROM a) SELECT * FROM f WHERE subject IS NOT NULL AND object IS NOT NULL AND NOT ({_PREDICATE}) AND NOT ({_OBJECT})")
def parse_relation_responses(spark, sf_dir):
    out = parse.parse_relations(derive(spark, sf_dir, _RELATIONS))
    return out.select("block_id", "subject", "predicate", "object", "confidence", F.element_at("attributes", F.lit("since")).alias("since"))


_EVENTS = """SELECT event_id AS block_id, concat('Found ```json {"is_relevant": true, "events": [{"event_type": "', event_type, '", "anchor_entity": "user_', CAST(user_id AS string), '", "arguments": [{"role": "channel", "value": "web"}, {"role": "kind", "value": "', event_type, '"}], "confidence": 0.5}, {"event_type": "nobody", "arguments": [], "confidence": 1}]} ```') AS response FROM {events}"""


@query(f"WITH {_valid(_EVENTS)}, e AS (SELECT block_id, {_json("json_extract(j, '$.events')")} AS e FROM b), a AS (SELECT block_id, json_extract_string(e, '$.event_type') AS event_type, json_extract_string(e, '$.anchor_entity') AS anchor_entity, CAST(json_extract_string(e, '$.confidence') AS double) AS confidence, {_json("json_extract(e, '$.arguments')")} AS a FROM e) SELECT block_id, event_type, anchor_entity, confidence, json_extract_string(a, '$.role') AS role, json_extract_string(a, '$.value') AS value FROM a WHERE anchor_entity IS NOT NULL")
def parse_event_responses(spark, sf_dir):
    return parse.parse_events(derive(spark, sf_dir, _EVENTS)).select("block_id", "event_type", "anchor_entity", "confidence", F.inline("arguments"))


def _with_source(name: str, text: str) -> str:
    """The registered SQL of a response query, with text_id and the beginning of the chunk."""
    return f"SELECT f.*, 'block_' || f.block_id AS text_id, substr(c.text, 1, 200) AS source_text FROM ({oracle_sql()[name]}) f LEFT JOIN ({text}) c USING (block_id)"


#: Chunks of over and under 200 characters; every fifth block has none.
_RELATION_CHUNKS = "SELECT s_suppkey AS block_id, CASE WHEN s_suppkey % 2 = 0 THEN repeat(concat(s_name, ' '), 20) ELSE s_name END AS text FROM {supplier} WHERE s_suppkey % 5 > 0"
_EVENT_CHUNKS = "SELECT event_id AS block_id, concat('On event ', CAST(event_id AS string), ' of ', event_type) AS text FROM {events} WHERE event_id % 5 > 0"


@query(_with_source("parse_relation_responses", plain(_RELATION_CHUNKS)))
def facts_relations(spark, sf_dir):
    out = parse.facts_from_responses(derive(spark, sf_dir, _RELATIONS), derive(spark, sf_dir, _RELATION_CHUNKS))["relations"]
    return out.select("block_id", "subject", "predicate", "object", "confidence", F.element_at("attributes", F.lit("since")).alias("since"), "text_id", "source_text")


@query(_with_source("parse_event_responses", plain(_EVENT_CHUNKS)))
def facts_events(spark, sf_dir):
    out = parse.facts_from_responses(derive(spark, sf_dir, _EVENTS), derive(spark, sf_dir, _EVENT_CHUNKS))["events"]
    return out.select("block_id", "event_type", "anchor_entity", "confidence", "text_id", "source_text", F.inline("arguments"))


_MAPS = """SELECT s_suppkey AS block_id, CASE WHEN s_acctbal < 0 THEN 'none' ELSE concat('{"relations": {" basedIn ": "', n_name, '", "trades": ["wood", " iron ", ""], "empty": " "}}') END AS response FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey"""


@query(f"WITH r AS ({plain(_MAPS)}), j AS (SELECT block_id, CASE WHEN json_valid(response) THEN response END AS j FROM r), m AS (SELECT block_id, unnest(map_entries(CAST(json_extract(j, '$.relations') AS map(varchar, json)))) AS m FROM j), f AS (SELECT block_id, trim(m.key) AS predicate, unnest(CASE WHEN json_type(m.value) = 'ARRAY' THEN TRY_CAST(m.value AS varchar[]) ELSE [json_extract_string(m.value, '$')] END) AS object FROM m) SELECT block_id, predicate, trim(object) AS object FROM f WHERE trim(object) <> ''")
def parse_relation_maps(spark, sf_dir):
    return parse.parse_relation_map(derive(spark, sf_dir, _MAPS))


_CHOICES = """SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 THEN 'I cannot say' ELSE concat('My answer is {"choice": "', c_mktsegment, '"} as asked') END AS answer FROM {customer}"""


@query(f"WITH r AS ({plain(_CHOICES)}) SELECT id, CASE WHEN regexp_extract(answer, '\"choice\": \"([^\"]*)\"', 1) IN ('BUILDING', 'MACHINERY') THEN regexp_extract(answer, '\"choice\": \"([^\"]*)\"', 1) END AS choice FROM r")
def parse_judge_choices(spark, sf_dir):
    rows = derive(spark, sf_dir, _CHOICES).withColumn("candidates", F.array(F.lit("BUILDING"), F.lit("MACHINERY")))
    return rows.select("id", parse.parse_judge_choice("answer", "candidates").alias("choice"))


_NAMES = """SELECT s_suppkey AS id, CASE WHEN s_acctbal < 0 THEN concat('{"entity_name": "', s_name, '", "x": 1}') WHEN s_acctbal < 2000 THEN concat('{', s_name) ELSE s_name END AS name FROM {supplier}"""


@query(f"WITH r AS ({plain(_NAMES)}) SELECT id, CASE WHEN name LIKE '{{%' THEN coalesce(json_extract_string(CASE WHEN json_valid(name) THEN name END, '$.entity_name'), name) ELSE name END AS name FROM r")
def unwrap_entity_names(spark, sf_dir):
    return derive(spark, sf_dir, _NAMES).select("id", parse.unwrap_entity_name("name").alias("name"))


#: Lists of records in the forms that a literal has: either quote, booleans, None, trailing commas, an apostrophe, numbers, tuples; nan, null and broken ones.
_LITERALS = """SELECT o_orderkey AS id, CASE o_orderkey % 9
    WHEN 0 THEN concat('[{', chr(39), 'status', chr(39), ': ', chr(39), o_orderstatus, chr(39), ', ', chr(39), 'priority', chr(39), ': ', chr(39), o_orderpriority, chr(39), '}, {', chr(39), 'status', chr(39), ': ', chr(39), 'again', chr(39), '}]')
    WHEN 1 THEN concat('[{"status": True, ', chr(39), 'priority', chr(39), ': None}, {"status": False, "priority": "', o_orderpriority, '"},]')
    WHEN 2 THEN concat('[ {', chr(39), 'status', chr(39), ' : "', o_orderstatus, chr(39), 's", ', chr(39), 'priority', chr(39), ': ', CAST(o_custkey AS string), ',}, ]')
    WHEN 3 THEN concat('({', chr(39), 'status', chr(39), ': ', chr(39), 'a ', chr(92), chr(39), 'b', chr(92), chr(39), ' "c"', chr(39), ', ', chr(39), 'priority', chr(39), ': -', CAST(o_custkey AS string), '.25},)')
    WHEN 4 THEN 'nan' WHEN 5 THEN NULL WHEN 6 THEN '[]' WHEN 7 THEN concat('[{', chr(39), 'status', chr(39), ': ', o_orderstatus) ELSE concat('[{"status": "', o_orderstatus, '"}] tail') END AS text, o_orderstatus, o_orderpriority, o_custkey
FROM {orders}"""


@query(f"""WITH r AS ({plain(_LITERALS)})
SELECT id, o_orderstatus AS status, o_orderpriority AS priority FROM r WHERE id % 9 = 0 UNION ALL SELECT id, 'again', NULL FROM r WHERE id % 9 = 0
UNION ALL SELECT id, 'true', NULL FROM r WHERE id % 9 = 1 UNION ALL SELECT id, 'false', o_orderpriority FROM r WHERE id % 9 = 1
UNION ALL SELECT id, o_orderstatus || chr(39) || 's', CAST(o_custkey AS varchar) FROM r WHERE id % 9 = 2
UNION ALL SELECT id, 'a ' || chr(39) || 'b' || chr(39) || ' "c"', '-' || o_custkey || '.25' FROM r WHERE id % 9 = 3""")
def parse_literal_lists(spark, sf_dir):
    rows = derive(spark, sf_dir, _LITERALS).select("id", F.explode(parse.parse_literal_lists("text")).alias("m"))
    return rows.select("id", F.element_at("m", F.lit("status")).alias("status"), F.element_at("m", F.lit("priority")).alias("priority"))


_TASKS = "SELECT r_name AS task, lower(substr(r_name, 1, 3)) AS prefix, concat('About ', r_name, ': %s (end)') AS template FROM {region}"
_CHUNKS = "SELECT p_partkey AS block_id, CASE WHEN p_size = 3 THEN '  ' WHEN p_size = 4 THEN NULL ELSE p_name END AS text FROM {part}"


@query(f"WITH c AS ({plain(_CHUNKS)}), t AS ({plain(_TASKS)}) SELECT prefix || '_section_' || block_id AS custom_id, task, replace(template, '%s', text) AS prompt FROM c, t WHERE trim(text) <> ''")
def render_requests(spark, sf_dir):
    return parse.render_requests(derive(spark, sf_dir, _CHUNKS), derive(spark, sf_dir, _TASKS))


# --- readers -------------------------------------------------------------------------------------
_LINES = """SELECT s_suppkey AS id, CASE WHEN s_acctbal < 0 THEN concat('{"subject": "', s_name) WHEN s_acctbal < 1000 THEN '  ' ELSE concat('{"subject": "', s_name, '", "predicate": "basedIn", "object": "', n_name, '", "confidence": 0.5}') END AS value FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey"""


@query(f"WITH r AS ({plain(_LINES)}), j AS (SELECT value, json_valid(value) AS ok FROM r WHERE trim(value) <> '') SELECT 'good' AS kind, json_extract_string(CASE WHEN ok THEN value END, '$.subject') AS subject, json_extract_string(CASE WHEN ok THEN value END, '$.predicate') AS predicate, json_extract_string(CASE WHEN ok THEN value END, '$.object') AS object, 0.5::double AS confidence FROM j WHERE ok UNION ALL SELECT 'malformed', value, NULL, NULL, NULL FROM j WHERE NOT ok")
def read_triple_lines(spark, sf_dir):
    good, bad = io.split_json_lines(derive(spark, sf_dir, _LINES).select("value"))
    null = F.lit(None).cast("string")
    return good.select(F.lit("good").alias("kind"), "subject", "predicate", "object", "confidence").union(bad.select(F.lit("malformed"), "value", null, null, null.cast("double")))


_DOCUMENTS = """SELECT CASE WHEN p_size < 10 THEN concat('{"content": "', p_name, '", "text": "x"}') WHEN p_size < 20 THEN concat('{"text": "', p_name, ' text"}') WHEN p_size < 30 THEN concat('{"title": "', p_name, '", "summary": "', p_brand, '"}') WHEN p_size < 40 THEN concat('"', p_name, '"') ELSE concat('{"other": "', p_name, '"}') END AS value, p_name, p_brand, p_size FROM {part}"""


@query(f"WITH r AS ({plain(_DOCUMENTS)}), t AS (SELECT CASE WHEN p_size < 10 THEN p_name WHEN p_size < 20 THEN p_name || ' text' WHEN p_size < 30 THEN p_name || ' ' || p_brand WHEN p_size < 40 THEN p_name END AS text FROM r) SELECT text, count(*) AS n FROM t WHERE text IS NOT NULL GROUP BY 1")
def read_document_lines(spark, sf_dir):
    return io.document_text(derive(spark, sf_dir, _DOCUMENTS).select("value")).groupBy("text").agg(F.count("*").alias("n"))


_PAIRS = """SELECT concat('{"', s_name, '": "', n_name, '", "key', CAST(s_suppkey AS string), '": "', s_name, '"}') AS value, s_name, s_suppkey, n_name FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey"""


@query(f"WITH r AS ({plain(_PAIRS)}) SELECT s_name AS key, n_name AS value FROM r UNION ALL SELECT 'key' || s_suppkey, s_name FROM r")
def read_json_map(spark, sf_dir):
    return io.json_map(derive(spark, sf_dir, _PAIRS).select("value"))


_RECORDS = """SELECT concat('{"', s_name, CASE WHEN s_acctbal < 1000 THEN '_simbad' WHEN s_acctbal < 4000 THEN '_info_box' WHEN s_acctbal < 7000 THEN '_wikidata' ELSE '_other' END, '":{"key":', CAST(s_suppkey AS string), ',"list":[1,2]}}') AS value, s_name, s_suppkey, s_acctbal FROM {supplier}"""


@query(f"""WITH r AS ({plain(_RECORDS)}) SELECT s_name AS entity, CASE WHEN s_acctbal < 1000 THEN 'simbad' WHEN s_acctbal < 4000 THEN 'info_box' ELSE 'wikidata' END AS source_kind, '{{"key":' || s_suppkey || ',"list":[1,2]}}' AS payload FROM r WHERE s_acctbal < 7000""")
def read_structured_data(spark, sf_dir):
    return io.structured_data(derive(spark, sf_dir, _RECORDS).select("value"))


_SEEDS = """SELECT CASE WHEN s_acctbal < 0 THEN NULL WHEN s_acctbal < 1000 THEN '  ' WHEN s_acctbal < 3000 THEN concat('{"type": "entity", "value": " ', s_name, '"}') WHEN s_acctbal < 5000 THEN concat('{"direct_question": "', s_name, '?"}') WHEN s_acctbal < 7000 THEN concat('{"entity_name": "', s_name, '"}') ELSE concat(' ', s_name) END AS json, s_name, s_acctbal FROM {supplier}"""


@query(f"""WITH r AS ({plain(_SEEDS)}) SELECT CASE WHEN s_acctbal < 3000 THEN 'entity' WHEN s_acctbal < 5000 THEN 'direct_question' ELSE 'topic' END AS type, CASE WHEN s_acctbal < 3000 THEN s_name WHEN s_acctbal < 5000 THEN s_name || '?' WHEN s_acctbal < 7000 THEN '{{"entity_name": "' || s_name || '"}}' ELSE s_name END AS value FROM r WHERE s_acctbal >= 1000""")
def read_seed_items(spark, sf_dir):
    return io.seed_items(derive(spark, sf_dir, _SEEDS).select("json"))


_RESULTS = """SELECT concat('{"triple_list": [{"head": "', s_name, '", "head_type": "Supplier", "relation": "in", "relation_type": "place", "tail": "', n_name, '", "tail_type": "', CASE WHEN s_acctbal < 0 THEN 'Land' ELSE 'Nation' END, '"}], "entity_list": [{"name": "', n_name, '", "type": "Nation"}], "relation_list": [{"head": "', s_name, '", "tail": "', n_name, '", "relation": "near"}], "event_list": [{"event_type": "Sale", "event_trigger": "', s_name, '", "event_argument": {"place": "', n_name, '"}}]}') AS value, s_name, n_name, s_acctbal FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey"""
_FACTS = f"r AS ({plain(_RESULTS)}), f AS (SELECT 'entity' AS kind, n_name AS subject, NULL AS predicate, NULL AS object, 'Nation' AS subject_type, NULL AS object_type FROM r UNION ALL SELECT 'relation', s_name, 'near', n_name, NULL, NULL FROM r UNION ALL SELECT 'triple', s_name, 'in', n_name, 'Supplier', CASE WHEN s_acctbal < 0 THEN 'Land' ELSE 'Nation' END FROM r UNION ALL SELECT 'event', s_name, 'place', n_name, 'Sale', NULL FROM r)"


@query(f"WITH {_FACTS} SELECT * FROM f")
def ingest_ie_results(spark, sf_dir):
    return io.ingest_ie_results(derive(spark, sf_dir, _RESULTS).select("value"))


@query(f"WITH {_FACTS} SELECT * FROM f WHERE subject_type = 'Supplier' AND predicate IN ('in', 'near') AND object_type = 'Nation'")
def constraint_filter(spark, sf_dir):
    facts = io.ingest_ie_results(derive(spark, sf_dir, _RESULTS).select("value"))
    return io.constraint_filter(facts, heads=["Supplier"], relations=["in", "near"], tails=["Nation"])


@query("SELECT 'DOCUMENTS' AS kind, doc_id AS id, source AS label FROM documents UNION ALL SELECT 'PAGES', page_id, NULL FROM pages")
def union_facts(spark, sf_dir):
    a = derive(spark, sf_dir, "SELECT 'DOCUMENTS' AS kind, doc_id AS id, source AS label FROM {documents}")
    return io.union_facts(a, derive(spark, sf_dir, "SELECT 'PAGES' AS kind, page_id AS id FROM {pages}"))


@query("SELECT '03_knowledge_auditing' AS stage, s_name AS subject, n_name AS object FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def resume_from_stage(spark, sf_dir):
    """Two stages are written as tables in the shared folder; the later one is found and read."""
    import uuid

    from ..operators.stage import stage_root

    facts = derive(spark, sf_dir, "SELECT s_name AS subject, n_name AS object FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey")
    root = f"{stage_root(spark)}/stages-{uuid.uuid4().hex}"
    for stage in io.STAGES[1:3]:
        io.write_stage(facts, root, stage, "facts")
    stage, found = io.resume_from_stage(spark, root, {s: "facts" for s in io.STAGES})
    return found.select(F.lit(stage).alias("stage"), "subject", "object")
