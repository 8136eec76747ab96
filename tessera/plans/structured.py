"""Registered queries of names, pages' structured parts, claims, plans and graph building, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed, html, text as T
from ..functions.text import any_of
from ..operators import canon, claims, evaluate, graph, links, provenance, quality, vectors
from ..operators.stage import delete_path, stage
from ..sources import io
from . import sql as D
from .registry import query
from .tables import derive, event_facts, plain, price_claims, table

# --- names and markup ----------------------------------------------------------------------------
_CAMEL = "SELECT concat(replace(initcap(p_name), ' ', ''), CAST(p_size AS string), p_type, 'x', CAST(p_partkey AS string)) AS name, p_name, p_size, p_type, p_partkey FROM {part}"
_NAME = "array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1:1]) || lower(w[2:])), '') || p_size || p_type || 'x' || p_partkey"
_SPLIT = "array_to_string(list_transform(range(1, length(name) + 1), lambda i: CASE WHEN i > 1 AND ((regexp_matches(name[i], '[A-Z]') AND NOT regexp_matches(name[i-1], '[A-Z\\s]')) OR (regexp_matches(name[i-1], '[a-zA-Z]') AND regexp_matches(name[i], '\\d')) OR (regexp_matches(name[i-1], '\\d') AND regexp_matches(name[i], '[a-zA-Z]'))) THEN ' ' || name[i] ELSE name[i] END), '')"


@query(f"WITH n AS (SELECT DISTINCT {_NAME} AS name FROM part) SELECT name, trim(regexp_replace({_SPLIT}, '\\s+', ' ', 'g')) AS plain FROM n")
def split_camel_case(spark, sf_dir):
    return derive(spark, sf_dir, _CAMEL).select("name").distinct().select("name", T.split_camel_case("name").alias("plain"))


_BOX = """SELECT p_partkey AS entity, concat('<html><body><p>x</p><table class="infobox vcard"><tbody><tr><th colspan="2">', p_name, '</th></tr><tr><th scope="row">Brand Name</th><td>', p_brand, '<sup class="reference">[1]</sup></td></tr><tr><th scope="row">size</th><td>', CAST(p_size AS string), ' &times; 10<sup>3</sup></td></tr><tr><td><b>Kind</b></td><td>', p_type, '<br>', p_name, '</td></tr><tr><th scope="row">None</th><td>unknown</td></tr></tbody></table></body></html>') AS html, p_name, p_brand, p_size, p_type FROM {part}"""


@query("SELECT p_partkey AS entity, unnest([{'label': 'Brand Name', 'value': p_brand}, {'label': 'size', 'value': p_size || ' × 10^3'}, {'label': 'Kind', 'value': p_type || ', ' || p_name}, {'label': 'None', 'value': 'unknown'}], recursive := true) FROM part")
def infobox_rows(spark, sf_dir):
    return html.infobox_rows(derive(spark, sf_dir, _BOX)).select("entity", "label", "value")


@query("SELECT p_partkey AS entity, unnest([{'label': 'brand_name', 'value': p_brand}, {'label': 'size', 'value': p_size || ' × 10^3'}, {'label': 'kind', 'value': p_type || ', ' || p_name}], recursive := true) FROM part")
def infobox_entries(spark, sf_dir):
    rows = html.infobox_rows(derive(spark, sf_dir, _BOX)).where(T.is_infobox_entry("label", "value"))
    return rows.select("entity", T.normalize_label("label").alias("label"), "value")


_WIKI = "SELECT p_partkey AS id, concat('{{box|x}} [[', p_name, '|', p_brand, ']] and [[', p_type, ']] <ref name=\"a\">cited</ref> <b>bold</b> [', CAST(p_size AS string), ']  end') AS text, p_brand, p_type FROM {part}"


@query(f"WITH w AS ({plain(_WIKI)}) SELECT id, p_brand || ' and ' || p_type || ' bold end' AS text FROM w")
def clean_wiki_markup(spark, sf_dir):
    return derive(spark, sf_dir, _WIKI).select("id", T.clean_wiki_markup("text").alias("text"))


_FORMULA = "SELECT p_partkey AS id, concat('mass', chr(10), '=', chr(10), CAST(p_size AS string), ' kg', chr(10), '+', chr(10), 'rest (', chr(10), p_name, chr(10), ')', chr(10), '^', chr(10), 'two') AS text, p_name, p_size FROM {part}"


@query(f"WITH w AS ({plain(_FORMULA)}) SELECT id, 'mass = ' || p_size || ' kg + rest (' || p_name || ')^two' AS text FROM w")
def clean_formula_newlines(spark, sf_dir):
    return derive(spark, sf_dir, _FORMULA).select("id", T.clean_formula_newlines("text").alias("text"))


@query("SELECT page_id, try_cast(nullif(regexp_extract(url, '[-+]?\\d*\\.?\\d+(?:[eE][-+]?\\d+)?'), '') AS double) AS number FROM pages")
def extract_number(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.extract_number("url").alias("number"))


# --- sections and claims -------------------------------------------------------------------------
_SECTIONS = """SELECT 'world' AS doc, r_name AS id, CAST(NULL AS string) AS parent, CASE WHEN r_regionkey = 4 THEN 'References' ELSE r_name END AS title, 'region' AS text FROM {region}
UNION ALL SELECT 'world', n_name, r_name, CASE WHEN n_nationkey = 7 THEN 'External links' ELSE n_name END, 'nation' FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
UNION ALL SELECT 'world', s_name, n_name, s_name, 'supplier' FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey"""


@query(f"""WITH RECURSIVE s AS ({plain(_SECTIONS)}), ok AS (SELECT * FROM s WHERE NOT regexp_full_match(lower(trim(title)), {D.q('|'.join(fixed.EXCLUDED_SECTIONS))})),
w(id, path, depth, text) AS (SELECT id, title, 0, text FROM ok WHERE parent IS NULL UNION ALL SELECT ok.id, w.path || ' > ' || ok.title, w.depth + 1, ok.text FROM ok JOIN w ON ok.parent = w.id) SELECT 'world' AS doc, id, path, depth, text FROM w""")
def section_tree_flatten(spark, sf_dir):
    return claims.section_tree_flatten(derive(spark, sf_dir, _SECTIONS))


_CLAIMS = """SELECT concat('Q', CAST(p_partkey + 1000 AS string)) AS qcode, concat('{"P31":[{"mainsnak":{"datatype":"wikibase-item","datavalue":{"value":{"id":"Q', CAST(p_size AS string), '"}}}}],"P2":[{"mainsnak":{"datatype":"quantity","datavalue":{"value":{"amount":"+', CAST(p_size AS string), '","unit":"http://x.org/entity/Q7"}}}}],"P3":[{"mainsnak":{"datatype":"time","datavalue":{"value":{"time":"+2001-01-01"}}}},{"mainsnak":{"datatype":"time","datavalue":{"value":{"time":"+2002-01-01"}}}}],"P4":[{"mainsnak":{"datatype":"globe-coordinate","datavalue":{"value":{"latitude":1.5,"longitude":2.25}}}}],"P5":[{"mainsnak":{"datatype":"monolingualtext","datavalue":{"value":{"text":"', p_name, '"}}}}]}') AS json, p_partkey, p_size, p_name FROM {part}"""
_LABELS = "SELECT concat('Q', CAST(n_nationkey AS string)) AS code, n_name AS label FROM {nation} UNION ALL SELECT 'P31', 'instance of' UNION ALL SELECT 'P3', 'time'"


@query(f"""SELECT 'Q' || (p_partkey + 1000) AS qcode, unnest([{{'label': 'instance of', 'value': coalesce(n.n_name, 'Q' || p_size)}}, {{'label': 'P2', 'value': p_size || ' ' || u.n_name}}, {{'label': 'time', 'value': '+2001-01-01; +2002-01-01'}}, {{'label': 'place', 'value': 'lat:1.5, lon:2.25'}}, {{'label': 'P5', 'value': p_name}}], recursive := true)
FROM part LEFT JOIN nation n ON n.n_nationkey = p_size CROSS JOIN (SELECT n_name FROM nation WHERE n_nationkey = 7) u""")
def flatten_claims(spark, sf_dir):
    overrides = derive(spark, sf_dir, "SELECT 'P4' AS code, 'place' AS label")
    return claims.flatten_claims(derive(spark, sf_dir, _CLAIMS).select("qcode", "json"), derive(spark, sf_dir, _LABELS), overrides)


@query(f"WITH l AS ({plain(_LABELS)}), c AS (SELECT DISTINCT unnest(['P31', 'P2', 'P3', 'P4', 'P5', 'Q7', 'Q' || p_size]) AS code FROM part) SELECT code FROM c WHERE code NOT IN (SELECT code FROM l)")
def unknown_codes(spark, sf_dir):
    return claims.unknown_codes(derive(spark, sf_dir, _CLAIMS).select("qcode", "json"), derive(spark, sf_dir, _LABELS)).select("code")


# --- articles and plans --------------------------------------------------------------------------
_ARTICLES = "SELECT doc_id, text, length(text) AS n FROM {documents}"
_PARTS = "list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: s <> '')"


@query(f"WITH d AS (SELECT doc_id, {_PARTS} AS s, doc_id % 30 AS box, doc_id % 2 = 0 AS ok FROM documents) SELECT doc_id, round(least(CASE WHEN len(s) > 0 THEN least(len(s) / 10.0::double, 1) * 0.3::double + least(list_sum(list_transform(s, lambda x: CASE WHEN length(x) >= 100 THEN 0.1::double WHEN length(x) >= 50 THEN 0.05::double ELSE 0::double END)), 0.2::double) ELSE 0 END + least(box / 20.0::double, 1) * 0.3::double + CASE WHEN ok THEN 0.2::double ELSE 0 END, 1), 6) AS score FROM d")
def article_quality(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    sections = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda s: s != "")
    a = d.select("doc_id", F.lit("").alias("title"), sections.alias("sections"), (F.col("doc_id") % 30).alias("infobox_size"), (F.col("doc_id") % 2 == 0).alias("exists"))
    return quality.article_quality(a).select("doc_id", F.round("score", 6).alias("score"))


@query("SELECT doc_id FROM documents WHERE lang = 'en' AND length(text) > 100 ORDER BY doc_id LIMIT 40")
def valid_articles(spark, sf_dir):
    """The first 40 are the operator's feature, a limit that its caller states."""
    a = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("summary"), (F.col("lang") == "en").alias("exists"))
    return quality.valid_articles(a, 40, "doc_id").select("doc_id")


@query(f"WITH m AS (SELECT avg({D.content_quality('text')}) AS a FROM documents), b AS (SELECT avg({D.content_quality('html')}) AS b FROM pages), c AS (SELECT avg((quality = 1)::int) AS c FROM labels), x AS (SELECT a, b, c, avg(l_discount) * 5 AS v, avg(l_tax) * 10 AS u, avg(1 - l_discount) AS w FROM lineitem, m, b, c GROUP BY 1, 2, 3) SELECT round(0.4::double * (b + a + c) / 3 + 0.6::double * (v + u + w) / 3, 6) AS overall_quality, array_to_string(list_filter([CASE WHEN b < 0.6 THEN 'filter web content harder' END, CASE WHEN a < 0.7 THEN 'extract articles better' END, CASE WHEN c < 0.6 THEN 'rank search results better' END, CASE WHEN v < 0.8 THEN 'validate triples harder' END, CASE WHEN u < 0.9 THEN 'detect more duplicates' END, CASE WHEN w < 0.7 THEN 'calibrate confidence' END], lambda z: z IS NOT NULL), '; ') AS advice FROM x")
def overall_quality(spark, sf_dir):
    from ..functions import scores as S

    m = table(spark, sf_dir, "pages").agg(F.avg(S.content_quality("html")).alias("web_content_quality"))
    m = m.join(table(spark, sf_dir, "documents").agg(F.avg(S.content_quality("text")).alias("wikipedia_content_quality")))  # one row each
    m = m.join(table(spark, sf_dir, "labels").agg(F.avg((F.col("quality") == 1).cast("int")).alias("search_result_quality")))
    m = m.join(table(spark, sf_dir, "lineitem").agg((F.avg("l_discount") * 5).alias("validity_rate"), (F.avg("l_tax") * 10).alias("uniqueness_rate"), F.avg(1 - F.col("l_discount")).alias("confidence_score")))
    return quality.overall_quality(m).select(F.round("overall_quality", 6).alias("overall_quality"), F.array_join("advice", "; ").alias("advice"))


_PLAN = "SELECT CASE WHEN c_acctbal < 3000 THEN 'wikipedia_search' ELSE 'web_search' END AS tool, c_mktsegment AS query, c_custkey AS seq FROM {customer}"
_TOPICS = "SELECT DISTINCT c_mktsegment AS topic FROM {customer} UNION ALL SELECT r_name FROM {region}"


@query(f"WITH p AS ({plain(_PLAN)}), d AS (SELECT tool, query, min(seq) AS seq FROM p GROUP BY 1, 2), t AS (SELECT DISTINCT topic FROM ({plain(_TOPICS)})) SELECT tool, query FROM d UNION ALL SELECT 'wikipedia_search', topic FROM t WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.tool = 'wikipedia_search' AND d.query = topic)")
def dedupe_plan(spark, sf_dir):
    return links.ensure_fallback(links.dedupe_plan(derive(spark, sf_dir, _PLAN)), derive(spark, sf_dir, _TOPICS)).select("tool", "query")


_TEXTS = "SELECT page_id % 20 AS query, url, 'body' AS text, page_id AS seq FROM {pages} WHERE page_id < 60"
_SPARE = "SELECT page_id % 20 AS query, url, concat(' title ', url) AS title, CASE WHEN page_id % 3 = 0 THEN 'short' ELSE concat('a snippet that is long enough ', CAST(page_id AS string)) END AS snippet, CAST(page_id % 7 AS double) AS score, page_id AS seq FROM {pages}"


@query(f"WITH t AS ({plain(_TEXTS)}), l AS ({plain(_SPARE)}), h AS (SELECT query, count(*) AS n FROM t GROUP BY 1), s AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, seq) AS k FROM l WHERE length(trim(snippet)) >= 20 AND NOT EXISTS (SELECT 1 FROM t WHERE t.query = l.query AND t.url = l.url)) SELECT query, url, text, 'web' AS source_type, seq FROM t UNION ALL SELECT s.query, url, trim(title) || chr(10) || trim(snippet), 'web_snippet', seq FROM s LEFT JOIN h USING (query) WHERE k + coalesce(n, 0) <= 5")
def fill_with_snippets(spark, sf_dir):
    return links.fill_with_snippets(derive(spark, sf_dir, _TEXTS), derive(spark, sf_dir, _SPARE), 5)


_FOUND = "SELECT c_mktsegment AS topic, c_nationkey AS query_seq, c_custkey AS seq FROM {customer}"


@query(f"WITH r AS ({plain(_FOUND)}), p AS (SELECT topic, query_seq, count(*) AS n FROM r GROUP BY 1, 2), b AS (SELECT topic, query_seq, coalesce(sum(n) OVER (PARTITION BY topic ORDER BY query_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM p), k AS (SELECT r.*, row_number() OVER (PARTITION BY topic ORDER BY query_seq, seq) AS k FROM r JOIN b USING (topic, query_seq) WHERE before < 12) SELECT topic, query_seq, seq FROM k WHERE k <= 24")
def fallback_queries(spark, sf_dir):
    return links.fallback_queries(derive(spark, sf_dir, _FOUND), 24)


_ORIGINS = "SELECT CASE WHEN page_id % 2 = 0 THEN 'web_search' ELSE 'pdf' END AS tool, page_id % 20 AS query, page_id, CASE WHEN page_id % 5 = 0 THEN 'own' END AS origin_type, CAST(NULL AS string) AS origin_value, CASE WHEN page_id % 4 > 0 THEN 'web' END AS source_type FROM {pages}"
_STEPS = "SELECT 'web_search' AS tool, n_nationkey AS query, 'entity' AS origin_type, n_name AS origin_value FROM {nation}"


@query(f"WITH c AS ({plain(_ORIGINS)}), p AS ({plain(_STEPS)}) SELECT c.page_id, coalesce(c.origin_type, p.origin_type) AS origin_type, coalesce(c.origin_value, p.origin_value) AS origin_value, coalesce(source_type, 'unknown') AS source_type FROM c LEFT JOIN p ON p.tool = c.tool AND p.query = c.query")
def annotate_origin(spark, sf_dir):
    return provenance.annotate_origin(derive(spark, sf_dir, _ORIGINS), derive(spark, sf_dir, _STEPS)).select("page_id", "origin_type", "origin_value", "source_type")


_SOURCES = "SELECT l_orderkey, l_linenumber, l_partkey AS source_block_index, CASE WHEN l_returnflag = 'R' THEN '' WHEN l_returnflag = 'A' THEN 'given' END AS source_text, l_linestatus AS preview FROM {lineitem}"


@query(f"WITH f AS ({plain(_SOURCES)}), b AS (SELECT p_partkey, p_name FROM part WHERE p_size > 10) SELECT l_orderkey, l_linenumber, source_block_index, coalesce(nullif(source_text, ''), p_name, preview) AS source_text FROM f LEFT JOIN b ON p_partkey = source_block_index")
def recover_source_text(spark, sf_dir):
    blocks = derive(spark, sf_dir, "SELECT p_partkey AS block_index, p_name AS text FROM {part} WHERE p_size > 10")
    return provenance.recover_source_text(derive(spark, sf_dir, _SOURCES), blocks).select("l_orderkey", "l_linenumber", "source_block_index", "source_text")


# --- canonical names -----------------------------------------------------------------------------
_NEW = "SELECT DISTINCT p_name AS term, 'entity' AS term_type FROM {part} UNION SELECT DISTINCT p_type, 'relation' FROM {part}"
_HELD = "SELECT 'entity' AS term_type, upper(replace(min(p_name), ' ', '')) AS canonical FROM {part}"


@query(f"""WITH t AS ({plain(_NEW)}), w AS (SELECT term, term_type, string_split(lower(term), ' ') AS w FROM t), c AS (SELECT term, term_type, CASE WHEN term_type = 'entity' THEN array_to_string(list_transform(w, lambda x: upper(x[1:1]) || x[2:]), '') ELSE array_to_string(list_transform(string_split_regex(trim(regexp_replace(term, '([A-Z])', ' \\1', 'g')), '[ _]+'), lambda x, i: CASE WHEN i = 1 THEN lower(x) ELSE upper(x[1:1]) || lower(x[2:]) END), '') END AS canonical FROM w), h AS ({plain(_HELD)})
SELECT term, c.term_type, coalesce(h.canonical, c.canonical) AS canonical FROM c LEFT JOIN h ON h.term_type = c.term_type AND lower(h.canonical) = lower(c.canonical)""")
def generated_names(spark, sf_dir):
    return canon.generated_names(derive(spark, sf_dir, _NEW), derive(spark, sf_dir, _HELD)).select("term", "term_type", "canonical")


_STAGED = "SELECT p_brand AS canonical, p_name AS term, p_partkey AS seq FROM {part}"


@query(f"WITH s AS ({plain(_STAGED)}), k AS (SELECT canonical || '_' || substr(md5(term), 1, 8) AS id, canonical, term FROM s) SELECT DISTINCT id, canonical AS canonical_name, term AS original_term FROM k")
def index_upsert(spark, sf_dir):
    return vectors.index_rows(derive(spark, sf_dir, _STAGED))


_REQUESTS = "SELECT o_orderkey AS id, 'entity' AS term_type, o_orderpriority AS term, o_orderstatus FROM {orders}"


@query(f"WITH r AS ({plain(_REQUESTS)}) SELECT id, CASE WHEN o_orderstatus = 'P' THEN 'A' ELSE 'B' END AS choice FROM r")
def judge_requests(spark, sf_dir):
    r = derive(spark, sf_dir, _REQUESTS)
    c = F.when(F.col("o_orderstatus") == "P", F.array(F.lit("C"), F.lit("A"))).otherwise(F.array(F.lit("C"), F.lit("B")))
    return canon.judge_requests(r.withColumn("candidates", c), lambda kind, term, options: min(options)).select("id", "choice")


# --- graph ---------------------------------------------------------------------------------------
_EDGES = "SELECT s_name AS subject, 'basedIn' AS predicate, n_name AS object, s_suppkey AS seq, s_acctbal AS confidence, map('since', CAST(s_suppkey AS string), 'confidence', 'own') AS attributes FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey UNION ALL SELECT n_name, 'in', CASE WHEN n_nationkey = 3 THEN n_name ELSE r_name END, 100000000 + n_nationkey, 1.5, CAST(NULL AS map<string,string>) FROM {nation} JOIN {region} ON n_regionkey = r_regionkey"


@query("SELECT s_name AS src, 'basedIn' AS predicate, n_name AS dst, 'own' AS confidence, CAST(s_suppkey AS varchar) AS seq, CAST(s_suppkey AS varchar) AS since FROM supplier JOIN nation ON s_nationkey = n_nationkey UNION ALL SELECT n_name, 'in', r_name, '1.5', CAST(100000000 + n_nationkey AS varchar), NULL FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 3")
def build_edges(spark, sf_dir):
    e = graph.build_edges(derive(spark, sf_dir, _EDGES), ("confidence", "seq"))
    return e.select("src", "predicate", "dst", *[F.element_at("props", F.lit(k)).alias(k) for k in ("confidence", "seq", "since")])


_PAYLOADS = """SELECT concat(s_name, '_info') AS key, concat('{"home":{"nation":"', n_name, '","codes":[1,2]},"key":', CAST(s_suppkey AS string), '}') AS json FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey"""


@query("WITH s AS (SELECT s_name, s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey) SELECT s_name AS entity, unnest([{'key': 'info_home_nation', 'value': n_name}, {'key': 'info_home_codes', 'value': '[1,2]'}, {'key': 'info_key', 'value': CAST(s_suppkey AS varchar)}], recursive := true) FROM s")
def flatten_attributes(spark, sf_dir):
    p = derive(spark, sf_dir, _PAYLOADS).select(F.split_part("key", F.lit("_"), F.lit(1)).alias("entity"), F.lit("info").alias("key"), "json")
    return graph.flatten_attributes(p)


@query("SELECT s_name || '_info' AS key, s_name AS node FROM supplier WHERE s_acctbal >= 0 UNION ALL SELECT s_name, s_name FROM supplier WHERE s_acctbal >= 0")
def link_attributes(spark, sf_dir):
    keys = derive(spark, sf_dir, "SELECT concat(s_name, '_info') AS key FROM {supplier} UNION ALL SELECT s_name FROM {supplier}")
    return graph.link_attributes(keys, derive(spark, sf_dir, "SELECT s_name AS id FROM {supplier} WHERE s_acctbal >= 0"))


_RAW = "SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 THEN upper(c_mktsegment) WHEN c_acctbal < 2000 THEN concat(' ', lower(c_mktsegment), ' ') ELSE c_name END AS entity, c_mktsegment, c_acctbal, c_name FROM {customer}"


@query(f"WITH r AS ({plain(_RAW)}) SELECT id, CASE WHEN c_acctbal < 2000 THEN 'Segment ' || c_mktsegment ELSE c_name END AS entity FROM r")
def map_structured_entity(spark, sf_dir):
    m = derive(spark, sf_dir, "SELECT DISTINCT lower(c_mktsegment) AS raw, concat('Segment ', c_mktsegment) AS canonical FROM {customer}")
    return graph.map_structured_entity(derive(spark, sf_dir, _RAW), m).select("id", "entity")


@query("WITH a AS (SELECT l_suppkey, l_returnflag, arg_max(CAST(l_orderkey AS varchar), {'a': l_orderkey, 'b': l_linenumber, 'c': l_partkey}) AS v FROM lineitem GROUP BY 1, 2) SELECT s_name AS id, max(v) FILTER (l_returnflag = 'A') AS a, max(v) FILTER (l_returnflag = 'R') AS r FROM supplier LEFT JOIN a ON l_suppkey = s_suppkey GROUP BY 1")
def build_nodes(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("node"))
    li = table(spark, sf_dir, "lineitem").join(s, "l_suppkey")
    attrs = li.select("node", F.col("l_returnflag").alias("name"), F.col("l_orderkey").cast("string").alias("value"), F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("seq"))
    n = graph.build_nodes(s.select(F.col("node").alias("id")), attrs)
    return n.select("id", F.element_at("attributes", F.lit("A")).alias("a"), F.element_at("attributes", F.lit("R")).alias("r"))


_OLD = "SELECT s_name AS id, map('home', CAST(s_nationkey AS string), 'name', 'old', 'kept', 'yes') AS attributes FROM {supplier} WHERE s_acctbal > 0"
_UP = "SELECT s_name AS id, map('home', 'new', 'name', 'other') AS attributes FROM {supplier} WHERE s_acctbal < 5000"


@query("SELECT s_name AS id, CASE WHEN s_acctbal < 5000 THEN 'new' ELSE CAST(s_nationkey AS varchar) END AS home, s_name AS name, CASE WHEN s_acctbal > 0 THEN 'yes' END AS kept FROM supplier")
def upsert_nodes(spark, sf_dir):
    out = graph.upsert_nodes(derive(spark, sf_dir, _OLD), derive(spark, sf_dir, _UP))
    return out.select("id", *[F.element_at("attributes", F.lit(k)).alias(k) for k in ("home", "name", "kept")])


@query("SELECT 'User ' || user_id AS anchor_entity, event_type, event_id AS seq FROM events WHERE user_id % 2 = 0 UNION ALL SELECT 'user_' || user_id, event_type, event_id FROM events WHERE user_id % 2 = 1")
def event_gate(spark, sf_dir):
    """Every event has confidence 1; users with an even number are mapped."""
    m = derive(spark, sf_dir, "SELECT DISTINCT concat('user_', CAST(user_id AS string)) AS raw, concat('User ', CAST(user_id AS string)) AS canonical FROM {events} WHERE user_id % 2 = 0")
    return graph.event_gate(event_facts(spark, sf_dir), m).select("anchor_entity", "event_type", "seq")


#: The ordered fold as a recursion: a row for each key and claim, the state a list of its targets.
_E = "struct_pack(dst := {0}, status := {1}, contested := {2}, vf := {3}, vt := {4}, cs := {5}, ts := {6})"
_KEPT = _E.format("x.dst", "CASE WHEN x.status = 'Current' AND better THEN 'History' ELSE x.status END", "CASE WHEN x.status = 'Current' AND beside THEN true ELSE x.contested END", "x.vf", "CASE WHEN x.status = 'Current' AND better THEN n_ts ELSE x.vt END", "x.cs", "x.ts")
_OWN = _E.format("n_dst", "n_status", "beside", "CASE WHEN n_status = 'Current' THEN n_ts ELSE own.vf END", "CASE WHEN n_status = 'Current' THEN own.vt ELSE n_ts END", "n_cs", "n_ts")
_WEIGHT = "[1.0, 0.9, 0.7, 0.5, 0.6][l_suppkey % 5 + 1]::double"
_FOLD = f"""c AS (SELECT 'Part#' || l_partkey AS src, CAST(CAST(floor(l_extendedprice / l_quantity * 100) AS bigint) AS varchar) AS n_dst, {_WEIGHT} AS n_cs, epoch(l_shipdate)::bigint::double AS n_ts,
  row_number() OVER (PARTITION BY l_partkey ORDER BY lpad(CAST(epoch(l_shipdate)::bigint AS varchar), 12, '0') || lpad(CAST(l_orderkey AS varchar), 10, '0') || lpad(CAST(l_linenumber AS varchar), 10, '0') || lpad(CAST(l_partkey AS varchar), 10, '0') || lpad(CAST(l_suppkey AS varchar), 10, '0')) AS k FROM lineitem),
f(src, k, state) AS (SELECT DISTINCT src, 0::bigint, CAST([] AS struct(dst varchar, status varchar, contested boolean, vf double, vt double, cs double, ts double)[]) FROM c
UNION ALL SELECT src, k, list_append(list_filter(kept, lambda x: x.dst <> n_dst), {_OWN}) FROM (
  SELECT *, list_transform(state, lambda x: {_KEPT}) AS kept, coalesce(list_filter(list_transform(state, lambda x: {_KEPT}), lambda x: x.dst = n_dst)[1], NULL) AS own, CASE WHEN best IS NULL OR better OR beside THEN 'Current' ELSE 'History' END AS n_status FROM (
    SELECT *, best IS NOT NULL AND coalesce(n_cs > best.cs AND n_ts >= best.ts, false) AS better, best IS NOT NULL AND NOT coalesce(n_cs > best.cs AND n_ts >= best.ts, false) AND coalesce(abs(n_cs - best.cs) <= 0.08::double AND abs(n_dst::double - best.dst::double) / abs(best.dst::double) <= 0.03::double, false) AS beside FROM (
      SELECT f.src, c.k, state, n_dst, n_cs, n_ts, list_reverse_sort(list_transform(list_filter(state, lambda x: x.status = 'Current' AND x.dst <> n_dst), lambda x: struct_pack(cs := x.cs, ts := x.ts, dst := x.dst)))[1] AS best FROM f JOIN c ON c.src = f.src AND c.k = f.k + 1)))),
e AS (SELECT src, unnest(state) AS e FROM (SELECT src, arg_max(state, k) AS state FROM f GROUP BY 1)),
edges AS (SELECT src, 'unitPrice' AS predicate, e.dst AS dst, e.status AS status, e.contested AS is_contested, e.vf AS valid_from, e.vt AS valid_to, e.cs AS cs, e.ts AS ts FROM e)"""


@query(f"WITH RECURSIVE {_FOLD} SELECT * FROM edges")
def numeric_conflict_fold(spark, sf_dir):
    return graph.resolve_conflicts(price_claims(spark, sf_dir))


@query(f"WITH RECURSIVE {_FOLD} SELECT status, is_contested, count(*) AS n, count(DISTINCT src) AS n_subjects FROM edges GROUP BY 1, 2")
def current_contested_counts(spark, sf_dir):
    e = graph.resolve_conflicts(price_claims(spark, sf_dir))
    return e.groupBy("status", "is_contested").agg(F.count("*").alias("n"), F.count_distinct("src").alias("n_subjects"))


@query(f"WITH RECURSIVE {_FOLD} SELECT 'current' AS kind, src, dst, valid_from, valid_to FROM edges WHERE status = 'Current' UNION ALL SELECT 'history', src, dst, valid_from, valid_to FROM edges WHERE status = 'History' UNION ALL SELECT 'contested', src, dst, valid_from, valid_to FROM edges WHERE is_contested")
def incremental_graph_views(spark, sf_dir):
    """The claims in two batches, the second over the first one's edges; then the three views."""
    c = price_claims(spark, sf_dir)
    ends, at = stage(c.select(F.explode(F.array("src", "dst")).alias("id")).distinct().withColumn("attributes", F.expr("map()").cast("map<string,string>")), "nodes", clean=True)
    none = ends.limit(0)
    nodes, edges = graph.incremental_graph_update(none, graph.resolve_conflicts(c.limit(0)), ends, c.where("ts < 1e9"))
    first, before = stage(edges, "edges", clean=True)
    _, edges = graph.incremental_graph_update(nodes, first, none, c.where("ts >= 1e9"))
    edges, _ = stage(edges, "edges", clean=True)
    for path in (at, before):
        delete_path(spark, path)
    views = [("current", graph.current_view), ("history", graph.history_view), ("contested", graph.contested_view)]
    parts = [f(edges).select(F.lit(k).alias("kind"), "src", "dst", "valid_from", "valid_to") for k, f in views]
    return parts[0].union(parts[1]).union(parts[2])


_DOCS = "SELECT n_name AS id, map('region', r_name) AS attributes FROM {nation} JOIN {region} ON n_regionkey = r_regionkey UNION ALL SELECT s_name, map('home', CAST(s_nationkey AS string)) FROM {supplier}"


@query("""SELECT n_name AS id, '{"id":"' || n_name || '","attributes":{"region":"' || r_name || '"},"relationships":[]}' AS document FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT s_name, '{"id":"' || s_name || '","attributes":{"home":"' || s_nationkey || '"},"relationships":[{"predicate":"basedIn","target":"' || n_name || '"}]}' FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def entity_documents(spark, sf_dir):
    edges = derive(spark, sf_dir, "SELECT s_name AS src, 'basedIn' AS predicate, n_name AS dst FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey")
    return io.entity_documents(derive(spark, sf_dir, _DOCS), edges)


@query("SELECT 'user_' || user_id AS anchor_entity, 'event_' || event_type || '_' || row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS attribute_key, event_type AS type, event_type AS channel, json_extract_string(props, '$.k') AS k FROM events")
def event_attribute_values(spark, sf_dir):
    e = graph.events_to_attributes(event_facts(spark, sf_dir))
    return e.select("anchor_entity", "attribute_key", *[F.get_json_object("value", f"$.{p}").alias(n) for p, n in (("event_type", "type"), ("channel", "channel"), ("k", "k"))])


# --- scores --------------------------------------------------------------------------------------
_SEQ = "l_linenumber * 1000000000000 + l_partkey * 100000 + l_suppkey AS seq"
_GOLD = f"SELECT l_orderkey AS row_id, l_returnflag AS e, concat('v', CAST(l_suppkey % 6 AS string)) AS v, {_SEQ} FROM {{lineitem}}"
_GUESS = f"SELECT l_orderkey AS row_id, concat(' ', lower(l_returnflag)) AS e, concat('V', CAST((l_suppkey + l_partkey % 3) % 6 AS string), ' ') AS v, {_SEQ} FROM {{lineitem}} WHERE l_partkey % 7 > 0"
#: A value is as near to the next one as the threshold asks, nearer to the one before.
_NEAR = "SELECT concat('v', CAST(i AS string)) AS a, concat('v', CAST((i + 1) % 6 AS string)) AS b, CAST(0.9 AS double) AS score FROM (SELECT DISTINCT l_suppkey % 6 AS i FROM {lineitem}) x UNION ALL SELECT concat('v', CAST((i + 1) % 6 AS string)), concat('v', CAST(i AS string)), CAST(0.95 AS double) FROM (SELECT DISTINCT l_suppkey % 6 AS i FROM {lineitem}) y"


@query(f"""WITH RECURSIVE g AS ({plain(_GOLD)}), p AS ({plain(_GUESS)}), near AS ({plain(_NEAR)}),
o AS (SELECT p.row_id, p.e, p.seq, list(g.seq ORDER BY CASE WHEN lower(trim(p.v)) = g.v THEN 1 ELSE score END DESC, g.seq) AS o
  FROM p JOIN g ON g.row_id = p.row_id AND lower(trim(g.e)) = trim(p.e) LEFT JOIN near ON a = lower(trim(p.v)) AND b = g.v WHERE lower(trim(p.v)) = g.v OR score >= 0.9 GROUP BY 1, 2, 3),
k AS (SELECT *, row_number() OVER (PARTITION BY row_id, e ORDER BY seq) AS i, count(*) OVER (PARTITION BY row_id, e) AS n FROM o),
s AS (SELECT row_id, e, 1 AS i, n, o[1:1] AS used FROM k WHERE i = 1
  UNION ALL SELECT s.row_id, s.e, k.i, s.n, s.used || list_filter(k.o, lambda x: NOT list_contains(s.used, x))[1:1] FROM s JOIN k ON k.row_id = s.row_id AND k.e = s.e AND k.i = s.i + 1),
m AS (SELECT sum(len(used))::bigint AS tp FROM s WHERE i = n), c AS (SELECT tp, (SELECT count(*) FROM p) - tp AS fp, (SELECT count(*) FROM g) - tp AS fn FROM m),
r AS (SELECT *, tp::double / (tp + fp) AS precision, tp::double / (tp + fn) AS recall FROM c)
SELECT tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0), 6) AS f1 FROM r""")
def semantic_prf(spark, sf_dir):
    """An order has several gold and predicted values of a key, so that a prediction may find its best one taken."""
    out = evaluate.semantic_prf(derive(spark, sf_dir, _GOLD), derive(spark, sf_dir, _GUESS), ["e"], "v", derive(spark, sf_dir, _NEAR))
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})
