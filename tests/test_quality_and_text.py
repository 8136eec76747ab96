import json

import pytest
from pyspark.sql import functions as F

from tessera.functions import chunk, html, parse
from tessera.functions import scores as S
from tessera.functions import text as T
from tessera.operators import claims, links, provenance, quality

TRIPLE = "subject string, predicate string, object string, confidence double, seq int"
SMOKE = [("Mars", "orbits", "Sun", 0.9, 1), ("null", "orbits", "Sun", 0.9, 2), ("Mars", "orbits", "Sun", 0.8, 3), ("Mars", "orbits", "Mars", 0.9, 4), ("Earth", "has", "Moon", 0.9, 5), ("", "orbits", "Sun", 0.9, 6), (None, "orbits", "Sun", 0.9, 7), ("category:x", "orbits", "Sun", 0.9, 8)]


def one(spark, expr, **cols):
    names = list(cols)
    return spark.createDataFrame([tuple(cols.values())], ", ".join(f"{n} string" for n in names)).select(expr.alias("x")).first().x


def test_reasons(spark):
    t = spark.createDataFrame(SMOKE, TRIPLE)
    got = [r.reason for r in quality.with_reason(t).orderBy("seq").collect()]
    assert got == ["valid", "invalid_values", "low_confidence", "self_reference", "meaningless_relation", "invalid_values", "missing_required_fields", "low_quality_content"]
    stats = {r.reason: r.n for r in quality.filter_stats(t, 0.3).collect()}
    assert stats["duplicate"] == 1 and stats["valid"] == 1 and "low_confidence" not in stats
    assert quality.process_triples(t, 0.3).count() == 1
    a = quality.quality_rates(quality.analyze(t)).first()
    assert a.total_count == 8 and a.self_references == 1 and a.null_values == 3
    empty = quality.quality_rates(quality.analyze(t.limit(0))).first()
    assert empty.total_count == 0 and empty.validity_rate == 0
    d = quality.quality_delta(quality.analyze(t), quality.analyze(quality.process_triples(t, 0.3))).first()
    assert d.self_reference_reduction == 1 and d.overall_improvement > 0


def test_partitions_make_no_difference(spark):
    t = spark.createDataFrame([(f"s{i % 7}", "linksTo", f"O {i % 5}", 0.95, i) for i in range(300)], TRIPLE)
    results = [sorted(map(tuple, quality.process_triples(t.repartition(n)).collect())) for n in (1, 4, 50)]
    assert results[0] == results[1] == results[2]


def test_overall_quality(spark):
    row = spark.createDataFrame([(0.5, 0.8, 0.7, 0.9, 0.95, 0.6)], "web_content_quality double, wikipedia_content_quality double, search_result_quality double, validity_rate double, uniqueness_rate double, confidence_score double")
    r = quality.overall_quality(row).first()
    assert abs(r.overall_quality - (0.4 * 2.0 / 3 + 0.6 * 2.45 / 3)) < 1e-9 and len(r.advice) == 2


def test_article_scores(spark):
    a = spark.createDataFrame([("a", ["x" * 120, "y" * 60], 10, True, "s" * 101, 1), ("b", [], None, False, "s" * 200, 2), ("c", ["z"], 40, True, "s", 3)], "title string, sections array<string>, infobox_size int, exists boolean, summary string, seq int")
    got = {r.title: round(r.score, 4) for r in quality.article_quality(a).collect()}
    assert got == {"a": round(0.2 * 0.3 + 0.15 + 0.15 + 0.2, 4), "b": 0.0, "c": round(0.03 + 0.3 + 0.2, 4)}
    assert [r.title for r in quality.valid_articles(a, 5).collect()] == ["a"]


def test_classes(spark):
    value = lambda v: one(spark, S.is_attribute_value("v"), v=v)
    assert value("12.5 km") and value("Solid") and value("Voyager 1") and not value("Saturn") and not value("") and not value(None)
    assert one(spark, S.is_attribute_predicate("v"), v="discovered by") and not one(spark, S.is_attribute_predicate("v", strict=True), v="discovered by")
    assert one(spark, S.is_entity("v"), v="the star") and one(spark, S.is_entity("v"), v="Élan") and not one(spark, S.is_entity("v"), v="blue") and not one(spark, S.is_entity("v"), v=None)
    assert one(spark, S.is_event_predicate("v"), v="was launched in") and one(spark, S.is_event_type("v"), v="Solar Dimming") and not one(spark, S.is_event_type("v"), v="x")
    assert one(spark, S.relation_reject_reason("p", "o"), p="orbits", o="Sun") == "event_predicate"
    assert one(spark, S.relation_reject_reason("p", "o"), p="near", o="Sun") is None


def test_components_of_terms(spark):
    n = lambda v: one(spark, S.normalize_component("v"), v=v)
    assert n('  "the   big dipper" ') == "the Big Dipper".replace("big", "Big") or n('  "the   big dipper" ') == "the big Dipper"
    assert n("mars (disambiguation)") == "Mars" and n("NASA center") == "NASA center" and n("mars (red)") == "Mars (red)"


def test_urls_and_sources(spark):
    assert one(spark, S.is_valid_url("u"), u="https://science.org/x") and not one(spark, S.is_valid_url("u"), u="https://www.reddit.com/r") and not one(spark, S.is_valid_url("u"), u="https://a.org/x.docx")
    assert abs(one(spark, S.url_score("u", "t", "s"), u="https://astro.caltech.edu/", t="dark matter", s="cheap") - (1 + 2 + 1.5 + 1 + 0.2 - 0.5)) < 1e-9
    assert one(spark, S.url_score("u"), u=None) == 0.5
    cls = lambda u, r: one(spark, S.source_authority("u", None, r), u=u)
    assert cls("https://doi.org/1", "A") == "general_web" and cls("https://doi.org/1", "B") == "academic_paper" and cls("http://simbad.u/x", "A") == "simbad"
    assert one(spark, S.source_authority("u", F.lit("News"), "B"), u="https://x.y") == "web_news"
    a = one(spark, S.confidence_score_a(F.lit(1.0), F.lit(0.0), F.lit(0.0)), u="")
    assert abs(a - (0.7 * 0.7 + 0.3)) < 1e-9


def test_text(spark):
    assert one(spark, T.clean_web_text("v"), v="Hi&nbsp;there  Loading (x) [1] ok!! yes,no") == "Hi there ok. yes. no"
    assert one(spark, T.slugify("v"), v=" Épée &  Co ") == "epee_co" and one(spark, T.slugify("v"), v="日本") == "unnamed_entity"
    assert one(spark, T.to_camel_case("v"), v="Orbital Period") == "orbitalPeriod" and one(spark, T.to_pascal_case("v"), v="black-hole x") == "BlackHoleX" and one(spark, T.to_pascal_case("v"), v="") == "UnnamedEntity"
    assert one(spark, T.split_camel_case("v"), v="surfaceArea2km") == "surface Area 2 km"
    assert one(spark, T.normalize_label("v"), v=" Right ascension* ") == "ra"
    assert one(spark, T.clean_wiki_markup("v"), v="{{x}} a [[B|c]] [[d]]<ref n=1>z</ref> e [9]\n=\n f") == "a c d e = f"
    assert one(spark, T.extract_number("v"), v="about -1.5e3 km") == -1500.0 and one(spark, T.extract_number("v"), v="none") is None
    assert one(spark, T.truncate_source("v"), v="x" * 501) == "x" * 500 + "..."
    assert one(spark, T.is_infobox_entry("a", "b"), a="Mass", b="n/a") is False and one(spark, T.is_infobox_entry("a", "b"), a="Mass", b="5")
    assert one(spark, T.extract_all_text("v"), v="<p>a<script>x</script> b</p>") == "a b"
    assert one(spark, T.main_blocks("v"), v="<article><nav>no</nav><p>Planets move around their star slowly.</p></article>") == ["Planets move around their star slowly."]
    assert not one(spark, T.is_meaningful("v"), v="please accept our cookie rules now") and not one(spark, T.is_meaningful("v"), v=None)


def test_chunks():
    text = "\n\n".join(" ".join(f"w{i}x{k}" for k in range(60)) for i in range(12))
    out = chunk.recursive_chunks(text, 200, 40)
    assert max(map(len, out)) <= 200 and all(out)
    assert set(" ".join(out).split()) == set(text.split())
    assert [len(c) for c in chunk.recursive_chunks("x" * 2500, 1024, 0)] == [1024, 1024, 452]
    assert all(len(c) <= 50 for c in chunk.recursive_chunks("漢字" * 100 + " end", 50, 10))


def test_chunk_table(spark):
    d = spark.createDataFrame([(1, "a b"), (2, None), (3, " "), (4, "w " * 900)], "doc_id long, text string")
    got = chunk.chunk_text(d).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in got} == {1: 1, 4: 2}


BOX = """<table class="infobox vcard"><tbody><tr><th colspan="2">Orbital data</th></tr><tr><td>1.5 AU</td></tr>
<tr><th scope="row">orbitalPeriod</th><td>687&nbsp;days<sup class="reference"><a href="#cite_note-1">[1]</a></sup></td></tr>
<tr><th scope="row">Mass</th><td>6.4 × 10<sup>23</sup> kg</td></tr><tr><td><b>Moons</b></td><td><ul><li>Phobos</li><li>Deimos</li></ul></td></tr><tr><td>long label of many words here</td><td>x</td></tr></tbody></table>"""


def test_html(spark):
    pages = spark.createDataFrame([(1, f"<html><body><main><div class='sidebar-x'>no</div><p>Mars is a small rocky planet.</p></main>{BOX}</body></html>"), (2, None), (3, "<p>broken")], "page_id long, html string")
    assert [r.text for r in html.extract_main_content(pages).where("page_id = 1").collect()] == ["Mars is a small rocky planet."]
    rows = [(r.label, r.value) for r in html.infobox_rows(pages, "page_id").orderBy("pos").collect()]
    assert rows == [("Orbital data", "1.5 AU"), ("orbital Period", "687 days"), ("Mass", "6.4 × 10^23 kg"), ("Moons", "Phobos, Deimos")]


def test_sections_and_claims(spark):
    s = spark.createDataFrame([("d", 1, None, "Intro", "t1"), ("d", 2, 1, "Orbit", "t2"), ("d", 3, None, "References", "t3"), ("d", 4, 3, "More", "t4")], "doc string, id int, parent int, title string, text string")
    assert {r.path for r in claims.section_tree_flatten(s).collect()} == {"Intro", "Intro > Orbit"}
    snak = lambda dt, v: {"mainsnak": {"datatype": dt, "datavalue": {"value": v}}}
    c = {"P1": [snak("wikibase-item", {"id": "Q5"}), snak("wikibase-item", {"id": "Q6"})], "P2": [snak("quantity", {"amount": "+3", "unit": "http://x/entity/Q7"})], "P3": [snak("time", {"time": "+2000"})], "P4": [snak("monolingualtext", {"text": "hi"})], "P5": [snak("globe-coordinate", {"latitude": 1.5, "longitude": 2})], "P6": [snak("url", "http://u")], "P7": [snak("other", 1)]}
    df = spark.createDataFrame([("Q1", json.dumps(c))], "qcode string, json string")
    labels = spark.createDataFrame([("P1", "part"), ("Q5", "five"), ("Q7", "metre")], "code string, label string")
    got = {r.label: r.value for r in claims.flatten_claims(df, labels).collect()}
    assert got == {"part": "five; Q6", "P2": "3 metre", "P3": "+2000", "P4": "hi", "P5": "lat:1.5, lon:2", "P6": "http://u"}
    assert {r.code for r in claims.unknown_codes(df, labels).collect()} == {"P2", "P3", "P4", "P5", "P6", "P7", "Q6"}


def test_deep_sections(spark):
    rows = [("d", k, k - 1 if k else None, f"S{k}", "t") for k in range(10)]
    s = spark.createDataFrame(rows, "doc string, id int, parent int, title string, text string")
    assert {(r.id, r.depth) for r in claims.section_tree_flatten(s).collect()} == {(k, k) for k in range(10)}
    assert claims.section_tree_flatten(s, 6).count() == 7
    assert claims.section_tree_flatten(s.limit(0)).count() == 0
    loop = s.union(spark.createDataFrame([("d", 0, 9, "S0", "t")], s.schema))
    with pytest.raises(RuntimeError):
        claims.section_tree_flatten(loop)


def test_responses(spark):
    rel = {"is_relevant": True, "relations": [{"subject": "Mars", "predicate": "near", "object": "Jupiter", "confidence": 0.9, "attributes": {"a": "b"}}, {"subject": "Mars", "predicate": "near", "object": "5 km", "confidence": 1}, {"subject": "Mars"}]}
    att = {"is_relevant": True, "attributes": [{"attribute": "mass", "value": "5", "confidence": 0.9}, {"attribute": "x"}]}
    eve = {"is_relevant": True, "events": [{"event_type": "Launch", "anchor_entity": "A", "arguments": [{"role": "r", "value": "v"}], "confidence": 0.9}]}
    ent = {"is_relevant": True, "entities": [{"entity_name": '{"entity_name": "Mars"}', "attributes": [{"attribute": "a", "value": "1", "confidence": 1.0}]}, {"entity_name": "E", "attributes": []}]}
    rows = [(i, f"Text\n```json\n{json.dumps(x)}\n```" if i % 2 else json.dumps(x)) for i, x in enumerate([rel, att, eve, ent])] + [(9, "broken {"), (10, None)]
    r = spark.createDataFrame(rows, "block_id int, response string")
    chunks = spark.createDataFrame([(0, "c" * 300)], "block_id int, text string")
    facts = parse.facts_from_responses(r, chunks)
    got = facts["relations"].collect()
    assert [(x.object, x.attributes, x.text_id, len(x.source_text)) for x in got] == [("Jupiter", {"a": "b"}, "block_0", 200)]
    assert facts["attributes"].count() == 1 and facts["events"].count() == 1
    assert [(x.entity, x.value) for x in parse.parse_entities(r).collect()] == [("Mars", "1")]
    m = spark.createDataFrame([(1, '{"relations": {"near": ["A", " B "], "of": "C", " ": "D"}}')], "block_id int, response string")
    assert {(x.predicate, x.object) for x in parse.parse_relation_map(m).collect()} == {("near", "A"), ("near", "B"), ("of", "C")}
    j = spark.createDataFrame([('so: {"choice": "a"}', ["a", "b"]), ('{"choice": "z"}', ["a"]), ("no", ["a"])], "t string, c array<string>")
    assert [x.v for x in j.select(parse.parse_judge_choice("t", "c").alias("v")).collect()] == ["a", None, None]
    assert one(spark, F.size(parse.parse_literal_lists("v")), v="[{'entity': 'x'}]") == 1 and one(spark, F.size(parse.parse_literal_lists("v")), v="nan") == 0
    tasks = spark.createDataFrame([("relations", "rel", "Find in: %s")], "task string, prefix string, template string")
    q = parse.render_requests(spark.createDataFrame([(3, "x"), (4, " ")], "block_id int, text string"), tasks).collect()
    assert [(x.custom_id, x.prompt) for x in q] == [("rel_section_3", "Find in: x")]


def test_links(spark):
    l = spark.createDataFrame([("q", f"https://nasa.gov/{i}", "title", "s" * 30, i, 1.0) for i in range(3)] + [("q", "https://x.com/a", "t", "s" * 30, 9, 2.0), ("r", "https://x.com/b", "t", "short", 1, 1.0)], "query string, url string, title string, snippet string, seq int, score double")
    assert links.prefer_or_all(l).groupBy("query").count().orderBy("query").collect()[0]["count"] == 3
    assert [r.seq for r in links.top_links(l, 2).where("query = 'q'").orderBy("rank").collect()] == [9, 0]
    t = spark.createDataFrame([("q", "https://nasa.gov/0", "body", 0)], "query string, url string, text string, seq int")
    got = links.fill_with_snippets(t, l, 3)
    assert got.where("query = 'q'").count() == 3 and got.where("source_type = 'web_snippet'").count() == 2
    plan = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("wikipedia_search", "T", 3)], "tool string, query string, seq int")
    topics = spark.createDataFrame([("T",), ("U",)], "topic string")
    assert links.ensure_fallback(links.dedupe_plan(plan), topics).count() == 3
    res = spark.createDataFrame([("t", 0, i) for i in range(2)] + [("t", 1, i) for i in range(4)] + [("t", 2, i) for i in range(4)], "topic string, query_seq int, seq int")
    assert links.fallback_queries(res, 6).count() == 6 and links.fallback_queries(res, 4).count() == 2


def test_provenance(spark):
    f = spark.createDataFrame([(1, "", "pre", 0), (2, "own", "p", 1), (3, None, "pre", 7)], "id int, source_text string, preview string, source_block_index int")
    b = spark.createDataFrame([(0, "block")], "block_index int, text string")
    assert {r.id: r.source_text for r in provenance.recover_source_text(f, b).collect()} == {1: "block", 2: "own", 3: "pre"}
    c = spark.createDataFrame([("t", "q", "x", None, None, None), ("t", "z", "y", "web", "topic", "v")], "tool string, query string, text string, source_type string, origin_type string, origin_value string")
    p = spark.createDataFrame([("t", "q", "entity", "Mars")], "tool string, query string, origin_type string, origin_value string")
    got = {r.text: (r.source_type, r.origin_type, r.origin_value) for r in provenance.annotate_origin(c, p).collect()}
    assert got == {"x": ("unknown", "entity", "Mars"), "y": ("web", "topic", "v")}
    assert [r.band for r in provenance.confidence_split(spark.createDataFrame([(0.95,), (None,)], "confidence double")).collect()] == ["high", "low"]


def test_a_whole_text_goes_before_the_preview_of_a_longer_one(spark):
    """A later text that begins with another one doesn't take its place; empty texts are texts; previews stand where no text is equal."""
    docs = spark.createDataFrame([("a" * 200, "own", 1), ("a" * 200 + "b", "longer", 9), ("", "empty", 3), (None, "none", 10), ("c" * 201, "c1", 4), ("c" * 202, "c2", 5)], "text string, source_url string, doc_seq int")
    docs = docs.selectExpr("*", "'web' as source_type", "'' as page_title")
    facts = spark.createDataFrame([("a" * 200,), ("a" * 200 + "b",), ("",), ("c" * 200,), ("d",), (None,)], "text string").select("text", provenance.source_id("text").alias("source_id"))
    got = {r.text: r.source_url for r in provenance.source_meta_join(facts, docs).collect()}
    assert got == {"a" * 200: "own", "a" * 200 + "b": "longer", "": "empty", "c" * 200: "c2", "d": None, None: None}


def test_sources_of_odd_documents(spark, tmp_path):
    """Documents without a text have no row; one without a source has that of an earlier equal text."""
    from tessera.plans import catalog

    spark.createDataFrame([(1, "x", "s1"), (2, "x", None), (3, None, "s3"), (4, "", "s4"), (5, "y", None)], "doc_id long, text string, source string").write.parquet(f"file://{tmp_path}/documents.parquet")
    got = {r.doc_id: r.source_url for r in catalog.queries()["enrich_for_conflicts"](spark, f"file://{tmp_path}").collect()}
    assert got == {1: "https://s1.org", 2: "https://s1.org", 4: "https://s4.org", 5: None}
