import os
import random
import time

import pytest
from pyspark.sql import functions as F

from tessera.operators import canon, evaluate, graph, vectors
from tessera.sources import io

CLAIM = "src string, predicate string, dst string, cs double, ts double, seq int"


def fold(claims):
    state = {}
    for _, _, dst, cs, ts, _ in claims:
        graph.fold_edge(state, dst, cs or 0.0, ts or 0.0)
    return {(d, e["status"], e["is_contested"], e["valid_from"], e["valid_to"]) for d, e in state.items()}


def test_fold_branches():
    rows = [("10 km", 0.7, 1.0), ("12 km", 0.9, 2.0), ("12.1 km", 0.88, 3.0), ("99 km", 0.85, 4.0), ("blue", 0.95, 5.0), ("12 km", 0.99, 6.0)]
    state, seen = {}, []
    for r in rows:
        graph.fold_edge(state, *r)
        seen.append({d: (e["status"], e["is_contested"]) for d, e in state.items()})
    assert seen[0] == {"10 km": ("Current", False)}
    assert seen[1] == {"10 km": ("History", False), "12 km": ("Current", False)}
    assert seen[2]["12.1 km"] == ("Current", True) and seen[2]["12 km"] == ("Current", True)
    assert seen[3]["99 km"] == ("History", False)
    assert seen[4]["blue"] == ("Current", False) and seen[4]["12 km"] == ("History", True)
    assert seen[5]["12 km"] == ("Current", False) and state["12 km"]["valid_to"] == 5.0


def test_fold_table_equals_scan(spark):
    rng = random.Random(1)
    claims = [(f"s{rng.randint(0, 12)}", rng.choice("pq"), rng.choice(["1 m", "1.01 m", "2 m", "red", "blue"]), rng.choice([0.5, 0.55, 0.6, 0.9, None]), float(rng.randint(0, 5)), i) for i in range(400)]
    df = spark.createDataFrame(claims, CLAIM).withColumn("seq", F.lpad(F.col("seq").cast("string"), 6, "0"))
    want = {(k, *e) for k in {c[:2] for c in claims} for e in fold([c for c in claims if c[:2] == k])}
    for n in (1, 7):
        got = {((r.src, r.predicate), r.dst, r.status, r.is_contested, r.valid_from, r.valid_to) for r in graph.resolve_conflicts(df.repartition(n)).collect()}
        assert got == want
    half = df.where("seq < '000200'"), df.where("seq >= '000200'")
    step = graph.resolve_conflicts(half[1], graph.resolve_conflicts(half[0]))
    assert {((r.src, r.predicate), r.dst, r.status, r.is_contested, r.valid_from, r.valid_to) for r in step.collect()} == want
    assert graph.current_view(step).count() + graph.history_view(step).count() == step.count() and graph.contested_view(step).count() > 0


@pytest.mark.parametrize("run", [9, 300])
def test_fold_in_runs_equals_scan(spark, run):
    """A key's claims cut into runs, which carry the current edges, over existing edges of it and of keys without claims."""
    rng = random.Random(run)
    claims = [(f"s{rng.randint(0, 1)}", "p", rng.choice(["1 m", "1.01 m", "1.02 m", "2 m", "red", "1e3 m", "-.5"]), rng.choice([0.5, 0.55, 0.6, 0.9]), float(rng.randint(0, 9)), i) for i in range(60)]
    before = [("s0", "p", "1 m", 0.8, 4.0, 1), ("s0", "p", "red", 0.75, 4.0, 2), ("s0", "p", "gone", 0.1, 1.0, 3), ("other", "p", "x", 0.5, 1.0, 4)]
    old = graph.resolve_conflicts(spark.createDataFrame(before, CLAIM))
    got = {((r.src, r.predicate), r.dst, r.status, r.is_contested, r.valid_from, r.valid_to) for r in graph.resolve_conflicts(spark.createDataFrame(claims, CLAIM), old, run=run).collect()}
    assert got == {(k, *e) for k in {c[:2] for c in claims + before} for e in fold([c for c in before + claims if c[:2] == k])}


def test_fold_of_many_claims_of_one_key(spark):
    """30,000 claims of one key and 3,000 targets: events by blocks, nothing is held by Python."""
    claims = spark.range(30_000).selectExpr("'a' as src", "'p' as predicate", "concat(id * 7 % 3000, ' km') as dst", "cast(id % 97 as double) / 100 as cs", "cast(id as double) as ts", "id as seq")
    rows = claims.collect()
    got = {(r.dst, r.status, r.is_contested, r.valid_from, r.valid_to) for r in graph.resolve_conflicts(claims).collect()}
    assert got == fold([tuple(r) for r in rows])


def test_edges_without_claims_are_not_shuffled(spark, tmp_path):
    old = graph.resolve_conflicts(spark.createDataFrame([(f"s{i}", "p", "x", 0.5, 1.0, i) for i in range(100)], CLAIM))
    old.write.parquet(f"file://{tmp_path}/edges")
    claims = spark.createDataFrame([("s1", "p", "y", 0.9, 2.0, 1)], CLAIM)
    touched, rest = graph.split_touched(spark.read.parquet(f"file://{tmp_path}/edges"), claims)
    assert (touched.count(), rest.count()) == (1, 99)
    lines = rest._jdf.queryExecution().executedPlan().toString().split("\n")
    join = next(i for i, x in enumerate(lines) if "BroadcastHashJoin" in x and "LeftAnti" in x and "BuildRight" in x)
    above_scan = lines[join : next(i for i, x in enumerate(lines) if "FileScan parquet" in x)]
    assert not any("Exchange hashpartitioning" in x for x in above_scan)


def test_fold_orders_numbers_as_numbers(spark):
    rows = [("a", "p", "x", 0.5, 1.0, 2), ("a", "p", "y", 0.9, 2.0, 10), ("a", "p", "z", 0.95, 3.0, 100)]
    got = {r.dst: (r.status, r.valid_to) for r in graph.resolve_conflicts(spark.createDataFrame(rows, CLAIM)).collect()}
    assert got == {"x": ("History", 2.0), "y": ("History", 3.0), "z": ("Current", None)}
    half = [spark.createDataFrame(r, CLAIM) for r in (rows[:1], rows[1:])]
    assert {r.dst: (r.status, r.valid_to) for r in graph.resolve_conflicts(half[1], graph.resolve_conflicts(half[0])).collect()} == got


def test_edges_and_nodes(spark):
    t = spark.createDataFrame([("Messier7", "in", "Scorpius", 1, {"k": "v"}), ("Messier7", "in", "Scorpius", 2, None), ("Messier7", "type", "cluster", 3, None), ("X", "is", "X", 4, None), ("messier7", "in", "scorpius", 5, None)], "subject string, predicate string, object string, seq int, attributes map<string,string>")
    e = graph.build_edges(t, ("seq",))
    assert e.where("src = 'Messier7'").count() == 2 and e.where("src = 'X'").count() == 0
    assert e.where("predicate = 'in' and src = 'Messier7'").first().props == {"seq": "1", "k": "v"}
    assert graph.dedupe_triples(t.withColumn("object", F.lower("object")).withColumn("subject", F.initcap("subject")), fold_case=("in",)).where("predicate = 'in'").count() == 1
    attrs = spark.createDataFrame([("Messier7_info", "a"), ("X", "b"), ("none_x", "c")], "key string, v string")
    assert {(r.key, r.node) for r in graph.link_attributes(attrs, graph.node_set(t)).collect()} == {("Messier7_info", "Messier7"), ("X", "X")}
    n = graph.build_nodes(graph.node_set(t), spark.createDataFrame([("X", "a", "1", 1), ("X", "a", "2", 2)], "node string, name string, value string, seq int"))
    assert {r.id: r.attributes for r in n.collect()}["X"] == {"a": "2"}
    up = graph.upsert_nodes(n, spark.createDataFrame([("X", {"b": "3"}), ("New", {"c": "4"})], "id string, attributes map<string,string>"))
    assert {r.id: r.attributes for r in up.collect() if r.id in ("X", "New")} == {"X": {"a": "2", "b": "3", "name": "X"}, "New": {"c": "4", "name": "New"}}
    docs = {r.id: r.document for r in io.entity_documents(n, e).collect()}
    assert '"target":"Scorpius"' in docs["Messier7"] and docs["cluster"].endswith('"relationships":[]}')


def test_flatten(spark):
    p = spark.createDataFrame([("e", "raw", '{"a": {"b": 1, "c": [1, 2]}, "d": "x"}'), ("e", "n", "5"), ("e", "bad", "{oops")], "entity string, key string, json string")
    assert {(r.key, r.value) for r in graph.flatten_attributes(p).collect()} == {("raw_a_b", "1"), ("raw_a_c", "[1,2]"), ("raw_d", "x"), ("n", "5"), ("bad", "{oops")}
    deep = '{"k": ' * 12 + "1" + "}" * 12
    assert [tuple(r) for r in graph.flatten_attributes(spark.createDataFrame([("e", "a", deep)], p.schema)).collect()] == [("e", "a" + "_k" * 12, "1")]


def test_flatten_keeps_types_in_one_pass(spark):
    rows = [("e", "r", '{"a": {"b": 1.5, "c": {"d": true, "e": {}}}, "t": "x {", "l": [{"m": {"n": 1}}], "z": null, "q": "\\\\"}'), ("f", "r", None), ("g", "r", "plain {text}"), ("h", "r", "[1, 2]"), ("i", "r", " {} ")]
    p = spark.createDataFrame(rows, "entity string, key string, json string")
    got = {(r.entity, r.key): (r.value, r.t) for r in graph.flatten_variants(p).selectExpr("entity", "key", "to_json(value) as value", "schema_of_variant(value) as t").collect()}
    assert {k: v[0] for k, v in got.items()} == {("e", "r_a_b"): "1.5", ("e", "r_a_c_d"): "true", ("e", "r_t"): '"x {"', ("e", "r_l"): '[{"m":{"n":1}}]', ("e", "r_z"): "null", ("e", "r_q"): '"\\\\"', ("f", "r"): None, ("g", "r"): '"plain {text}"', ("h", "r"): '"[1, 2]"'}
    assert got["e", "r_a_c_d"][1] == "BOOLEAN" and got["e", "r_a_b"][1].startswith("DECIMAL") and got["e", "r_l"][1].startswith("ARRAY")
    assert spark.createDataFrame(rows, p.schema).select(F.max(graph.object_depth(F.col("json")))).first()[0] == 4
    assert "Exchange" not in graph.flatten_variants(p)._jdf.queryExecution().executedPlan().toString()


def test_events(spark):
    arg = "array<struct<role:string,value:string,value_type:string>>"
    ev = spark.createDataFrame([("A", "Launch", [("site", "Cape C", "string"), ("mass", "5", "number"), ("site", "A", "string")], 0.95, 1), ("A", "Launch", [("x", "a b c d e f", "string")], 0.5, 2), ("", "Launch", [], 1.0, 3)], f"anchor_entity string, event_type string, arguments {arg}, confidence double, seq int")
    assert [r.attribute_key for r in graph.event_sequence(ev).orderBy("seq").collect()] == ["event_launch_1", "event_launch_2"]
    assert {tuple(r) for r in graph.events_to_edges(ev).collect()} == {("A", "has_launch_site", "Cape C")}
    assert '"site":"A"' in graph.events_to_attributes(ev).orderBy("attribute_key").first().value
    m = spark.createDataFrame([("A", "Alpha")], "raw string, canonical string")
    assert [r.anchor_entity for r in graph.event_gate(ev, m).orderBy("seq").collect()] == ["Alpha", ""]


def test_events_with_odd_roles_and_types(spark):
    """Types that differ in case or blanks count together; empty and null roles go; a role may take the type's place; null arguments are none."""
    arg = "array<struct<role:string,value:string,value_type:string>>"
    rows = [
        ("Sun", "Solar Flare", None, [("event_type", "burst", "string"), ("", "x", "string"), (None, "y", "string"), ("where", "  Mars ", "string"), ("peak", "5.50", "number"), ("seen", "true", "boolean"), ("none", None, "string")], 1),
        ("Sun", "solar flare", "s1", None, 2), ("Sun", None, "s1", [], 3), (None, "x", "s1", [], 4), ("Sun", "SOLAR FLARE", "s2", [("where", "sun", "string"), ("where", " ", "string"), ("a", 'say "hi"', "string"), ("n", "oops", "number")], 5),
    ]
    ev = spark.createDataFrame(rows, f"anchor_entity string, event_type string, source_id string, arguments {arg}, seq int")
    got = {r.attribute_key: r.value for r in graph.events_to_attributes(ev).collect()}
    assert got == {
        "event_solar_flare_1": '{"event_type":"burst","none":null,"peak":5.5,"seen":true,"source_id":"","where":"  Mars "}',
        "event_solar_flare_2": '{"event_type":"solar flare","source_id":"s1"}',
        "event_solar_flare_3": '{"a":"say \\"hi\\"","event_type":"SOLAR FLARE","n":"oops","source_id":"s2","where":" "}',
    }
    assert {tuple(r) for r in graph.events_to_edges(ev).collect()} == {("Sun", "has_solar_flare_event_type", "burst"), ("Sun", "has_solar_flare_where", "Mars"), ("Sun", "has_solar_flare_a", 'say "hi"')}


def test_subgraph(spark):
    e = spark.createDataFrame([("a", "p", "b"), ("b", "p", "c"), ("c", "p", "a")], "src string, predicate string, dst string")
    got = {(r.node, tuple(r.path)) for r in graph.subgraph(e, spark.createDataFrame([("a",)], "id string"), 3).collect()}
    assert got == {("b", ("a", "b")), ("c", ("a", "c")), ("c", ("a", "b", "c")), ("b", ("a", "c", "b")), ("a", ("a", "b", "c", "a")), ("a", ("a", "c", "b", "a"))}
    s = graph.map_structured_entity(spark.createDataFrame([("mars",), (" x ",)], "entity string"), spark.createDataFrame([("mars", "Mars"), ("x", "X")], "raw string, canonical string"))
    assert {r.entity for r in s.collect()} == {"Mars", "X"}


def test_subgraph_splits_hubs(spark):
    """The paths are the same however the edges of a hub are dealt, loops and parallel edges included."""
    rows = [("hub", "p", f"n{i}") for i in range(12)] + [("hub", "p", "hub"), ("hub", "q", "n1"), ("n1", "p", "n2")]
    e = spark.createDataFrame(rows, "src string, predicate string, dst string")
    start = spark.createDataFrame([("n1",), ("hub",), ("absent",)], "id string")
    paths = lambda hub: sorted((r.start, r.hops, *r.path) for r in graph.subgraph(e, start, 3, hub).collect())

    def walk(first, path, used):
        for i, (a, _, b) in enumerate(rows):
            for x, y in {(a, b), (b, a)}:
                if x == path[-1] and y is not None and i not in used:
                    want.append((first, len(path), *path, y))
                    if len(path) < 3:
                        walk(first, (*path, y), used | {i})

    want: list = []
    for first in ("n1", "hub"):
        walk(first, (first,), set())
    assert sorted(p for p in paths(3) if None not in p) == sorted(want)
    assert paths(3) == paths(100_000)



def greedy(terms, near, threshold):
    leaders, out = [], {}
    for t in sorted(terms, key=lambda t: (-terms[t], t)):
        best = max(((near.get((t, u), 0), -terms[u] * -1, u) for u in leaders if near.get((t, u), 0) >= threshold), key=lambda x: (x[0], x[1]), default=None)
        out[t] = best[2] if best else t
        leaders += [] if best else [t]
    return out


def test_canonicalize(spark):
    terms = {"red star a": 5, "red star b": 4, "star b c": 3, "b c d": 2, "lone": 1}
    df = spark.createDataFrame(list(terms.items()), "term string, n long")
    vec = vectors.sparse_embedding(df)
    near = {(r.a, r.b): round(r.score, 9) for r in vectors.sparse_candidates(vec, vec, 0.0).collect()}
    got = {r.raw: r.canonical for r in canon.canonicalize_terms(df, 0.5).collect()}
    assert got == greedy(terms, near, 0.5)
    assert all(got[c] == c for c in got.values())
    split = {(r.a, r.b): round(r.score, 9) for r in vectors.sparse_candidates(vec, vec, 0.0, salts=3).collect()}
    assert split == near
    never = {r.raw: r.canonical for r in canon.canonicalize_terms(df, 0.5, judge=lambda kind, term, options: None).collect()}
    assert never == {t: t for t in terms}


def test_canonicalize_long_cluster(spark):
    terms = spark.createDataFrame([(f"very long common name of a star{' x' * k}", 100 - k) for k in range(54)], "term string, n long")
    loose = dict(judge=lambda kind, term, options: None)
    assert {r.raw for r in canon.canonicalize_terms(terms, 0.1, **loose).collect()} == {r.term for r in terms.collect()}
    with pytest.raises(RuntimeError):
        canon.canonicalize_terms(terms, 0.1, max_rounds=2, group_pairs=10, **loose)


@pytest.mark.parametrize("bound", [0, 3, 10_000])
def test_canonicalize_by_components(spark, bound):
    """The greedy scan, by rounds for every component, for greater ones, or for none; with a judge and without."""
    rng = random.Random(3)
    terms = {" ".join(rng.choice("ab cd ef gh ij kl mn op".split()) for _ in range(rng.randint(1, 4))): rng.randint(1, 9) for _ in range(40)}
    df = spark.createDataFrame(list(terms.items()), "term string, n long")
    vec = vectors.sparse_embedding(df)
    near = {(r.a, r.b): round(r.score, 9) for r in vectors.sparse_candidates(vec, vec, 0.0).collect()}
    assert {r.raw: r.canonical for r in canon.canonicalize_terms(df, 0.6, group_pairs=bound).collect()} == greedy(terms, near, 0.6)
    first = lambda kind, term, options: options[0] if options else None
    want: dict = {}
    for t in sorted(terms, key=lambda t: (-terms[t], t)):
        options = sorted(x for x in want if want[x] == x and near.get((t, x), -1) >= 0.6)
        want[t] = options[0] if options else t
    assert {r.raw: r.canonical for r in canon.canonicalize_terms(df, 0.6, k=100, judge=first, group_pairs=bound).collect()} == want


def test_components_of_chains_and_stars(spark, monkeypatch):
    """A chain of 1,000 vertices takes under 30 staged tables; a star, a pair, loops and repeats are as they are."""
    from tessera.operators import components, stage

    edges = [(f"v{i:04d}", f"v{i + 1:04d}") for i in range(999)] + [("hub", f"s{i}") for i in range(50)] + [("p", "q"), ("q", "p"), ("p", "q"), ("own", "own"), ("own", None)]
    made, real = [], stage.stage
    monkeypatch.setattr(stage, "stage", lambda df, label: made.append(label) or real(df, label))
    got = {}
    for r in components.connected_components(spark.createDataFrame(edges, "x string, y string")).collect():
        got.setdefault(r.component, set()).add(r.vertex)
    assert sorted(map(len, got.values())) == [1, 2, 51, 1000]
    assert len(made) < 30


def test_mapping_tools(spark):
    r = spark.createDataFrame([(1, ["a", "x", "a"]), (2, [])], "id int, l array<string>")
    m = spark.createDataFrame([("a", "A")], "raw string, canonical string")
    assert {x.id: x.l for x in canon.map_list(r, "l", m, "id").collect()} == {1: ["A", "x", "A"], 2: []}
    lists = spark.createDataFrame([("P", ["p", "P", ""], 1), ("Q", ["p"], 2)], "primary string, aliases array<string>, seq int")
    assert {(x.alias, x.primary) for x in canon.alias_table(lists).collect()} == {("p", "Q")}
    names = canon.generated_names(spark.createDataFrame([("relation", "orbital period"), ("entity", "black hole")], "term_type string, term string"))
    assert {x.canonical for x in names.collect()} == {"orbitalPeriod", "BlackHole"}
    t = spark.createDataFrame([("s", "attributes", "o"), ("x", "rel", "y")], "subject string, predicate string, object string")
    assert {x.term for x in canon.distinct_terms(t).collect()} == {"x", "rel", "y"}
    ids = vectors.index_rows(spark.createDataFrame([("A", "a", 1), ("A", "a", 2)], "canonical string, term string, seq int")).collect()
    assert [x.id for x in ids] == ["A_0cc175b9"]


def test_scores(spark):
    g = spark.createDataFrame([(1, "A", "x"), (1, "B", "y"), (2, "C", "z")], "row_id int, e string, v string")
    p = spark.createDataFrame([(1, " a", "X"), (1, "a", "x"), (2, "C", "q")], "row_id int, e string, v string")
    s = evaluate.exact_prf(g, p, ["e", "v"]).first()
    assert (s.tp, s.fp, s.fn) == (1, 1, 2)
    gold = spark.createDataFrame([(1, "e", "big star", 1)], "row_id int, e string, v string, seq int")
    pred = spark.createDataFrame([(1, "e", "large star", 1), (1, "e", "big star", 2)], "row_id int, e string, v string, seq int")
    sim = spark.createDataFrame([("large star", "big star", 0.95)], "a string, b string, score double")
    s = evaluate.semantic_prf(gold, pred, ["e"], "v", sim).first()
    assert (s.tp, s.fp, s.fn) == (1, 1, 0)


def test_sources(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('{"subject": "a", "predicate": "p", "object": "b", "confidence": 0.5}\n\nbroken\n')
    good, bad = io.read_triples(spark, f"file://{tmp_path}/t.jsonl")
    assert good.count() == 1 and bad.count() == 1
    (tmp_path / "s.json").write_text('[{"type": "entity", "value": "Mars"}, {"topic": "stars"}, {"entity_name": "x"}, "plain", null]')
    assert [tuple(r) for r in io.read_seed_items(spark, f"file://{tmp_path}/s.json").collect()] == [("entity", "Mars"), ("topic", "stars"), ("topic", '{"entity_name":"x"}'), ("topic", "plain")]
    (tmp_path / "s.csv").write_text("name,other\nMars,1\n,2\n")
    assert [r.value for r in io.read_seed_items(spark, f"file://{tmp_path}/s.csv").collect()] == ["Mars"]
    (tmp_path / "d.jsonl").write_text('{"text": "t"}\n{"content": "c", "text": "t"}\n{"title": "a", "summary": "b"}\n"just text"\n')
    assert [r.text for r in io.read_documents(spark, f"file://{tmp_path}/d.jsonl").collect()] == ["t", "c", "a b", "just text"]
    (tmp_path / "m.json").write_text('{"a": "A", "b": "B"}')
    assert io.read_json_map(spark, f"file://{tmp_path}/m.json").count() == 2
    (tmp_path / "x.json").write_text('[{"Mars_simbad": {"a": 1}}, {"The_Moon_info_box": {"k": "v"}}, {"other": 1}]')
    assert {(r.entity, r.source_kind) for r in io.read_structured_data(spark, f"file://{tmp_path}/x.json").collect()} == {("Mars", "simbad"), ("The_Moon", "info_box")}
    root = f"file://{tmp_path}/run"
    assert io.resume_from_stage(spark, root, {s: "facts" for s in io.STAGES}) == (None, None)
    io.write_stage(good, root, io.STAGES[1], "facts")
    stage, df = io.resume_from_stage(spark, root, {s: "facts" for s in io.STAGES})
    assert stage == io.STAGES[1] and df.count() == 1
    ie = spark.createDataFrame([('{"entity_list": [{"name": "a", "type": "T"}]}',), ('{"relation_list": [{"head": "a", "tail": "b", "relation": "r"}]}',), ('{"event_list": [{"event_type": "E", "event_trigger": "t", "event_argument": {"x": "y"}}]}',), ('{"triple_list": [{"head": "a", "head_type": "H", "relation": "r", "relation_type": "R", "tail": "b", "tail_type": "L"}]}',)], "value string")
    facts = io.ingest_ie_results(ie)
    assert {r.kind for r in facts.collect()} == {"entity", "relation", "event", "triple"}
    assert io.constraint_filter(facts, heads=["H"], relations=["r"]).count() == 1


@pytest.mark.parametrize("run", [9, 300])
def test_many_keys_meet_existing_edges_in_one_shuffle(spark, tmp_path, run):
    """Without a broadcast of keys: the same edges, untouched ones as they are, repeated, without status or key."""
    rng = random.Random(run)
    claims = spark.createDataFrame([(f"s{rng.randint(0, 2)}" if i else None, "p", rng.choice(["1 m", "1.01 m", "2 m", "red"]), rng.choice([0.5, 0.55, 0.9]), float(rng.randint(0, 9)), i) for i in range(60)], CLAIM)
    old = [("s0", "p", "1 m", "Current", None, 4.0, None, 0.8, 4.0), ("s0", "p", "gone", "History", True, 1.0, 2.0, 0.1, 1.0), ("s1", "p", "red", None, None, None, None, None, None)]
    old += [("lone", "p", "x", "Current", None, 1.0, None, 0.5, 1.0)] * 2 + [("lone", "p", "y", None, None, None, 3.0, None, None), (None, "p", "2 m", "Current", False, 1.0, None, 0.99, 9.0)]
    spark.createDataFrame(old, graph.EDGE).write.parquet(f"file://{tmp_path}/old")
    edges = spark.read.parquet(f"file://{tmp_path}/old")
    got = graph.resolve_conflicts(claims, edges, run=run, few=0)
    assert sorted(map(str, got.collect())) == sorted(map(str, graph.resolve_conflicts(claims, edges, run=run).collect()))
    if run == 300:
        plan = graph.resolve_conflicts(claims, edges, run=run, few=0)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1, plan


def test_ends_that_are_lost(spark):
    """Claims aren't shuffled for the few ends that are no nodes."""
    nodes = spark.createDataFrame([("a",), ("b",)], "id string")
    edges = spark.createDataFrame([("a", "p", "b"), ("a", "p", "c"), ("d", "p", "b"), (None, "p", "b"), ("b", "p", None), ("b", "p", "a")], "src string, predicate string, dst string")
    for limit in (None, 0, 10):
        assert sorted(map(tuple, graph.edge_endpoints(edges, nodes, limit).select("src", "predicate", "dst").collect())) == [("a", "p", "b"), ("b", "p", "a")]
    assert "hashpartitioning" not in graph.edge_endpoints(edges, nodes, 10)._jdf.queryExecution().executedPlan().toString()


def test_a_clean_stage_keeps_no_shuffle_files(spark):
    from tessera.operators.stage import stage

    files = lambda: {f for d, _, names in os.walk(spark.conf.get("spark.local.dir")) for f in names if f.startswith("shuffle_")}
    before = files()
    staged, _ = stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "clean", clean=True)
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before and staged.count() == 7 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
