"""Nodes and edges: construction, structured attributes, conflict resolution and versions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .quality import first_wins
from .stage import staged

EDGE = "src string, predicate string, dst string, status string, is_contested boolean, valid_from double, valid_to double, cs double, ts double"


def dedupe_triples(triples: DataFrame, seq: str = "seq", fold_case: tuple[str, ...] = ()) -> DataFrame:
    """No self loops, one row for each (s, p, o), first wins; predicates in fold_case compare without case."""
    low = lambda c: F.when(F.col("predicate").isin(*fold_case), F.lower(c)).otherwise(F.col(c)) if fold_case else F.col(c)
    return first_wins(triples.where("subject != object").withColumns({"_s": low("subject"), "_o": low("object")}), ["_s", "predicate", "_o"], seq).drop("_s", "_o")


def dedupe_events(events: DataFrame, valid, seq: str = "seq") -> DataFrame:
    """One event for each (event_type, anchor_entity) among those of a valid type, first wins."""
    return first_wins(events.where(valid), ["event_type", "anchor_entity"], seq)


def node_set(triples: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Distinct ids: subjects, objects, event anchors and string argument values."""
    ids = triples.select(F.explode(F.array("subject", "object")).alias("id"))
    if events is not None:
        ids = ids.union(events.select(F.explode(F.concat(F.array("anchor_entity"), F.transform(F.filter("arguments", lambda a: a.value_type == "string"), lambda a: a.value)))))
    return ids.where("id is not null and id != ''").distinct()


def build_edges(triples: DataFrame, props: tuple[str, ...] = (), seq: str = "seq") -> DataFrame:
    """(src, predicate, dst, props map): given columns as strings, and the relation's attributes over them."""
    own = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(p).alias("k"), F.col(p).cast("string").alias("v")) for p in props]), lambda x: x.v.isNotNull())) if props else F.expr("map()").cast("map<string,string>")
    if "attributes" in triples.columns:
        extra = F.coalesce("attributes", F.expr("map()").cast("map<string,string>"))
        own = F.map_concat(F.map_filter(own, lambda k, v: ~F.map_contains_key(extra, k)), extra)
    return dedupe_triples(triples, seq).select(F.col("subject").alias("src"), "predicate", F.col("object").alias("dst"), own.alias("props"))


def object_depth(json: str) -> Column:
    """How deep objects lie within objects in a JSON text; those in lists don't count. 0 for other texts."""
    marks = F.split(F.regexp_replace(json, r'(?s)"(?:[^"\\\\]|\\\\.)*"|[^{}\[\]]', ""), "")
    zero = F.struct(F.lit(0).alias("lists"), F.lit(0).alias("now"), F.lit(0).alias("most"))
    shift = lambda x, up, down: F.when(x == up, 1).when(x == down, -1).otherwise(0)

    def step(acc, x):
        now = acc.now + F.when(acc.lists == 0, shift(x, "{", "}")).otherwise(0)
        return F.struct((acc.lists + shift(x, "[", "]")).alias("lists"), now.alias("now"), F.greatest(acc.most, now).alias("most"))

    return F.when(F.ltrim(json).startswith("{"), F.aggregate(marks, zero, step, lambda acc: acc.most)).otherwise(0)


def flatten_variants(payloads: DataFrame) -> DataFrame:
    """payloads(entity, key, json) to (entity, key, value variant): nested objects become a_b keys, other values keep their type.

    A text that is no object, or no JSON, is a string as it stands; an empty object has no row. All levels
    are one pass without a shuffle: objects open into their entries as often as the deepest text needs.
    """
    rows = payloads.select("entity", "key", F.expr("coalesce(if(startswith(ltrim(json), '{'), try_parse_json(json), null), cast(json as variant))").alias("value"))
    depth = payloads.agg(F.max(object_depth(F.col("json")))).first()[0] or 0
    for _ in range(depth):
        opened = "if(startswith(schema_of_variant(value), 'OBJECT'), map_entries(cast(value as map<string,variant>)), array(named_struct('key', cast(null as string), 'value', value)))"
        rows = rows.select("entity", F.col("key").alias("_k"), F.explode(F.expr(f"if(value is null, array(named_struct('key', cast(null as string), 'value', value)), {opened})")).alias("_e"))
        rows = rows.select("entity", F.concat_ws("_", "_k", "_e.key").alias("key"), F.col("_e.value").alias("value"))
    return rows


def flatten_attributes(payloads: DataFrame) -> DataFrame:
    """flatten_variants with values as text: strings as they are, lists and numbers as JSON, JSON null as null."""
    return flatten_variants(payloads).withColumn("value", F.expr("case when value is null or is_variant_null(value) then null when schema_of_variant(value) = 'STRING' then cast(value as string) else to_json(value) end"))


def link_attributes(attributes: DataFrame, nodes: DataFrame) -> DataFrame:
    """attributes(key, ...) with node: the node of that id, else of the text before the first _; others go."""
    full, head = nodes.select(F.col("id").alias("_full")), nodes.select(F.col("id").alias("_head"))
    out = attributes.join(full, F.col("key") == F.col("_full"), "left").join(head, F.split_part("key", F.lit("_"), F.lit(1)) == F.col("_head"), "left")
    return out.withColumn("node", F.coalesce("_full", "_head")).where("node is not null").drop("_full", "_head")


def map_structured_entity(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """entity by mapping(raw, canonical): raw name, else lower-cased, else trimmed; default self."""
    out = rows
    for i, key in enumerate((F.col("entity"), F.lower("entity"), F.trim("entity"))):
        out = out.join(mapping.select(F.col("raw").alias(f"_r{i}"), F.col("canonical").alias(f"_c{i}")), key == F.col(f"_r{i}"), "left")
    return out.withColumn("entity", F.coalesce("_c0", "_c1", "_c2", "entity")).select(*rows.columns)


def orphan_entities(structured: DataFrame, nodes: DataFrame) -> DataFrame:
    """A synthetic triple for each entity of structured(entity) that is no node."""
    lone = structured.select("entity").distinct().join(nodes.select(F.col("id").alias("entity")), "entity", "left_anti")
    return lone.select(F.col("entity").alias("subject"), F.lit("data_source").alias("predicate"), F.lit("Structured Data").alias("object"), F.lit(1.0).alias("confidence"))


def merge_structured_attributes(catalogue: DataFrame, text: DataFrame, least: float = 0.9) -> DataFrame:
    """(entity, attribute, value): the last of catalogue(entity, attribute, value, seq); text(…, confidence, seq) of at least that confidence fills gaps, first wins."""
    known = catalogue.groupBy("entity", "attribute").agg(F.max_by("value", "seq").alias("value"))
    usable = text.where((F.col("confidence") >= least) & (F.coalesce("attribute", F.lit("")) != "") & (F.coalesce("value", F.lit("")) != "") & ~F.col("attribute").isin("text_id", "source_id"))
    gaps = usable.groupBy("entity", "attribute").agg(F.min_by("value", "seq").alias("filler"))
    return known.join(gaps, ["entity", "attribute"], "full").select("entity", "attribute", F.coalesce("value", "filler").alias("value"))


def build_nodes(ids: DataFrame, attributes: DataFrame) -> DataFrame:
    """(id, attributes map) of ids(id) and linked attributes(node, name, value, seq), the last value of a name."""
    last = attributes.groupBy("node", "name").agg(F.max_by("value", "seq").alias("value"))
    maps = last.groupBy("node").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value")))).alias("attributes"))
    return ids.join(maps.withColumnRenamed("node", "id"), "id", "left").withColumn("attributes", F.coalesce("attributes", F.expr("map()").cast("map<string,string>")))


def event_slug(event_type="event_type") -> Column:
    """The type as it stands in keys and predicates: lower case, _ for blanks."""
    return F.replace(F.lower(F.col(event_type)), F.lit(" "), F.lit("_"))


def _anchored(events: DataFrame) -> DataFrame:
    return events.where("anchor_entity != '' and event_type != ''")


def event_sequence(events: DataFrame, seq: str = "seq") -> DataFrame:
    """events(anchor_entity, event_type, ...) with attribute_key event_<type>_<n>; types that differ in case share a numbering."""
    n = F.row_number().over(W.partitionBy("anchor_entity", "_slug").orderBy(seq))
    keyed = _anchored(events).withColumn("_slug", event_slug())
    return keyed.withColumn("attribute_key", F.concat(F.lit("event_"), "_slug", F.lit("_"), n.cast("string"))).drop("_slug")


def events_to_attributes(events: DataFrame, seq: str = "seq") -> DataFrame:
    """(anchor_entity, attribute_key, value JSON): event_type, source_id ('' without one) and the last value of each role, keys ascending.

    Values keep their type: those of value_type string are JSON strings, others JSON as they stand. Empty
    and null roles are left out; a role named event_type or source_id takes that place; null arguments are
    none; a null value is null.
    """
    text = lambda c: F.expr("cast({} as variant)".format(c))
    args = F.expr("""transform(filter(coalesce(arguments, array()), a -> coalesce(a.role, '') <> ''), a -> named_struct('role', a.role, 'value',
        coalesce(if(a.value_type = 'string', cast(a.value as variant), coalesce(try_parse_json(a.value), cast(a.value as variant))), parse_json('null'))))""")
    own = [F.struct(F.lit("event_type").alias("role"), text("event_type").alias("value"))]
    own.append(F.struct(F.lit("source_id").alias("role"), text("coalesce(cast(source_id as string), '')" if "source_id" in events.columns else "''").alias("value")))
    keyed = event_sequence(events, seq).withColumn("_e", F.concat(F.array(*own), args))
    last = F.expr("filter(_e, (x, i) -> not exists(slice(_e, i + 2, size(_e)), y -> y.role = x.role))")
    ordered = F.array_sort(last, lambda x, y: F.when(x.role < y.role, -1).when(x.role > y.role, 1).otherwise(0))
    return keyed.select("anchor_entity", "attribute_key", F.to_json(F.map_from_entries(ordered)).alias("value"))


def events_to_edges(events: DataFrame) -> DataFrame:
    """(src, predicate, dst): string arguments of 1 to 5 words, trimmed, become has_<type>_<role> edges; none to the anchor itself, in any case."""
    flat = _anchored(events).select("anchor_entity", event_slug().alias("_slug"), F.explode("arguments").alias("a"))
    flat = flat.where("a.role != '' and a.value_type = 'string'").select("anchor_entity", "_slug", F.col("a.role").alias("role"), F.regexp_replace("a.value", r"^\s+|\s+$", "").alias("dst"))
    ok = F.size(F.filter(F.split("dst", r"\s+"), lambda w: w != "")).between(1, 5) & (F.lower("dst") != F.lower("anchor_entity"))
    return flat.where(ok).select(F.col("anchor_entity").alias("src"), F.concat(F.lit("has_"), "_slug", F.lit("_"), "role").alias("predicate"), "dst").distinct()


def event_gate(events: DataFrame, mapping: DataFrame, least: float = 0.9) -> DataFrame:
    kept = events.where(F.col("confidence") >= least)
    out = kept.join(mapping.select(F.col("raw").alias("_r"), F.col("canonical").alias("_c")), F.col("anchor_entity") == F.col("_r"), "left")
    return out.withColumn("anchor_entity", F.coalesce("_c", "anchor_entity")).select(*events.columns)


def edge_endpoints(edges: DataFrame, nodes: DataFrame, limit: int | None = None) -> DataFrame:
    """Edges whose two ends are nodes(id). With limit, ends that are none are looked for first: at most so many are broadcast, and edges are not shuffled."""
    if limit is not None:
        lost = staged(edges.select(F.explode(F.array("src", "dst")).alias("id")).where("id is not null").distinct().join(nodes.select("id"), "id", "left_anti"), "lost-ends")
        if lost.limit(limit + 1).count() <= limit:
            known = edges.where("src is not null and dst is not null")
            for end in ("src", "dst"):
                known = known.join(F.broadcast(lost.withColumnRenamed("id", f"_{end}")), F.col(end) == F.col(f"_{end}"), "left_anti")
            return known
    return edges.join(nodes.select(F.col("id").alias("src")), "src", "left_semi").join(nodes.select(F.col("id").alias("dst")), "dst", "left_semi")


def upsert_nodes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(id, attributes): new values over old ones, other old ones stay, name is the id."""
    empty = F.expr("map()").cast("map<string,string>")
    both = old.select("id", F.col("attributes").alias("o")).join(new.select("id", F.col("attributes").alias("n")), "id", "full")
    o, n = F.coalesce("o", empty), F.map_concat(F.map_filter(F.coalesce("n", empty), lambda k, v: k != "name"), F.create_map(F.lit("name"), F.col("id")))
    return both.select("id", F.map_concat(F.map_filter(o, lambda k, v: ~F.map_contains_key(n, k)), n).alias("attributes"))


_NUMBER = re.compile(r"[-+]?\d*\.?\d+(?:[eE][-+]?\d+)?")


def _number(text):
    m = _NUMBER.search(text or "")
    return float(m[0]) if m else None


def fold_edge(state: dict, dst: str, cs: float, ts: float, tolerance: float = 0.03, close: float = 0.08) -> None:
    """Adds a claim to state (dst to edge dict) of one source and predicate.

    Against the best current rival by (cs, ts), equal ones by greater dst: a better and not older claim
    replaces all current ones; a claim about as good whose number, if both have one, is about the same
    stands beside them, contested; any other is history at once.
    """
    rivals = [e for e in state.values() if e["status"] == "Current" and e["dst"] != dst]
    status, contested = "Current", False
    if rivals:
        best = max(rivals, key=lambda e: (e["cs"], e["ts"], e["dst"]))
        new, old = _number(dst), _number(best["dst"])
        ratio = None if new is None or old is None else abs(new - old) / (abs(old) if abs(old) > 1e-12 else 1.0)
        current = [e for e in state.values() if e["status"] == "Current"]
        if cs > best["cs"] and ts >= best["ts"]:
            for e in current:
                e["status"], e["valid_to"] = "History", ts
        elif abs(cs - best["cs"]) <= close and (ratio is None or ratio <= tolerance):
            contested = True
            for e in current:
                e["is_contested"] = True
        else:
            status = "History"
    e = state.setdefault(dst, {"dst": dst, "valid_from": None, "valid_to": None})
    e |= {"status": status, "is_contested": contested, "cs": cs, "ts": ts}
    e["valid_from" if status == "Current" else "valid_to"] = ts


_EVENT = "array<struct<at:bigint,dst:string,is_current:boolean,is_contested:boolean,cs:double,ts:double,valid_from:double,valid_to:double>>"
_CURRENT = "array<struct<dst:string,num:double,is_contested:boolean,cs:double,ts:double>>"
_BLOCK = 256  # claims whose events are put together at once


def _let(value: str, name: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _event(i, dst, status, contested, cs, ts, since, until) -> str:
    return f"named_struct('at', {i} * 2, 'dst', {dst}, 'is_current', {str(status == 'Current').lower()}, 'is_contested', {contested}, 'cs', {cs}, 'ts', {ts}, 'valid_from', {since}, 'valid_to', {until})"


def _step(tolerance: float, close: float) -> str:
    """acc(cur, ev) and claim c to the next acc: fold_edge over the current edges alone, with an event for each edge that it sets or retires."""
    none = "cast(null as double)"
    best = "array_max(transform(filter(acc.cur, e -> e.dst <> c.dst), e -> struct(e.cs, e.ts, e.dst, e.num)))"
    near = f"abs(c.cs - b.cs) <= {close}D and coalesce(abs(c.num - b.num) / if(abs(b.num) > 1e-12D, abs(b.num), 1D) <= {tolerance}D, true)"
    how = f"case when b is null then 'alone' when c.cs > b.cs and c.ts >= b.ts then 'better' when {near} then 'near' else 'worse' end"
    own = lambda contested: f"named_struct('dst', c.dst, 'num', c.num, 'is_contested', {contested}, 'cs', c.cs, 'ts', c.ts)"
    others = "filter(acc.cur, e -> e.dst <> c.dst)"
    marked = f"transform({others}, e -> named_struct('dst', e.dst, 'num', e.num, 'is_contested', true, 'cs', e.cs, 'ts', e.ts))"
    cur = f"case h when 'near' then concat({marked}, array({own('true')})) when 'worse' then {others} else array({own('false')}) end"
    retired = f"transform({others}, e -> {_event('c.i', 'e.dst', 'History', 'e.is_contested', 'e.cs', 'e.ts', none, 'c.ts')})"
    set_ = lambda status, contested, since, until: "array(" + _event("c.i", "c.dst", status, contested, "c.cs", "c.ts", since, until) + ")"
    was = f"if(exists(acc.cur, e -> e.dst = c.dst), c.ts, {none})"
    events = f"case h when 'alone' then {set_('Current', 'false', 'c.ts', none)} when 'better' then concat({retired}, {set_('Current', 'false', 'c.ts', was)}) when 'near' then {set_('Current', 'true', 'c.ts', none)} else {set_('History', 'false', none, 'c.ts')} end"
    return _let(best, "b", _let(how, "h", f"named_struct('cur', {cur}, 'ev', concat(acc.ev, {events}))"))


def _folded(runs: DataFrame, tolerance: float, close: float, keep: list[str]) -> DataFrame:
    """runs(src, predicate, claims in order, cur, keep) with cur after them and events ev."""
    block = f"aggregate(part, named_struct('cur', whole.cur, 'ev', cast(array() as {_EVENT})), (acc, c) -> {_step(tolerance, close)})"
    merged = _let(block, "r", "named_struct('cur', r.cur, 'ev', array_append(whole.ev, r.ev))")
    parts = f"transform(sequence(0, (size(claims) - 1) div {_BLOCK}), j -> slice(claims, cast(j * {_BLOCK} + 1 as int), {_BLOCK}))"
    out = runs.withColumn("_f", F.expr(f"aggregate({parts}, named_struct('cur', coalesce(cur, cast(array() as {_CURRENT})), 'ev', cast(array() as array<{_EVENT}>)), (whole, part) -> {merged})"))
    return out.select("src", "predicate", F.col("_f.cur").alias("cur"), F.flatten("_f.ev").alias("ev"), *keep)


def number_in(text: str) -> Column:
    return F.nullif(F.regexp_extract(text, _NUMBER.pattern, 0), F.lit("")).cast("double")


def _few_keys(claims: DataFrame, limit: int) -> bool:
    """Whether claims have at most limit keys; an estimate tells where they are far from it."""
    about = claims.agg(F.approx_count_distinct(F.xxhash64("src", "predicate"))).first()[0]
    return about <= 2 * limit and claims.select("src", "predicate").distinct().limit(limit + 1).count() <= limit


def split_touched(edges: DataFrame, claims: DataFrame, limit: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """edges of a (src, predicate) that claims have, and the others; without a shuffle of edges if the keys are at most limit, which are broadcast then."""
    keys = claims.select("src", "predicate").distinct()
    keys = F.broadcast(keys) if _few_keys(claims, limit) else keys
    return edges.join(keys, ["src", "predicate"], "left_semi"), edges.join(keys, ["src", "predicate"], "left_anti")


def _old(existing: DataFrame) -> Column:
    return F.struct("dst", F.col("status").cast("string").alias("status"), F.col("is_contested").alias("is_contested"), *[F.col(c).cast("double").alias(c) for c in ("cs", "ts", "valid_from", "valid_to")])


def _current_of(old: str) -> Column:
    return F.transform(F.filter(old, lambda e: F.coalesce(e.status == "Current", F.lit(False))), lambda e: F.struct(e.dst.alias("dst"), number_in(e.dst).alias("num"), F.coalesce(e.is_contested, F.lit(False)).alias("is_contested"), e.cs.alias("cs"), e.ts.alias("ts")))


def _events_of(old: str) -> Column:
    return F.transform(old, lambda e: F.struct(F.lit(-1).cast("bigint").alias("at"), e.dst.alias("dst"), (e.status == "Current").alias("is_current"), F.coalesce(e.is_contested, F.lit(False)).alias("is_contested"), e.cs.alias("cs"), e.ts.alias("ts"), e.valid_from.alias("valid_from"), e.valid_to.alias("valid_to")))


def begun(existing: DataFrame) -> DataFrame:
    """Edges by their key: (src, predicate, cur, ev), the current ones and an event before all others for each."""
    old = existing.groupBy("src", "predicate").agg(F.collect_list(_old(existing)).alias("_old"))
    return old.select("src", "predicate", _current_of("_old").alias("cur"), _events_of("_old").alias("ev"))


def _longest(rows: DataFrame, run: int) -> int:
    """How many claims a key has at most; more than it has, but not over run, by a count of 65,536 buckets of keys where that is enough."""
    most = lambda *by: rows.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
    bound = most(F.pmod(F.xxhash64("src", "predicate"), F.lit(65_536)))
    return bound if bound <= run else most("src", "predicate")


def fold_claims(claims: DataFrame, carried: DataFrame | None = None, seq: str = "seq", tolerance: float = 0.03, close: float = 0.08, run: int = 100_000, existing: DataFrame | None = None) -> list[DataFrame]:
    """(src, predicate, cur, ev) for each run of claims(src, predicate, dst, cs, ts, seq) over carried(src, predicate, cur, ev): the current edges after it, and its events in order of at.

    With existing edges instead of carried, these meet the claims in one shuffle of both, and all come out:
    the first run has a row of each key, those without a claim with untouched edges and no events.
    """
    rows = claims.select("src", "predicate", F.col(seq).alias("seq"), "dst", F.coalesce("cs", F.lit(0.0)).cast("double").alias("cs"), F.coalesce("ts", F.lit(0.0)).cast("double").alias("ts"))
    key, none, out = ["src", "predicate"], F.lit(None).cast("double"), []
    no_events, claim = F.expr(f"cast(array() as {_EVENT})"), F.struct("seq", "dst", "cs", "ts")
    rounds = max(1, -(-_longest(rows, run) // run))
    if rounds > 1:
        rows = staged(rows.withColumn("_run", F.floor((F.row_number().over(W.partitionBy(*key).orderBy("seq", "dst", "cs", "ts")) - 1) / run).cast("int")), "claim-runs")
    for r in range(rounds):
        some = rows.where(F.col("_run") == r) if rounds > 1 else rows
        whole = existing is not None and r == 0
        if whole:
            given = some.select(*key, claim.alias("_c"))
            both = given.unionByName(existing.select(*key, _old(existing).alias("_o")), allowMissingColumns=True)
            lists = both.groupBy(*key).agg(F.array_sort(F.collect_list("_c")).alias("_l"), F.collect_list("_o").alias("_old")).withColumn("cur", _current_of("_old"))
        else:
            lists = some.groupBy(*key).agg(F.array_sort(F.collect_list(claim)).alias("_l"))
        claims_of = F.transform("_l", lambda c, j: F.struct((F.lit(r * run) + j).cast("bigint").alias("i"), c.dst.alias("dst"), number_in(c.dst).alias("num"), c.cs.alias("cs"), c.ts.alias("ts")))
        runs = lists.withColumn("claims", claims_of).drop("_l")
        if not whole:
            runs = runs.join(carried, key, "left") if carried is not None else runs.withColumn("cur", F.lit(None).cast(_CURRENT))
        runs = runs.withColumn("_before", _events_of("_old") if whole else F.coalesce("ev", no_events) if "ev" in runs.columns else no_events)
        done = _folded(runs, tolerance, close, ["_before", *(["_old"] if whole else [])])
        # a current edge may have become contested since the claim that set it
        last = F.lit(2 * ((r + 1) * run - 1) + 1).cast("bigint")
        now = F.transform("cur", lambda e: F.struct(last.alias("at"), e.dst.alias("dst"), F.lit(True).alias("is_current"), e.is_contested.alias("is_contested"), e.cs.alias("cs"), e.ts.alias("ts"), none.alias("valid_from"), none.alias("valid_to")))
        events = F.concat("_before", "ev", now)
        if whole:
            idle = F.size("ev") == 0
            done = done.select(*key, "cur", F.when(~idle, events).otherwise(no_events).alias("ev"), F.when(idle, F.col("_old")).alias("untouched"))
        else:
            done = done.select(*key, "cur", events.alias("ev"))
        if rounds > 1:
            done = staged(done, "folded-run")
            after = done.select(*key, "cur")
            carried = after if carried is None else staged(carried.select(*key, "cur").join(after.select(*key), key, "left_anti").unionByName(after), "carried")
        out.append(done)
    return out


def edges_of_events(events: DataFrame, at: Column | None = None) -> DataFrame:
    """Edges of events(src, predicate, dst, at, ...): the last event of each with its last begin and end."""
    at = F.col("at") if at is None else at
    state = [F.max_by(c, at).alias(c) for c in ("is_current", "is_contested", "cs", "ts")]
    times = [F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in ("valid_from", "valid_to")]
    last = events.groupBy("src", "predicate", "dst").agg(*state, *times)
    return last.select("src", "predicate", "dst", F.when(F.col("is_current"), "Current").otherwise("History").alias("status"), "is_contested", "valid_from", "valid_to", "cs", "ts")


def _edges_of_all(runs: list[DataFrame]) -> DataFrame:
    """edges_of_events of runs whose first one has untouched edges too, which come out as they are: each is a group of its own in the same pass."""
    key = ["src", "predicate"]
    plain = "e -> named_struct('_n', 0, 'status', cast(null as string), 'at', e.at, 'dst', e.dst, 'is_current', e.is_current, 'is_contested', e.is_contested, 'cs', e.cs, 'ts', e.ts, 'valid_from', e.valid_from, 'valid_to', e.valid_to)"
    still = "(e, i) -> named_struct('_n', i + 1, 'status', e.status, 'at', -1L, 'dst', e.dst, 'is_current', false, 'is_contested', e.is_contested, 'cs', e.cs, 'ts', e.ts, 'valid_from', e.valid_from, 'valid_to', e.valid_to)"
    rows = [r.select(*key, F.inline(F.expr(f"if(untouched is null, transform(ev, {plain}), transform(untouched, {still}))" if i == 0 else f"transform(ev, {plain})"))) for i, r in enumerate(runs)]
    events = reduce(DataFrame.unionByName, rows)
    state = [F.max_by(c, "at").alias(c) for c in ("status", "is_current", "is_contested", "cs", "ts")]
    times = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("at"))).alias(c) for c in ("valid_from", "valid_to")]
    last = events.groupBy(*key, "dst", "_n").agg(*state, *times)
    status = F.when(F.col("_n") > 0, F.col("status")).when(F.col("is_current"), "Current").otherwise("History").alias("status")
    return last.select(*key, "dst", status, "is_contested", "valid_from", "valid_to", "cs", "ts")


def resolve_conflicts(claims: DataFrame, existing: DataFrame | None = None, seq: str = "seq", tolerance: float = 0.03, close: float = 0.08, run: int = 100_000, few: int = 200_000) -> DataFrame:
    """Versioned edges of claims(src, predicate, dst, cs, ts, seq), folded in order of seq as its type orders it (ties by dst, cs, ts), over existing edges.

    The rule is that of fold_edge. A claim is weighed against the current edges of its key, so these alone
    are carried along an ordered array of the key's claims, in the JVM; each claim leaves events, of which
    the last for an edge, with its last begin and end, are the result. A key of over `run` claims is folded
    a run at a time. Existing edges of keys without a claim pass through, without a shuffle if the keys of
    the claims are at most `few`, which are broadcast; else existing edges and claims meet in one shuffle.
    """
    how = {"seq": seq, "tolerance": tolerance, "close": close, "run": run}
    if existing is not None and not _few_keys(claims, few):
        unnamed = F.col("src").isNull() | F.col("predicate").isNull()  # keys that no claim meets
        out = _edges_of_all(fold_claims(claims, existing=existing.where(~unnamed), **how))
        return out.unionByName(existing.where(unnamed).select(*out.columns))
    touched, untouched = split_touched(existing, claims, few) if existing is not None else (None, None)
    runs = fold_claims(claims, None if touched is None else begun(touched), **how)
    out = edges_of_events(reduce(DataFrame.unionByName, [r.select("src", "predicate", F.inline("ev")) for r in runs]))
    return out.unionByName(untouched.select(*out.columns)) if untouched is not None else out


def current_view(edges: DataFrame) -> DataFrame:
    return edges.where("status = 'Current'")


def history_view(edges: DataFrame) -> DataFrame:
    return edges.where("status = 'History'")


def contested_view(edges: DataFrame) -> DataFrame:
    return edges.where("is_contested")


def incremental_graph_update(nodes: DataFrame, edges: DataFrame, new_nodes: DataFrame, claims: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A batch over persisted nodes and edges; claims need both ends."""
    merged = upsert_nodes(nodes, new_nodes)
    return merged, resolve_conflicts(edge_endpoints(claims, merged, limit=200_000), edges)


def subgraph(edges: DataFrame, start: DataFrame, depth: int, hub: int = 100_000) -> DataFrame:
    """(start, node, hops, path): undirected paths of 1 to depth edges, none used twice. edges(src, predicate, dst) are distinct.

    A node with over `hub` edges has them dealt into parts of about as many, each of which meets the paths
    at that node in a task of its own.
    """
    e = edges.select("src", "predicate", "dst", F.xxhash64("src", "predicate", "dst").alias("_e"))
    both = e.select(F.col("src").alias("_from"), F.col("dst").alias("_to"), "_e").union(e.where("src != dst").select("dst", "src", "_e"))
    hubs = staged(both.groupBy("_from").count().where(F.col("count") > hub).select("_from", F.ceil(F.col("count") / hub).alias("_parts")), "hubs")
    parts = F.coalesce("_parts", F.lit(1)).cast("long")
    both = both.join(hubs, "_from", "left").select("_from", "_to", "_e", F.pmod("_e", parts).alias("_part"))
    paths = start.select(F.col("id").alias("start"), F.col("id").alias("node"), F.array().cast("array<bigint>").alias("_used"), F.array("id").alias("path"))
    out = None
    for hop in range(1, depth + 1):
        at = paths.join(hubs.withColumnRenamed("_from", "node"), "node", "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("_parts")
        step = at.join(both.withColumnRenamed("_from", "node"), ["node", "_part"]).where(~F.array_contains("_used", F.col("_e")))
        paths = step.select("start", F.col("_to").alias("node"), F.array_append("_used", F.col("_e")).alias("_used"), F.array_append("path", F.col("_to")).alias("path"))
        paths = staged(paths, "paths") if hop < depth else paths
        found = paths.select("start", "node", F.lit(hop).alias("hops"), "path")
        out = found if out is None else out.union(found)
    return out
