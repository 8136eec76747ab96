"""Canonical names: distinct terms, mappings, aliases, definitions and leader clustering."""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import slugify, to_camel_case, to_pascal_case
from .components import connected_components
from .stage import staged
from .vectors import sparse_candidates, sparse_embedding

ATTRIBUTE_PREDICATES = ("attribute", "attributes")


def _plain() -> "F.Column":
    return ~F.coalesce(F.lower("predicate").isin(*ATTRIBUTE_PREDICATES), F.lit(False))


def distinct_terms(triples: DataFrame) -> DataFrame:
    """(term_type, term, n): relations and entities of rows that aren't attributes. List-valued terms count each element."""
    def flat(c: str):
        kind = dict(triples.dtypes)[c]
        return F.col(c) if kind.startswith("array") else F.array(c)

    def typed(kind: str):
        return lambda x: F.struct(F.lit(kind).alias("term_type"), x.alias("term"))

    parts = [F.transform(flat(c), typed(k)) for c, k in (("subject", "entity"), ("predicate", "relation"), ("object", "entity"))]
    rows = triples.where(_plain()) if dict(triples.dtypes)["predicate"] == "string" else triples
    return rows.select(F.explode(F.concat(*parts)).alias("x")).select("x.*").where("term is not null and term != ''").groupBy("term_type", "term").agg(F.count("*").alias("n"))


def predicate_objects(triples: DataFrame) -> DataFrame:
    """The distinct objects of each predicate, as rows."""
    return triples.select("predicate", "object").distinct()


def new_terms(terms: DataFrame, mappings: DataFrame) -> DataFrame:
    """Terms that mappings(term_type, raw, canonical) doesn't have."""
    return terms.join(mappings.select("term_type", F.col("raw").alias("term")), ["term_type", "term"], "left_anti")


def apply_mappings(triples: DataFrame, mappings: DataFrame) -> DataFrame:
    """Terms replaced by their canonical, default self; attribute rows keep predicate and object."""
    ent = mappings.where("term_type = 'entity'").select(F.col("raw").alias("_raw"), F.col("canonical").alias("_to"))
    rel = mappings.where("term_type = 'relation'").select(F.col("raw").alias("_raw"), F.col("canonical").alias("_to"))
    out = triples
    for c, table in (("subject", ent), ("object", ent), ("predicate", rel)):
        out = out.join(table.withColumnRenamed("_to", f"_{c}"), F.col(c) == F.col("_raw"), "left").drop("_raw")
    plain = _plain()
    out = out.select(*triples.columns, *[F.coalesce(f"_{c}", c).alias(f"_n_{c}") for c in ("subject", "object", "predicate")], plain.alias("_plain"))
    new = {c: F.when(F.col("_plain"), F.col(f"_n_{c}")).otherwise(F.col(c)) for c in ("object", "predicate")} | {"subject": F.col("_n_subject")}
    return out.withColumns(new).select(*triples.columns)


def map_list(df: DataFrame, column: str, mappings: DataFrame, key: str) -> DataFrame:
    """A list-valued column mapped element by element, in order. key identifies rows."""
    table = mappings.select(F.col("raw").alias("_x"), F.col("canonical").alias("_to"))
    flat = df.select(key, F.posexplode(column).alias("_i", "_x")).join(table, "_x", "left").select(key, "_i", F.coalesce("_to", "_x").alias("_x"))
    lists = flat.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_x"))), lambda s: s._x).alias("_new"))
    return df.join(lists, key, "left").withColumn(column, F.coalesce("_new", F.col(column))).drop("_new")


def alias_table(lists: DataFrame, identifiers: DataFrame | None = None) -> DataFrame:
    """(alias, primary) of lists(primary, aliases array, seq), then of catalogue identifiers of the same shape; the last wins, and no alias is its primary."""
    both = lists.select("primary", "aliases", F.lit(0).alias("_o"), "seq")
    if identifiers is not None:
        both = both.union(identifiers.select("primary", "aliases", F.lit(1), "seq"))
    rows = both.select(F.explode("aliases").alias("alias"), "primary", "_o", "seq").where("alias != '' and alias != primary")
    return rows.groupBy("alias").agg(F.max_by("primary", F.struct("_o", "seq")).alias("primary"))


def resolve_aliases(triples: DataFrame, aliases: DataFrame) -> DataFrame:
    """Subject and object by alias(alias, primary); original_* where one was replaced."""
    out = triples
    for c in ("subject", "object"):
        out = out.join(aliases.select(F.col("alias").alias(c), F.col("primary").alias(f"_{c}")), c, "left")
        out = out.withColumn(f"original_{c}", F.when(F.col(f"_{c}").isNotNull(), F.col(c))).withColumn(c, F.coalesce(f"_{c}", c)).drop(f"_{c}")
    return out.select(*triples.columns, "original_subject", "original_object")


def attach_definitions(triples: DataFrame, definitions: DataFrame) -> DataFrame:
    """subject_definition, and object_definition unless the predicate is 'has definition'."""
    out = triples
    for c in ("subject", "object"):
        out = out.join(definitions.select(F.col("entity").alias(c), F.col("definition").alias(f"{c}_definition")), c, "left")
    own = F.when(F.col("predicate").eqNullSafe("has definition"), None).otherwise(F.col("object_definition"))
    return out.withColumn("object_definition", own).select(*triples.columns, "subject_definition", "object_definition")


def append_definitions(attributes: DataFrame, definitions: DataFrame) -> DataFrame:
    """A definition attribute for each defined entity without one."""
    have = attributes.where("attribute = 'definition'").select("entity")
    new = definitions.join(have, "entity", "left_anti").select("entity", F.lit("definition").alias("attribute"), F.col("definition").alias("value"), F.lit(1.0).alias("confidence"), F.lit("UAT_definition").alias("text_id"))
    return attributes.unionByName(new, allowMissingColumns=True)


def mapping_stats(mappings: DataFrame, exact: bool = True) -> DataFrame:
    """By term_type: total, distinct canonicals, merged and merge rate."""
    distinct = F.count_distinct("canonical") if exact else F.approx_count_distinct("canonical")
    out = mappings.groupBy("term_type").agg(F.count("*").alias("total"), distinct.alias("n_canonical"))
    return out.withColumn("merged", F.col("total") - F.col("n_canonical")).withColumn("merge_rate", 1 - F.col("n_canonical") / F.col("total"))


def judge_key() -> "F.Column":
    """Cache key of a request(term_type, term, candidates)."""
    return F.md5(F.concat_ws(":", "term_type", "term", F.array_join(F.array_sort("candidates"), "|")))


def judge_requests(requests: DataFrame, judge: Callable[[str, str, list], str | None]) -> DataFrame:
    """requests with choice: each distinct (type, term, candidate set) is judged once. A choice that is no candidate is null."""
    keyed = requests.withColumn("_key", judge_key())
    once = keyed.groupBy("_key").agg(F.min(F.struct("term_type", "term", F.array_sort("candidates").alias("candidates"))).alias("r")).select("_key", "r.*")

    def run(frames):
        for f in frames:
            picks = [judge(a, b, list(c)) for a, b, c in zip(f["term_type"], f["term"], f["candidates"])]
            yield pd.DataFrame({"_key": f["_key"], "choice": [p if p is not None and p in list(c) else None for p, c in zip(picks, f["candidates"])]})

    return keyed.join(once.mapInPandas(run, "_key string, choice string"), "_key").drop("_key")


_DECIDED = "term string, leader string"


def _greedy(judge: Callable | None, term_type: str, k: int):
    """The greedy scan over the accepted pairs of one group."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        near: dict[str, list] = {}
        for a, b, score, same, n in zip(frame["a"], frame["b"], frame["score"], frame["same"], frame["n_b"]):
            near.setdefault(a, []).append((same, score, n, b))
        count_of = dict(zip(frame["a"], frame["n_a"]))
        leader: dict[str, str] = {}
        for a in sorted(near, key=lambda t: (-count_of[t], t)):
            # what is before it and has no pair of its own leads itself
            options = [x[3] for x in sorted((x for x in near[a] if leader.get(x[3], x[3]) == x[3]), reverse=True)[:k]]
            pick = (options[0] if options else None) if judge is None else judge(term_type, a, sorted(options))
            leader[a] = pick if pick in options else a
        return pd.DataFrame({"term": list(leader), "leader": list(leader.values())})

    return run


def _in_rounds(terms: DataFrame, pairs: DataFrame, k: int, judge: Callable | None, term_type: str, max_rounds: int | None) -> DataFrame:
    """(term, leader) of the terms of pairs, those whose earlier terms are all decided at a time."""
    done = staged(terms.join(pairs.select(F.col("a").alias("term")), "term", "left_anti").select("term", F.col("term").alias("leader")), "decided")
    for n in count():
        left = pairs.join(done.select(F.col("term").alias("a")), "a", "left_anti")
        seen = left.join(done.select(F.col("term").alias("b"), "leader"), "b", "left")
        # a leader is its own leader; a decided member is no candidate
        options = F.sort_array(F.collect_list(F.when(F.col("leader") == F.col("b"), F.struct("same", "score", "n_b", F.col("b")))), asc=False)
        per = seen.groupBy("a").agg(F.count_if(F.col("leader").isNull()).alias("open"), F.slice(options, 1, k).alias("c"))
        ready = per.where("open = 0").select(F.col("a").alias("term"), F.transform("c", lambda x: x.b).alias("candidates"))
        if judge is None:
            new = ready.select("term", F.coalesce(F.get("candidates", F.lit(0)), "term").alias("leader"))
        else:
            new = judge_requests(ready.withColumn("term_type", F.lit(term_type)), judge).select("term", F.coalesce("choice", "term").alias("leader"))
        new = staged(new, "decided-now")
        if new.isEmpty():
            return done
        if n == max_rounds:
            raise RuntimeError("canonicalize_terms did not settle")
        done = staged(done.union(new), "decided")


def canonicalize_terms(terms: DataFrame, threshold: float = 0.7, k: int = 5, judge: Callable | None = None, term_type: str = "entity", max_rounds: int | None = None, group_pairs: int = 200_000) -> DataFrame:
    """(raw, canonical) of terms(term, n): greedy leaders in order of frequency, then name.

    A term joins a leader that comes before it and is accepted, else leads itself. Without a judge the
    leader with an equal slug, else the nearest, is taken. The scan of one connected component of accepted
    pairs doesn't touch another, so each of up to group_pairs pairs is scanned in one pass over its pairs;
    without a judge, fewer pairs than that in all are one group. Greater components are decided in rounds,
    each term once all accepted terms before it are; with max_rounds, terms left after it are an error.
    """
    vec = sparse_embedding(terms)
    order = terms.select("term", F.struct((-F.col("n")).alias("n"), "term").alias("o"))
    pairs = sparse_candidates(vec, vec, threshold).where("a != b")
    pairs = pairs.join(order.select(F.col("term").alias("a"), F.col("o").alias("oa")), "a").join(order.select(F.col("term").alias("b"), F.col("o").alias("ob")), "b").where("ob < oa")
    pairs = staged(pairs.select("a", "b", F.round("score", 9).alias("score"), (slugify("a") == slugify("b")).alias("same"), (-F.col("oa.n")).alias("n_a"), (-F.col("ob.n")).alias("n_b")), "accepted-pairs")
    alone = terms.join(pairs.select(F.col("a").alias("term")), "term", "left_anti").select("term", F.col("term").alias("leader"))
    if judge is None and pairs.limit(group_pairs + 1).count() <= group_pairs:
        decided = pairs.groupBy(F.lit(0).alias("component")).applyInPandas(_greedy(None, term_type, k), _DECIDED)
        return alone.union(decided).select(F.col("term").alias("raw"), F.col("leader").alias("canonical"))
    part = connected_components(pairs.select(F.col("a").alias("x"), F.col("b").alias("y")))
    tagged = pairs.join(part.withColumnRenamed("vertex", "a"), "a")
    great = staged(tagged.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") > group_pairs).select("component"), "great-components")
    decided = tagged.join(great, "component", "left_anti").groupBy("component").applyInPandas(_greedy(judge, term_type, k), _DECIDED)
    if not great.isEmpty():
        rest = staged(tagged.join(great, "component", "left_semi").drop("component"), "great-pairs")
        members = part.join(great, "component", "left_semi").select(F.col("vertex").alias("term"))
        ranked = _in_rounds(members, rest, k, judge, term_type, max_rounds)
        decided = decided.union(ranked.join(alone.select("term"), "term", "left_anti"))
    return alone.union(decided).select(F.col("term").alias("raw"), F.col("leader").alias("canonical"))


def incremental_mapping(terms: DataFrame, mappings: DataFrame, **options) -> DataFrame:
    """mappings(term_type, raw, canonical) kept, with those of terms they don't have."""
    fresh, out = new_terms(terms, mappings), mappings
    for kind in ("entity", "relation"):
        out = out.unionByName(canonicalize_terms(fresh.where(F.col("term_type") == kind), term_type=kind, **options).withColumn("term_type", F.lit(kind)))
    return out


def generated_names(terms: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Older form: canonical is camelCase of a relation or PascalCase of an entity, or one already staged under that name."""
    named = terms.withColumn("canonical", F.when(F.col("term_type") == "relation", to_camel_case("term")).otherwise(to_pascal_case("term")))
    if existing is None:
        return named
    held = existing.groupBy("term_type", F.lower("canonical").alias("_k")).agg(F.min("canonical").alias("_held"))
    return named.withColumn("_k", F.lower("canonical")).join(held, ["term_type", "_k"], "left").withColumn("canonical", F.coalesce("_held", "canonical")).drop("_k", "_held")
