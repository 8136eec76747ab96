"""A Merkle manifest of a dataset: digests of rows, runs of them, languages and the whole, with proofs.

Each row is a leaf. The leaves of a language, by doc_id, are hashed in runs of `arity`, and so are the
digests made of them, until one is left; these digests, by language, are hashed likewise to the root. At
each level the first of a run names its siblings' indices by slot offsets, an equijoin fetches them, and
that row emits the parent. Going down, a node finds its run by the index of its slot zero and takes the
others of it before its parent's proof, so an upper part of a proof is worked out once for all below.

Indices come from a range partitioning, so a language of most rows is no single task; the number of levels
is the logarithm of the largest language, and each is one staged table.

Defined cases: a null value is `-` in the leaf; null lang is a language of its own, before others; null
doc_id comes first and is not tampered with; rows of one doc_id are leaves of their own, by digest; texts
of any length are hashed whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Staging, ascii_lower
from .ordering import numbered, sorted_parts

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_GROUP = ["_group"]
_NO_PATH = "cast(array() as array<struct<l:string,r:string>>)"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """Length in bytes, colon, value: no two lists of values read the same."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**replaced: Column) -> Column:
    return digest(*[field(replaced.get(c, F.col(c))) for c in FIELDS])


def levels_of(nodes: DataFrame, arity: int, stage) -> list[DataFrame]:
    """Tables (_group, idx, n, hash, children) of each level over nodes(_group, idx, n, hash); a group ends at the level where n is 1."""
    out, most = [nodes], nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        level = out[-1].where("n > 1").select("_group", "idx", "n", "hash")
        slot = F.col("idx") % arity
        first = level.where(slot == 0)
        asked = first.where(F.col("n") - 1 > F.col("idx")).select("_group", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(arity - 1), F.col("n") - 1 - F.col("idx")))).alias("_off"), "idx", "n")
        asked = asked.select("_group", (F.col("idx") + F.col("_off")).alias("idx"), F.col("idx").alias("_zero"), "n")
        siblings = asked.join(level.select("_group", "idx", "hash"), ["_group", "idx"])
        runs = first.select("_group", "idx", F.col("idx").alias("_zero"), "n", "hash").unionByName(siblings)
        parents = runs.groupBy("_group", "_zero", "n").agg(F.array_sort(F.collect_list(F.struct("idx", "hash"))).alias("_c"))
        children = F.col("_c.hash")
        out.append(stage(parents.select("_group", F.expr(f"_zero div {arity}").alias("idx"), F.ceil(F.col("n") / arity).alias("n"), digest(F.array_join(children, "")).alias("hash"), children.alias("children")), "level"))
        most = -(-most // arity)
    return out


def _side(start, length) -> Column:
    return F.array_join(F.slice("_run", start, length), "")


def paths_of(levels: list[DataFrame], tops: DataFrame | None, arity: int, keep: list[str]) -> DataFrame:
    """Rows of the first level with `keep`, their group's columns of tops(_group, path, ...) and path: (left, right) siblings of each level, upwards.

    Without tops there is nothing above the groups.
    """
    extra = [c for c in tops.columns if c not in ("_group", "path")] if tops is not None else []
    below = None
    for level in reversed(levels):
        last = level is levels[0]
        own = ["_group", "idx", "hash", *(keep if last else ["children"])]
        done = level.where("n = 1").select(*own)
        done = done.join(tops, "_group") if tops is not None else done.withColumn("path", F.expr(_NO_PATH))
        if below is not None:
            slot = (F.col("idx") % arity).cast("int")
            run = below.select("_group", F.col("idx").alias("_above"), F.col("children").alias("_run"), F.col("path").alias("_path"), *extra)
            met = level.where("n > 1").select(*own, F.expr(f"idx div {arity}").alias("_above")).join(run, ["_group", "_above"])
            step = F.struct(_side(F.lit(1), slot).alias("l"), _side(slot + 2, F.lit(arity)).alias("r"))
            done = done.unionByName(met.select(*own, F.concat(F.array(step), "_path").alias("path"), *extra))
        below = done
    return below


def merkle_manifest(docs: DataFrame, arity: int = 8, tampered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, lang, idx, proof) of docs(doc_id, source, lang, n_chars, text).

    Rows for which `tampered` holds have their text's A-Z lower-cased before the leaf is folded with the
    proof of the original; verified says whether root comes out.
    """
    stage, passing = Staging(docs.sparkSession), Staging(docs.sparkSession)
    bad = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    lower = F.when(bad, leaf_digest(text=ascii_lower(F.col("text"))))
    group = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-"))  # null before all
    leaves = passing(docs.select(*FIELDS).select(group.alias("_group"), "doc_id", "lang", leaf_digest().alias("hash"), lower.alias("_bad")), "leaves")
    nodes = stage(numbered(sorted_parts(leaves, _GROUP, ["doc_id", "hash"], passing), _GROUP), "leaves-numbered")
    levels = levels_of(nodes, arity, stage)
    subroots = None
    for level in levels:
        found = level.where("n = 1").select(F.col("_group").alias("_lang"), "hash")
        subroots = found if subroots is None else subroots.unionByName(found)
    subroots = sorted_parts(subroots.withColumn("_group", F.lit("")), _GROUP, ["_lang"], passing)
    top = levels_of(stage(numbered(subroots, _GROUP), "subroots"), arity, stage)
    passing.close()
    head = top[-1].select("hash").first()
    root = F.lit(head[0] if head else None).cast("string")
    tops = paths_of(top, None, arity, ["_lang"]).select(F.col("_lang").alias("_group"), F.col("hash").alias("subroot"), "path")
    rows = paths_of(levels, tops, arity, ["doc_id", "lang", "_bad"])
    folded = F.aggregate("path", F.coalesce("_bad", "hash"), lambda acc, x: F.sha2(F.concat(x.l, acc, x.r), 256))
    proof = F.array_join(F.transform("path", lambda x: F.concat(x.l, x.r)), "")
    out = rows.select("doc_id", F.col("hash").alias("leaf"), "subroot", root.alias("root"), F.sha2(proof, 256).alias("proof_sha256"), folded.alias("folded_root"), "lang", "idx", proof.alias("proof"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
