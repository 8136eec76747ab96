"""Section trees and claims JSON as tables."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import clean_wiki_markup, is_excluded_section, is_section_text
from .stage import staged

SNAK = "struct<mainsnak:struct<datatype:string,datavalue:struct<value:string>>>"


def section_tree_flatten(sections: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(doc, id, path, depth, text) of sections(doc, id, parent, title, text); an excluded section drops its subtree.

    path is 'parent > child'. One equi-join a level, until a level is empty; with max_depth, deeper sections are
    left out. A level deeper than a doc has sections is an error, as a section is below itself then.
    """
    level = sections.where(F.col("parent").isNull() & ~is_excluded_section("title")).select("doc", "id", F.col("title").alias("path"), F.lit(0).alias("depth"), "text")
    out = level = staged(level, "section-level")
    kids = sections.where(F.col("parent").isNotNull() & ~is_excluded_section("title"))
    most = kids.groupBy("doc").count().agg(F.max("count")).first()[0] or 0
    for depth in count(1):
        if max_depth is not None and depth > max_depth or level.isEmpty():
            return out
        if depth > most + 1:
            raise RuntimeError("section_tree_flatten: a section is below itself")
        up = level.select("doc", F.col("id").alias("parent"), F.col("path").alias("_up"))
        level = kids.join(up, ["doc", "parent"]).select("doc", "id", F.concat_ws(" > ", "_up", "title").alias("path"), F.lit(depth).alias("depth"), "text")
        level = staged(level, "section-level")
        out = out.union(level)


def section_texts(sections: DataFrame) -> DataFrame:
    """Flattened sections with clean text of sufficient quality."""
    flat = section_tree_flatten(sections).withColumn("text", clean_wiki_markup("text"))
    return flat.where(is_section_text("text")).withColumn("text", F.concat(F.lit("Section: "), F.col("path"), F.lit("\n"), F.col("text")))


def _snaks(claims: DataFrame) -> DataFrame:
    """(qcode, prop, pos, datatype, value JSON) of claims(qcode, json)."""
    props = claims.select("qcode", F.explode(F.from_json("json", "map<string,string>")).alias("prop", "list"))
    return props.select("qcode", "prop", F.posexplode(F.from_json("list", f"array<{SNAK}>")).alias("pos", "c")).select("qcode", "prop", "pos", F.col("c.mainsnak.datatype").alias("datatype"), F.col("c.mainsnak.datavalue.value").alias("value")).where("value is not null")


def _unit():
    url = F.get_json_object("value", "$.unit")
    return F.when(F.contains(url, F.lit("entity/")), F.substring_index(url, "/", -1))


def unknown_codes(claims: DataFrame, labels: DataFrame, batch: int = 50) -> DataFrame:
    """(code, batch_no) of P and Q codes without a label, in batches by code order within hash groups of codes."""
    s = _snaks(claims)
    codes = s.select(F.explode(F.filter(F.array("prop", F.when(F.col("datatype") == "wikibase-item", F.get_json_object("value", "$.id")), F.when(F.col("datatype") == "quantity", _unit())), lambda c: c.isNotNull())).alias("code")).distinct()
    new = codes.where(F.col("code").rlike(r"^[QP]\d+$")).join(labels.select("code"), "code", "left_anti").withColumn("_g", F.pmod(F.xxhash64("code"), F.lit(64)))
    k = F.row_number().over(W.partitionBy("_g").orderBy("code")) - 1
    return new.select("code", F.concat_ws("-", F.col("_g"), F.floor(k / batch)).alias("batch_no"))


def flatten_claims(claims: DataFrame, labels: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """(qcode, label, value): codes by overrides, then labels(code, label), else themselves; values by datatype; several joined by '; '."""
    names = labels.select("code", "label")
    if overrides is not None:
        names = names.join(overrides.select("code", F.col("label").alias("_o")), "code", "full").select("code", F.coalesce("_o", "label").alias("label"))
    s = _snaks(claims)
    code = F.when(F.col("datatype") == "wikibase-item", F.get_json_object("value", "$.id")).when(F.col("datatype") == "quantity", _unit())
    s = s.withColumn("_code", code).join(names.select(F.col("code").alias("_code"), F.col("label").alias("_v")), "_code", "left").join(names.select(F.col("code").alias("prop"), F.col("label").alias("_p")), "prop", "left")
    shown = F.coalesce("_v", "_code")
    j = lambda p: F.get_json_object("value", p)
    value = (
        F.when(F.col("datatype") == "wikibase-item", shown)
        .when(F.col("datatype") == "quantity", F.trim(F.concat_ws(" ", F.replace(j("$.amount"), F.lit("+"), F.lit("")), F.coalesce(shown, F.lit("")))))
        .when(F.col("datatype") == "time", j("$.time"))
        .when(F.col("datatype") == "monolingualtext", j("$.text"))
        .when(F.col("datatype") == "globe-coordinate", F.concat(F.lit("lat:"), j("$.latitude"), F.lit(", lon:"), j("$.longitude")))
        .when(F.col("datatype").isin("url", "commonsMedia"), F.col("value"))
    )
    rows = s.select("qcode", F.coalesce("_p", "prop").alias("label"), "prop", "pos", value.alias("value")).where("value is not null")
    many = F.transform(F.array_sort(F.collect_list(F.struct("prop", "pos", "value"))), lambda x: x.value)
    return rows.groupBy("qcode", "label").agg(F.array_join(many, "; ").alias("value"))
