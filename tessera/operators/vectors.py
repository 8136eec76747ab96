"""Hash embeddings, cosine candidates and nearest neighbours."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import nearest
from .stage import staged

DIM = 384


def token_hash(token: Column) -> Column:
    """FNV-1a over code points, 32 bits."""
    codes = F.filter(F.split(token, ""), lambda c: c != "")
    step = lambda h, c: ((h.bitwiseXOR(F.ascii(c).cast("long"))) * F.lit(16777619)).bitwiseAND(F.lit(0xFFFFFFFF))
    return F.aggregate(codes, F.lit(2166136261).cast("long"), step)


def sparse_embedding(terms: DataFrame, term: str = "term", dim: int = DIM) -> DataFrame:
    """(term, idx, w) of the unit hash vector of each term; terms without a token have no rows."""
    tokens = F.regexp_extract_all(F.lower(F.col(term)), F.lit(r"(?U)[\w\x{4e00}-\x{9fff}]+"), F.lit(0))
    h = terms.select(term).distinct().select(term, F.explode(tokens).alias("_tok")).select(term, token_hash(F.col("_tok")).alias("h"))
    sign = F.when(F.shiftright("h", 1).bitwiseAND(F.lit(1)) == 1, -1.0).otherwise(1.0)
    parts = h.select(term, F.pmod("h", F.lit(dim)).cast("int").alias("idx"), (sign * (1.0 + F.pmod(F.shiftright("h", 8), F.lit(100)) / 500.0)).alias("w"))
    summed = parts.groupBy(term, "idx").agg(F.sum("w").alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy(term)))
    return summed.withColumn("w", F.col("w") / norm)


def _indexed(side: DataFrame, name: str, rarity: DataFrame, threshold: float, equal: tuple[str, ...]) -> DataFrame:
    """Entries of each vector's prefix with the norm of what follows: dimensions by rarity, up to where the rest alone is below the threshold."""
    by = W.partitionBy("term").orderBy("_rare", "idx")
    after = F.coalesce(F.sum(F.col("w") * F.col("w")).over(by.rowsBetween(1, W.unboundedFollowing)), F.lit(0.0))
    ranked = side.join(rarity, "idx").withColumn("_after", F.sqrt(after))
    rest = F.sqrt(F.col("_after") * F.col("_after") + F.col("w") * F.col("w"))
    return ranked.where(rest >= threshold - 1e-6).select(F.col("term").alias(name), "idx", "_rare", F.col("w").alias(f"w{name}"), F.col("_after").alias(f"after_{name}"), *equal)


def _vectors(side: DataFrame, name: str) -> DataFrame:
    return side.groupBy("term").agg(F.map_from_entries(F.collect_list(F.struct("idx", "w"))).alias(f"v{name}")).withColumnRenamed("term", name)


def prefix_matches(left: DataFrame, right: DataFrame, threshold: float, salts: int = 1, equal: tuple[str, ...] = (), heavy: int = 50_000) -> DataFrame:
    """(a, b, idx, ...): what the prefixes of the vectors left and right(term, idx, w, equal) share."""
    counts = left.select("idx").unionAll(right.select("idx")).groupBy("idx").agg(F.count("*").alias("_rare"))
    l, r = _indexed(left, "a", counts, threshold, equal), _indexed(right, "b", counts, threshold, equal)
    parts = F.greatest(F.lit(salts), F.ceil(F.col("_rare") / heavy)).cast("long")
    l = l.withColumn("_s", F.pmod(F.xxhash64("a"), parts))
    r = r.withColumn("_s", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("_rare")
    return l.join(r, ["idx", "_s", *equal])


def sparse_candidates(left: DataFrame, right: DataFrame, threshold: float, salts: int = 1, equal: tuple[str, ...] = (), heavy: int = 50_000) -> DataFrame:
    """(a, b, score) with cosine >= threshold of the unit vectors left and right(term, idx, w), and equal values of the columns `equal`.

    A prefix-filtered join. Dimensions are ordered by how many vectors have them, rare ones first, and a
    vector's prefix ends where the norm of the rest falls below the threshold; two vectors as near as that
    share a dimension of both prefixes, so a dimension that all have is met only where it matters. A pair
    goes on if what its prefixes share, with the norm beyond them, can reach the threshold; its score is
    then taken over the whole vectors. A dimension with over `heavy` entries is split by salt.

    A term is one vector, with one value of each of `equal`; null values of these match nothing.
    """
    keep = ["term", "idx", "w", *equal]
    left, right = left.select(*keep), right.select(*keep)
    met = prefix_matches(left, right, threshold, salts, equal, heavy)
    # beyond the last dimension that both prefixes have, the product is at most that of the norms of the rests
    shared = met.groupBy("a", "b").agg(F.sum(F.col("wa") * F.col("wb")).alias("_part"), F.max_by(F.col("after_a") * F.col("after_b"), F.struct("_rare", "idx")).alias("_rest"))
    likely = shared.where(F.col("_part") + F.col("_rest") >= threshold - 1e-6) if threshold > 0 else shared
    both = likely.select("a", "b").join(_vectors(left, "a"), "a").join(_vectors(right, "b"), "b")
    dot = F.aggregate(F.map_entries("va"), F.lit(0.0), lambda acc, e: acc + e.value * F.coalesce(F.try_element_at("vb", e.key), F.lit(0.0)))
    return both.select("a", "b", dot.alias("score")).where(F.round("score", 9) >= threshold)


def cosine(a: Column, b: Column) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.try_divide(dot, norm(a) * norm(b))


def vector_topk(queries: DataFrame, vectors: DataFrame, k: int = 5, equal: str | None = None, max_queries: int = 10_000) -> DataFrame:
    """(query_id, vec_id, score, rank): the k nearest of vectors(vec_id, embedding) for a stated set of queries(query_id, embedding).

    The queries are broadcast in blocks of about max_queries, each of which is done before the next; every
    task keeps its own best k of each query before the shuffle. Vectors of numbers, as long as most of a
    block's queries, are compared as matrices (nearest), odd ones as columns. With equal, only vectors with
    the same value of that column count.
    """
    keep = [equal] if equal else []
    q, rows = queries.select("query_id", "embedding", *keep), vectors.select("vec_id", "embedding", *keep)
    rows = rows.repartition(max(rows.rdd.getNumPartitions(), rows.sparkSession.sparkContext.defaultParallelism))  # few files, costly work
    blocks, out = max(1, -(-queries.count() // max_queries)), None
    for i in range(blocks):
        some = q.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == i) if blocks > 1 else q
        some, all_, groups = nearest.grouped(some, rows, tuple(keep))
        sizes = some.groupBy(F.coalesce(F.size("embedding"), F.lit(-1)).alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").collect()  # one row a length
        size = next((r["size"] for r in sizes if r["size"] > 0), 1)
        names, m = nearest.collected(some, size)
        plain = nearest.regular("embedding", size)
        scored = lambda v, s: v.join(F.broadcast(s.select("query_id", F.col("embedding").alias("_q"), F.col("_g").alias("_h"))), F.col("_g") == F.col("_h")).select("query_id", "vec_id", F.round(cosine(F.col("embedding"), F.col("_q")), 6).alias("score"))
        pairs = scored(all_.where(~plain), some)
        if len(m) < sum(r["n"] for r in sizes):
            pairs = pairs.unionAll(scored(all_.where(plain), some.where(~plain)))
        if len(m):
            number = names.column("_g").to_numpy()
            of = [np.flatnonzero(number == g) for g in range(groups)] if keep else None
            pairs = pairs.unionAll(nearest.best_rows(all_.where(plain), F.col("_g"), q.schema["query_id"], names.column("query_id"), m, k, lambda g, of=of: None if of is None else of[g]))
        best = nearest.ranked(pairs, k)
        best = staged(best, "nearest") if blocks > 1 else best
        out = best if out is None else out.union(best)
    return out


def index_rows(staged: DataFrame, seq: str = "seq") -> DataFrame:
    """(id, canonical_name, original_term): id is canonical_<8 of md5(term)>, first wins."""
    rows = staged.select(F.concat_ws("_", "canonical", F.substring(F.md5("term"), 1, 8)).alias("id"), F.col("canonical").alias("canonical_name"), F.col("term").alias("original_term"), seq)
    return rows.withColumn("_k", F.row_number().over(W.partitionBy("id").orderBy(seq))).where("_k = 1").drop("_k", seq)
