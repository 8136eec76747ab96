import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.operators import ivf, nearest, vectors

from .conftest import SMALL


def dense(rows):
    out = {}
    for r in rows:
        out.setdefault(r.term, {})[r.idx] = r.w
    return out


def brute(vec, threshold, meta=None):
    out = {}
    for a in vec:
        for b in vec:
            score = sum(w * vec[b].get(i, 0.0) for i, w in vec[a].items())
            if set(vec[a]) & set(vec[b]) and round(score, 9) >= threshold and (meta is None or (meta[a] is not None and meta[a] == meta[b])):
                out[a, b] = round(score, 9)
    return out


@pytest.fixture(scope="module")
def terms(spark):
    rng = random.Random(4)
    names = sorted({"part " + " ".join(rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) for _ in range(rng.randint(1, 6))) for _ in range(90)} | {"part", "", "lone word"})
    return spark.createDataFrame([(n, rng.choice(["x", "y", None])) for n in names], "term string, meta string")


@pytest.mark.parametrize("threshold", [0.0, 0.4, 0.75, 0.95, 1.0])
def test_pairs_against_all_products(spark, terms, threshold):
    vec = vectors.sparse_embedding(terms)
    got = {(r.a, r.b): round(r.score, 9) for r in vectors.sparse_candidates(vec, vec, threshold, heavy=20).collect()}
    assert got == brute(dense(vec.collect()), threshold)


def test_pairs_of_equal_metadata(spark, terms):
    vec = vectors.sparse_embedding(terms).join(terms, "term")
    got = {(r.a, r.b): round(r.score, 9) for r in vectors.sparse_candidates(vec, vec, 0.6, equal=("meta",)).collect()}
    assert got == brute(dense(vec.collect()), 0.6, {r.term: r.meta for r in terms.collect()})


def test_a_common_token_is_not_met(spark):
    """400 terms share one of three tokens: of 160,000 pairs only those of a rare one are met."""
    t = spark.createDataFrame([(f"part a{i} b{i % 200}",) for i in range(400)], "term string")
    vec = vectors.sparse_embedding(t, dim=1 << 30)
    assert vec.groupBy("idx").count().agg(F.max("count")).first()[0] == 400
    assert vectors.prefix_matches(vec, vec, 0.9).count() < 4000
    assert vectors.sparse_candidates(vec, vec, 0.9).count() == len(brute(dense(vec.collect()), 0.9))


def test_no_vectors(spark, terms):
    vec = vectors.sparse_embedding(terms)
    assert vectors.sparse_candidates(vec.limit(0), vec, 0.5).count() == 0


@pytest.fixture(scope="module")
def embeddings(spark):
    return spark.read.parquet(SMALL.replace("sf0.001", "sf0.01") + "/embeddings.parquet")


def queries_of(v):
    return v.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


def rows(df):
    return {(r.query_id, r.rank): (r.vec_id, r.score) for r in df.collect()}


def test_recall_of_the_index(spark, embeddings):
    index = ivf.build_index(embeddings)
    want = rows(vectors.vector_topk(queries_of(embeddings), embeddings, 10))
    pairs = {(q, v) for (q, _), (v, _) in want.items()}
    nprobe = ivf.tune_nprobe(index, 10)
    assert nprobe < len(index.centroids)
    got = {(q, v) for (q, _), (v, _) in rows(ivf.index_topk(queries_of(embeddings), index, 10, nprobe)).items()}
    assert index.table.count() == embeddings.count()
    assert len(got & pairs) / len(pairs) >= 0.9


@pytest.mark.parametrize("nprobe, blocks", [(1, 1000), (3, 4)])
def test_exact_search_equals_a_scan(spark, embeddings, nprobe, blocks):
    got = ivf.index_topk(queries_of(embeddings), ivf.build_index(embeddings), 10, nprobe, exact=True, max_queries=blocks)
    assert rows(got) == rows(vectors.vector_topk(queries_of(embeddings), embeddings, 10))


def test_exact_search_of_equal_labels(spark, embeddings):
    q = embeddings.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding", "label")
    got = ivf.index_topk(q, ivf.build_index(embeddings, keep=("label",)), 4, 2, exact=True, equal=("label",))
    assert rows(got) == rows(vectors.vector_topk(q, embeddings, 4, equal="label"))


def test_an_index_of_odd_rows(spark):
    """Null, zero and wrongly sized vectors are in no list; equal ones share a list and rank by id."""
    r = np.random.default_rng(0)
    same = [float(x) for x in r.normal(size=4)]
    df = spark.createDataFrame([(i, same) for i in range(30)] + [(100, None), (101, [0.0] * 4), (102, [1.0, 2.0])], "vec_id long, embedding array<double>")
    index = ivf.build_index(df, lists=4)
    assert index.table.count() == 30
    q = spark.createDataFrame([(1, same), (2, None), (3, [0.0] * 4)], "query_id long, embedding array<double>")
    assert [(x.query_id, x.vec_id) for x in ivf.index_topk(q, index, 3, exact=True).orderBy("query_id", "rank").collect()] == [(1, 0), (1, 1), (1, 2)]
    assert ivf.index_topk(q, ivf.build_index(df.limit(0)), 3, exact=True).count() == 0


def by_columns(queries, vecs, k, equal=None):
    """All pairs, scored by columns."""
    q = queries.select("query_id", F.col("embedding").alias("_q"), *([F.col(equal).alias("_e")] if equal else []))
    pairs = vecs.join(q, F.col(equal) == F.col("_e") if equal else F.lit(True)).select("query_id", "vec_id", F.round(vectors.cosine(F.col("embedding"), F.col("_q")), 6).alias("score"))
    return sorted((r.query_id, r.rank, r.vec_id, str(r.score)) for r in pairs.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k).collect())


@pytest.mark.parametrize("kind, equal, blocks", [("long", None, 1000), ("string", None, 7), ("long", "label", 1000)])
def test_nearest_of_odd_vectors(spark, kind, equal, blocks):
    """Null, zero, short, long, huge and tiny vectors, ones with null and NaN, many equal ones, ids that are null: as columns score and rank them."""
    rng = random.Random(5)
    same = [rng.gauss(0, 1) for _ in range(8)]
    make = lambda i: [None, [0.0] * 8, same, same, [x * 1e-3 for x in same], [1.0] * 5, [1.0] * 9, [1e160] * 8, [1e-160] * 8, [None] + [1.0] * 7, [float("nan")] + [1.0] * 7, []][i % 40] if i % 40 < 12 else [float(rng.randint(-2, 2)) if i % 3 else rng.gauss(0, 1) for _ in range(8)]
    rows = [(i if i != 77 else None, make(i), rng.choice(["x", "y", None])) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").withColumn("vec_id", F.col("vec_id").cast(kind))
    q = df.where("vec_id % 3 = 0").select(F.col("vec_id").alias("query_id"), "embedding", "label")
    got = vectors.vector_topk(q, df, 4, equal, max_queries=blocks)
    assert sorted((r.query_id, r.rank, r.vec_id, str(r.score)) for r in got.collect()) == by_columns(q, df, 4, equal)


def test_rounding_is_that_of_columns(spark):
    x = np.array([0.1234565, -0.1234565, 0.0000005, 0.4999995, 1.0, 0.9999994999999, 2.5e-7])
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i int, v double")
    assert list(nearest.rounded(x)) == [r.v for r in df.select("i", F.round("v", 6).alias("v")).orderBy("i").collect()]


def test_forty_million_pairs(spark):
    """Pair by pair, as columns, they take minutes."""
    v = spark.range(20_000).select(F.col("id").alias("vec_id"), F.transform(F.sequence(F.lit(1), F.lit(64)), lambda j: (F.pmod(F.xxhash64("id", j), F.lit(2001)) - 1000).cast("float")).alias("embedding"))
    q = v.where("vec_id % 10 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    began = time.time()
    got = vectors.vector_topk(q, v).where("rank = 1").collect()
    assert time.time() - began < 40 and len(got) == 2000 and all(r.query_id == r.vec_id and r.score == 1 for r in got)


def test_an_exact_search_through_most_lists(spark):
    """No vector is near another, so that the second pass has nearly all pairs; as columns they take minutes. A longer vector costs the others nothing."""
    v = spark.range(20_000).select(F.col("id").alias("vec_id"), F.transform(F.sequence(F.lit(1), F.lit(64) + F.when(F.col("id") == 5, 1).otherwise(0)), lambda j: (F.pmod(F.xxhash64("id", j), F.lit(2001)) - 1000).cast("float")).alias("embedding"))
    q = v.where("vec_id % 10 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    index = ivf.build_index(v)
    assert index.table.count() == 19_999
    began = time.time()
    got = ivf.index_topk(q, index, 3, 2, exact=True)
    assert rows(got) == rows(vectors.vector_topk(q, v.where("vec_id != 5"), 3)) and time.time() - began < 60
