"""The nearest of many vectors for a block of queries: products of matrices find what may be near, and that is scored as columns score it.

A product of unit rows in single precision is off by at most a known bound; each pair that could be among
the k best by it is scored again in double precision, place by place in the order of the fold of
vectors.cosine, so that scores and ties are those of the columns. A task keeps k rows a query.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

_CELLS = 4_000_000  # products at once


def regular(embedding: str, size: int) -> Column:
    """A vector of `size` numbers whose products neither vanish nor overflow."""
    return F.coalesce(F.expr(f"size({embedding}) = {size} and forall({embedding}, x -> x is not null and abs(x) < 1e100D) and exists({embedding}, x -> abs(x) > 1e-100D)"), F.lit(False))


def unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return (m / np.linalg.norm(m, axis=1, keepdims=True)).astype(np.float32)


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), size)


def _norms(places: np.ndarray) -> np.ndarray:
    total = np.zeros(places.shape[1])
    for p in places:
        total += p * p
    return np.sqrt(total)


def rounded(x: np.ndarray) -> np.ndarray:
    """To six places, halves of the decimal number as it is written away from zero."""
    y = np.abs(x) * 1e6
    out = np.copysign(np.floor(y + 0.5) / 1e6, x)
    for i in np.flatnonzero(np.abs(y - np.floor(y) - 0.5) < 1e-4):
        out[i] = float(Decimal(repr(float(x[i]))).quantize(Decimal("0.000001"), ROUND_HALF_UP))
    return out


class Best:
    """The k best rows of each query among those that are added, by rounded score and then id."""

    def __init__(self, queries: np.ndarray, k: int, least: np.ndarray | None = None):
        """Rows with a score under `least` of a query, where that is known, need not be kept."""
        self.units, self.places, self.k = unit(queries), np.ascontiguousarray(queries.T), k
        self.norms, self.slack = _norms(self.places), 1e-6 + 4e-7 * (queries.shape[1] + 8)
        self.floor = np.full(len(queries), -np.inf) if least is None else np.where(np.isnan(least), -np.inf, least - self.slack)
        self.q, self.raw, self.score = np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        self.none, self.ids, self.new = np.zeros(0, bool), None, 0

    def add(self, ids: np.ndarray, none: np.ndarray, rows: np.ndarray, some: np.ndarray | None = None) -> None:
        """rows with their ids (none: null ones) for all queries or those numbered `some`."""
        units, places = unit(rows), np.ascontiguousarray(rows.T)
        norms = _norms(places)
        of = self.units if some is None else self.units[some]
        step = max(1, _CELLS // max(1, len(of)))
        for at in range(0, len(rows), step):
            near = of @ units[at : at + step].T
            floor = self.floor if some is None else self.floor[some]
            if near.shape[1] > self.k and np.isneginf(floor).any():
                floor = np.maximum(floor, np.partition(near, near.shape[1] - self.k, axis=1)[:, -self.k] - 2 * self.slack)
            q, v = np.nonzero(near >= floor.astype(np.float32)[:, None])
            for i in range(0, len(q), 200_000):
                self._score(q[i : i + 200_000] if some is None else some[q[i : i + 200_000]], v[i : i + 200_000] + at, ids, none, places, norms)

    def _score(self, q, v, ids, none, places, norms) -> None:
        dot = np.zeros(len(q))
        for mine, theirs in zip(self.places, places):
            dot += theirs[v] * mine[q]
        raw = dot / (norms[v] * self.norms[q])
        self.q, self.raw, self.score = np.concatenate([self.q, q]), np.concatenate([self.raw, raw]), np.concatenate([self.score, rounded(raw)])
        self.none, self.ids = np.concatenate([self.none, none[v]]), ids[v] if self.ids is None else np.concatenate([self.ids, ids[v]])
        self.new += len(q)
        if self.new > len(self.norms) * self.k // 2:
            self.cut()

    def cut(self) -> None:
        if not len(self.q):
            return
        ids = self.ids if self.ids.dtype != object else np.unique(self.ids, return_inverse=True)[1]
        order = np.lexsort((ids, ~self.none, -self.score, self.q))
        q = self.q[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        last = order[place == self.k - 1]
        self.floor[self.q[last]] = np.maximum(self.floor[self.q[last]], self.score[last] - self.slack)
        order = order[place < self.k]
        self.q, self.raw, self.score, self.none, self.ids, self.new = self.q[order], self.raw[order], self.score[order], self.none[order], self.ids[order], 0


def ids_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids as they sort, where they are null)."""
    none = column.is_null().to_numpy(zero_copy_only=False)
    if none.any():
        known = column.drop_null()
        column = column.fill_null(known[0]) if len(known) else pa.array(np.zeros(len(column), np.int64))
    if pa.types.is_integer(column.type) or pa.types.is_floating(column.type):
        return column.to_numpy(zero_copy_only=False), none
    return np.array(column.to_pylist() + [None], dtype=object)[:-1], none


def collected(queries: DataFrame, size: int) -> tuple[pa.Table, np.ndarray]:
    """Those of a block of queries(query_id, embedding, _g) that are regular vectors of `size` numbers, with their matrix."""
    t = queries.where(regular("embedding", size)).select("query_id", F.col("embedding").cast("array<double>").alias("embedding"), "_g").toArrow()
    return t.drop_columns("embedding"), matrix(t.column("embedding").combine_chunks(), size) if t.num_rows else np.zeros((0, size))


def grouped(queries: DataFrame, vectors: DataFrame, equal: tuple[str, ...]) -> tuple[DataFrame, DataFrame, int]:
    """Both with _g, the number of their values of the columns `equal`, those of other values left out; how many there are."""
    if not equal:
        return queries.withColumn("_g", F.lit(0)), vectors.withColumn("_g", F.lit(0)), 1
    kinds = queries.select(*equal).dropna().distinct().collect()  # at most one a query of the block
    schema = T.StructType([*[T.StructField(f"_{e}", queries.schema[e].dataType) for e in equal], T.StructField("_g", T.IntegerType())])
    kind = F.broadcast(queries.sparkSession.createDataFrame([(*r, i) for i, r in enumerate(kinds)], schema))
    joined = [x.join(kind, [x[e] == kind[f"_{e}"] for e in equal]).drop(*[f"_{e}" for e in equal]) for x in (queries, vectors)]
    return joined[0], joined[1], max(1, len(kinds))


def best_rows(vectors: DataFrame, by: Column, query_id: T.StructField, ids: pa.ChunkedArray, queries: np.ndarray, k: int, some: Callable[[int], np.ndarray | None], least: np.ndarray | None = None) -> DataFrame:
    """(query_id, vec_id, score): the k best rows or fewer for each query in a task's vectors(vec_id, embedding), which are regular and as long as queries' rows.

    some(b) numbers the queries that vectors with by = b are for; None: all. Rows under a query's least
    score may be left out. The queries are broadcast.
    """
    shared = vectors.sparkSession.sparkContext.broadcast((ids.combine_chunks(), queries, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, q, floor = shared.value
        best, kind = Best(q, k, floor), None
        for batch in batches:
            if not batch.num_rows:
                continue
            kind = batch.column("vec_id").type
            (vec_ids, none), of = ids_of(batch.column("vec_id")), batch.column("_by").to_numpy(zero_copy_only=False)
            rows, order = matrix(batch.column("embedding"), q.shape[1]), np.argsort(of, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
                which = some(int(of[part[0]]))
                if which is None or len(which):
                    best.add(vec_ids[part], none[part], rows[part], which)
        best.cut()
        for at in range(0, len(best.q), 50_000):
            cut = slice(at, at + 50_000)
            yield pa.RecordBatch.from_arrays([names.take(pa.array(best.q[cut])), pa.array(best.ids[cut], type=kind, mask=best.none[cut]), pa.array(best.raw[cut])], names=["query_id", "vec_id", "raw"])

    schema = T.StructType([query_id, vectors.schema["vec_id"], T.StructField("raw", T.DoubleType())])
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), by.cast("bigint").alias("_by"))
    return rows.mapInArrow(run, schema).select("query_id", "vec_id", F.round("raw", 6).alias("score"))


def ranked(pairs: DataFrame, k: int) -> DataFrame:
    return pairs.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
