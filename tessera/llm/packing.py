"""Best-fit packing by exact-complement hashing.

Documents become token ids; pieces of at most ``capacity`` tokens are packed into sequences. What is
packed are lengths, of which there are at most ``capacity`` different ones whatever the corpus holds:
Spark counts the pieces of each length, the plan is made on that histogram, and every piece finds its
place from its rank among the pieces of its length.

Defined cases: null and empty texts have just the end id; repeated rows are packed each; an empty table
gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import Staging, lean, runs_of, staged
from .tokens import encoder, tokenizer_path

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, capacity: int = 4096, path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of docs(doc_id, text)."""
    path = path or tokenizer_path()

    def cut(batches):
        enc = encoder(path)
        for batch in batches:
            docs, sizes = batch.column(0).to_pylist(), pc.binary_length(batch.column(1)).to_pylist()
            for a, b in runs_of(sizes, 2_000_000):
                ids, ends = enc.encode_ended(batch.column(1).slice(a, b - a))
                view, ends = memoryview(ids.tobytes()), ends.tolist()
                out = [[], [], [], [], []]
                for doc, first, last in zip(docs[a:b], ends, ends[1:]):
                    for k, s in enumerate(range(first, last, capacity)):
                        e = min(s + capacity, last)
                        for col, v in zip(out, (doc, k, s - first, e - s, zlib.crc32(view[4 * s : 4 * e]))):
                            col.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(cut), PIECES)


def plan_patterns(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """(lengths, times) covering counts: sequences with these lengths, made that many times.

    From the longest length down: one, two or three lengths that fill its gap exactly, as long as they
    are in stock; when none do, the longest that fit, again and again. Each step uses up a length, so
    there are at most twice as many steps as lengths.
    """
    stock = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        stock[length] = n
    plan: list[tuple[list[int], int]] = []

    def take(parts: list[int]) -> None:
        sizes, uses = np.unique(parts, return_counts=True)
        times = int((stock[sizes] // uses).min())
        stock[sizes] -= times * uses
        plan.append((parts, times))

    def enough(parts: list[int]) -> bool:
        sizes, uses = np.unique(parts, return_counts=True)
        return bool((stock[sizes] >= uses).all())

    def pair(gap: int, held: list[int]) -> list[int] | None:
        a = have[(have <= gap // 2)]
        a = a[stock[gap - a] > 0]
        for x in a[::-1]:
            if enough(held + [int(x), gap - int(x)]):
                return [int(x), gap - int(x)]
        return None

    def exact(first: int) -> list[int] | None:
        gap = capacity - first
        if gap == 0:
            return []
        if stock[gap] and enough([first, gap]):
            return [gap]
        if found := pair(gap, [first]):
            return found
        for c in have[(have >= (gap + 2) // 3) & (have < gap - 1)][::-1]:
            if found := pair(gap - int(c), [first, int(c)]):
                return [int(c), *found]
        return None

    residual = []
    for first in range(capacity, 0, -1):
        while stock[first]:
            have = np.flatnonzero(stock)
            if (rest := exact(first)) is None:
                residual.append((first, int(stock[first])))
                stock[first] = 0
            else:
                take([first, *rest])
    for first, n in residual:
        stock[first] = n
    for first in range(capacity, 0, -1):
        while stock[first]:
            parts, gap = [first], capacity - first
            left = stock.copy()
            left[first] -= 1
            while gap:
                fits = np.flatnonzero(left[: gap + 1])
                if not len(fits):
                    break
                size = int(fits[-1])
                n = int(min(left[size], gap // size))
                parts += [size] * n
                left[size] -= n
                gap -= n * size
            take(parts)
    return plan


def _runs(plan: list[tuple[list[int], int]], capacity: int):
    """Arrays (length, first rank, times, first sequence, offset), one entry for each length of a pattern."""
    used = np.zeros(capacity + 1, dtype=np.int64)
    rows, sequence = [], 0
    for parts, times in plan:
        offset = 0
        for size in dict.fromkeys(parts):
            n = parts.count(size)
            rows.append((size, used[size], times, sequence, offset))
            used[size] += n * times
            offset += n * size
        sequence += times
    rows.sort()
    return [np.array(c, dtype=np.int64) for c in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 5


def pack(pieces: DataFrame, capacity: int = 4096, salted_rows: int = 100_000) -> DataFrame:
    """pieces with sequence_id and offset. pieces is read twice: give a stored table.

    The rank of a piece within its length is that within (length, salt) plus the pieces of earlier
    salts, of which there is one for each salted_rows pieces, so a length that very many pieces have is ranked by many tasks.
    """
    salts = max(32, -(-pieces.count() // salted_rows))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    sums = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    counts = {r["length"]: r["n"] for r in sums.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    length, first, times, sequence, offset = _runs(plan_patterns(counts, capacity), capacity)
    key = (length << 44) + first
    before = W.partitionBy("length").orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    own = W.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("_rank", F.row_number().over(own) - 1).join(sums, ["length", "_salt"])

    def place(frames):
        for f in frames:
            rank = f["_rank"].to_numpy()
            i = np.searchsorted(key, (f["length"].to_numpy() << 44) + rank, side="right") - 1
            slot, seq = np.divmod(rank - first[i], times[i])
            f["sequence_id"], f["offset"] = sequence[i] + seq, offset[i] + slot * length[i]
            yield f.drop(columns="_rank")

    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_rank") + F.col("_before")).alias("_rank"))
    return ranked.mapInPandas(lean(place), PIECES + ", sequence_id long, offset long")


def best_fit_packing(docs: DataFrame, capacity: int = 4096, path: str | None = None) -> DataFrame:
    """docs(doc_id, text) tokenized, cut and packed."""
    with Staging(docs.sparkSession) as stage:
        return staged(pack(stage(token_pieces(docs, capacity, path), "pieces"), capacity), "packed")
