"""Token ids in binary blocks, written in doc_id order and read back.

Documents are range-partitioned by doc_id, then by a hash of the text; each partition cuts its ids into blocks of ``block`` ids, which
the context-mixing range coder codes on their own, with a model that is in the block. A block is a row of a Parquet
table: Spark commits its files, and a lost task writes them again. Its columns are

    part, block     the range partition, in doc_id order, and the block's number in it
    first           ids of the partition before the block
    n_ids, crc32    of the block's ids as little-endian unsigned 32-bit integers
    docs, lengths   doc_id and ids of each piece of a document in the block
    payload         header and 16-bit words of the coder

Reading checks each block's crc32. A document over several blocks is put together from its pieces' crc32
and lengths, without its ids in one place.

Defined cases: null texts are empty and have the end id alone; null doc_ids come first; rows with the same
doc_id come one after the other in order of their text's hash and of the text, and are documents of their
own; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import chunks_of, lean, runs_of, sliced, stage_root
from .range_coder import decode_blocks, encode_blocks
from .tokens import END_ID, encoder, tokenizer_path

BLOCK = 1 << 18
_TOGETHER = 1 << 21  # ids coded side by side; bounds a task's memory, not the results
_CHARS = 4_000_000  # of texts tokenized at once, as each look-up hashes the table of words
_SCHEMA = "part int, block long, first long, n_ids int, crc32 long, rows array<long>, docs array<long>, lengths array<int>, payload binary"
_POLY = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of polynomials modulo the crc32 polynomial, in its reflected bit order."""
    out = 0
    while b:
        if b & 0x80000000:
            out ^= a
        a = a >> 1 ^ (_POLY if a & 1 else 0)
        b = b << 1 & 0xFFFFFFFF
    return out


def crc32_joined(first: int, second: int, n_bytes: int) -> int:
    """crc32 of two strings one after the other, from theirs and the second's length: first times x**(8 n), plus second."""
    power, square, bits = 0x80000000, 0x40000000, 8 * n_bytes  # 1 and x
    while bits:
        if bits & 1:
            power = _times(power, square)
        square = _times(square, square)
        bits >>= 1
    return _times(first, power) ^ second


def _to_blocks(path: str, block: int):
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches):
        from pyspark import TaskContext

        part, enc = TaskContext.get().partitionId(), encoder(path)
        held, size, number, first, row = [], 0, 0, 0, 0  # held: (row, doc, ids as bytes)
        ready: list[tuple] = []

        def close():
            nonlocal held, size, number, first
            data = b"".join(h[2] for h in held)
            ready.append((part, number, first, len(data) // 4, zlib.crc32(data), [h[0] for h in held], [h[1] for h in held], [len(h[2]) // 4 for h in held], np.frombuffer(data, dtype="<u4")))
            held, size, number, first = [], 0, number + 1, first + len(data) // 4

        def flush():
            nonlocal ready
            if ready:
                coded = encode_blocks([r[8] for r in ready])
                types = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in ready], t) for k, t in enumerate(types)] + [pa.array(coded, pa.binary())], names=[x.split()[0] for x in _SCHEMA.split(", ")])
                ready = []

        for batch in sliced(batches, 2000):
            docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in chunks_of(texts, _CHARS):
                for doc, ids in zip(docs[a:b], enc.encode(texts[a:b])):
                    ids, at = ids + end, 0
                    while at < len(ids):
                        take = min(len(ids) - at, 4 * block - size)
                        held.append((row, doc, ids[at : at + take]))
                        at, size = at + take, size + take
                        if size == 4 * block:
                            close()
                            if len(ready) * block >= _TOGETHER:
                                yield from flush()
                    row += 1
        if held:
            close()
        yield from flush()

    return run


def write_token_blocks(docs: DataFrame, where: str, path: str | None = None, block: int = BLOCK) -> None:
    """docs(doc_id, text) to a table of blocks in folder where."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_h"))
    rows = rows.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h", "text").select("doc_id", "text")
    rows.mapInArrow(lean(_to_blocks(path or tokenizer_path(), block)), _SCHEMA).write.option("compression", "uncompressed").parquet(where)


def _read(batches):
    types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
    for batch in batches:
        for a, b in runs_of(batch.column("n_ids").to_pylist(), _TOGETHER):
            some, out = batch.slice(a, b - a).to_pylist(), []
            for row, ids in zip(some, decode_blocks([r["payload"] for r in some], [r["n_ids"] for r in some])):
                data, at = ids.astype("<u4").tobytes(), 0
                if zlib.crc32(data) != row["crc32"]:
                    raise ValueError(f"block {row['block']} of part {row['part']} is damaged")
                for number, doc, n in zip(row["rows"], row["docs"], row["lengths"]):
                    out.append((row["part"], number, doc, row["block"], row["first"] + at, n, zlib.crc32(data[4 * at : 4 * (at + n)])))
                    at += n
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(types)], names=["part", "row", "doc_id", "block", "at", "n", "crc"])


def read_token_blocks(spark: SparkSession, where: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the documents in folder where."""
    blocks = spark.read.schema(_SCHEMA).parquet(where)
    # start of a part: one row a partition, not a document
    sizes = blocks.groupBy("part").agg(F.sum(F.col("n_ids").cast("long")).alias("n"))
    before = sizes.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    pieces = blocks.mapInArrow(lean(_read), "part int, row long, doc_id long, block long, at long, n long, crc long")
    docs = pieces.groupBy("part", "row").agg(F.first("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("block", "n", "crc"))).alias("parts"))
    docs = docs.join(before, "part").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "parts")

    def join(batches):
        for batch in batches:
            crcs = []
            for parts in batch.column(3).to_pylist():
                crc = parts[0]["crc"]
                for p in parts[1:]:
                    crc = crc32_joined(crc, p["crc"], 4 * p["n"])
                crcs.append(crc)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return docs.mapInArrow(join, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Writes docs to a new folder of the shared one and reads it back."""
    import uuid

    spark = docs.sparkSession
    where = f"{stage_root(spark)}/token-blocks-{uuid.uuid4().hex}"
    write_token_blocks(docs, where, path)
    return read_token_blocks(spark, where)
