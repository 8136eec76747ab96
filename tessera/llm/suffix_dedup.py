"""Removal of repeated substrings by longest-previous-factor arrays.

A byte goes if a string of ``length`` bytes that covers it also starts earlier: in an earlier document, or
before in its own. Documents are in order of doc_id; texts under one doc_id are documents of their own, in
order of a hash. Equal strings have their smallest 32-byte hash at the same place, so each string belongs to
one anchor, and the strings of an anchor's occurrence are a short context around it. Contexts meet by
anchor, and nothing else of the corpus does:

1. one row for each anchor occurrence (about one in 35 bytes): anchor hash, context hash, place. Of equal
   contexts in one task's buffer all but the first are repeats already; they are dealt anywhere;
2. anchors with one occurrence are done. Of occurrences with the same context, the first stands for all
   and the later ones are repeats altogether; an anchor that has several contexts needs a look;
3. the contexts that need it, in order of their place, are one text: its suffixes are put in order, and the
   previous and the next smaller position of each in that order have its longest previous factor. Where
   that is ``length`` or more, a string is removed, and the earlier one kept;
4. the spans of a document are joined and cut out.

Contexts are known by a hash modulo a prime together with one modulo 2**64, of which no pairs are equal by
structure; strings in step 3 are compared byte by byte. Contexts of an anchor with over ``max_contexts`` of
them are dealt out by string over many tasks instead, and ordered there by Spark's sort.

Defined cases: null texts are empty; texts under ``length`` bytes lose nothing; rows that repeat doc_id
and text count as one document and get the same result; null doc_ids come first; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .bytehash import mix, powers, prefix_sums, prime_hashes, prime_sums, substring_hashes
from .common import Staging, sliced, staged

GRAM = 32
_BUFFER = 3_000_000  # under 2**22, as places share a word with hashes


def _anchor_rows(buf: np.ndarray, ends: np.ndarray, length: int):
    """(text number, place of context, strings in it, anchor hash, context hash) over texts joined in buf."""
    sums = prefix_sums(buf)
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * powers(len(sums))[1][: len(buf) - GRAM + 1])
    low = np.uint64(22)
    least = (grams >> low << low) | np.arange(len(grams), dtype=np.uint64)
    span, width = 1, length - GRAM + 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    anchor = (least & np.uint64((1 << 22) - 1)).astype(np.int64)
    end = np.repeat(ends, np.diff(np.r_[0, ends]))[: len(anchor)]
    at = np.flatnonzero(np.arange(len(anchor)) + length <= end)
    if not len(at):
        return None
    of = anchor[at]
    new = np.r_[True, (of[1:] != of[:-1]) | (at[1:] != at[:-1] + 1)]
    first = at[new]
    last = at[np.r_[new[1:], True]]
    of = of[new]
    prime = prime_hashes(prime_sums(buf), first, last + length)
    context = mix(substring_hashes(sums, first, last + length) + mix(prime << np.uint64(8) | (of - first).astype(np.uint64)))
    return np.searchsorted(ends, first, side="right"), first, last - first + 1, grams[of], context


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """(anchor, context, doc_id, text_id, place, again) of docs(doc_id, text_id, text): place is the context's first byte * 128 + its strings, again that the buffer has the context earlier."""

    def run(batches):
        for batch in sliced(batches, 2000):
            ids = np.array([-(1 << 63) if d is None else d for d in batch.column(0).to_pylist()], dtype=np.int64)
            tids = batch.column(1).to_numpy()
            pieces = []  # (row, offset, bytes)
            for k, t in enumerate(batch.column(2).to_pylist()):
                raw = (t or "").encode()
                if len(raw) >= length:
                    pieces += [(k, i, raw[i : i + _BUFFER + length - 1]) for i in range(0, len(raw) - length + 1, _BUFFER)]
            start = 0
            while start < len(pieces):
                stop, total = start, 0
                while stop < len(pieces) and (stop == start or total + len(pieces[stop][2]) <= _BUFFER):
                    total += len(pieces[stop][2])
                    stop += 1
                some, start = pieces[start:stop], stop
                ends = np.cumsum([len(p[2]) for p in some])
                found = _anchor_rows(np.frombuffer(b"".join(p[2] for p in some), dtype=np.uint8), ends, length)
                if found is None:
                    continue
                k, first, strings, anchor, context = found
                row, offset = np.array([p[0] for p in some])[k], np.array([p[1] for p in some])[k] - np.r_[0, ends][k]
                doc, tid, place = ids[row], tids[row], (first + offset) * 128 + strings
                order = np.argsort(context, kind="stable")
                c = context[order]
                twice = np.zeros(len(c), dtype=bool)
                twice[1:] = c[1:] == c[:-1]
                again = np.zeros(len(c), dtype=bool)
                if twice.any():  # these few in full order
                    both = order[twice | np.r_[twice[1:], False]]
                    both = both[np.lexsort((place[both], tid[both], doc[both], anchor[both], context[both]))]
                    same = (context[both][1:] == context[both][:-1]) & (anchor[both][1:] == anchor[both][:-1])
                    repeated = (doc[both][1:] == doc[both][:-1]) & (tid[both][1:] == tid[both][:-1]) & (place[both][1:] == place[both][:-1])
                    again[both[1:]] = same
                    # rows that repeat a document are that document: they are as its first row is
                    for i in np.flatnonzero(same & repeated):
                        again[both[i + 1]] = again[both[i]]
                null = doc == -(1 << 63)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64)), pa.array(doc, pa.int64(), mask=null), pa.array(tid), pa.array(place), pa.array(again)], names=["anchor", "context", "doc_id", "text_id", "place", "again"])

    if not GRAM < length < GRAM + 127:
        raise ValueError("length must be 33 to 158 bytes")
    return docs.select("doc_id", "text_id", "text").mapInArrow(run, "anchor long, context long, doc_id long, text_id long, place long, again boolean")


def smaller_positions(order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each rank of a suffix order: the nearest ranks before and after whose position is smaller; -1 and len(order) where there is none."""
    n = len(order)
    found = []
    for step, none in ((-1, -1), (1, n)):
        at = np.arange(n) + step
        while True:  # over suffixes that are larger, by what these have found
            inside = (at >= 0) & (at < n)
            far = np.flatnonzero(inside)[order[at[inside]] > order[inside]]
            if not len(far):
                break
            at[far] = at[at[far]]
        found.append(np.where((at < 0) | (at >= n), none, at))
    return found[0], found[1]


def longest_previous_factors(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of suffixes, in order of position, given as rows of bytes padded to one width: the length of the longest common prefix with an earlier one."""
    n, width = rows.shape
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{width}").ravel(), kind="stable")
    before, after = smaller_positions(order)
    out = np.zeros(n, dtype=np.int64)
    for near in (before, after):
        has = np.flatnonzero((near >= 0) & (near < n))
        for i in range(0, len(has), 1 << 16):
            k = has[i : i + (1 << 16)]
            mine, other = order[k], order[near[k]]
            differ = rows[mine] != rows[other]
            common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
            np.maximum.at(out, mine, np.minimum(common, np.minimum(sizes[mine], sizes[other])))
    return out


def repeated_strings(text: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Of suffixes at places at (ascending) of text: those whose longest previous factor is length or more."""
    out = np.zeros(len(at), dtype=bool)
    if not len(at):
        return out
    hashes = substring_hashes(prefix_sums(text), at, at + length)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    maybe = np.sort(order[np.r_[same, False] | np.r_[False, same]])  # a suffix without an equal hash has no factor of that length
    if len(maybe):
        rows = np.lib.stride_tricks.sliding_window_view(text, length)[at[maybe]]
        out[maybe] = longest_previous_factors(rows, np.full(len(maybe), length)) >= length
    return out


def _spans(f: pd.DataFrame, length: int) -> pd.DataFrame:
    """(doc_id, text_id, start, stop) of the repeats in contexts, which come in order of anchor and place."""
    contexts = f["bytes"].tolist()
    text = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    sizes = np.array([len(c) for c in contexts])
    begin = np.cumsum(sizes) - sizes
    strings = sizes - length + 1
    owner = np.repeat(np.arange(len(sizes)), strings)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(strings) - strings, strings)
    hit = np.flatnonzero(repeated_strings(text, begin[owner] + inner, length))
    owner, inner = owner[hit], inner[hit]
    new = np.r_[True, (owner[1:] != owner[:-1]) | (inner[1:] != inner[:-1] + 1)][: len(hit)]
    last = np.r_[new[1:], True][: len(hit)]
    rows = f.iloc[owner[new]]
    first = (rows["place"] // 128).to_numpy()
    return pd.DataFrame({"doc_id": rows["doc_id"].array, "text_id": rows["text_id"].array, "start": first + inner[new], "stop": first + inner[last] + length})


def _same_text(docs: DataFrame, other: DataFrame) -> DataFrame:
    """docs joined with other(_id, text_id, ...) by doc_id and text_id, left."""
    return docs.join(other, (docs["text_id"] == other["text_id"]) & docs["doc_id"].eqNullSafe(other["_id"]), "left").drop(other["text_id"]).drop("_id")


def _numbered(docs: DataFrame) -> DataFrame:
    """(doc_id, text_id, text): text_id is a hash of the text; null texts are empty."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_id"), text.alias("text"))


def repeated_spans(docs: DataFrame, stage: Staging, length: int = 100, max_contexts: int = 20_000) -> DataFrame:
    """(doc_id, text_id, start, stop) in bytes of docs(doc_id, text_id, text); spans may touch or overlap."""
    key = ["doc_id", "text_id", "place"]
    rows = anchors(docs, length)
    # repeats within a buffer have a key of their own, so that a context that is everywhere is not in one task
    rows = rows.withColumn("deal", F.when(F.col("again"), F.xxhash64(*key)).otherwise(F.col("anchor")))
    rows = rows.repartition("deal").sortWithinPartitions("deal", "anchor", "context", *key)
    one, same = W.partitionBy("deal", "anchor"), W.partitionBy("deal", "anchor", "context").orderBy(*key)
    flagged = rows.withColumns({"_many": F.min("context").over(one) != F.max("context").over(one), "_n": F.count("*").over(one)}).withColumn("_rank", F.rank().over(same))
    flagged = flagged.where("again or _many or _rank > 1").select("anchor", *key, "_n", (F.col("again") | (F.col("_rank") > 1)).alias("whole"))
    flagged = stage(flagged, "anchors")
    start, strings = F.shiftright("place", 7), F.col("place").bitwiseAND(F.lit(127))
    whole = flagged.where("whole").select("doc_id", "text_id", start.alias("start"), (start + strings + length - 1).alias("stop"))

    wanted = flagged.where("not whole").groupBy("doc_id", "text_id").agg(F.collect_set(F.struct("anchor", "place", "_n")).alias("wanted"))
    text = docs.where(F.octet_length("text") >= length)

    def cut(batches):
        for batch in sliced(batches):
            cols = [[], [], [], [], [], []]
            for doc, tid, raw, wanted in zip(*(batch.column(k).to_pylist() for k in range(4))):
                raw = raw.encode()
                for w in wanted:
                    a, n = divmod(w["place"], 128)
                    for col, v in zip(cols, (w["anchor"], doc, tid, w["place"], w["_n"], raw[a : a + n + length - 1])):
                        col.append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["anchor", "doc_id", "text_id", "place", "n", "bytes"])

    found = _same_text(text, wanted.withColumnRenamed("doc_id", "_id")).where("wanted is not null").select("doc_id", "text_id", "text", "wanted")
    contexts = stage(found.mapInArrow(cut, "anchor long, doc_id long, text_id long, place long, n long, bytes binary"), "contexts")

    def look(frames):
        held, strings, own = [], 0, ["anchor", *key]
        for f in frames:
            f["doc_id"] = f["doc_id"].astype("Int64")
            held.append(f.drop_duplicates(own))
            strings += len(f)
            if strings >= 8192:
                f = pd.concat(held, ignore_index=True).drop_duplicates(own)
                # an anchor may go on in the next frame
                done = int(np.searchsorted(f["anchor"].to_numpy(), f["anchor"].iloc[-1]))
                if done:
                    yield _spans(f.iloc[:done], length)
                held = [f.iloc[done:]]
                strings = len(held[0])
        if strings:
            yield _spans(pd.concat(held, ignore_index=True).drop_duplicates(own), length)

    usual = contexts.where(F.col("n") <= max_contexts).repartition("anchor").sortWithinPartitions("anchor", *key).select("anchor", *key, "bytes")
    usual = usual.mapInPandas(look, "doc_id long, text_id long, start long, stop long")
    string = contexts.where(F.col("n") > max_contexts).dropDuplicates(["anchor", *key])
    string = string.select("doc_id", "text_id", F.shiftright("place", 7).alias("at"), "bytes", F.posexplode(F.sequence(F.lit(1), F.octet_length("bytes") - (length - 1))).alias("k", "from"))
    string = string.select("doc_id", "text_id", (F.col("at") + F.col("k")).alias("start"), F.substring("bytes", F.col("from"), length).alias("string"))
    often = string.withColumn("_rank", F.rank().over(W.partitionBy("string").orderBy("doc_id", "text_id", "start"))).where("_rank > 1").select("doc_id", "text_id", "start", (F.col("start") + length).alias("stop"))
    return whole.union(usual).union(often)


def remove_repeats(docs: DataFrame, length: int = 100, max_contexts: int = 20_000, keep_text: bool = False) -> DataFrame:
    """For each row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with keep_text the bytes that stay."""
    docs = _numbered(docs)
    with Staging(docs.sparkSession) as stage:
        spans = staged(repeated_spans(docs, stage, length, max_contexts), "spans")
    spans = spans.groupBy("doc_id", "text_id").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    rows = _same_text(docs, spans.withColumnRenamed("doc_id", "_id")).select("doc_id", "text", "spans")

    def cut(batches):
        for batch in sliced(batches):
            cols = [[], [], [], [], []]
            for raw, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw, kept, at, runs, removed = raw.encode(), [], 0, 0, 0
                last = -1
                for start, stop in sorted((s["start"], s["stop"]) for s in spans or ()):
                    if start > last:
                        kept.append(raw[at:start])
                        runs += 1
                        removed += stop - start
                    elif stop > last:
                        removed += stop - last
                    last = at = max(last, stop)
                kept.append(raw[at:])
                rest = b"".join(kept)
                for col, v in zip(cols, (len(raw), removed, runs, hashlib.sha256(rest).hexdigest(), rest)):
                    col.append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            out = [batch.column(0)] + [pa.array(c, t) for c, t in zip(cols, types)]
            yield pa.RecordBatch.from_arrays(out[: 5 + keep_text], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + keep_text])

    return rows.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text)
