"""Recursive chunking over Arrow batches."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import is_meaningful

SEPARATORS = ("\n\n", "\n", " ", "")


def _merge(parts: list[str], sep: str, size: int, overlap: int) -> list[str]:
    """Parts joined greedily up to size; each chunk starts with as many last parts of the one before as overlap allows."""
    out, held, total = [], [], 0
    for p in parts:
        if held and total + len(p) + len(sep) > size:
            out.append(sep.join(held))
            while held and (total > overlap or total + len(p) + len(sep) > size):
                total -= len(held.pop(0)) + (len(sep) if held else 0)
        total += len(p) + (len(sep) if held else 0)
        held.append(p)
    return out + ([sep.join(held)] if held else [])


def recursive_chunks(text: str, size: int = 1024, overlap: int = 80, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Splits by the first separator that occurs, and what is still too long by the later ones. Stripped, none empty."""
    sep = next((s for s in separators if s == "" or s in text), "")
    rest = separators[separators.index(sep) + 1 :]
    out, short = [], []
    for p in text.split(sep) if sep else list(text):
        if len(p) <= size:
            short.append(p) if p else None
            continue
        if short:
            out += _merge(short, sep, size, overlap)
            short = []
        out += recursive_chunks(p, size, overlap, rest) if rest else [p]
    if short:
        out += _merge(short, sep, size, overlap)
    return [c for c in (x.strip() for x in out) if c]


def chunk_text(docs: DataFrame, key: str = "doc_id", size: int = 1024, overlap: int = 80) -> DataFrame:
    """(key, pos, text) of docs(key, text); texts that fit are one chunk."""
    def run(batches):
        for batch in batches:
            rows = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                t = (t or "").strip()
                rows += [(k, i, c) for i, c in enumerate([t] if 0 < len(t) <= size else recursive_chunks(t, size, overlap))]
            types = (batch.schema.types[0], pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=[key, "pos", "text"])

    return docs.select(key, "text").mapInArrow(run, f"{key} {dict(docs.dtypes)[key]}, pos int, text string")


def join_meaningful_blocks(blocks: DataFrame, key: str = "page_id", size: int = 1024, overlap: int = 80) -> DataFrame:
    """blocks(key, pos, text) of a page joined in order, chunked, and kept if meaningful and over 50 characters."""
    page = blocks.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda b: b.text), " ").alias("text"))
    return chunk_text(page, key, size, overlap).where(is_meaningful("text") & (F.length("text") > 50))
