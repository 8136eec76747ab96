"""Language ID with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A trigram's vector binds its letters' vectors, rotated by
2, 1 and 0 places, by elementwise product; a text's vector bundles (sums) those of its trigrams; a
language's prototype bundles the vectors of its training texts; a text gets the language whose
prototype has the greatest cosine. Letters are lower-cased, and any run of other characters is one
boundary letter.

Texts go through Arrow in groups of about a million characters: a count matrix (text by
distinct trigram) times the trigram vectors, of bounded size: some thousand trigrams at a time, and as many
texts as give a million counts. A text beyond that is counted in slices, none is cut off.

Defined cases: null texts and texts without a letter are ``und`` with score 0; null or empty lang is
not learned from; equal cosines go to the smaller language name; with nothing to learn from, all are
``und``; repeated rows are judged each; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks_of, lean, sliced

DIM = 1024
UNDETERMINED = "und"
_SLICE = 1_000_000
_GRAMS, _CELLS = 4_096, 1 << 20  # trigram vectors and counts held at once
_letters: dict[tuple[int, int], np.ndarray] = {}


def letter_vector(code: int, dim: int = DIM) -> np.ndarray:
    """The same on every machine; code 0 is the boundary."""
    if (code, dim) not in _letters:
        if len(_letters) > 20_000:
            _letters.clear()
        _letters[code, dim] = np.where(np.random.default_rng([7, code]).integers(0, 2, dim), 1, -1).astype(np.int8)
    return _letters[code, dim]


def _symbols(text: str) -> np.ndarray:
    """Code points of letters, 0 for each run of others."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if not len(codes):
        return np.zeros(0, dtype=np.int64)
    present = np.flatnonzero(np.bincount(codes))
    table = np.zeros(int(present[-1]) + 1, dtype=np.int64)
    for c in present:
        if chr(c).isalpha():
            table[c] = c
    out = table[codes]
    return out[(out != 0) | np.r_[True, out[:-1] != 0]]


def _join(parts: list[np.ndarray]) -> np.ndarray:
    out = np.concatenate(parts)
    return out[(out != 0) | np.r_[True, out[:-1] != 0]]


def _slices(text: str):
    """Symbol arrays whose trigrams together are those of boundary + text + boundary."""
    edge = carry = np.zeros(1, dtype=np.int64)
    for i in range(0, len(text), _SLICE):
        last = i + _SLICE >= len(text)
        s = _join([carry, _symbols(text[i : i + _SLICE])] + [edge] * last)
        yield s
        carry = s[-2:]


def text_vectors(texts: list[str], dim: int = DIM) -> tuple[np.ndarray, np.ndarray]:
    """(len(texts), dim) float32 bundles, and which texts have a letter."""
    rows, syms = [], []
    for k, t in enumerate(texts):
        for s in _slices(t or ""):
            if len(s) > 2:
                rows.append(k)
                syms.append(s)
    out, lettered = np.zeros((len(texts), dim), dtype=np.float32), np.zeros(len(texts), dtype=bool)
    for a, b in chunks_of(syms, _SLICE):
        one = np.concatenate(syms[a:b])
        present = np.flatnonzero(np.bincount(one))
        base, place = len(present), np.zeros(int(present[-1]) + 1, dtype=np.int64)
        place[present] = np.arange(base)
        local = place[one]
        code = (local[:-2] * base + local[1:-1]) * base + local[2:]
        sizes = np.array([len(s) for s in syms[a:b]])
        owner = np.repeat(np.arange(b - a, dtype=np.int32), sizes)
        whole = owner[:-2] == owner[2:]  # none over the border of two texts
        code, owner = code[whole], owner[:-2][whole]
        if base**3 <= 1 << 22:
            seen = np.zeros(base**3, dtype=bool)
            seen[code] = True
            used = np.flatnonzero(seen)
            col = (np.cumsum(seen, dtype=np.int32) - 1)[code]
        else:
            used, col = np.unique(code, return_inverse=True)
        first, second, third = used // (base * base), used // base % base, used % base
        plain = np.stack([letter_vector(int(c), dim) for c in present])
        order = np.argsort(col, kind="stable")
        col, owner = col[order], owner[order]
        edges = np.searchsorted(col, np.arange(0, len(used) + _GRAMS, _GRAMS))
        rolled = np.roll(plain, 2, axis=1), np.roll(plain, 1, axis=1)
        for u, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
            v = slice(u * _GRAMS, min((u + 1) * _GRAMS, len(used)))
            width = v.stop - v.start
            grams = (rolled[0][first[v]] * rolled[1][second[v]] * plain[third[v]]).astype(np.float32)
            for r in range(0, b - a, step := max(1, _CELLS // width)):
                inside = (owner[lo:hi] >= r) & (owner[lo:hi] < r + step)
                if inside.any():
                    n = min(step, b - a - r)
                    counts = np.bincount((owner[lo:hi][inside].astype(np.int64) - r) * width + col[lo:hi][inside] - v.start, minlength=n * width).reshape(n, -1).astype(np.float32)
                    np.add.at(out, rows[a + r : a + r + n], counts @ grams)
        np.logical_or.at(lettered, rows[a:b], np.array([bool(s.any()) for s in syms[a:b]]))
    return out, lettered


def train_prototypes(labelled: DataFrame, dim: int = DIM, max_docs: int = 20_000) -> dict[str, np.ndarray]:
    """Unit prototypes by language from labelled(doc_id, text, lang).

    Of a language with more than max_docs texts, those whose hashed doc_id falls below that share of the
    hash range are taken, about max_docs. The result has one vector a language.
    """
    labelled = labelled.where("lang is not null and lang != ''")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return {}
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, max_docs / n)))])
    some = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.element_at(share, F.col("lang")) * (1 << 20))

    def bundle(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in sliced(batches):
            langs, texts = np.array(batch.column(0).to_pylist(), dtype=object), batch.column(1).to_pylist()
            for a, b in chunks_of(texts, _SLICE):
                vectors, lettered = text_vectors(texts[a:b], dim)
                norm = np.linalg.norm(vectors, axis=1, keepdims=True)
                vectors = vectors / np.where(norm, norm, 1)
                for lang in set(langs[a:b]):
                    sums[lang] = sums.get(lang, 0) + vectors[(langs[a:b] == lang) & lettered].sum(axis=0, dtype=np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], names=["lang", "sums"])

    def add(lang: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": lang["lang"].iloc[:1], "sums": [np.sum(np.stack(lang["sums"]), axis=0)]})

    # parts are added twice over, so that no task gets the parts of all others
    parts = some.select("lang", "text").mapInArrow(lean(bundle), "lang string, sums array<double>").withColumn("_part", F.pmod(F.xxhash64("sums"), F.lit(64)))
    parts = parts.groupBy("lang", "_part").applyInPandas(add, "lang string, sums array<double>").groupBy("lang").applyInPandas(add, "lang string, sums array<double>")
    found = {r["lang"]: np.array(r["sums"]) for r in parts.collect()}
    return {k: (v / n).astype(np.float32) for k, v in sorted(found.items()) if (n := np.linalg.norm(v))}


def identify_language(docs: DataFrame, prototypes: dict[str, np.ndarray], keep: tuple[str, ...] = ("doc_id",), dim: int = DIM) -> DataFrame:
    """docs' columns keep, with lang_pred and score (the cosine, not under 0)."""
    names = list(prototypes)
    matrix = np.stack([prototypes[k] for k in names]).T if names else np.zeros((dim, 1), dtype=np.float32)

    def judge(batches):
        for batch in sliced(batches):
            texts = batch.column("text").to_pylist()
            pred, score = [], []
            for a, b in chunks_of(texts, _SLICE):
                vectors, lettered = text_vectors(texts[a:b], dim)
                norm = np.linalg.norm(vectors, axis=1)
                cos = vectors @ matrix / np.where(norm, norm, 1)[:, None]
                best = cos.argmax(axis=1)
                sure = lettered & (norm > 0) & bool(names)
                pred += [names[k] if s else UNDETERMINED for k, s in zip(best, sure)]
                score += np.where(sure, np.clip(cos[np.arange(b - a), best], 0, 1), 0.0).tolist()
            out = [batch.column(c) for c in keep] + [pa.array(pred, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(out, names=[*keep, "lang_pred", "score"])

    rows = docs.select(*keep) if "text" in keep else docs.select(*keep, "text")
    schema = rows.select(*keep, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return rows.mapInArrow(lean(judge), schema)
