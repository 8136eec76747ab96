import hashlib
import random
import re

import pytest

from .conftest import DOCS, ROWS, row, words

from tessera.llm import suffix_dedup
from tessera.llm.components import components
from tessera.llm.jaccard_join import jaccard_components
from tessera.llm.suffix_dedup import remove_repeats

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_repeats(rows, length=100):
    """Rows that repeat doc_id and text are one document."""
    seen, out = {}, {}
    for doc, text in sorted(set((r[0], r[1] or "") for r in rows)):
        b, hit = text.encode(), set()
        for p in range(len(b) - length + 1):
            if b[p : p + length] in seen:
                hit |= set(range(p, p + length))
            seen.setdefault(b[p : p + length], (doc, p))
        kept = bytes(x for i, x in enumerate(b) if i not in hit)
        out[doc] = (len(b), len(hit), sum(i - 1 not in hit for i in hit), hashlib.sha256(kept).hexdigest())
    return sorted((r[0], *out[r[0]]) for r in rows)


@pytest.mark.parametrize("most", [20_000, 1])
def test_repeats(docs, no_docs, most):
    got = sorted(tuple(r) for r in remove_repeats(docs, max_contexts=most).collect())
    assert got == brute_repeats(ROWS)
    assert any(r[2] for r in got)
    assert remove_repeats(no_docs).count() == 0


def test_repeats_random(spark, monkeypatch):
    rng = random.Random(3)
    parts = [words(12, rng) for _ in range(6)]
    rows = [row(i, " ".join(rng.choice([*parts, words(3, rng)]) for _ in range(rng.randint(0, 12)))) for i in range(60)]
    got = sorted(tuple(r) for r in remove_repeats(spark.createDataFrame(rows, DOCS).repartition(4)).collect())
    assert got == brute_repeats(rows)


def test_long_texts_in_slices():
    import numpy as np

    data = np.frombuffer(("ab" * 100 + words(400)).encode() * 2, dtype=np.uint8)
    found = suffix_dedup.repeated_strings(data, np.arange(len(data) - 99), 100)
    text = data.tobytes()
    seen, want = set(), []
    for p in range(len(text) - 99):
        want.append(text[p : p + 100] in seen)
        seen.add(text[p : p + 100])
    assert found.tolist() == want


def test_longest_previous_factors():
    import numpy as np

    rng = random.Random(8)
    for n, width in ((1, 4), (60, 6), (300, 9)):
        text = [bytes(rng.choice(b"abc") for _ in range(width)) for _ in range(n)]
        rows = np.frombuffer(b"".join(text), dtype=np.uint8).reshape(n, width)
        common = lambda a, b: next((i for i in range(width) if a[i] != b[i]), width)
        want = [max((common(text[i], text[j]) for j in range(i)), default=0) for i in range(n)]
        assert suffix_dedup.longest_previous_factors(rows, np.full(n, width)).tolist() == want
        order = np.argsort([t for t in rows.view(f"S{width}").ravel()], kind="stable")
        before, after = suffix_dedup.smaller_positions(order)
        assert before.tolist() == [max((j for j in range(r) if order[j] < order[r]), default=-1) for r in range(n)]
        assert after.tolist() == [min((j for j in range(r + 1, n) if order[j] < order[r]), default=n) for r in range(n)]


def test_texts_of_one_or_no_doc_id_are_documents_of_their_own(spark):
    a, b = words(60), words(60)
    rows = [(7, a), (7, b), (7, a), (None, a + " x"), (None, b[:50] + a), (9, b + "!"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    hashes = {r[1] or "": h for r, h in zip(rows, [x.h for x in df.selectExpr("xxhash64(coalesce(text, '')) as h").collect()])}
    docs = sorted({(-1 if d is None else d, hashes[t or ""], t or "") for d, t in rows})
    seen, want = set(), {}
    for d, _, t in docs:
        raw = t.encode()
        hit = {q for p in range(len(raw) - 99) if raw[p : p + 100] in seen or seen.add(raw[p : p + 100]) for q in range(p, p + 100)}
        want[d, t] = len(hit)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed) for r in remove_repeats(df.repartition(3)).collect())
    assert got == sorted((-1 if d is None else d, len((t or "").encode()), want[-1 if d is None else d, t or ""]) for d, t in rows)


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    k = min(size, len(w))
    return {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()


def brute_components(rows, size, percent):
    sets = [shingles(r[1], size) for r in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * same >= percent * (len(sets[i]) + len(sets[j]) - same):
                old, new = root[i], root[j]
                root = [new if x == old else x for x in root]
    low = {}
    for r, c in zip(rows, root):
        low[c] = min(low.get(c, r[0]), r[0])
    return sorted((r[0], len(s), low[c]) for r, s, c in zip(rows, sets, root))


@pytest.mark.parametrize("most", [20_000, 8])
def test_jaccard(spark, docs, no_docs, most):
    got = sorted(tuple(r) for r in jaccard_components(docs, max_block=most, max_group=most).collect())
    assert got == brute_components(ROWS, 4, 85)
    assert jaccard_components(no_docs).count() == 0


@pytest.mark.parametrize("most", [20_000, 16])
def test_jaccard_random_near_copies(spark, most):
    rng = random.Random(9)
    base = [words(rng.randint(20, 120), rng).split() for _ in range(5)]
    rows = []
    for i in range(150):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"new{rng.randint(0, 3)}"
        rows.append(row(i, " ".join(w)))
    got = sorted(tuple(r) for r in jaccard_components(spark.createDataFrame(rows, DOCS).repartition(5), max_block=most, max_group=most, broadcast_rows=0).collect())
    assert got == brute_components(rows, 4, 85)


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100), (200, 201), (201, 200), (None, 3)] + [(300, 301 + k) for k in range(40)] + [(rng.randint(400, 500), rng.randint(400, 500)) for _ in range(60)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long").repartition(6)).collect()}
    root = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
            root.setdefault(min(a, b), min(a, b))
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
