import zlib

import numpy as np

from .conftest import ROWS

from tessera.llm import language_id as L


def test_slices_make_no_difference(monkeypatch):
    texts = [r[1] or "" for r in ROWS]
    whole, lettered = L.text_vectors(texts)
    monkeypatch.setattr(L, "_SLICE", 37)
    parts, again = L.text_vectors(texts)
    assert np.array_equal(whole, parts) and (lettered == again).all()


def test_vector_is_bundle_of_bound_letters():
    got, _ = L.text_vectors(["Ab"])
    v = lambda c: L.letter_vector(c).astype(int)
    grams = [(0, 97, 98), (97, 98, 0)]
    assert np.array_equal(got[0], sum(np.roll(v(a), 2) * np.roll(v(b), 1) * v(c) for a, b, c in grams))


def test_held_out_accuracy_and_cases(spark, docs, no_docs):
    a, b = "the of and thing other there", "der und nicht sich auch schon"
    rows = [(i, " ".join((a if i % 2 else b).split()[k % 6] for k in range(i % 9 + 2)), "en" if i % 2 else "de") for i in range(120)]
    data = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learn = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    p = L.train_prototypes(spark.createDataFrame(learn, data.schema))
    got = {r.doc_id: r for r in L.identify_language(data, p).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert np.mean([got[r[0]].lang_pred == r[2] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())
    out = L.identify_language(docs, p).collect()
    assert len(out) == len(ROWS)
    assert {r.doc_id for r in out if r.lang_pred == "und"} >= {4, 5, 6}
    assert L.train_prototypes(no_docs) == {}
    assert {r.lang_pred for r in L.identify_language(docs, {}).collect()} == {"und"}
    assert L.identify_language(no_docs, p).count() == 0


def test_predictions_against_brute_force(spark):
    """Prototypes as sums of unit text vectors, each from its own trigrams, and the greatest cosine."""
    rows = [(i, " ".join(("the of and thing other" if i % 3 else "der und nicht sich auch").split()[(i * k) % 5] for k in range(1, i % 7 + 3)), "en" if i % 3 else "de") for i in range(40)] + [(100, "漢字 テキスト", None), (101, "q!w", None), (102, "123", None)]

    def vector(text):
        codes = [0]
        for c in text.lower():
            if c.isalpha() or codes[-1]:
                codes.append(ord(c) if c.isalpha() else 0)
        codes += [0] * bool(codes[-1])
        v = {c: L.letter_vector(c).astype(float) for c in set(codes)}
        return sum((np.roll(v[a], 2) * np.roll(v[b], 1) * v[c] for a, b, c in zip(codes, codes[1:], codes[2:])), np.zeros(L.DIM))

    unit = lambda v: v / (np.linalg.norm(v) or 1)
    prototypes = {k: unit(sum(unit(vector(t)) for _, t, lang in rows if lang == k)) for k in ("de", "en")}
    data = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    for r in L.identify_language(data, L.train_prototypes(data)).collect():
        cos = {k: float(unit(vector(dict((i, t) for i, t, _ in rows)[r.doc_id])) @ p) for k, p in prototypes.items()}
        if r.doc_id == 102:
            assert (r.lang_pred, r.score) == (L.UNDETERMINED, 0.0)
        else:
            assert r.lang_pred == max(cos, key=cos.get) and abs(r.score - max(0.0, *cos.values())) < 1e-4


def test_many_letters_in_bounded_memory():
    import random
    import tracemalloc

    rng = random.Random(6)
    texts = ["".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(100)) for _ in range(1_000)]
    L.text_vectors(texts[:10])
    tracemalloc.start()
    L.text_vectors(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6
