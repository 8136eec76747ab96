import hashlib
import random
import re

import pytest

from tessera.llm import crf, pii
from tessera.llm.pii_rules import KINDS, base_spans, luhn

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind in KINDS:
        for m in re.finditer(PLAIN[kind], text):
            d = re.sub(r"[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False, "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


@pytest.fixture(scope="module")
def model(spark):
    return pii.train(pii.labelled_examples(spark))


def test_rules_against_the_plain_patterns():
    rng = random.Random(2)
    parts = ["@", ".", "+", "-", " ", "(", ")", "1", "25", "300", "4111111111111111", "4111 1111 1111 1111", "a", "bc.d", "é", "x@y.z", "10.0.0.1", "+1 (743) 555-3824", "%", "\n"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 24)))
        assert base_spans(text) == brute(text), text


def test_rules_are_linear_in_very_long_texts():
    for text in ("z" * 2_000_000, "1" * 2_000_000, "1.x" * 400_000, "@" * 500_000, "+1" * 300_000, "a@" * 300_000):
        assert base_spans(text) == []
    assert base_spans("z" * 10**6 + "@b.c") == [("email", 0, 10**6 + 4)]


def test_luhn():
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def _score(lines, model):
    base = [base_spans(x) for x, _ in lines]
    good = wrong = missed = 0
    for (_, spans), b, got in zip(lines, base, pii.added_spans([x for x, _ in lines], base, model)):
        want = {s for s in spans if all(s[2] <= x or y <= s[1] for _, x, y in b)}
        good, wrong, missed = good + len(want & set(got)), wrong + len(set(got) - want), missed + len(want - set(got))
    return good / (good + wrong), good / (good + missed)


def test_held_out_lines(model):
    w = pii._Writer(99)
    precision, recall = _score([w.line() for _ in range(1000)], model)
    assert precision > 0.95 and recall > 0.9


HAND = [
    ("Call me on (415) 555-0132 tomorrow.", ["phone:(415) 555-0132"]), ("you can reach maria dot lopez at uni dot edu any time", ["email:maria dot lopez at uni dot edu"]), ("server at 10[.]20[.]30[.]40 was down", ["ip:10[.]20[.]30[.]40"]),
    ("Amex 3714 496353 98431 exp 12/26", ["card:3714 496353 98431"]), ("mail: peter.k [at] firma [dot] de", ["email:peter.k [at] firma [dot] de"]), ("my cell is 555-867-5309 ok", ["phone:555-867-5309"]), ("card 4111.1111.1111.1111 ok", ["card:4111.1111.1111.1111"]),
    ("released on 2024-10-11, version 3.12.4, 120-145", []), ("isbn 978-3-16-148410-0", []), ("order 555-1234 shipped", []), ("The temperature fell at 7 dot 5 degrees", []), ("see [1], [2] and [3]", []), ("1600 Pennsylvania Ave 20500", []), ("0x7fff5fbff 1234567890123", []), ("card 4111.1111.1111.1112", []),
]


@pytest.mark.parametrize("text, want", HAND)
def test_lines_written_by_hand(model, text, want):
    assert [f"{k}:{text[a:b]}" for k, a, b in pii.added_spans([text], [base_spans(text)], model)[0]] == want


def test_viterbi_is_the_best_of_all_labellings():
    rng = crf.np.random.default_rng(1)
    k = 5
    t = crf.tokenize("a 1 - b\n7\nx @ y")
    ids = crf.features(t)
    m = crf.Model(("p", "q"), rng.normal(size=(crf.n_features(), k)).astype("float32"), rng.normal(size=(k, k)).astype("float32"), rng.normal(size=k).astype("float32"))
    got, moves = crf.decode(m, t), m.moves + crf._allowed(k)
    unary = m.weights[ids].sum(axis=1)
    import itertools

    for a, n in zip(t.first, t.size):
        score = lambda ls: m.opening[ls[0]] + sum(unary[a + i][x] for i, x in enumerate(ls)) + sum(moves[x, y] for x, y in zip(ls, ls[1:]))
        assert tuple(got[a : a + n]) == max(itertools.product(range(k), repeat=int(n)), key=score)


def test_gradient_is_that_of_the_likelihood():
    """Training raises the likelihood of the labelled line over all labellings to nearly 1."""
    text, spans = "tel 555-1234 ok", [("phone", 4, 12)]
    m = crf.train([text] * 3, [spans] * 3, KINDS, rounds=80)
    t = crf.tokenize(text)
    assert crf.spans_of(crf.decode(m, t), t, KINDS) == spans


def test_neighbourhoods_stay_in_their_line_and_meet():
    text = "a" * 100 + " 1 " + "b" * 200 + " 2\n3 " + "c" * 30 + " 4"
    got = pii.neighbourhoods(text)
    assert all("\n" not in text[a:b] for a, b in got) and len(got) == 3
    assert got[-1] == (text.index("\n") + 1, len(text))


def test_query_rows(spark, docs, no_docs, model):
    extra = [(100, "(415) 555-0132 call a@b.co or +1 (743) 555-3824", None, None, None, 1, 2, "x", "y", "z", "w", 3, 4), (None, "x " * 1_500_000 + "10.0.0.1", None, None, None, 1, 2, "x", "y", "z", "w", 3, 4)]
    df = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    got = pii.find_personal_data(df, model).collect()
    assert len(got) == df.count()
    for r, text in [(r, t) for t in (extra[0][1],) for r in got if r["doc_id"] == 100]:
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in brute(text))
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and (r["n_email"], r["n_phone"], r["n_added"]) == (1, 1, 1)
        assert r["spans"] == "email:20:26,phone:0:14,phone:30:47"
    assert [r["spans"] for r in got if r["doc_id"] is None] == ["ip:3000000:3000008"]
    assert {r["base_sha256"] for r in got if r["doc_id"] == 4} == {hashlib.sha256(b"").hexdigest()}
    assert pii.find_personal_data(no_docs, model).collect() == []


def test_redact_by_place():
    text = "1.1.1.1 is not 1.1.1.1x"
    assert pii.redact(text, [("ip", 0, 7)]) == "<ip> is not 1.1.1.1x"
