import hashlib
import random
import zlib

from pyspark.sql import functions as F

from tessera.llm import prefix_trie as P

COLUMNS = "conv_id long, turn long, role string, text string, depth long, a long, n_convs long"


def brute(rows, modulus=100, heads=6):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % heads for c in own}
    whole = {c: tuple(own.get(c - c % modulus, [])[: h[c]] + t[h[c] :]) for c, t in own.items()}
    members = {}
    for c, t in whole.items():
        for d in range(len(t) + 1):
            members.setdefault(t[:d], []).append(c)
    out = []
    for k, m in members.items():
        below = [x for x in members if x[: len(k)] == k]
        kids = [x for x in below if len(x) == len(k) + 1]
        leaves = [x for x in below if not any(y[: len(x)] == x and len(y) == len(x) + 1 for y in below)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        ends = ",".join(str(c) for c in sorted(c for c in m if whole[c] == k))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], COLUMNS).repartition(3)
    c = F.col("conv_id")
    out = P.prefix_trie(df, c - c % 100, F.crc32(c.cast("string")) % 6, 5)
    return sorted([tuple(r) for r in out.collect()], key=str)


def test_random_conversations_against_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for c in [0, 100, *rng.sample(range(1, 330), 60)]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(("user", "assistant", None)), rng.choice(("a", "bé", "", None, "ccc 😀"))))
    assert run(spark, rows) == brute(rows)


def test_one_long_conversation_and_copies(spark):
    long = [(200, t, "user", f"turn {t % 7}") for t in range(137)]
    copies = [(c, t, "user", f"turn {t % 7}") for c in range(201, 261) for t in range(20)]
    assert run(spark, long + copies) == brute(long + copies)


def test_nulls_ties_and_absent_bases(spark):
    rows = [(None, 0, "user", "lost"), (None, None, None, None), (7, None, None, None), (7, None, "b", "x"), (7, 0, "a", "y"), (7, 0, "a", "y"), (7, 0, "a", "x"), (8, 0, "user", "turnless"), (-5, 0, "u", "neg"), (350, 1, "u", "z" * 2_000_000), (300, 1, "u", "z" * 2_000_000)]
    assert run(spark, rows) == brute([r for r in rows if r[0] is not None])


def test_role_and_text_do_not_run_together(spark):
    rows = [(c, 0, "ab", "c") for c in range(300, 306)] + [(c, 0, "a", "bc") for c in range(400, 406)]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_fingerprints_that_meet_are_made_anew(spark, monkeypatch):
    """In the first attempt all prefixes of a length have one fingerprint; the result stays right."""
    real, tried = P.Constants, []

    class Weak(real):
        def __init__(self, attempt, max_head):
            super().__init__(attempt, max_head)
            tried.append(attempt)

        def x(self, m):
            return F.lit(1).cast("long") if len(tried) == 1 else super().x(m)

        def power(self, m, n):
            return F.lit(1).cast("long") if len(tried) == 1 else super().power(m, n)

    monkeypatch.setattr(P, "Constants", Weak)
    rows = [(100 * c, t, "u", f"{c % 4} {t}") for c in range(20) for t in range(6)]
    assert run(spark, rows) == brute(rows)
    assert len(tried) > 1
