import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm.merkle import merkle_manifest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, idx long, root string, _group string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text=None):
    return H(*[field(v) for v in (r[0], r[3], r[2], r[4], r[1] if text is None else text)])


def levels(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + arity]) for i in range(0, len(out[-1]), arity)])
    return out


def path(lv, i, arity):
    out = []
    for level in lv[:-1]:
        a = i // arity * arity
        out.append((level[a:i], level[i + 1 : a + arity]))
        i //= arity
    return out


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, arity):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs}
    trees = {x: levels([leaf(r) for r in g], arity) for x, g in groups.items()}
    top = levels([trees[x][-1][0] for x in langs], arity)
    out = []
    for n, x in enumerate(langs):
        for i, r in enumerate(groups[x]):
            steps = path(trees[x], i, arity) + path(top, n, arity)
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
            h = leaf(r, lower(r[1])) if bad else leaf(r)
            for lo, hi in steps:
                h = H(*lo, h, *hi)
            out.append((r[0], leaf(r), trees[x][-1][0], top[-1][0], H(*[s for lo, hi in steps for s in lo + hi]), h, h == top[-1][0]))
    return sorted(out, key=str)


def run(spark, rows, arity=8):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], COLUMNS).repartition(3)
    out = merkle_manifest(df, arity, F.crc32(F.col("doc_id").cast("string")) % 3 == 0)
    return sorted([tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()], key=str)


def rows_of(n, lang):
    return [(i, f"Text {i} É", lang, None if i % 5 == 0 else "s", i) for i in range(n)]


@pytest.mark.parametrize("sizes, arity", [((73, 8, 1, 9), 8), ((5, 1), 2), ((1,), 8)])
def test_proofs_against_brute_force(spark, sizes, arity):
    rows = [(1000 * k + r[0], *r[1:]) for k, n in enumerate(sizes) for r in rows_of(n, (None, "en", "é", "zz")[k])]
    assert run(spark, rows, arity) == brute(rows, arity)


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [(None, None, None, None, None), (None, "A", None, None, None), (5, "", "", "", 0), (5, "", "", "", 0), (5, "b", "", "", 0), (6, "ÀB" * 700_000, "", None, -1), (7, None, "en", "1:x", 3), (2**62, "Z", "en", None, None)]
    got = run(spark, rows)
    assert got == brute(rows, 8)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_one_row_repeated_lies_over_partitions(spark):
    rows = [(1, "same", "en", "s", 4)] * 200
    assert run(spark, rows) == brute(rows, 8)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_values_do_not_run_together(spark):
    a, b = run(spark, [(1, "x", "1:y", "s", 2)]), run(spark, [(1, "x1:y", "", "s", 2)])
    assert a[0][1] != b[0][1]
