import hashlib
import re

import pytest

from .conftest import ROWS, row, words

from tessera.llm.decontamination import decontaminate

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute(rows, items):
    wins = {}
    for item, text in items:
        w = split(text)
        for s in range(max(len(w) - 9, 1)) if w else ():
            wins.setdefault(tuple(w[s : s + 10]), set()).add(str(item))
    out = []
    for r in rows:
        w, hit, found = split(r[1]), set(), set()
        for win, names in wins.items():
            for p in range(len(w) - len(win) + 1):
                if tuple(w[p : p + len(win)]) == win:
                    hit |= set(range(p, p + len(win)))
                    found |= names
        out.append((r[0], len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_against_brute_force(spark, docs):
    items = [(1, ROWS[12][1]), (2, "Two WORDS"), (3, "one"), (4, None), (5, ""), (6, ROWS[3][1][:150]), (7, ROWS[3][1][:150]), (10, words(12)), (11, "É ü"), (12, "... !!")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r)[:6] for r in decontaminate(docs, bench).collect()), key=str)
    want = brute(ROWS, items)
    assert got == want
    assert sum(r[5] for r in got) > 4


ITEMS = [(1, ROWS[12][1]), (2, "Two WORDS"), (3, "one"), (4, None), (5, ""), (6, ROWS[3][1][:150]), (7, ROWS[3][1][:150]), (10, words(12)), (11, "É ü"), (12, "... !!"), (13, " ".join(split(ROWS[0][1])[20:25]))]
MORE = [row(None, ROWS[12][1]), row(None, "two words"), row(7, ROWS[12][1] + " more"), row(7, ROWS[12][1] + " more"), row(30, "..., " + ROWS[3][1])]


@pytest.mark.parametrize("rows", [200_000, 3, 0])
def test_both_ways_against_brute_force(spark, docs, rows):
    """Of null doc_ids and of different texts under one doc_id, too."""
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    all_docs = docs.union(spark.createDataFrame(MORE, docs.schema)).repartition(3)
    if rows == 0:  # the blocks of short windows would be empty
        bench, items = bench.where("item_id in (1, 6, 7, 10)"), [i for i in ITEMS if i[0] in (1, 6, 7, 10)]
    else:
        items = ITEMS
    got = sorted((tuple(r)[:6] for r in decontaminate(all_docs, bench, broadcast_rows=rows).collect()), key=str)
    assert got == sorted(brute(ROWS + MORE, items), key=str)


def test_shuffled_places_grow_with_the_text(spark):
    """Beyond the broadcast a place is (text, place, key), about two for nine words, however long the text is."""
    from tessera.llm.decontamination import _least_places

    n = [_least_places(spark.createDataFrame([(1, words(k))], "doc_id long, text string"), 10).count() for k in (2_000, 8_000)]
    assert 0.1 < n[0] / 2_000 < 0.35 and 3 < n[1] / n[0] < 5


def test_empty(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(no_docs, none).count() == 0
    got = decontaminate(docs, none).collect()
    assert len(got) == len(ROWS) and not any(r.contaminated for r in got)
