import re
from collections import Counter

from pyspark.sql import functions as F

from .conftest import ROWS

from tessera.llm.quality_rules import labelled_sample, learn_rules, quality_verdicts, text_stats, verdict


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    n, held = Counter(grams), set()
    for k, g in enumerate(grams):
        held |= {k, k + 1, k + 2} if n[g] > 1 else set()
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(held)


def test_stats(docs):
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = sorted((r.doc_id, *[r[c] for c in cols]) for r in text_stats(docs).collect())
    assert got == sorted((r[0], *brute(r[1])) for r in ROWS)


def test_learns_and_keeps(spark):
    good = [(i, " ".join(f"word{(i * 7 + k * k) % 97}" for k in range(80))) for i in range(120)]
    bad = [(1000 + i, " ".join(f"word{(i * 5 + k * 3) % 97}$$" for k in range(80))) for i in range(60)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(5, None, 0), (None, 0, 0), (99999, 0, 0)], "doc_id long, quality int, toxic int")
    rules = learn_rules(labelled_sample(docs, labels))
    assert rules and "CASE" in str(verdict(rules))
    out = {r.doc_id: r.kept for r in quality_verdicts(docs, rules).collect()}
    assert all(out[i] for i, _ in good) and not any(out[i] for i, _ in bad)


def test_callers_columns_stay(spark):
    rows = spark.createDataFrame([(1, "a b a b", "mine", "his", 7)], "doc_id long, text string, _w string, _lines string, n_words int")
    got = text_stats(rows).first()
    assert (got["_w"], got["_lines"], got["n_words"]) == ("mine", "his", 4)


def test_first_condition_is_the_best_one(spark):
    """The learner's first condition against all conditions tried one by one."""
    import random

    from tessera.llm import quality_rules as Q

    rng = random.Random(3)
    rows = [(i, *[float(rng.randint(0, 9)) for _ in Q.FEATURES]) for i in range(600)]
    data = spark.createDataFrame([(*r, r[3] > 6 or rng.random() < 0.1) for r in rows], "doc_id long, " + ", ".join(f"{f} double" for f in Q.FEATURES) + ", bad boolean").cache()
    first = Q.learn_rules(data, max_rules=1, max_conditions=1)[0].conditions[0]
    grow = [(r, r.bad) for r in data.withColumn("_g", F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(3)) != 0).where("_g").collect()]
    p, n = sum(b for _, b in grow), sum(not b for _, b in grow)

    def gain(f, cut, above):
        c = [b for r, b in grow if (r[f] > cut) == above]
        return sum(c) * (Q._information(sum(c), len(c) - sum(c)) - Q._information(p, n)) if sum(c) >= 5 else 0

    best = max(gain(f, float(cut), above) for f in Q.FEATURES for cut in range(10) for above in (True, False))
    assert abs(gain(first.feature, first.threshold, first.above) - best) < 1e-9 and (first.feature, first.threshold, first.above) == (Q.FEATURES[2], 6.0, True)


def test_large_label_tables_are_sampled_by_hash_share(spark, docs):
    labels = docs.where("doc_id is not null").selectExpr("doc_id", "1 as quality")
    assert labelled_sample(docs, labels, 10**6).count() >= labelled_sample(docs, labels, 5).count()


def test_defined_cases(spark, docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert learn_rules(labelled_sample(docs, none)) == []
    one = spark.createDataFrame([(0, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    assert learn_rules(labelled_sample(docs, one)) == []
    out = quality_verdicts(docs, [])
    assert out.count() == len(ROWS)
    assert not out.where("doc_id in (4, 5, 6, 7)").agg(F.max("kept")).first()[0]
    assert quality_verdicts(no_docs, []).count() == 0
