"""Quality rules: decision lists learned by sequential covering, as ordered Spark conditions.

Everything is DataFrame or SQL functions: statistics of a text come from array functions within its
row, so no text is shuffled; the learner counts candidate conditions with one grouped job a step.

Defined cases: a null or empty text has zero words and fails the base rules; null doc_ids keep their
rows; repeated rows are judged each; labels that are null or without a document are not learned from;
with no labels or only one class the list is empty and the base rules alone decide; other
columns of the caller are kept, and clashing names are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_WORD, staged, words

#: What the learner may test. Shares are of words or of characters.
FEATURES = ("n_words", "mean_word", "symbol_share", "upper_share", "mark_share", "digit_share", "dup_line_share", "repeat_share", "distinct_share")


def _kept_chars(text: Column, others: str) -> Column:
    return F.length(F.regexp_replace(text, others, ""))


def text_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and FEATURES (double)."""
    t, w, h = F.col("__t"), F.col("__w"), F.col("__h")
    caller = [c for c in docs.columns if c not in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *FEATURES)]
    df = docs.drop("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *FEATURES).withColumn("__t", F.coalesce(F.col(text), F.lit("")))
    df = df.withColumn("__w", words(t))
    df = df.withColumn("__n", F.size(w)).withColumn("__h", F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))))
    # Windows that occur again: equal neighbours after sorting; most texts have none and skip it.
    df = df.withColumn("__s", F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = F.col("__s")
    twice = F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1), lambda a, b: F.when(a.h == b.h, F.array(a.i, b.i)).otherwise(F.array().cast("array<int>")))
    df = df.withColumn("__p", F.array_sort(F.array_distinct(F.flatten(twice))))
    p = F.col("__p")
    covered = F.aggregate(F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.coalesce(F.least(F.lit(3), b - a), F.lit(3))), F.lit(0), lambda a, x: a + x)
    df = df.withColumn("n_repeat_words", F.coalesce(F.when(F.size(p) > 0, covered), F.lit(0)).cast("long"))
    df = df.withColumn("__lines", F.filter(F.split(t, "\n"), lambda x: x.rlike(SPACE_WORD)))
    df = df.select(
        *[F.col(c) for c in caller],
        F.col("__n").cast("long").alias("n_words"),
        _kept_chars(t, r"[\x20\x09-\x0D]+").cast("long").alias("word_chars"),
        _kept_chars(t, r"[^#*$%&|<>]+").cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("__lines").alias("__n_lines"),
        F.size(F.array_distinct(w)).alias("__n_distinct"),
        _kept_chars(t, r"[^\p{Lu}]+").alias("__upper"),
        _kept_chars(t, r"[^!?]+").alias("__marks"),
        _kept_chars(t, r"[^0-9]+").alias("__digits"),
    )
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    shares = {"mean_word": ("word_chars", "n_words"), "symbol_share": ("n_symbols", "word_chars"), "upper_share": ("__upper", "word_chars"), "mark_share": ("__marks", "word_chars"), "digit_share": ("__digits", "word_chars"), "dup_line_share": ("n_dup_lines", "__n_lines"), "repeat_share": ("n_repeat_words", "n_words"), "distinct_share": ("__n_distinct", "n_words")}
    return df.withColumns({k: share(*v) for k, v in shares.items()}).drop("__n_lines", "__n_distinct", "__upper", "__marks", "__digits")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def sql(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold!r}D"


@dataclass(frozen=True)
class Rule:
    """All conditions hold: the text is bad. precision and covered are those on the pruning part."""

    conditions: tuple[Condition, ...]
    precision: float
    covered: int

    def sql(self) -> str:
        return " AND ".join(c.sql() for c in self.conditions) or "true"


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one ordered conditional: true keeps the text."""
    if not rules:
        return F.lit(True)
    return F.expr("CASE " + " ".join(f"WHEN {r.sql()} THEN false" for r in rules) + " ELSE true END")


def rule_number(rules: list[Rule]) -> Column:
    """The first rule that fires, from 1; null if none does."""
    if not rules:
        return F.lit(None).cast("int")
    return F.expr("CASE " + " ".join(f"WHEN {r.sql()} THEN {i}" for i, r in enumerate(rules, 1)) + " END")


def _information(p: float, n: float) -> float:
    return math.log2(p / (p + n)) if p else -1e9


def learn_rules(labelled: DataFrame, bad: str = "bad", key: str = "doc_id", max_rules: int = 8, max_conditions: int = 3, bins: int = 32, min_precision: float = 0.7, min_covered: int = 5) -> list[Rule]:
    """Sequential covering over labelled(FEATURES, bad boolean): grow a rule on two thirds, prune it on a third, drop what it covers, again.

    labelled is read once a step; give a stored and bounded table. A step counts bad and good rows for
    each (feature, bin), at most len(FEATURES) * (bins + 1) groups whatever the rows.
    """
    levels = labelled.agg(*[F.percentile_approx(f, [i / bins for i in range(1, bins)], 10_000).alias(f) for f in FEATURES]).first()
    cuts = {f: sorted({float(x) for x in (levels[f] or [])}) for f in FEATURES}
    if not any(cuts.values()):
        return []

    def binned(f: str) -> Column:
        return F.size(F.filter(F.array(*[F.lit(c) for c in cuts[f]]) if cuts[f] else F.array().cast("array<double>"), lambda c: F.col(f) > c))

    data = staged(labelled.select(F.col(bad).alias("_bad"), (F.pmod(F.xxhash64(F.lit("part"), F.col(key)), F.lit(3)) != 0).alias("_grow"), F.array(*[binned(f) for f in FEATURES]).alias("_bins")), "labelled-bins")

    def counts(rest: Column):
        found = data.where(rest).select("_bad", "_grow", F.posexplode("_bins").alias("_f", "_b")).groupBy("_f", "_b").agg(*[F.count_if((F.col("_grow") == g) & (F.col("_bad") == b)).alias(f"{'grow' if g else 'prune'}_{'bad' if b else 'good'}") for g in (True, False) for b in (True, False)]).collect()
        table = {}
        for r in found:
            table.setdefault(FEATURES[r["_f"]], {})[r["_b"]] = (r["grow_bad"], r["grow_good"], r["prune_bad"], r["prune_good"])
        return table

    def total(table) -> tuple[int, int, int, int]:
        return tuple(sum(x) for x in zip(*table[FEATURES[0]].values())) if table else (0, 0, 0, 0)

    def holds(conditions) -> Column:
        # _bins counts the cuts below the value: value > cuts[k] just if the bin is over k
        out = F.lit(True)
        for c in conditions:
            b, k = F.get(F.col("_bins"), F.lit(FEATURES.index(c.feature))), cuts[c.feature].index(c.threshold)
            out = out & ((b > k) if c.above else (b <= k))
        return out

    rules: list[Rule] = []
    rest = F.lit(True)
    first = counts(rest)
    while len(rules) < max_rules:
        table, conditions, seen = first, [], []
        p, n, _, _ = total(table)
        if p < min_covered:
            break
        while n and len(conditions) < max_conditions:
            best, choice = 0.0, None
            for f in FEATURES:
                for k, cut in enumerate(cuts[f]):
                    high = [v for b, v in table.get(f, {}).items() if b > k]
                    hp, hn = sum(v[0] for v in high), sum(v[1] for v in high)
                    for above, cp, cn in ((True, hp, hn), (False, p - hp, n - hn)):
                        if cp >= min_covered and (gain := cp * (_information(cp, cn) - _information(p, n))) > best + 1e-9:
                            best, choice = gain, Condition(f, above, cut)
            if choice is None:
                break
            conditions.append(choice)
            table = counts(rest & holds(conditions))
            p, n, pp, pn = total(table)
            seen.append((pp, pn))
        if not conditions:
            break
        worth = [((pp - pn) / (pp + pn) if pp + pn else -1.0) for pp, pn in seen]
        keep = max(range(len(worth)), key=lambda i: (worth[i], -i)) + 1
        pp, pn = seen[keep - 1]
        if pp + pn == 0 or pp / (pp + pn) < min_precision:
            break
        rule = Rule(tuple(conditions[:keep]), pp / (pp + pn), pp + pn)
        rules.append(rule)
        rest = rest & ~holds(rule.conditions)
        first = counts(rest)
    return rules


def labelled_sample(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000) -> DataFrame:
    """Statistics and label of labelled documents; of more than max_labelled about that many, those whose hashed doc_id falls below that share."""
    some = labels.where("quality is not null and doc_id is not null").select("doc_id", (F.col("quality") == 0).alias("bad"))
    if (n := some.count()) > max_labelled:
        some = some.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(max_labelled / n * (1 << 20)))
    some = staged(some, "labelled-ids")
    return staged(text_stats(docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")), "labelled-stats")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def quality_verdicts(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """docs with their statistics, base_failed, kept and the number of the rule that fired."""
    out = text_stats(docs).withColumn("base_failed", base_failed())
    return out.withColumn("rule", rule_number(rules)).withColumn("kept", ~F.col("base_failed") & verdict(rules))
