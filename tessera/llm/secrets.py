"""Secret scans: candidate strings judged by a random forest, in DataFrame functions throughout.

Candidates are runs of 16 or more of ``[A-Za-z0-9+/_-]`` (and ``=`` at the end), and of 8 to 15 where a naming
word and an assignment stand before, unless it is a plain word after ``:`` (no quote, digit or inner capital).
Their features are length, character transitions, dictionary coverage, path signs and the neighbouring words.
Spark's random forest is fitted to labelled findings and then written out as arrays of constants that a fold walks, so
a scan is a projection: no text is shuffled or leaves the JVM.

Where a corpus has no labelled findings, ``generated_findings`` makes labelled texts: secrets of many forms as
they are written (assigned, in headers, exported, as issued keys), and strings that look like them but are none
(digests, commit and object ids, UUIDs, paths, images in base64, names, numbers, also behind ``=`` and ``:``).
What was put in is known, so labels don't come from the features. The words around are the corpus's own.

Defined cases: null and empty texts have no candidates; a candidate that repeats is judged at each
place; repeated rows are scanned each; without findings of both classes the rule for labels decides; of
other columns the caller's stay, clashing names are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Staging, staged, words

CANDIDATE = r"[A-Za-z0-9+/_-]{8,}={0,2}"
LONG = 16
KEYWORDS = r"(?i)token|secret|passw|credential|api.?key|access.?key|private.?key|bearer|auth(?!ors?\b)"
#: At the end of what stands before a candidate.
ASSIGNED = r"(?:[=:]|\b(?:[Bb]earer|BEARER|[Bb]asic|BASIC)\s)\s*[\"'`(\[]*$"
#: Openings of keys whose issuers publish them.
ISSUED = r"^(?:(?:AKIA|ASIA)[A-Z0-9]{16}$|gh[opsur]_|github_pat_|glpat-|sk[-_]|xox[abops]-|AIza|eyJ)"
FEATURES = ("length", "digit_share", "upper_share", "turns", "distinct_share", "hex", "dictionary", "path_share", "keyword", "assigned", "equals", "issued", "quoted", "prose")
MASK = "<secret>"


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _count(s: Column, others: str) -> Column:
    return F.length(F.regexp_replace(s, others, ""))


def _before(w: Column, at: Column, s: Column) -> Column:
    """Three words and the opening of its own before candidate s in word number at of the words w."""
    return F.concat_ws(" ", F.get(w, at - 3), F.get(w, at - 2), F.get(w, at - 1), F.split_part(F.get(w, at), s, F.lit(1)))


def _is_candidate(w: Column, at: Column, s: Column) -> Column:
    before = _before(w, at, s)
    shape = s.rlike("[0-9]|[a-z][A-Z]") | F.get(w, at).rlike("[\"'`]") | before.rlike(r"=\s*$")
    return (F.length(s) >= LONG) | shape & before.rlike(ASSIGNED) & before.rlike(KEYWORDS)


def _features(w: Column, at: Column, s: Column, dictionary: list[str]) -> dict[str, Column]:
    """Of candidate s in word number at of the words w."""
    n = F.length(s)
    own = F.get(w, at)
    before = _before(w, at, s)
    turn = r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[a-z])(?=[A-Z])"
    near = F.concat_ws(" ", F.get(w, at - 1), F.get(w, at + 1))
    known = _ratio(n - F.length(F.regexp_replace(F.lower(s), "|".join(dictionary), "")), n) if dictionary else F.lit(0.0)
    return {
        "length": n.cast("double"),
        "digit_share": _ratio(_count(s, "[^0-9]+"), n),
        "upper_share": _ratio(_count(s, "[^A-Z]+"), n),
        "turns": _ratio(F.length(F.regexp_replace(s, turn, " ")) - n, n),
        "distinct_share": _ratio(F.size(F.array_distinct(F.split(s, ""))), n),
        "hex": s.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double"),
        "dictionary": known,
        "path_share": _ratio(_count(s, "[^/_-]+"), n),
        "keyword": before.rlike(KEYWORDS).cast("double"),
        "assigned": before.rlike(ASSIGNED).cast("double"),
        "equals": before.rlike(r"=\s*[\"'`]?$").cast("double"),
        "issued": s.rlike(ISSUED).cast("double"),
        "quoted": own.rlike("[\"'`]").cast("double"),
        "prose": _ratio(_count(near, r"[^\p{Ll}]+"), F.length(near)),
    }


def candidates(docs: DataFrame, dictionary: list[str], text: str = "text") -> DataFrame:
    """docs with found: array of (at, string, FEATURES), in order of place."""
    w = F.col("_w")
    df = docs.drop("found").withColumn("_w", words(F.col(text)))
    shape = lambda i: F.get(w, i).rlike("[=:\"'`0-9]|[a-z][A-Z]") | F.get(w, i - 1).rlike("=$")
    long = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: (F.length(F.get(w, i)) >= LONG) | (F.length(F.get(w, i)) >= 8) & shape(i))
    df = df.withColumn("_at", F.when(F.size(w) > 0, long).otherwise(F.array().cast("array<int>")))
    strings = F.flatten(F.transform("_at", lambda i: F.transform(F.regexp_extract_all(F.get(w, i), F.lit(CANDIDATE), F.lit(0)), lambda s: F.struct(i.alias("at"), s.alias("string")))))
    df = df.withColumn("_s", F.filter(strings, lambda c: _is_candidate(w, c.at, c.string)))
    found = F.transform("_s", lambda c: F.struct(c.at.alias("at"), c.string.alias("string"), *[v.alias(k) for k, v in _features(w, c.at, c.string, dictionary).items()]))
    return df.withColumn("found", found).drop("_w", "_at", "_s")


def _flat(found: DataFrame, label: Column) -> DataFrame:
    """found exploded, with label of candidate c."""
    # the outer form, as Spark puts a filter made from array expressions below the other one
    flat = found.select("*", F.explode_outer("found").alias("c")).where("c.string is not null")
    return flat.select("c.*", label.cast("double").alias("label"))


def generated_texts(spark, dictionary: list[str], n: int = 12_000) -> DataFrame:
    """(id, text, secret) of n made-up texts; secret is null where there is none."""
    common = [x for x in dictionary if not re.search(KEYWORDS, x)]
    given_words = common if len(common) > 5 else ["alpha", "common", "letter", "window", "garden", "number"]
    ws = F.split(F.lit(" ".join(given_words)), " ")  # one constant; an array of literals at each use makes plans of gigabytes
    digest = lambda salt: F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    number = lambda salt: F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(1 << 30))
    word = lambda salt: F.get(ws, F.pmod(number(salt), F.lit(len(given_words))).cast("int"))
    hexes = digest("h")
    mixed = F.replace(F.replace(F.replace(F.base64(F.unhex(digest("m"))), F.lit("+")), F.lit("/")), F.lit("="))
    b64 = F.base64(F.unhex(digest("b")))
    camel = F.concat(*[F.initcap(word(f"c{k}")) for k in range(4)])
    quote = F.get(F.array(F.lit('"'), F.lit("'"), F.lit("")), F.pmod(number("q"), F.lit(3)).cast("int"))
    name = F.get(F.array(*[F.lit(x) for x in ("token", "api_key", "secret", "password", "access_key", "auth_token", "client_secret", "db_password", "private_key")]), F.pmod(number("n"), F.lit(9)).cast("int"))
    sign = F.get(F.array(*[F.lit(x) for x in (" = ", ": ", "=", ":")]), F.pmod(number("s"), F.lit(4)).cast("int"))
    plain = F.get(F.array(*[F.lit(x) for x in ("commit", "checksum", "sha256", "etag", "id", "revision", "digest", "object")]), F.pmod(number("p"), F.lit(8)).cast("int"))
    uuid = F.concat_ws("-", F.substring(hexes, 1, 8), F.substring(hexes, 9, 4), F.substring(hexes, 13, 4), F.substring(hexes, 17, 4), F.substring(hexes, 21, 12))
    path = F.concat_ws("/", *[word(f"d{k}") for k in range(4)], F.concat(F.lit("file_"), F.substring(hexes, 1, 3)))
    digits = F.concat(F.lit("9807"), F.lpad((number("d1") % 1_000_000).cast("string"), 6, "0"), F.lpad((number("d2") % 1_000_000).cast("string"), 6, "0"))
    null = F.lit(None).cast("string")
    lower, title = F.concat(word("l1"), word("l2"), word("l3")), F.concat(F.initcap(word("t1")), F.lit("-"), F.initcap(word("t2")), F.initcap(word("t3")))
    twice = F.concat(F.rpad(F.substring(word("r"), 1, 6), 4, "e"), F.rpad(F.substring(word("r"), 1, 6), 4, "e"))
    size = F.get(F.array(*[F.lit(x) for x in (32, 40, 48, 64)]), F.pmod(number("z"), F.lit(4)).cast("int"))

    def given(value: Column) -> tuple[Column, Column]:
        return F.concat(name, sign, quote, value, quote), value

    short = F.concat(F.substring(camel, 1, 6), F.substring(hexes, 1, 5))
    forms = [
        given(F.substring(hexes, F.lit(1), size)), given(mixed), given(b64), given(F.concat(camel, F.upper(F.substring(hexes, 1, 1)))), (F.concat(name, F.lit("="), lower), lower), (F.concat(name, F.lit("="), F.substring(lower, 1, 12)), F.substring(lower, 1, 12)), (F.concat(name, F.lit("="), twice), twice), (F.concat(name, F.lit(': "'), short, F.lit('"')), short),
        (F.concat(F.lit("Authorization: Bearer "), F.substring(hexes, F.lit(1), size)), F.substring(hexes, F.lit(1), size)), (F.concat(F.lit("Authorization: Basic "), b64), b64),
        *[(F.concat(word("i"), F.lit(" "), v), v) for v in (F.concat(F.lit("AKIA"), F.upper(F.substring(hexes, 1, 16))), F.concat(F.lit("ghp_"), F.substring(mixed, 1, 36)), F.concat(F.lit("sk-"), mixed), F.concat(F.lit("eyJ"), mixed))],
        (F.concat(F.lit("export "), F.upper(name), F.lit("="), mixed), mixed), (F.concat(name, F.lit(' = "'), hexes, F.lit('"')), hexes),
        *[(x, null) for x in (
            F.concat(plain, sign, quote, F.substring(hexes, F.lit(1), size), quote), F.concat(F.lit("commit "), F.substring(hexes, 1, 40)), F.concat(plain, sign, quote, uuid, quote), F.concat(F.lit("see "), path), F.concat(word("w"), sign, path),
            F.concat(F.lit('src="data:image/png;base64,'), b64, b64, F.lit('"')), F.concat(F.lit("https://"), word("u"), F.lit(".org/"), path, F.lit("/"), F.substring(hexes, 1, 16)), F.concat(F.lit("class "), camel), F.concat(F.lit("card number "), digits), F.concat(word("v"), sign, digits),
            F.concat(F.lit("author: "), title), F.concat(name, F.lit(": "), word("x"), F.lit(" "), lower), F.concat(F.lit("the "), lower, F.lit(" of "), title), F.concat(F.lit("token_count_"), lower, F.lit(" is high")),
        )],
    ]
    kind = F.pmod(F.col("id"), F.lit(len(forms))).cast("int")
    made = reduce(lambda a, k: a.when(kind == k, F.struct(forms[k][0].alias("t"), forms[k][1].alias("secret"))), range(len(forms)), F)
    rows = spark.range(n).withColumn("m", made)
    # words before and after, or on one side, or none
    around = [F.when(F.pmod(number(f"side {side}"), F.lit(2)) > 0, F.concat_ws(" ", *[word(f"{side}{k}") for k in range(4)])) for side in "ab"]
    return rows.select("id", F.concat_ws(" ", around[0], "m.t", around[1]).alias("text"), "m.secret")


def generated_findings(spark, dictionary: list[str], n: int = 12_000, stage: Staging | None = None) -> DataFrame:
    """Candidates of generated_texts with id and label: whether they are (part of) what was put in. With stage the texts are stored first."""
    texts = generated_texts(spark, dictionary, n)
    found = candidates(stage(texts, "generated-texts") if stage else texts, dictionary)
    return _flat(found, F.coalesce(F.contains("secret", F.col("c.string")), F.lit(False)))


def _sure(c) -> Column:
    """The rule that decides where no forest can be fitted: assigned by a naming word, or opening as issued keys do."""
    return (c["keyword"] > 0) & (c["assigned"] > 0) | (c["issued"] > 0)


@dataclass(frozen=True)
class Forest:
    """Trees as nested (feature, threshold, low, high) or a vote; without trees, the rule for labels."""

    trees: tuple
    dictionary: tuple[str, ...] = ()

    def score(self, c) -> Column:
        """Share of trees that call candidate c a secret."""

        if not self.trees:
            return F.when(_sure(c), 1.0).otherwise(0.0)
        roots, feature, cut, low, high, depth = self.table()
        # arrays of constants: one expression whatever the forest holds, where conditions written out make plans that fill a driver
        column = lambda values, kind: F.lit(np.array(values, dtype=kind))
        feature, cut, low, high = column(feature, "int32"), column(cut, "float64"), column(low, "int32"), column(high, "int32")
        values = F.array(*[c[f] for f in FEATURES])
        step = lambda node, _: F.when(F.get(values, F.get(feature, node)) <= F.get(cut, node), F.get(low, node)).otherwise(F.get(high, node))
        votes = lambda sum_, root: sum_ + F.get(cut, F.aggregate(F.sequence(F.lit(1), F.lit(depth)), root, step)) if depth else sum_ + F.get(cut, root)
        return F.aggregate(column(roots, "int32"), F.lit(0.0), votes) / len(self.trees)

    def table(self) -> tuple[list[int], list[int], list[float], list[int], list[int], int]:
        """Places of the roots; of each node its feature, threshold and where it leads; the greatest depth. A leaf has its vote for a threshold and leads to itself."""
        feature, cut, low, high = [], [], [], []

        def put(node) -> tuple[int, int]:
            at = len(cut)
            for column, v in ((feature, 0), (cut, 0.0), (low, at), (high, at)):
                column.append(v)
            if not isinstance(node, tuple):
                cut[at] = float(node)
                return at, 0
            feature[at], cut[at] = FEATURES.index(node[0]), float(node[1])
            (low[at], below), (high[at], above) = put(node[2]), put(node[3])
            return at, 1 + max(below, above)

        placed = [put(t) for t in self.trees]
        return [at for at, _ in placed], feature, cut, low, high, max((d for _, d in placed), default=0)


def _parse(text: str):
    """A tree from Spark's description of it."""
    lines = [x.strip() for x in text.splitlines() if re.match(r"\s*(If|Else|Predict)", x)]

    def node(i: int):
        if lines[i].startswith("Predict"):
            return float(lines[i].split(":")[1]), i + 1
        f, cut = re.match(r"If \(feature (\d+) <= ([^)]+)\)", lines[i]).groups()
        low, i = node(i + 1)
        high, i = node(i + 1)  # past the Else
        return (FEATURES[int(f)], float(cut), low, high), i

    return node(0)[0]


def fit_forest(labelled: DataFrame, dictionary: list[str] = (), max_findings: int = 20_000, trees: int = 9, depth: int = 7, seed: int = 7) -> Forest:
    """From labelled(FEATURES, label 0.0 or 1.0); of more than max_findings, those whose hash falls below that share are used."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    some = staged(labelled.where("label is not null").select(*FEATURES, "label"), "findings")
    if (n := some.count()) > max_findings:
        some = some.where(F.pmod(F.xxhash64(*FEATURES, "label"), F.lit(1 << 20)) < F.lit(max_findings / n * (1 << 20)))
    if {r["label"] for r in some.select("label").distinct().limit(3).collect()} != {0.0, 1.0}:
        return Forest((), tuple(dictionary))
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(some)
    model = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.8).fit(rows)
    return Forest(tuple(_parse(t.toDebugString) for t in model.trees), tuple(dictionary))


def frequent_words(docs: DataFrame, size: int = 300) -> list[str]:
    """The classifier's dictionary: the words of 4 to 12 lower-case letters that are in most texts, counted over all."""
    rows = docs.where("text is not null").select(F.explode(F.array_distinct(words(F.lower("text"), "[a-z]{4,12}"))).alias("w"))
    return sorted(r["w"] for r in rows.groupBy("w").count().orderBy(F.desc("count"), "w").limit(size).collect())


def train(docs: DataFrame) -> Forest:
    """A forest for docs(doc_id, text) without labelled findings: from generated ones, in the corpus's words."""
    if docs.isEmpty():
        return Forest(())
    dictionary = frequent_words(docs)
    with Staging(docs.sparkSession) as stage:  # the texts on their own, as plans of both at once are several times as large
        return fit_forest(generated_findings(docs.sparkSession, dictionary, stage=stage), dictionary)


def scan(docs: DataFrame, forest: Forest, least: float = 0.5, text: str = "text") -> DataFrame:
    """docs with found (candidates and score) and secrets (strings judged secret, in order of place)."""
    df = candidates(docs.drop("secrets"), list(forest.dictionary), text)
    df = df.withColumn("found", F.transform("found", lambda c: F.struct(c.at.alias("at"), c.string.alias("string"), forest.score(c).alias("score"))))
    return df.withColumn("secrets", F.transform(F.filter("found", lambda c: c.score > least), lambda c: c.string))


def redact(docs: DataFrame, forest: Forest, least: float = 0.5, text: str = "text") -> DataFrame:
    """docs with each secret in text replaced by MASK."""
    df = scan(docs, forest, least, text)
    # longer strings first, as one may be part of another
    order = F.transform(F.sort_array(F.transform(F.array_distinct("secrets"), lambda s: F.struct(F.length(s).alias("n"), s.alias("s"))), asc=False), lambda x: x.s)
    return df.withColumn(text, F.aggregate(order, F.col(text), lambda t, s: F.replace(t, s, F.lit(MASK)))).select(*docs.columns)
