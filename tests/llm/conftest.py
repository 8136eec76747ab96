import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words long, key long, spans string, found string, kept string, tokens string, rank int, place long"
_rng = random.Random(5)
_VOCAB = ["alpha", "beta", "Gamma", "delta", "épée", "Über", "eta", "theta", "iota", "kappa", "lambda", "mu", "nu", "xi", "omicron", "pi"]


def words(n, rng=_rng):
    return " ".join(rng.choice(_VOCAB) + rng.choice(["", "", "", ",", ".", "!"]) for _ in range(n))


def row(i, text, lang="en"):
    return (i, text, lang, "s", None, 1, 2, "x", "y", "z", "w", 3, 4)


_A, _B, _PASSAGE = words(120), words(90), words(40)
ROWS = [
    row(0, _A), row(1, _A), row(2, _A.replace("alpha", "omega", 1)), row(3, _B), row(4, None), row(5, ""), row(6, " \t\n "), row(7, "one"), row(8, "two words"),
    row(9, "A b C"), row(10, "É é É Ü ß ı İ K"), row(11, words(30) + "\n" + _PASSAGE + "\n" + words(20)), row(12, _PASSAGE), row(13, words(2500)),
    row(14, "same line\nsame line\n\nsame line\nother"), row(15, "x " * 400), row(16, _B + " tail"), row(17, words(60) + " " + _PASSAGE + " " + words(60)), row(18, "日本語 テキスト 日本語 テキスト です 漢字"), row(19, "   \x00 <|endoftext|> 'twas naïve’s é ﬁ … ½ 3.14"),
    row(20, _A), row(20, _A), row(21, _A, None), row(22, "z" * 5000),
]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
