import ast

import pytest

from tessera.functions.literals import parse_literal_lists

GOOD = [
    "[{'a': True, 'b': None, 'c': 'x'}]", "[{'a': 'x'},]", '[{"a": "it\'s"}, {\'b\': \'say "hi"\'}]', "[{'a': 'it\\'s'}]", "[{'a': 'tab\\tnew\\nline \\x41 \\u00e9 \\\\ \\d'}]", "({'a': '1'}, {'a': '2'},)",
    "[{'a': '[not, a] {token}: (here),'}]", "[]", "[{}]", "  [ {'a' : 'b' , } , ]  ", "[{'a': 'é 😀'}]", "[{u'a': u'b'}]", "[{'': ''}]", "[{'a': False}, {'b': 'None'}]", "[{'a': \"\"}]",
]
BAD = ["nan", "", "   ", "None", "'x'", "{'a': 'b'}", "[{'a': }]", "[{'a': 'b'}", "[{'a': 'b'}] tail", "[{'a': b}]", "[{'a': 'b}]", "[{'a' 'b'}]", "[{'a': 'line\nbreak'}]", "[{'a': 'b'} {'c': 'd'}]", "[,]x", "[{'a': 'b'}], [{'c': 'd'}]"]


def shown(v):
    return None if v is None else str(v).lower() if isinstance(v, bool) else str(v)


@pytest.fixture(scope="module")
def parsed(spark):
    rows = spark.createDataFrame([(x,) for x in GOOD + BAD + [None]], "t string")
    return {r.t: r.v for r in rows.select("t", parse_literal_lists("t").alias("v")).collect()}


@pytest.mark.parametrize("text", GOOD)
def test_lists_as_python_reads_them(parsed, text):
    assert [dict(m) for m in parsed[text]] == [{k: shown(v) for k, v in d.items()} for d in ast.literal_eval(text.strip())]


@pytest.mark.parametrize("text", BAD + [None])
def test_other_texts_are_empty_lists(parsed, text):
    assert parsed[text] == []


def test_numbers(spark):
    text = "[{'a': 1_000, 'b': +2.5, 'c': .5, 'd': -3., 'e': 1e3, 'f': 007, 'g': [1, (2, None)], 'h': {'i': True}}]"
    got = spark.createDataFrame([(text,)], "t string").select(parse_literal_lists("t")).first()[0][0]
    assert (got["a"], float(got["b"]), float(got["c"]), float(got["d"]), float(got["e"]), got["g"], got["h"]) == ("1000", 2.5, 0.5, -3.0, 1000.0, "[1,[2,null]]", '{"i":true}')
