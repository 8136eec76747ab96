"""Python literals as text, turned into JSON by JVM expressions: a tokenizer, a rule for each token, and Spark's JSON parser."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

_TOKEN = r"""(?s)[uU]?'(?:[^'\\\n]|\\.)*'|[uU]?"(?:[^"\\\n]|\\.)*"|[\[\]{}():,]|[^\s\[\]{}():,'"]+|['"]"""
_PIECE = r"(?s)\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\.|[^\\]+"
_NUMBER = r"^[-+]?(\d[\d_]*\.?[\d_]*|\.\d[\d_]*)([eE][-+]?\d+)?$"
_KEPT = r'\\[\\"nrtbf]'
_NAMED = {"\\'": "'", "\\a": "\\u0007", "\\v": "\\u000b", "\\0": "\\u0000", "\\\n": ""}


def _piece(x: Column) -> Column:
    """A part of a string's inside, an escape or what is between, as JSON has it."""
    plain = F.replace(F.replace(x, F.lit('"'), F.lit('\\"')), F.lit("\t"), F.lit("\\t"))
    out = F.when(~x.startswith("\\"), plain).when(x.rlike(r"^\\x..$"), F.concat(F.lit("\\u00"), F.substring(x, 3, 2))).when(x.rlike(r"^\\u....$") | x.rlike(f"^{_KEPT}$"), x)
    for k, v in _NAMED.items():
        out = out.when(x == k, F.lit(v))
    return out.otherwise(F.concat(F.lit("\\"), F.replace(x, F.lit('"'), F.lit('\\"'))))  # an unknown escape is a backslash and its character


def _token(x: Column) -> Column:
    string = F.regexp_replace(x, r"""^[uU](?=['"])""", "")
    inside = F.substr(string, F.lit(2), F.length(string) - 2)
    quoted = F.concat(F.lit('"'), F.array_join(F.transform(F.regexp_extract_all(inside, F.lit(_PIECE), F.lit(0)), _piece), ""), F.lit('"'))
    number = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.replace(x, F.lit("_"), F.lit("")), r"^\+", ""), r"^(-?)\.", "$10."), r"\.(?=$|[eE])", ".0")
    number = F.regexp_replace(number, r"^(-?)0+(?=\d)", "$1")
    return (
        F.when(x.rlike(r"""^[uU]?['"]."""), quoted).when(x == "True", "true").when(x == "False", "false").when(x == "None", "null").when(x == "(", "[").when(x == ")", "]")
        .when(x.rlike(r"^[\[\]{}:,]$"), x).when(x.rlike(_NUMBER), number).otherwise("?")
    )


def literal_to_json(text) -> Column:
    """JSON of a literal of lists, tuples, dicts with string keys, strings, numbers, True, False and None; null if it is none.

    Either quote, escapes and commas before a closing bracket are read; strings side by side, bytes, sets
    and complex numbers are not. True and False become booleans, None becomes null.
    """
    tokens = F.regexp_extract_all(col(text), F.lit(_TOKEN), F.lit(0))
    closing = F.array(F.lit("]"), F.lit("}"), F.lit(")"))
    needed = F.filter(tokens, lambda x, i: ~((x == ",") & F.coalesce(F.array_contains(closing, F.get(tokens, i + 1)), F.lit(False)) & (i > 0)))
    json = F.array_join(F.transform(needed, _token), "")
    alone = F.try_parse_json(F.concat(F.lit("["), json, F.lit("]")))  # within brackets the parser also reads what follows
    return F.when(alone.isNotNull() & F.try_variant_get(alone, "$[1]", "variant").isNull(), json)


def parse_literal_lists(text) -> Column:
    """The records of a stringified list of them, as array<map<string,string>>; empty for null, malformed or other text."""
    json, none = literal_to_json(text), F.expr("array()").cast("array<map<string,string>>")
    return F.coalesce(F.when(json.startswith("["), F.from_json(json, "array<map<string,string>>")), none)
