"""Pieces of DuckDB SQL that mirror the column functions."""

from __future__ import annotations

from ..functions import fixed
from ..functions.text import any_of


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def matches(expr: str, pattern: str) -> str:
    return f"regexp_matches({expr}, {q(pattern)})"


def sub(expr: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({expr}, {q(pattern)}, {q(to)}, 'g')"


def invalid(c: str) -> str:
    t = f"trim({c})"
    return f"(regexp_full_match(lower({t}), {q('|'.join(fixed.NULL_LIKE))}) OR length({t}) NOT BETWEEN 2 AND 200 OR NOT {matches(t, '[a-zA-Z0-9]')})"


def low_quality(c: str) -> str:
    return f"({matches(f'lower({c})', any_of(fixed.LOW_QUALITY_MARKS))} OR length({sub(c, '[^0-9]')}) > 0.7 * length({c}) OR length({sub(c, '[a-zA-Z0-9 ]')}) > 0.5 * length({c}))"


def reason(least: float = 0.9) -> str:
    bad = " OR ".join(invalid(c) for c in ("subject", "predicate", "object"))
    low = " OR ".join(low_quality(c) for c in ("subject", "predicate", "object"))
    return f"""CASE WHEN {bad} THEN 'invalid_values' WHEN lower(trim(subject)) = lower(trim(object)) THEN 'self_reference' WHEN {low} THEN 'low_quality_content'
    WHEN {matches('lower(trim(predicate))', any_of(fixed.MEANINGLESS_RELATIONS))} OR length(trim(predicate)) NOT BETWEEN 2 AND 100 THEN 'meaningless_relation'
    WHEN confidence < {least} THEN 'low_confidence' ELSE 'valid' END"""


def component(c: str) -> str:
    small = ", ".join(q(w) for w in fixed.SMALL_WORDS)
    w = f"list_transform(list_filter(string_split(trim({sub(c, chr(92) + 's+', ' ')}), ' '), lambda w: w <> ''), lambda w: CASE WHEN length(w) > 3 AND lower(w) NOT IN ({small}) THEN upper(w[1:1]) || lower(w[2:]) ELSE lower(w) END)"
    return f"CASE WHEN {matches(c, '[A-Z]{2,}')} THEN trim({c}) ELSE array_to_string({w}, ' ') END"


def words(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, {q(chr(92) + 's+')}), lambda w: w <> '')"


def letters(c: str) -> str:
    return f"length({sub(c, '[^' + chr(92) + 'p{L}]')})"


def clean_web(c: str) -> str:
    t = f"coalesce({c}, '')"
    for p, to in [("&[a-zA-Z0-9#]+;", " "), (r"\s+", " ")]:
        t = sub(t, p, to)
    for phrase in fixed.BOILERPLATE:
        t = sub(t, "(?i)" + any_of([phrase]))
    for p, to in [(r"(?s)\[.*?\]", ""), (r"(?s)\(.*?\)", ""), (r"[.,;:!?]{2,}", "."), (r"\s*[.,;:!?]\s*", ". "), (r"\s+", " ")]:
        t = sub(t, p, to)
    return f"trim({t})"


def meaningful(t: str) -> str:
    ws = words(t)
    return f"(length(trim({t})) >= 10 AND {letters(t)} >= 0.5 * length({t}) AND NOT {matches(f'lower({t})', any_of(fixed.USELESS_MARKS))} AND (len({ws}) = 0 OR len(list_distinct({ws})) >= 0.7 * len({ws})))"


def host(u: str) -> str:
    return f"lower(regexp_extract(coalesce({u}, ''), {q('^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)')}, 1))"


def valid_url(u: str) -> str:
    return f"(NOT {matches(host(u), any_of(fixed.EXCLUDED_DOMAINS))} AND NOT {matches(f'lower({u})', any_of(fixed.EXCLUDED_URL_WORDS))} AND NOT {matches(f'lower({u})', any_of(fixed.EXCLUDED_EXTENSIONS) + '$')})"


def hits(text: str, ws) -> str:
    return "(" + " + ".join(f"CASE WHEN contains({text}, {q(w)}) THEN 1 ELSE 0 END" for w in ws) + ")"


def url_score(u: str, title: str, snippet: str) -> str:
    h, text = host(u), f"lower(concat(coalesce({title}, ''), ' ', coalesce({snippet}, '')))"
    edu = f"({h} LIKE '%.edu' OR {h} LIKE '%.gov')"
    return f"greatest(1.0::double + CASE WHEN {matches(h, any_of(fixed.PREFERRED_DOMAINS))} THEN 2.0::double ELSE 0 END + CASE WHEN {edu} THEN 1.5::double ELSE 0 END + CASE WHEN {matches(h, any_of(fixed.SCIENCE_HOST_WORDS))} THEN 1.0::double ELSE 0 END + {hits(text, fixed.SCIENCE_KEYWORDS)} * 0.2::double - {hits(text, fixed.LOW_QUALITY_LINK_WORDS)} * 0.5::double, 0.1::double)"


def authority(u: str, rules) -> str:
    return "CASE " + " ".join(f"WHEN {matches(f'lower({u})', any_of(marks))} THEN {q(name)}" for name, marks in rules) + " ELSE 'general_web' END"


def weight(a: str) -> str:
    return f"CASE {a} " + " ".join(f"WHEN {q(k)} THEN {v}::double" for k, v in fixed.AUTHORITY_WEIGHTS.items()) + " END"


def content_quality(b: str) -> str:
    n, ws, share = f"length({b})", f"len({words(b)})", f"({letters(b)}::double / nullif(length({b}), 0))"
    return f"""(CASE WHEN {n} BETWEEN 50 AND 1000 THEN 0.3 WHEN {n} > 1000 THEN 0.2 WHEN {n} > 20 THEN 0.1 ELSE 0 END::double + CASE WHEN {ws} >= 10 THEN 0.3 WHEN {ws} >= 5 THEN 0.2 WHEN {ws} >= 2 THEN 0.1 ELSE 0 END::double
    + CASE WHEN {share} >= 0.7 THEN 0.2 WHEN {share} >= 0.5 THEN 0.1 ELSE 0 END::double + CASE WHEN contains({b}, '.') THEN 0.2 WHEN contains({b}, ',') THEN 0.1 ELSE 0 END::double)"""
