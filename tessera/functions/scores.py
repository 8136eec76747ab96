"""Predicates and scores as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .text import any_of, col, contains_any, letters, split_words

_lit = F.lit


# --- classes of facts ----------------------------------------------------------------------------
def is_attribute_value(value) -> Column:
    """A unit, state, colour or other value pattern, or any digit. Null and empty: false."""
    v = F.trim(F.coalesce(col(value), _lit("")))
    return v.rlike(r"(?i)^(?:" + "|".join(fixed.ATTRIBUTE_VALUES) + ")$") & (v != "") | v.rlike(r"\d")


def _holds(text: Column, words, strict: bool) -> Column:
    return F.coalesce(F.lower(text).rlike((r"\b" + any_of(words) + r"\b") if strict else any_of(words)), _lit(False))


def is_attribute_predicate(predicate, strict: bool = False) -> Column:
    """Holds an attribute word anywhere; with strict, as a whole word."""
    return _holds(col(predicate), fixed.ATTRIBUTE_WORDS + fixed.ATTRIBUTE_PREDICATES, strict)


def is_entity(value) -> Column:
    v = F.trim(F.coalesce(col(value), _lit("")))
    return (v != "") & (v.rlike(r"^\p{Lu}") | contains_any(F.lower(v), fixed.ENTITY_WORDS))


def is_event_predicate(predicate, strict: bool = False) -> Column:
    return _holds(col(predicate), fixed.EVENT_VERBS + fixed.EVENT_TYPES, strict)


def is_event_type(kind) -> Column:
    return _holds(col(kind), fixed.EVENT_TYPES, False)


def relation_reject_reason(predicate, obj, strict: bool = False) -> Column:
    """Why a relation isn't one; null if it is."""
    p, o = col(predicate), col(obj)
    return (
        F.when(p.isNull() | o.isNull(), "missing")
        .when(is_attribute_predicate(p, strict), "attribute_predicate")
        .when(is_attribute_value(o), "attribute_value")
        .when(is_event_predicate(p, strict), "event_predicate")
        .when(~is_entity(o), "not_entity")
    )


# --- triples -------------------------------------------------------------------------------------
def is_invalid_value(value) -> Column:
    """Null, null-like, outside 2..200 characters, or without a letter, digit or CJK character."""
    v = F.trim(F.coalesce(col(value), _lit("")))
    return v.rlike("(?i)^(?:" + "|".join(fixed.NULL_LIKE) + ")$") | ~F.length(v).between(2, 200) | ~v.rlike(r"[a-zA-Z0-9\x{4e00}-\x{9fff}]")


def is_low_quality(text) -> Column:
    t = F.coalesce(col(text), _lit(""))
    digits, special = F.length(F.regexp_replace(t, r"[^\p{Nd}]", "")), F.length(F.regexp_replace(t, r"[\p{L}\p{N}\s]", ""))
    return (t == "") | contains_any(F.lower(t), fixed.LOW_QUALITY_MARKS) | (digits > 0.7 * F.length(t)) | (special > 0.5 * F.length(t))


def is_meaningless_relation(predicate) -> Column:
    """Contains a meaningless relation anywhere ("has_moon" does), or is outside 2..100 characters."""
    p = F.lower(F.trim(F.coalesce(col(predicate), _lit(""))))
    return contains_any(p, fixed.MEANINGLESS_RELATIONS) | ~F.length(p).between(2, 100)


def coerce_confidence(value, default: float = 0.5) -> Column:
    return F.coalesce(col(value).try_cast("double"), _lit(default))


def validity_reason(subject="subject", predicate="predicate", obj="object", confidence="confidence", least: float = 0.9) -> Column:
    """The first rule that fails, or valid."""
    s, p, o = col(subject), col(predicate), col(obj)
    return (
        F.when(s.isNull() | p.isNull() | o.isNull(), "missing_required_fields")
        .when(is_invalid_value(s) | is_invalid_value(p) | is_invalid_value(o), "invalid_values")
        .when(F.lower(F.trim(s)) == F.lower(F.trim(o)), "self_reference")
        .when(is_low_quality(s) | is_low_quality(p) | is_low_quality(o), "low_quality_content")
        .when(is_meaningless_relation(p), "meaningless_relation")
        .when(F.coalesce(col(confidence).try_cast("double"), _lit(1.0)) < least, "low_confidence")
        .otherwise("valid")
    )


def normalize_component(text) -> Column:
    """Collapsed, unquoted, without long or disambiguating parentheses; capitalized words unless an acronym occurs."""
    t = F.regexp_replace(F.trim(F.coalesce(col(text), _lit(""))), r"\s+", " ")
    t = F.regexp_replace(t, "^[\"'](.+)[\"']$", "$1")
    t = F.regexp_replace(t, r"\((?:[^)]{51,}|[^)]*(?i:disambiguation)[^)]*)\)", "")

    def word(w: Column) -> Column:
        long = (F.length(w) > 3) & ~F.lower(w).isin(fixed.SMALL_WORDS)
        return F.when(long, F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, _lit(2), F.length(w))))).otherwise(F.lower(w))

    return F.trim(F.when(t.rlike("[A-Z]{2,}"), t).otherwise(F.array_join(F.transform(split_words(t), word), " ")))


# --- links ---------------------------------------------------------------------------------------
def host(url) -> Column:
    """Lower-case host of an http address, empty without one."""
    return F.lower(F.regexp_extract(F.coalesce(col(url), _lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def is_valid_url(url) -> Column:
    u = F.lower(F.coalesce(col(url), _lit("")))
    return ~contains_any(host(url), fixed.EXCLUDED_DOMAINS) & ~contains_any(u, fixed.EXCLUDED_URL_WORDS) & ~u.rlike(any_of(fixed.EXCLUDED_EXTENSIONS) + "$")


def is_preferred_host(url) -> Column:
    h = host(url)
    return contains_any(h, fixed.PREFERRED_DOMAINS) | h.endswith(".edu") | h.endswith(".gov")


def _hits(content: Column, words) -> Column:
    return F.aggregate(F.array(*[_lit(w) for w in words]), _lit(0), lambda n, w: n + F.when(F.contains(content, w), 1).otherwise(0))


def url_score(url, title=None, snippet=None) -> Column:
    """Base 1; host and keyword bonuses, a charge for poor words, not under 0.1."""
    h = host(url)
    text = F.lower(F.concat_ws(" ", F.coalesce(col(title), _lit("")) if title is not None else _lit(""), F.coalesce(col(snippet), _lit("")) if snippet is not None else _lit("")))
    score = (
        _lit(1.0)
        + F.when(contains_any(h, fixed.PREFERRED_DOMAINS), 2.0).otherwise(0.0)
        + F.when(h.endswith(".edu") | h.endswith(".gov"), 1.5).otherwise(0.0)
        + F.when(contains_any(h, fixed.SCIENCE_HOST_WORDS), 1.0).otherwise(0.0)
        + _hits(text, fixed.SCIENCE_KEYWORDS) * 0.2
        - _hits(text, fixed.LOW_QUALITY_LINK_WORDS) * 0.5
    )
    return F.when(col(url).isNull(), 0.5).otherwise(F.greatest(score, _lit(0.1)))


# --- sources -------------------------------------------------------------------------------------
def source_authority(url, source_type=None, rules: str = "A") -> Column:
    """simbad, academic_paper, wikipedia, web_news or general_web. Rules B also knows source_type."""
    u, out = F.lower(F.coalesce(col(url), _lit(""))), None
    for name, marks in fixed.AUTHORITY_A if rules == "A" else fixed.AUTHORITY_B:
        hit = contains_any(u, marks)
        if rules == "B" and name == "web_news" and source_type is not None:
            hit = hit | F.coalesce(F.lower(col(source_type)) == "news", _lit(False))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("general_web")


def authority_weight(authority, weights: dict[str, float] | None = None) -> Column:
    weights = weights or fixed.AUTHORITY_WEIGHTS
    table = F.create_map(*[_lit(x) for kv in weights.items() for x in kv])
    return F.coalesce(F.element_at(table, col(authority)), _lit(weights["general_web"]))


def confidence_score_a(authority, ts, confidence, w1: float = 0.7, w2: float = 0.3) -> Column:
    """A confidence of 0 or null counts as 1."""
    conf = F.coalesce(F.nullif(col(confidence).cast("double"), _lit(0.0)), _lit(1.0))
    return 0.7 * (w1 * col(authority) + w2 * F.least(F.greatest(col(ts) / fixed.TIME_UNIT, _lit(0.0)), _lit(1.0))) + 0.3 * conf


def confidence_score_b(authority, ts, now: float, w1: float = 0.7, w2: float = 0.3) -> Column:
    return w1 * col(authority) + w2 * F.least(F.greatest(F.coalesce(col(ts).try_cast("double"), _lit(float(now))) / float(now), _lit(0.0)), _lit(1.0))


# --- quality scores ------------------------------------------------------------------------------
def content_quality(block) -> Column:
    """Of a text block: length, words, letters and structure, up to 1. Take the mean over a page."""
    b = F.coalesce(col(block), _lit(""))
    n, ws, share = F.length(b), F.size(split_words(b)), letters(b) / F.nullif(F.length(b), _lit(0))
    return (
        F.when(n.between(50, 1000), 0.3).when(n > 1000, 0.2).when(n > 20, 0.1).otherwise(0.0)
        + F.when(ws >= 10, 0.3).when(ws >= 5, 0.2).when(ws >= 2, 0.1).otherwise(0.0)
        + F.when(share >= 0.7, 0.2).when(share >= 0.5, 0.1).otherwise(0.0)
        + F.when(F.contains(b, _lit(".")), 0.2).when(F.contains(b, _lit(",")), 0.1).otherwise(0.0)
    )


def search_quality(url, title, snippet, relevance=None) -> Column:
    u, t, s = (F.coalesce(col(c), _lit("")) for c in (url, title, snippet))
    rel = F.coalesce(col(relevance), _lit(0.5)) if relevance is not None else _lit(0.5)
    return (
        F.when(u.rlike(r"\.edu|\.gov|\.org"), 0.3).when(F.contains(u, _lit("wikipedia")), 0.25).when(u.rlike(r"\.com|\.net"), 0.15).otherwise(0.0)
        + F.when(F.length(t).between(20, 100), 0.3).when(F.length(t) >= 10, 0.2).otherwise(0.0)
        + F.when(F.length(s) >= 50, 0.2).when(F.length(s) >= 20, 0.1).otherwise(0.0)
        + rel * 0.2
    )


def is_blocked_text(text) -> Column:
    """Challenge pages and cookie banners of the older search form."""
    t = F.lower(F.coalesce(col(text), _lit("")))
    return contains_any(t, fixed.BLOCKED_TEXT_MARKS)
