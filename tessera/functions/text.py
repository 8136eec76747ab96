"""Text preparation as column expressions. Null text gives an empty result unless said otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def substitute(text: Column, *pairs: tuple[str, str]) -> Column:
    return reduce(lambda t, p: F.regexp_replace(t, *p), pairs, text)


def literal(word: str) -> str:
    """A pattern for just this word."""
    return "".join(c if c.isalnum() or c in " _" or ord(c) > 127 else "\\" + c for c in word)


def any_of(words) -> str:
    return "(?:" + "|".join(map(literal, words)) + ")"


def contains_any(text: Column, words) -> Column:
    return text.rlike(any_of(words))


def letters(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\p{L}]", ""))


def split_words(text: Column) -> Column:
    """Words between white space, as Python's split()."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def collapse(text) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(col(text), F.lit("")), r"\s+", " "))


normalize_text = collapse


def clean_web_text(text) -> Column:
    """Entities, boilerplate openings and bracketed parts go; punctuation is followed by one blank."""
    t = substitute(F.coalesce(col(text), F.lit("")), ("&[a-zA-Z0-9#]+;", " "), (r"\s+", " "))
    phrases = [("(?i)" + any_of(fixed.BOILERPLATE[:1]), ""), *[("(?i)" + literal(p), "") for p in fixed.BOILERPLATE[1:]]]
    # few texts have one of the phrases, and finding that out is cheap beside a pattern for each
    low = F.lower(t)
    t = F.when(reduce(lambda a, b: a | b, [low.contains(p.lower()) for p in fixed.BOILERPLATE]), substitute(t, *phrases)).otherwise(t)
    t = substitute(t, (r"(?s)\[.*?\]", ""), (r"(?s)\(.*?\)", ""), (r"[.,;:!?]{2,}", "."), (r"\s*[.,;:!?]\s*", ". "), (r"\s+", " "))
    return F.trim(t)


def is_meaningful(text) -> Column:
    """At least 10 characters, half of them letters, no useless mark, 70 % of the words different."""
    t = F.coalesce(col(text), F.lit(""))
    ws = split_words(t)
    varied = (F.size(ws) == 0) | (F.size(F.array_distinct(ws)) >= 0.7 * F.size(ws))
    return (F.length(F.trim(t)) >= 10) & (letters(t) >= 0.5 * F.length(t)) & ~contains_any(F.lower(t), fixed.USELESS_MARKS) & varied


def chunk_fixed(text, size: int = 1024, overlap: int = 80) -> Column:
    """Array of chunks at a fixed stride; one chunk if the text fits. Empty ones are left out."""
    t = F.coalesce(col(text), F.lit(""))
    starts = F.sequence(F.lit(0), F.greatest(F.length(t) - 1 - overlap, F.lit(0)), F.lit(size - overlap))
    cut = F.transform(starts, lambda s: F.trim(F.substring(t, s + 1, F.lit(size))))
    return F.filter(F.when(F.length(t) <= size, F.array(F.trim(t))).otherwise(cut), lambda c: c != "")


def slugify(text, longest: int = 100) -> Column:
    """ASCII slug. Accents go by decomposition of the Latin letters that have one."""
    accents = {"à": "a", "á": "a", "â": "a", "ã": "a", "ä": "a", "å": "a", "ç": "c", "è": "e", "é": "e", "ê": "e", "ë": "e", "ì": "i", "í": "i", "î": "i", "ï": "i", "ñ": "n", "ò": "o", "ó": "o", "ô": "o", "õ": "o", "ö": "o", "ù": "u", "ú": "u", "û": "u", "ü": "u", "ý": "y", "ÿ": "y"}
    t = F.translate(F.lower(F.coalesce(col(text), F.lit(""))), "".join(accents), "".join(accents.values()))
    t = F.regexp_replace(t, r"[^\x00-\x7F]", "")
    t = substitute(t, ("[^a-z0-9]+", "_"), ("^_+|_+$", ""))
    t = F.regexp_replace(F.substring(t, 1, longest), "^_+|_+$", "")
    return F.when(t == "", "unnamed_entity").otherwise(t)


def _capital(w: Column) -> Column:
    return F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, F.lit(2), F.length(w))))


def to_camel_case(text) -> Column:
    """Split before capitals and at blanks and underscores; first part lower, others capitalized."""
    t = F.regexp_replace(F.coalesce(col(text), F.lit("")), "([A-Z])", " $1")
    parts = F.filter(F.split(F.lower(t), "[ _]+"), lambda w: w != "")
    return F.when(F.size(parts) == 0, "").otherwise(F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), _capital), "")))


def to_pascal_case(text) -> Column:
    t = F.regexp_replace(F.coalesce(col(text), F.lit("")), "[^a-zA-Z0-9]+", " ")
    out = F.array_join(F.transform(F.filter(F.split(t, " "), lambda w: w != ""), _capital), "")
    return F.when(out == "", "UnnamedEntity").otherwise(out)


def split_camel_case(text) -> Column:
    """A blank at lower-to-upper and letter-digit borders."""
    return F.trim(substitute(col(text), (r"(?<!^)(?<![A-Z\s])([A-Z])", " $1"), (r"(?<=[a-zA-Z])(?=\d)", " "), (r"(?<=\d)(?=[a-zA-Z])", " "), (r"\s+", " ")))


def normalize_label(label) -> Column:
    """Snake case, then the common synonym."""
    t = F.regexp_replace(F.lower(F.trim(F.regexp_replace(col(label), r"[^a-zA-Z0-9\s]", ""))), r"\s+", "_")
    names = F.create_map(*[F.lit(x) for kv in fixed.LABEL_SYNONYMS.items() for x in kv])
    return F.coalesce(F.element_at(names, t), t)


def is_infobox_entry(label, data) -> Column:
    label, data = F.coalesce(col(label), F.lit("")), F.coalesce(col(data), F.lit(""))
    empty = data.rlike("(?i)^(?:" + "|".join(fixed.EMPTY_DATA) + ")$")
    return F.length(label).between(2, 100) & F.length(data).between(1, 1000) & ~empty


def clean_formula_newlines(text) -> Column:
    """Line breaks in formulas go: around operators, powers and brackets, in displaystyle blocks; LaTeX spaces become blanks."""
    return substitute(
        col(text),
        (r"\s*\n\s*(=)\s*\n?\s*", " $1 "), (r"\s*(=)\s*\n\s*", " $1 "),
        (r"\s*\n\s*([+\-*/≥≤])\s*\n?\s*", " $1 "), (r"\s*([+\-*/≥≤])\s*\n\s*", " $1 "),
        (r"\s*\n\s*\^\s*\n?\s*|\s*\^\s*\n\s*", "^"), (r"\(\s*\n\s*", "("), (r"\s*\n\s*\)", ")"),
        (r"([a-zA-Z0-9])\s*\n\s*(?=[a-zA-Z0-9])", "$1"), (r"([a-zA-Z]+)\s*\n\s*\(", "$1("), (r"([πα-ωΑ-Ω])\s*\n\s*", "$1 "),
        (r"\n{3,}", "\n\n"), (r"\s*\\(?:,|;|quad)\s*", " "),
    )


def clean_wiki_markup(text) -> Column:
    """Templates, references, tags and brackets go; links keep their label."""
    t = substitute(F.coalesce(col(text), F.lit("")), (r"\{\{[^}]*\}\}", ""), (r"\[\[[^\]]*\|([^\]]*)\]\]", "$1"), (r"\[\[([^\]]*)\]\]", "$1"), (r"\[[^\]]*\]", ""), (r"(?s)<ref[^>]*>.*?</ref>", ""), (r"<ref[^>]*/?>", ""), ("<[^>]+>", ""))
    return collapse(clean_formula_newlines(t))


def is_excluded_section(title) -> Column:
    return F.lower(F.trim(col(title))).rlike("^(?:" + "|".join(fixed.EXCLUDED_SECTIONS) + ")$")


def is_section_text(text, least: int = 50, most: int = 5000) -> Column:
    """Length within bounds, no mark of a poor article, 60 % letters, two sentences of over 10 characters."""
    t = F.coalesce(col(text), F.lit(""))
    sentences = F.filter(F.split(t, "[.!?]+"), lambda s: F.length(F.trim(s)) > 10)
    return F.length(t).between(least, most) & ~contains_any(F.lower(t), fixed.ARTICLE_MARKS) & (letters(t) >= 0.6 * F.length(t)) & (F.size(sentences) >= 2)


def truncate_source(text, longest: int = 500) -> Column:
    t = col(text)
    return F.when(F.length(t) > longest, F.concat(F.substring(t, 1, longest), F.lit("..."))).otherwise(t)


def preview(text, longest: int = 200) -> Column:
    return F.substring(col(text), 1, longest)


def extract_number(text) -> Column:
    """The first number in text as double; null without one."""
    return F.nullif(F.regexp_extract(col(text), r"[-+]?\d*\.?\d+(?:[eE][-+]?\d+)?", 0), F.lit("")).try_cast("double")


def extract_all_text(html) -> Column:
    """Whole-page text: scripts and styles go, tags become blanks."""
    t = substitute(F.coalesce(col(html), F.lit("")), (r"(?is)<(script|style)\b.*?</\1\s*>", " "), (r"(?s)<!--.*?-->", " "), ("<[^>]+>", " "))
    return collapse(t)


def main_blocks(html) -> Column:
    """A native form of main-content extraction: the texts of p, h1-6 and li in the article, cleaned."""
    body = F.regexp_extract(F.coalesce(col(html), F.lit("")), r"(?is)<(?:main|article)\b[^>]*>(.*?)</(?:main|article)>", 1)
    body = F.regexp_replace(body, r"(?is)<(script|style|nav|header|footer|aside)\b.*?</\1\s*>", " ")
    found = F.regexp_extract_all(body, F.lit(r"(?is)<(?:p|h[1-6]|li)\b[^>]*>(.*?)</(?:p|h[1-6]|li)>"), F.lit(1))
    texts = F.transform(found, lambda x: clean_web_text(F.trim(F.regexp_replace(x, "<[^>]+>", " "))))
    return F.filter(texts, lambda x: F.length(x).between(10, 2000) & is_meaningful(x))
