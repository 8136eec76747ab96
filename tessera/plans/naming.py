"""Registered queries of canonical names. Their SQL scans terms in order with a recursive query that carries the leaders found so far."""

from __future__ import annotations

from ..operators import canon
from .registry import oracle_sql, query
from .streams import _vectors
from .tables import derive, plain

#: Names of parts, every third size with a hyphen: equal slugs, shared words.
_TERMS = "SELECT CASE WHEN p_size % 3 = 0 THEN replace(p_name, ' ', '-') ELSE p_name END AS term, count(*) AS n FROM {part} GROUP BY 1"
#: Names that a mapping has already.
_KNOWN = "SELECT DISTINCT p_name AS raw, concat('known ', p_name) AS canonical FROM {part} WHERE p_name LIKE 'small%'"


def _greedy(terms: str, threshold: float) -> str:
    """CTEs up to out(raw, canonical) over the terms(term, n) of a query."""
    v = _vectors(oracle_sql()["hash_embed_terms"]).replace("SELECT p_type AS term FROM part UNION SELECT concat(p_type, ' ', p_brand) FROM part", "SELECT term FROM terms")
    slug = lambda c: f"replace(replace(lower({c}), '-', '_'), ' ', '_')"
    return f"""terms AS MATERIALIZED ({terms}), v AS MATERIALIZED ({v}),
    near AS MATERIALIZED (SELECT a.term AS a, b.term AS b, round(sum(a.w * b.w), 9) AS score FROM v a JOIN v b ON a.idx = b.idx WHERE a.term <> b.term GROUP BY 1, 2 HAVING round(sum(a.w * b.w), 9) >= {threshold}),
    ranked AS MATERIALIZED (SELECT term, n, row_number() OVER (ORDER BY n DESC, term) AS i FROM terms),
    options AS MATERIALIZED (SELECT x.i, list({{'b': b, 'i': y.i}} ORDER BY {slug('a')} = {slug('b')} DESC, score DESC, y.n DESC, b DESC) AS o FROM near JOIN ranked x ON x.term = a JOIN ranked y ON y.term = b WHERE y.i < x.i GROUP BY 1),
    scan AS (SELECT 0::bigint AS i, []::bigint[] AS leaders, NULL::varchar AS raw, NULL::varchar AS canonical
      UNION ALL SELECT i, CASE WHEN len(f) = 0 THEN list_append(leaders, i) ELSE leaders END, term, CASE WHEN len(f) = 0 THEN term ELSE f[1].b END
      FROM (SELECT r.i, s.leaders, r.term, list_filter(coalesce(o.o, []), lambda x: list_contains(s.leaders, x.i)) AS f FROM scan s JOIN ranked r ON r.i = s.i + 1 LEFT JOIN options o ON o.i = r.i)),
    out AS (SELECT raw, canonical FROM scan WHERE i > 0)"""


def register() -> None:
    """Needs the embedding query's SQL, which the catalogue registers first."""
    @query(f"WITH RECURSIVE {_greedy(plain(_TERMS), 0.5)} SELECT * FROM out")
    def canonicalize_terms(spark, sf_dir):
        return canon.canonicalize_terms(derive(spark, sf_dir, _TERMS), threshold=0.5)

    fresh = f"SELECT term, n FROM ({plain(_TERMS)}) WHERE term NOT IN (SELECT raw FROM ({plain(_KNOWN)}))"

    @query(f"WITH RECURSIVE {_greedy(fresh, 0.45)} SELECT 'entity' AS term_type, raw, canonical FROM out UNION ALL SELECT 'entity', raw, canonical FROM ({plain(_KNOWN)})")
    def incremental_mapping(spark, sf_dir):
        """Known names stay as they are; new ones are scanned without them and merge among themselves."""
        kind = "SELECT 'entity' AS term_type, * FROM ({})"
        return canon.incremental_mapping(derive(spark, sf_dir, kind.format(_TERMS)), derive(spark, sf_dir, kind.format(_KNOWN)), threshold=0.45)
