"""DuckDB SQL for the corpus queries that SQL can express."""

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP1 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOW}, '{_ITEM}') AS w FROM documents),
b AS (SELECT CAST(item_id AS varchar) AS item, regexp_extract_all({_LOW}, '{_ITEM}') AS w FROM benchmark),
win AS (SELECT item, w[s:s + 9] AS win FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS n FROM win),
places AS (SELECT doc_id, n, p, w[p:p + n - 1] AS win FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes)),
hits AS (SELECT doc_id, p, n, item FROM places JOIN win USING (win)),
cov AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY 1),
its AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS s FROM hits GROUP BY 1)
SELECT doc_id, CAST(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP7 = """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, role IS NULL AS nr, text IS NULL AS nt,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i FROM conversations),
c AS (SELECT conv_id, count(*) AS n, list({'r': role, 't': text, 'nr': nr, 'nt': nt} ORDER BY i) AS l FROM t GROUP BY conv_id),
kept AS (SELECT conv_id, n FROM c a WHERE NOT EXISTS (
    SELECT 1 FROM c b WHERE b.l[1] = a.l[1] AND ((b.n > a.n AND b.l[1:a.n] = a.l) OR (b.l = a.l AND b.conv_id < a.conv_id)))),
s AS (SELECT t.conv_id, CAST(i - 1 AS int) AS turn_index, n AS n_turns, concat('<|', role, '|>', chr(10), trim(text, ' '), '<|end|>', chr(10)) AS segment
      FROM t JOIN kept ON t.conv_id IS NOT DISTINCT FROM kept.conv_id)
SELECT conv_id, turn_index, n_turns, CAST(sum(length(segment)) OVER (PARTITION BY conv_id ORDER BY turn_index) - length(segment) AS bigint) AS start, segment FROM s
"""


def crc32(text: str) -> str:
    """The CRC of ASCII text, a bit at a time."""
    bits = "list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::ubigint[], lambda x, y: xor(x >> 1, 3988292384::ubigint * (x & 1)), xor(c, b))"
    return f"xor(list_reduce(list_transform(string_split({text}, ''), lambda ch: ascii(ch)::ubigint), lambda c, b: {bits}, 4294967295::ubigint), 4294967295::ubigint)"


def _merkle(level: str, rows: str) -> str:
    """Recursive table level(g, k, n, l) over rows(g, l): the list of digests of each level of a group."""
    up = "list_transform(range(0, (n + 7) // 8), lambda r: sha256(array_to_string(l[r * 8 + 1:r * 8 + 8], '')))"
    return f"{level} AS (SELECT g, 0 AS k, len(l) AS n, l FROM {rows} UNION ALL SELECT g, k + 1, (n + 7) // 8, {up} FROM {level} WHERE n > 1)"


def _steps(level: str, nodes: str) -> str:
    """(g, i, k, lo, hi): the siblings before and after the node above leaf i of nodes(g, i)."""
    at = "(i >> (3 * k))"
    return f"SELECT g, i, k, array_to_string(l[({at} // 8) * 8 + 1:{at}], '') AS lo, array_to_string(l[{at} + 2:({at} // 8) * 8 + 8], '') AS hi FROM {nodes} JOIN {level} USING (g) WHERE n > 1"


_FIELDS = ("doc_id", "source", "lang", "n_chars", "{text}")
_LEAF = "sha256(concat(" + ", ".join(f"coalesce(strlen(CAST({c} AS varchar)) || ':' || CAST({c} AS varchar), '-')" for c in _FIELDS) + "))"
OP13 = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('=' || lang, '-') AS g, {_LEAF.format(text="text")} AS leaf,
    CASE WHEN {crc32("CAST(doc_id AS varchar)")} % 3 = 0 THEN {_LEAF.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS bad FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
ls AS (SELECT g, list(leaf ORDER BY i) AS l FROM o GROUP BY g),
{_merkle("lv", "ls")},
sub AS (SELECT g AS lang, l[1] AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS i FROM lv WHERE n = 1),
tops AS (SELECT 0 AS g, list(subroot ORDER BY i) AS l FROM sub),
{_merkle("tv", "tops")},
root AS (SELECT l[1] AS root FROM tv WHERE n = 1),
path AS (SELECT doc_id, leaf, coalesce(bad, leaf) AS begin, subroot, root,
    coalesce((SELECT list({{'lo': lo, 'hi': hi}} ORDER BY k) FROM ({_steps("lv", "o")}) s WHERE s.g = o.g AND s.i = o.i), [])
    || coalesce((SELECT list({{'lo': lo, 'hi': hi}} ORDER BY k) FROM ({_steps("tv", "(SELECT 0 AS g, i FROM sub)")}) s WHERE s.i = sub.i), []) AS p
    FROM o JOIN sub ON o.g = sub.lang CROSS JOIN root),
f AS (SELECT doc_id, leaf, subroot, root, p, 0 AS k, begin AS h FROM path UNION ALL SELECT doc_id, leaf, subroot, root, p, k + 1, sha256(concat(p[k + 1].lo, h, p[k + 1].hi)) FROM f WHERE k < len(p))
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(p, lambda x: concat(x.lo, x.hi)), '')) AS proof_sha256, h AS folded_root, h = root AS verified FROM f WHERE k = len(p)
"""

OP11 = f"""
WITH t AS (SELECT conv_id, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS t, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
    FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(t ORDER BY i) AS l, CAST({crc32("CAST(conv_id AS varchar)")} % 6 AS bigint) AS h FROM t GROUP BY conv_id),
r AS (SELECT c.conv_id, coalesce(b.l[1:c.h], []) || c.l[c.h + 1:] AS l FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 100),
p AS (SELECT conv_id, l, unnest(range(0, len(l) + 1)) AS depth FROM r),
m AS (SELECT conv_id, depth, len(l) = depth AS ends, l[1:depth] AS k, l[1:depth - 1] AS up FROM p),
n AS (SELECT k, depth, first(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CAST(conv_id AS varchar), ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ends FROM m GROUP BY k, depth),
kids AS (SELECT up AS k, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY up),
v AS (SELECT n.k, n.depth, (coalesce(n_children, 0) = 0)::bigint AS leaf, (n_convs - 1) * CASE WHEN n.depth = 0 THEN 0 ELSE length(n.k[n.depth].t) END AS saved FROM n LEFT JOIN kids USING (k)),
s AS (SELECT k, sum(leaf)::bigint AS n_leaves, sum(saved)::bigint AS saved_tokens FROM (SELECT k[1:d] AS k, leaf, saved FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM v)) GROUP BY k)
SELECT n.conv_id, n.depth, CASE WHEN n.depth > 0 THEN u.conv_id END AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN s USING (k) LEFT JOIN kids USING (k) LEFT JOIN n u ON u.k = n.up
"""

SQL = {"op11_prefix_trie": OP11, "op1_decontamination": OP1, "op7_chat_format": OP7, "op13_merkle_manifest": OP13}
