"""Comparison SQL for the prefix trie, and a checksum for SQL that has none."""

from __future__ import annotations


def crc32(text: str) -> str:
    """CRC-32 of an ASCII string expression, bit by bit (polynomial 0xEDB88320)."""
    step = ("CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END")
    byte = f"list_reduce([xor(s, b)] || [0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: {step})"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return (f"xor(list_reduce([CAST(4294967295 AS BIGINT)] || {codes}, lambda s, b: {byte}), "
            "CAST(4294967295 AS BIGINT))")


SQL = f"""WITH t AS (
  SELECT conv_id AS c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT c, turns, {crc32('CAST(c AS VARCHAR)')} % 6 AS h FROM t),
x AS (SELECT h.c, coalesce(f.turns, [])[1:h.h] || h.turns[h.h + 1:] AS turns
  FROM h LEFT JOIN t f ON f.c = h.c - h.c % 100),
p AS (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM x),
n AS (SELECT d, turns[1:d] AS prefix, min(c) AS conv_id, count(*) AS n_convs,
    string_agg(CASE WHEN len(turns) = d THEN CAST(c AS VARCHAR) END, ',' ORDER BY c) AS ends
  FROM p GROUP BY 1, 2),
k AS (SELECT d - 1 AS d, prefix[1:d - 1] AS prefix, count(*) AS n_children FROM n WHERE d > 0
  GROUP BY 1, 2),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children,
    (n_convs - 1) * CASE WHEN n.d > 0 THEN length(n.prefix[n.d]['t']) ELSE 0 END AS saved
  FROM n LEFT JOIN k ON n.d = k.d AND n.prefix = k.prefix),
u AS (SELECT n_children, saved, prefix, unnest(range(0, d + 1)) AS d FROM m),
s AS (SELECT d, prefix[1:d] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves,
    sum(saved) AS saved FROM u GROUP BY 1, 2)
SELECT m.conv_id, m.d AS depth, q.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(m.ends, '')) AS ends_sha256
FROM m JOIN s ON m.d = s.d AND m.prefix = s.prefix
LEFT JOIN n q ON m.d > 0 AND q.d = m.d - 1 AND q.prefix = m.prefix[1:m.d - 1]"""
