"""Comparison SQL of the quality rules, built from the same parameters."""

from __future__ import annotations

from tiffin.llm import divergence as d


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql() -> str:
    marks = "[.,;:!?''\"()\\[\\]{}/\\\\_=+@^~`-]"
    hist = " ".join(
        f"WHEN lang = '{lang}' THEN [" + ", ".join(
            f"len(list_filter(words, lambda x: lower(x) = {_quoted(w)}))" for w in words) + "]"
        for lang, words in d.COMMON.items())
    classes, n = len(d.CLASSES), d.WORDS

    def distance(counts: str, ref: str, size: int) -> str:
        half = f"""list_sum([CASE WHEN {counts}[i] > 0 THEN {counts}[i] / total_{counts}
  * log2({counts}[i] / total_{counts} / (({counts}[i] / total_{counts} + {ref}[i]) / 2)) ELSE 0 END
  + CASE WHEN {ref}[i] > 0
    THEN {ref}[i] * log2({ref}[i] / (({counts}[i] / total_{counts} + {ref}[i]) / 2)) ELSE 0 END
  FOR i IN range(1, {size + 1})]) / 2"""
        return f"coalesce(sqrt(greatest({half}, 0.0)), 0.0)"
    return f"""WITH b AS (
  SELECT doc_id, CASE WHEN lang IN ('en', 'de', 'fr', 'es') THEN lang ELSE '' END AS lang,
    coalesce(text, '') AS t FROM documents),
s AS (SELECT doc_id, lang, t,
    list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(t, chr(10)),
                lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM b),
g AS (SELECT doc_id, words, unnest(range(1, len(words) - {d.WINDOW - 2})) AS i FROM s
      WHERE len(words) >= {d.WINDOW}),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (
      PARTITION BY doc_id, array_to_string(words[i:i + {d.WINDOW - 1}], ' ')) > 1),
v AS (SELECT doc_id, count(DISTINCT i + k) AS n
      FROM r, (SELECT unnest(range({d.WINDOW})) AS k) GROUP BY doc_id),
m AS (SELECT doc_id, lang, length(t) AS n_chars, len(words) AS n_words,
    length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper,
    length(regexp_replace(t, '[^0-9]', '', 'g')) AS digit,
    length(t) - length(regexp_replace(t, '{marks}', '', 'g')) AS mark,
    strlen(t) - length(t) AS beyond,
    CASE {hist} ELSE [0 FOR i IN range({n})] END AS w FROM s),
c AS (SELECT m.*, coalesce(v.n, 0) AS n_repeat_words,
    [upper, digit, n_chars - word_chars, mark, n_symbols, beyond, greatest(0, word_chars - upper
      - digit - mark - n_symbols - beyond)] AS c FROM m LEFT JOIN v ON m.doc_id = v.doc_id),
t AS (SELECT *, CAST(list_sum(c) AS DOUBLE) AS all_c, CAST(list_sum(w) AS DOUBLE) AS all_w FROM c),
p AS (SELECT lang, [{", ".join(f"sum(c[{i}]) / sum(all_c)" for i in range(1, classes + 1))}] AS pc,
    [{", ".join(f"coalesce(sum(w[{i}]) / nullif(sum(all_w), 0), 0)" for i in range(1, n + 1))}]
      AS pw FROM t GROUP BY lang),
j AS (SELECT t.*, pc, pw, nullif(all_c, 0) AS total_c, nullif(all_w, 0) AS total_w
      FROM t JOIN p ON t.lang = p.lang),
x AS (SELECT *, CASE WHEN total_c IS NULL THEN 0 ELSE {distance("c", "pc", classes)} END AS cd,
    CASE WHEN total_w IS NULL THEN 0 ELSE {distance("w", "pw", n)} END AS wd,
    n_words < {d.MIN_WORDS} OR {d.OF} * n_repeat_words > {d.MAX_REPEAT} * n_words AS base_failed
    FROM j)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND NOT (all_c >= {d.MIN_CHARS} AND cd > {d.MAX_CLASS_DISTANCE})
    AND NOT (all_w >= {d.MIN_COMMON} AND wd > {d.MAX_WORD_DISTANCE}) AS kept FROM x"""
