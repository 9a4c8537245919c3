"""Registered queries of this subpackage, with production parameters, and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tiffin.llm import (bpe, chat, divergence, divergence_sql, fmindex, jaccard, mixing, pii,
                        prefix_trie, separators, suffixes, toxicity, trie_sql, turn_repair, windows)
from tiffin.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def query(key: str, sql: str | None = None):
    def add(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return add


@query("op1_separator_scan")
def op1_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return separators.token_counts(table(spark, sf_dir, "documents"), BYTE_RANKS,
                                   public_tokenizers.PATTERN)


WORDS_SQL = """
w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
        lambda x: x <> '') AS words FROM documents)"""


def jaccard_sql(n: int, num: int, den: int) -> str:
    gram = " || chr(1) || ".join(f"words[i + {k}]" for k in range(n))
    return f"""WITH RECURSIVE {WORDS_SQL.strip()},
g AS (SELECT doc_id, CASE WHEN len(words) >= {n}
        THEN list_distinct([{gram} FOR i IN range(1, len(words) - {n - 2})])
        WHEN len(words) > 0 THEN [array_to_string(words, chr(1))] ELSE [] END AS grams FROM w),
f AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM g),
e AS (SELECT x.doc_id AS a, y.doc_id AS b FROM f x JOIN f y ON x.gram = y.gram
      GROUP BY x.doc_id, y.doc_id, x.n, y.n
      HAVING {den} * count(*) >= {num} * (x.n + y.n - count(*))),
r AS (SELECT doc_id, doc_id AS c FROM g UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.c = e.a)
SELECT g.doc_id, CAST(len(g.grams) AS BIGINT) AS n_shingles, m.c AS component_id
FROM g JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m ON g.doc_id = m.doc_id"""


@query("op2_ngram_jaccard", jaccard_sql(3, 90, 100))
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), n=3, num=90, den=100)


@query("op3_suffix_dedup")
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(table(spark, sf_dir, "documents"), length=100)


OP4_SQL = """WITH lowered AS (
  SELECT doc_id AS id, text, 'd' AS kind FROM documents
  UNION ALL SELECT item_id, text, 'i' FROM benchmark),
w AS (SELECT id, kind, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS words FROM lowered),
l AS (SELECT id, kind, words, len(words) AS n FROM w),
p AS (SELECT id AS item, unnest([array_to_string(words[i:i + 12], ' ')
        FOR i IN range(1, greatest(n - 11, 2))]) AS phrase, least(n, 13) AS size
      FROM l WHERE kind = 'i' AND n > 0),
s AS (SELECT DISTINCT size FROM p),
d AS (SELECT id, size, unnest(range(1, n - size + 2)) AS i, words FROM l, s
      WHERE kind = 'd' AND n >= size),
h AS (SELECT d.id, p.item, d.i, p.size FROM d JOIN p
      ON p.size = d.size AND p.phrase = array_to_string(d.words[d.i:d.i + d.size - 1], ' ')),
hits AS (SELECT id, count(DISTINCT k) AS n_hit
         FROM (SELECT id, unnest(range(i, i + size)) AS k FROM h) GROUP BY id),
found AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT id, CAST(item AS VARCHAR) AS item FROM h) GROUP BY id)
SELECT l.id AS doc_id, CAST(l.n AS BIGINT) AS n_words,
  CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= l.n AS contaminated
FROM l LEFT JOIN hits ON l.id = hits.id LEFT JOIN found ON l.id = found.id WHERE kind = 'd'"""


@query("op4_fm_decontamination", OP4_SQL)
def op4_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fmindex.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_pii")
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(table(spark, sf_dir, "documents"))


@query("op6_divergence", divergence_sql.sql())
def op6_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.verdicts(table(spark, sf_dir, "documents"))


@query("op7_compact_windows")
def op7_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.digests(table(spark, sf_dir, "documents"), length=50)


OP8_SQL = r"""WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
m AS (SELECT *, length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g'))
    + length(role) + length(regexp_replace(role, '[^\\#<:]', '', 'g')) + 14 AS marked FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
    AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256, CAST(sum(marked) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id"""


@query("op8_chat_rendering", OP8_SQL)
def op8_chat_rendering(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "\\### Assistant: </turn> ok"
    one = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)],
                                "conv_id long, turn long, role string, text string")
    return chat.digests(rows.unionByName(one))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), BYTE_BPE)


@query("op11_prefix_trie", trie_sql.SQL)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


@query("op12_systematic_mix", mixing.SQL)
def op12_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents"))


@query("op13_auction_repair", turn_repair.SQL)
def op13_auction_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.digests(table(spark, sf_dir, "conversations"))
