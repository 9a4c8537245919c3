"""Mixing sources to target weights by systematic sampling.

Each source gets a target: its weight's share of all words, at most a few times its own words, the
excess shared again by weight among the others until none is above. A document's expected copies are
target / words of its source. Within a source documents stand in order of size; the prefix sum of
their expected copies, shifted by one random offset, crosses some whole numbers at each document, and
the document is taken once per crossing. As neighbours are of like size, the words taken differ from
the target by less than about one longest document, and no document is taken more often than its
expected copies rounded up.

Expected copies are whole units of 2^-24, so prefix sums are exact and a factor of 3 is never 4.
The offset is a digest of a seed and the source: reruns agree. A source of any share is spread over
slices of the order (``operators.slices``), and the few numbers of a source reach its rows by a
salted join. The driver sees two sums per round of sharing.

NULL text has no words; a NULL source is a source, the last one. Documents without words take part,
but add nothing. A source without words has target 0. Documents that agree in source, size and
doc_id (repeated rows, NULL ids) are interchangeable. An empty table gives no rows. ``mixture`` keeps
all columns of the input; those named like its new ones are replaced. Very long texts are counted
whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.llm.common import fresh
from tiffin.operators.skew import lookup
from tiffin.operators.slices import POS, SLICE, ranked, running, sliced
from tiffin.session import materialise

WEIGHTS = (5, 2, 1)    # repeated over the sources in order
MOST = 3               # a source is used this many times at most
UNIT = 1 << 24         # parts of a copy; prefix sums of 10^11 documents of a source fit
SEED = 7
WORD = "[^\\x20\\x09-\\x0D]+"


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _key(source: Column) -> Column:
    """A source as a value that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Add ``target`` to (source, source_size), one row per source.

    The level is target per weight of the sources that are not at their limit. Each round puts those
    at their limit which the level exceeds and raises the level for the rest; sources are never
    collected.
    """
    cycle = F.array(*[F.lit(w) for w in weights])
    placed = ranked(sources.withColumn("_last", F.col("source").isNull()), [],
                    ["_last", "source"], "_at")
    weighed = materialise(placed.select(
        "source", "source_size", F.element_at(cycle, (F.col("_at") % len(weights) + 1).cast("int"))
        .cast("long").alias("_weight"), (F.col("source_size") * most).alias("_limit")), "sources")
    whole = weighed.agg(F.sum("source_size").alias("n"), F.sum("_weight").alias("w")).first()
    total, level, before = whole["n"] or 0, 0.0, None
    now = (0, whole["w"])
    while now != before and now[1]:
        level, before = (total - now[0]) / now[1], now
        full = F.col("_limit") <= F.lit(level) * F.col("_weight")
        r = weighed.agg(F.sum(F.when(full, F.col("_limit"))).alias("n"),
                        F.sum(F.when(~full, F.col("_weight"))).alias("w")).first()
        now = (r["n"] or 0, r["w"] or 0)
    return weighed.select("source", "source_size", F.least(
        F.col("_limit").cast("double"), F.lit(level) * F.col("_weight")).alias("target"))


def offset(source: Column, seed: int) -> Column:
    """A place in [0, UNIT) that depends on the seed and the source only."""
    text = F.concat(F.lit(f"{seed}"), source)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % UNIT


def systematic(rows: DataFrame, group: str, order: list[str], units: str, shift: Column,
               out: str) -> DataFrame:
    """Add how many whole numbers each row crosses: prefix sums of ``units`` (parts of UNIT) in the
    group, from ``shift`` on. Groups may be of any size."""
    summed = running(sliced(rows, [group, *order]), [group], units, "sum", "_end",
                     include_current=True)
    end = F.col("_end") + shift
    crossed = F.shiftright(end, 24) - F.shiftright(end - F.col(units), 24)
    return summed.withColumn(out, crossed).drop("_end", SLICE, POS)


def copies(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST,
           seed: int = SEED) -> DataFrame:
    """Add source_size, target and copies to rows of (doc_id, source, size); other columns stay."""
    totals = materialise(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "totals")
    rate = F.when(F.col("source_size") > 0, F.round(
        F.col("target") / F.col("source_size") * UNIT)).otherwise(0).cast("long")
    known = materialise(targets(totals, weights, most).select(
        _key(F.col("source")).alias("_key"), "source_size", "target", rate.alias("_units")),
        "targets")
    rows = lookup(sized.withColumn("_key", _key(F.col("source"))), known, ["_key"])
    taken = systematic(rows, "_key", ["size", "doc_id"], "_units", offset(F.col("_key"), seed),
                       "copies")
    return taken.drop("_key", "_units")


def mixture(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST,
            seed: int = SEED) -> DataFrame:
    """The mixed corpus: each document once per copy, with ``copy`` numbered from 1."""
    row = F.struct(*[F.col(c) for c in fresh(docs, "copy").columns])
    taken = copies(docs.select("doc_id", "source", words(F.col("text")).alias("size"),
                               row.alias("row")), weights, most, seed)
    return (taken.where("copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
                    .alias("copy")).select("row.*", "copy"))


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST,
         seed: int = SEED) -> DataFrame:
    """Per document its size, its source's size and target, and the words that the mix takes."""
    sized = materialise(docs.select("doc_id", "source", words(F.col("text")).alias("size")),
                        "sizes")
    return copies(sized, weights, most, seed).select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"))


SQL = f"""WITH d AS (SELECT doc_id, source, '=' || source AS k,
    CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
g AS (SELECT source, coalesce(k, '') AS k, n, w, 3 * n / w AS ratio FROM (
  SELECT source, k, CAST(sum(size) AS BIGINT) AS n,
    [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM d GROUP BY source, k)),
l AS (SELECT a.ratio, (SELECT sum(n) FROM g) AS total,
    (SELECT coalesce(sum(3 * n), 0) FROM g b WHERE b.ratio < a.ratio) AS full_n,
    (SELECT sum(w) FROM g b WHERE b.ratio >= a.ratio) AS open_w FROM g a),
v AS (SELECT min_by(CAST(total - full_n AS DOUBLE) / CAST(open_w AS DOUBLE), ratio) AS level
  FROM l WHERE CAST(total - full_n AS DOUBLE) / CAST(open_w AS DOUBLE) <= ratio),
t AS (SELECT k, n, least(CAST(3 * n AS DOUBLE), level * w) AS target,
    CAST(('0x' || substr(md5('{SEED}' || k), 1, 8)) AS BIGINT) % {UNIT} AS shift FROM g, v),
u AS (SELECT k, n, target, shift,
    CAST(CASE WHEN n > 0 THEN round(target / n * {UNIT}) ELSE 0 END AS BIGINT) AS units FROM t),
e AS (SELECT doc_id, size, n, target, units, shift + sum(units) OVER (PARTITION BY u.k
    ORDER BY size, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS over
  FROM d JOIN u ON coalesce(d.k, '') = u.k)
SELECT doc_id, size, n AS source_size, target,
  CAST((over // {UNIT} - (over - units) // {UNIT}) * size AS BIGINT) AS taken FROM e"""
