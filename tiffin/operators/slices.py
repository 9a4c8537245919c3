"""Ordered scans that survive hot groups.

A window over a group puts the whole group into one task, and a window without a group puts the
whole table there. Here the rows are range-partitioned on the full order instead, so a group that
holds a third of the table spreads over many slices. Each slice is scanned on its own and gets what
lies before it from a table with one row per (group, slice).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tiffin.operators.skew import null_safe
from tiffin.session import materialise

SLICE, POS = "_slice", "_pos"
_POS_BITS = 33  # monotonically_increasing_id keeps the partition number above these bits


def sliced(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows with their slice number and place in it; ``order`` must be unique per row.

    The result is written once: slice borders come from sampling, so every later branch must read
    the same borders.
    """
    keys = [F.col(c) for c in order]
    numbered = (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                .withColumn("_m", F.monotonically_increasing_id()))
    placed = numbered.select(
        *df.columns,
        F.shiftright("_m", _POS_BITS).cast("int").alias(SLICE),
        F.col("_m").bitwiseAND(F.lit((1 << _POS_BITS) - 1)).alias(POS),
    )
    return materialise(placed, "slices")


def before(parts: DataFrame, group: list[str], carry: Column) -> Column:
    """An aggregate of all earlier slices of the group; ``parts`` has a row per (group, slice)."""
    window = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    return carry.over(window.orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1))


def local_window(group: list[str]):
    return W.partitionBy(*group, SLICE).orderBy(POS)


def ranked(df: DataFrame, group: list[str], order: list[str], out: str,
           sums: dict[str, str] | None = None) -> DataFrame:
    """Zero-based rank of each row in its group, contiguous, for groups of any size.

    ``sums`` adds group totals of columns (name -> column) in the same pass.
    """
    sums = sums or {}
    placed = sliced(df, group + order)
    parts = placed.groupBy(*group, SLICE).agg(
        F.count(F.lit(1)).alias("_n"), F.min(POS).alias("_first"),
        *[F.sum(c).alias(f"_part_{n}") for n, c in sums.items()])
    whole = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    starts = parts.select(*group, SLICE, "_first",
                          F.coalesce(before(parts, group, F.sum("_n")), F.lit(0)).alias("_start"),
                          *[F.sum(f"_part_{n}").over(whole).alias(n) for n in sums])
    return (null_safe(placed, starts, group + [SLICE], ["_first", "_start", *sums])
            .withColumn(out, (F.col("_start") + F.col(POS) - F.col("_first")).cast("bigint"))
            .drop(SLICE, POS, "_first", "_start"))


def contiguous_ids(df: DataFrame, order: list[str], out: str, first: int = 1) -> DataFrame:
    """Surrogate ids 1..n in key order without a single-task window."""
    return ranked(df, [], order, out).withColumn(out, F.col(out) + F.lit(first))


def block_ranked(df: DataFrame, group: list[str], key: str, out: str,
                 block: int = 100_000) -> DataFrame:
    """Zero-based rank in the group in order of a unique integer key.

    A block holds at most ``block`` rows because the key is unique, so no group is hot. Needs
    nothing written; counts per (group, block) give the offsets.
    """
    blocked = df.withColumn("_block", F.floor(F.col(key) / F.lit(block)))
    window = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    parts = (blocked.groupBy(*group, "_block").agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_start", F.coalesce(
                 F.sum("_n").over(window.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)),
                 F.lit(0)))
             .drop("_n"))
    local = F.row_number().over(W.partitionBy(*group, "_block").orderBy(key))
    return (null_safe(blocked.withColumn("_local", local), parts, group + ["_block"], ["_start"])
            .withColumn(out, (F.col("_start") + F.col("_local") - 1).cast("bigint"))
            .drop("_block", "_local", "_start"))


def running(placed: DataFrame, group: list[str], value: str, fold: str, out: str,
            include_current: bool) -> DataFrame:
    """Running ``max`` or ``sum`` of a column along the slices of each group."""
    agg = {"max": F.max, "sum": F.sum}[fold]
    parts = placed.groupBy(*group, SLICE).agg(agg(value).alias("_part"))
    carries = parts.select(*group, SLICE, before(parts, group, agg("_part")).alias("_carry"))
    last = 0 if include_current else -1
    local = agg(value).over(local_window(group).rowsBetween(W.unboundedPreceding, last))
    joined = null_safe(placed.withColumn("_here", local), carries, group + [SLICE], ["_carry"])
    if fold == "max":
        total = F.greatest("_here", "_carry")  # greatest skips NULL
    else:
        total = F.coalesce("_here", F.lit(0)) + F.coalesce("_carry", F.lit(0))
    return joined.withColumn(out, total).drop("_here", "_carry")


def previous(placed: DataFrame, group: list[str], value: str, out: str) -> DataFrame:
    """``lag(value, 1)`` in the group across slice borders."""
    parts = placed.groupBy(*group, SLICE).agg(F.max_by(F.struct(value), F.col(POS)).alias("_last"))
    window = W.partitionBy(*group).orderBy(SLICE)
    carries = parts.select(*group, SLICE, F.lag("_last").over(window).alias("_carry"))
    here = F.lag(F.struct(value)).over(local_window(group))
    return (null_safe(placed.withColumn("_here", here), carries, group + [SLICE], ["_carry"])
            .withColumn(out, F.coalesce("_here", "_carry")[value]).drop("_here", "_carry"))


def first_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key; partial aggregation keeps hot keys cheap, no window needed."""
    rest = [c for c in df.columns if c not in keys]
    by = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    return (df.groupBy(*keys).agg(F.min_by(F.struct(*rest), by).alias("_row"))
            .select(*keys, "_row.*").select(*df.columns))


def expanded(df: DataFrame, count: str, out: str, chunk: int = 10_000) -> DataFrame:
    """``count`` rows per input row, numbered from 0; zero or NULL gives none.

    A count of any size is cut into chunks which are spread before the second step, so no array and
    no task grows with the largest count. The number of partitions is given, because by their few
    bytes the chunks would be put together in one task, which then makes all rows.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = (df.filter(F.col(count) > 0)
              .withColumn("_chunk", F.explode(F.sequence(
                  F.lit(0).cast("bigint"), F.floor((F.col(count) - 1) / F.lit(chunk))))))
    spread = chunks.repartition(parts, F.xxhash64(*df.columns, "_chunk"))
    first = F.col("_chunk") * F.lit(chunk)
    last = F.least(first + F.lit(chunk - 1), F.col(count).cast("bigint") - 1)
    return spread.withColumn(out, F.explode(F.sequence(first, last))).drop("_chunk")
