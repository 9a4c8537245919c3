"""Splitting totals: largest remainder, weights and weighted picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.functions.draws import WIDE_BITS
from tiffin.operators.skew import attach
from tiffin.operators.slices import POS, SLICE, expanded, ranked, running, sliced
from tiffin.session import materialise

UNITS = "decimal(38,0)"


def largest_remainder(df: DataFrame, group: list[str], total: str, weight: str, pos: str,
                      out: str, places: int = 2) -> DataFrame:
    """Split ``total`` over the rows of each group; the parts sum to it exactly.

    ``weight`` is a number with up to ten digits after the point; a longer decimal, or a float so
    small that it would become zero, is an error. ``pos`` breaks ties and is unique in the group. The
    arithmetic is on whole units, so nothing is rounded; a group whose weights sum to zero fails.
    The size of a negative total is split and the sign given back.
    """
    scale = 10 ** places
    kind = df.schema[weight].dataType
    fraction = isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType)
    digits = 10 if fraction else min(getattr(kind, "scale", 0), 10)
    wide = f"decimal({18 + digits},{digits})"
    given, cut = F.col(weight), F.col(weight).cast(wide)
    # A float is rounded, as it always is; a decimal must not be, and no weight may vanish.
    lost = (given > 0) & (cut == 0) if fraction else cut != given
    checked = F.when(lost, F.raise_error(F.concat(
        F.lit(f"weight has more than {digits} digits after the point: "), given.cast("string")))) \
        .otherwise(cut)
    weighed = attach(df.withColumn("_given", checked), group, _wsum=("sum", F.col("_given")))

    def whole(c: str, to: str) -> Column:
        return (F.col(c) * F.lit(10 ** digits).cast(f"decimal({digits + 1},0)")).cast(to)
    units = (weighed
             .withColumn("_signed", (F.col(total).cast("decimal(18,4)") * scale)
                         .cast("decimal(20,0)"))
             .withColumn("_total", F.abs("_signed"))
             .withColumn("_weight", F.col("_given"))
             .withColumn("_w", whole("_weight", "decimal(28,0)"))
             .withColumn("_ws", whole("_wsum", "decimal(34,0)")))
    checked = F.when(F.col("_ws") == 0, F.raise_error(F.lit("weights sum to zero"))) \
        .otherwise(F.col("_ws"))
    product = (F.col("_total") * F.col("_w")).cast(UNITS)
    split = (units.withColumn("_left", (product % checked).cast(UNITS))
             .withColumn("_floor", ((product - F.col("_left")) / F.col("_ws")).cast("decimal(20,0)"))
             .withColumn("_by", -F.col("_left"))
             .select(*df.columns, "_signed", "_total", "_floor", "_by"))
    placed = ranked(split, group, ["_by", pos], "_rank", sums={"_given": "_floor"})
    short = (F.col("_total") - F.col("_given")).cast("bigint")
    size = F.col("_floor") + F.when(F.col("_rank") < short, 1).otherwise(0)
    part = F.when(F.col("_signed") < 0, -size).otherwise(size)
    return placed.select(*df.columns, (part / F.lit(scale)).cast(f"decimal(18,{places})").alias(out))


def zipf_weight(rank: Column, exponent: float = 0.85, offset: float = 4.0) -> Column:
    """Popularity of a zero-based rank before normalising."""
    return F.lit(1.0) / F.pow(rank + F.lit(1.0 + offset), F.lit(exponent))


def density_weight(rank: Column, decay: float = 6.0) -> Column:
    """Exponential decay from the innermost rank outward before normalising."""
    return F.exp(-rank / F.lit(decay))


def normalised(df: DataFrame, weight: str, group: list[str], out: str) -> DataFrame:
    """Weights divided by the sum of their group."""
    if not group:
        total = df.agg(F.sum(weight)).scalar()
        return df.withColumn(out, F.col(weight) / total)
    summed = attach(df, group, _sum=("sum", F.col(weight)))
    return summed.withColumn(out, F.col(weight) / F.col("_sum")).drop("_sum")


def cumulative(df: DataFrame, key: str, weight: str, out: str) -> DataFrame:
    """Prefix sum of a whole-number weight in key order, over a table of any size."""
    return running(sliced(df, [key]), [], weight, "sum", out, include_current=True) \
        .drop(SLICE, POS)


FEW_KEYS = 1 << 16  # a table of this many keys is summed in one task, a larger one in slices


def whole_weights(weights: DataFrame, key: str, weight: str) -> DataFrame:
    """(key, _w): weights as whole numbers; a fraction or a negative weight is an error, because it
    would be cut or lost. Weights of zero and NULL have no share and are left out."""
    w = F.col(weight)
    wrong = (w < 0) | (w != F.floor(w))
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("weight is not a whole number: "),
                                                   w.cast("string")))).otherwise(w)
    return weights.select(key, checked.cast("bigint").alias("_w")).filter("_w > 0")


def weight_ranges(table: DataFrame, key: str, n: int) -> DataFrame:
    """(key, lo, hi): each key's stretch [lo, hi) of the cumulative weight in key order."""
    if n <= FEW_KEYS:
        upto = F.sum("_w").over(W.orderBy(key).rowsBetween(W.unboundedPreceding, 0))
        summed = table.withColumn("_c", upto)
    else:
        summed = cumulative(table, key, "_w", "_c")
    return summed.select(key, (F.col("_c") - F.col("_w")).alias("lo"), F.col("_c").alias("hi"))


def _point(draw: Column, total: int) -> Column:
    """draw * total >> WIDE_BITS, exactly: in longs where the product of half a draw fits."""
    half = WIDE_BITS // 2
    if total < 1 << (62 - half):
        high, low = F.shiftright(draw, half), draw.bitwiseAND(F.lit((1 << half) - 1))
        return F.shiftright(high * total + F.shiftright(low * total, half), half)
    over = F.lit(1 << WIDE_BITS).cast("decimal(19,0)")
    product = draw.cast("decimal(19,0)") * F.lit(total).cast("decimal(19,0)")
    return F.floor((product - product % over) / over).cast("bigint")


def weighted_pick(df: DataFrame, draw: Column, weights: DataFrame, key: str,
                  weight: str) -> DataFrame:
    """Add the key drawn for each row; ``draw`` has ``WIDE_BITS`` bits, weights are whole numbers.

    The draw becomes a point of the cumulative weight, which lies in one key's stretch. The weight
    axis is cut into as many cells as there are keys; keys and points meet by cell, and the stretch
    decides inside it. Every cell gets the same share of the rows whatever the weights, a key lies
    in as many cells as its share, and the table has at most twice as many rows as keys. There is no
    bound on the number of keys.

    A cell is a rounded product, the same one on both sides and never falling along the axis, so
    a point lies between its key's first and last cell without exact arithmetic.
    """
    table = materialise(whole_weights(weights, key, weight), "weights")
    size = table.agg(F.sum("_w").alias("total"), F.count(F.lit(1)).alias("n")).first()
    total, cells = size["total"] or 1, max(1, size["n"])

    def cell(c: Column) -> Column:
        return F.floor(c.cast("double") * F.lit(cells / total)).cast("bigint")
    first, last = cell(F.col("lo")), cell(F.col("hi") - 1)
    spread = expanded(weight_ranges(table, key, cells).select(
        key, "lo", "hi", first.alias("_first"), (last - first + 1).alias("_n")), "_n", "_k") \
        .select(key, "lo", "hi", (F.col("_first") + F.col("_k")).alias("_c"))
    rows = df.withColumn("_point", _point(draw, total))
    rows = rows.withColumn("_cell", cell(F.col("_point")))
    inside = (F.col("_point") >= F.col("lo")) & (F.col("_point") < F.col("hi"))
    return rows.join(spread, (F.col("_cell") == F.col("_c")) & inside).select(*df.columns, key)
