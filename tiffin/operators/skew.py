"""Joins of rows with one value per key when a key may hold a large share of the rows.

Spark's own skew handling splits a hot partition only when both join inputs come straight from a
shuffle; a side that is an aggregate on the join key does not qualify. These two helpers spread each
key over a fixed number of salts instead. The salt is a hash of the row, so a repeated task computes
the same one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 64


def _salt(df: DataFrame, salts: int) -> Column:
    """Rows must carry a unique column; exact copies of a whole row would share one salt."""
    return F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int")


def attach(df: DataFrame, keys: list[str], salts: int = SALTS, **aggs: tuple[str, Column]
           ) -> DataFrame:
    """Add aggregates of each row's key group; ``out=(fold, column)`` with sum, min or max.

    Folded per key, with map-side combining, next to a bit for each salt that the key's rows have; one
    row per key and such salt is joined back on (key, salt), so no task sees more than a 1/salts share
    of a key. A row per key and salt from the start would be a row per row where groups are small.
    """
    if salts > SALTS:
        raise ValueError(f"{salts} salts: their bits must fit a long, {SALTS} at most")
    folds = {"sum": F.sum, "min": F.min, "max": F.max}
    salted = df.withColumn("_salt", _salt(df, salts))
    bit = F.expr("shiftleft(1L, _salt)")
    whole = salted.groupBy(*keys).agg(*[folds[fold](col).alias(out)
                                        for out, (fold, col) in aggs.items()],
                                      F.bit_or(bit).alias("_bits"))
    merged = (whole.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
              .filter(F.col("_bits").bitwiseAND(bit) != 0).drop("_bits"))
    return null_safe(salted, merged, keys + ["_salt"], list(aggs)).drop("_salt")


def lookup(rows: DataFrame, per_key: DataFrame, keys: list[str], salts: int = 32) -> DataFrame:
    """Inner join with a table of one row per key that is small next to ``rows``; the table is
    repeated once per salt."""
    salted = rows.withColumn("_salt", _salt(rows, salts))
    repeated = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, keys + ["_salt"]).drop("_salt")


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Inner join where NULL keys match each other, as they do in a group."""
    other = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *values)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return left.join(other, same).drop(*[f"_k_{k}" for k in keys])
