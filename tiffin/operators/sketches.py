"""Mergeable summaries: distinct counts and quantiles from small tables, kept per day.

A summary is an ordinary table, so merging days is a group-by and a late day replaces its own rows.
All numbers are whole until the last step, so any order of merging gives the same result, and any
SQL engine with the same hash can repeat it.

- Distinct: 2^bits registers per key, each the largest rank of a first one-bit among its hashes
  (HyperLogLog); the standard error is 1.04 / sqrt(2^bits), and few values are counted by the
  registers that stayed empty.
- Quantiles: counts per value rounded down to ``bits`` significant binary digits; a quantile is off
  by less than its 2^(1 - bits) th part, and a key has at most 64 * 2^bits rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_BITS = 48
REGISTER_BITS, VALUE_BITS = 10, 8


def xx48(value: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(value), 64 - HASH_BITS)


def md5_48(value: Column) -> Column:
    """The portable hash, for comparison runs."""
    return F.conv(F.substring(F.md5(value.cast("string")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def distinct_sketch(df: DataFrame, keys: list[str], value: str, bits: int = REGISTER_BITS,
                    hashed: Callable[[Column], Column] = xx48) -> DataFrame:
    """(keys, register, rank); NULL values are not counted. At most 2^bits rows per key."""
    h, rest = hashed(F.col(value)), HASH_BITS - bits
    low = h.bitwiseAND(F.lit((1 << rest) - 1))
    rank = F.when(low == 0, rest + 1).otherwise(rest + 1 - F.length(F.bin(low)))
    return df.filter(F.col(value).isNotNull()).groupBy(
        *keys, F.shiftright(h, rest).cast("int").alias("register")).agg(
        F.max(rank).cast("int").alias("rank"))


def merged_distinct(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """The sketch of all rows of coarser keys."""
    return sketch.groupBy(*keys, "register").agg(F.max("rank").alias("rank"))


def estimated_distinct(sketch: DataFrame, keys: list[str], out: str, bits: int = REGISTER_BITS
                       ) -> DataFrame:
    """One row per key with the estimated number of distinct values, rounded."""
    m = 1 << bits
    sums = sketch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(
        F.pow(F.lit(2.0), -F.col("rank"))).alias("_s"))
    raw = F.lit(0.7213 / (1 + 1.079 / m) * m * m) / (F.col("_s") + (m - F.col("_n")))
    few = F.lit(float(m)) * F.ln(F.lit(float(m)) / (m - F.col("_n")))
    best = F.when((raw <= 2.5 * m) & (F.col("_n") < m), few).otherwise(raw)
    return sums.select(*keys, F.round(best).cast("bigint").alias(out))


def lower_edge(value: Column, bits: int = VALUE_BITS) -> Column:
    """A whole number from zero on, its binary digits after the first ``bits`` set to zero."""
    cut = F.greatest(F.length(F.bin(value)) - bits, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value.cast("bigint"), cut), cut)


def value_sketch(df: DataFrame, keys: list[str], value: str, bits: int = VALUE_BITS) -> DataFrame:
    """(keys, edge, n): rows per rounded value; NULL is not counted, negative values are refused."""
    v = F.when(F.col(value) < 0, F.raise_error(F.lit("a negative value"))).otherwise(F.col(value))
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, lower_edge(v, bits).alias("edge")) \
        .agg(F.count(F.lit(1)).alias("n"))


def merged_values(sketch: DataFrame, keys: list[str]) -> DataFrame:
    return sketch.groupBy(*keys, "edge").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, keys: list[str], wanted: dict[str, float]) -> DataFrame:
    """One row per key: for each name the edge below which its share of the rows lies.

    A key's edges are bounded in number, so they fit in one array, whose running count is searched.
    """
    edges = merged_values(sketch, keys).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("edge", "n"))).alias("_e"), F.sum("n").alias("_all"))

    def at(share: float) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("bigint").alias("v"))
        found = F.aggregate("_e", start, lambda s, e: F.struct(
            (s["n"] + e["n"]).alias("n"),
            F.coalesce(s["v"], F.when(s["n"] + e["n"] >= F.col("_all") * F.lit(share), e["edge"]))
            .alias("v")))
        return found["v"]
    return edges.select(*keys, *[at(q).alias(name) for name, q in wanted.items()])
