"""Declared tests of the mart columns, and one report over them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.operators import quality

# Which columns of a mart must be unique, filled, or found in another mart.
UNIQUE = {
    "dim_customer": "customer_id", "dim_restaurant": "restaurant_id", "dim_rider": "rider_id",
    "dim_zone": "zone_id", "dim_date": "date_day", "fct_orders": "order_id",
    "fct_deliveries": "order_id",
}
FILLED = {
    "dim_customer": ["customer_id"], "dim_restaurant": ["restaurant_id"],
    "dim_rider": ["rider_id"], "dim_zone": ["zone_id", "city_id"],
    "dim_date": ["date_day", "is_weekend"],
    "fct_orders": ["order_id", "customer_id", "restaurant_id", "zone_id", "date_day",
                   "net_revenue"],
    "fct_deliveries": ["order_id", "customer_id", "restaurant_id", "zone_id", "date_day",
                       "total_attempts", "was_matched"],
}
_DIMENSIONS = {"customer_id": ("dim_customer", "customer_id"),
               "restaurant_id": ("dim_restaurant", "restaurant_id"),
               "zone_id": ("dim_zone", "zone_id"), "date_day": ("dim_date", "date_day")}
FOUND = {
    "fct_orders": _DIMENSIONS,
    "fct_deliveries": _DIMENSIONS | {"accepted_rider_id": ("dim_rider", "rider_id")},
}


def report(model: str, mart: Callable[[str], DataFrame]) -> DataFrame:
    """(model, test, column, failures), a row per declared test; ``mart`` gives a mart by name.

    All column tests of a mart are one aggregate over it; uniqueness groups by the key, and each
    relation is an anti join with a dimension.
    """
    df = mart(model)
    filled = FILLED[model]
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in filled]).unpivot(
        [], filled, "column", "failures").select(F.lit("not_null").alias("test"), "column",
                                                 "failures")
    key = UNIQUE[model]
    parts = [nulls, quality.unique(df, [key]).agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit("unique").alias("test"), F.lit(key).alias("column"), "failures")]
    for column, (parent, parent_key) in FOUND.get(model, {}).items():
        lost = quality.relationships(df.select(column), column, mart(parent), parent_key)
        parts.append(lost.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit("relationship").alias("test"), F.lit(column).alias("column"), "failures"))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.select(F.lit(model).alias("model"), "test", "column", "failures")


def check(model: str, mart: Callable[[str], DataFrame]) -> quality.Check:
    return quality.Check(f"declared tests of {model}",
                         lambda: report(model, mart).filter("failures > 0"))
