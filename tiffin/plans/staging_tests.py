"""Declared tests of the staging models, and one report over them."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.operators import quality
from tiffin.sources.bronze import NOTES

# Per model the columns that are unique, filled, found in another model's column, or
# one of a list of values.
UNIQUE = {
    "cities": ["city_id"], "zones": ["zone_id"], "restaurants": ["restaurant_id"],
    "riders": ["rider_id"], "menu_items": ["menu_item_id"], "rider_payout_tiers": ["tier"],
    "demand_daily": ["day_index", "order_date"], "customers": ["customer_id"],
    "orders": ["order_id"], "order_items": ["order_item_id"], "match_attempts": ["match_id"],
    "payments": ["payment_id", "order_id"], "refunds": ["refund_id"],
}
FILLED = {
    "cities": ["city_id", "name", "country_code", "timezone"],
    "zones": ["zone_id", "city_id", "is_active"],
    "restaurants": ["restaurant_id", "zone_id", "cuisine_type", "commission_pct"],
    "riders": ["rider_id", "home_zone_id", "vehicle_type", "payout_tier"],
    "menu_items": ["menu_item_id", "restaurant_id", "price"],
    "rider_payout_tiers": ["tier", "base_fare"], "demand_daily": ["day_index", "order_date"],
    "demand_hourly": ["day_index", "hour", "orders"],
    "customers": ["customer_id", "email_hash", "phone_masked", "home_zone_id"],
    "orders": ["order_id", "customer_id", "restaurant_id", "zone_id", "order_status", "subtotal",
               "order_total"],
    "order_items": ["order_item_id", "order_id", "menu_item_id", "line_total"],
    "match_attempts": ["match_id", "order_id", "rider_id", "response"],
    "payments": ["payment_id", "order_id", "amount", "method", "status"],
    "refunds": ["refund_id", "order_id", "payment_id", "refund_amount", "reason"],
}
FOUND = {
    "zones": {"city_id": "cities"}, "restaurants": {"zone_id": "zones"},
    "riders": {"home_zone_id": "zones", "payout_tier": "rider_payout_tiers"},
    "menu_items": {"restaurant_id": "restaurants"}, "customers": {"home_zone_id": "zones"},
    "orders": {"customer_id": "customers", "restaurant_id": "restaurants", "zone_id": "zones"},
    "order_items": {"order_id": "orders", "menu_item_id": "menu_items"},
    "match_attempts": {"order_id": "orders", "rider_id": "riders"},
    "payments": {"order_id": "orders"}, "refunds": {"order_id": "orders", "payment_id": "payments"},
}
LISTED = {
    "orders": {"order_status": ["DELIVERED", "CANCELLED", "UNFULFILLED"], "delivery_notes": NOTES},
    "match_attempts": {"response": ["ACCEPTED", "DECLINED", "TIMEOUT"]},
    "payments": {"method": ["upi", "card", "wallet", "cod"], "status": ["SUCCESS", "FAILED"]},
    "refunds": {"reason": ["CANCELLED", "QUALITY_ISSUE", "LATE_DELIVERY", "MISSING_ITEMS"]},
}
KEY = {model: columns[0] for model, columns in UNIQUE.items()}


def report(table: Callable[[str], DataFrame], models: Iterable[str]) -> DataFrame:
    """(model, test, column, failures), a row per declared test of the given models.

    Filled and listed columns of a model are one aggregate over it. Relations to a model that is not
    given are left out.
    """
    given = list(models)
    parts = []
    for model in given:
        df = table(model)
        listed = LISTED.get(model, {})
        counts = {("not_null", c): F.col(c).isNull() for c in FILLED[model]} | {
            ("accepted_values", c): ~F.col(c).isin(v) for c, v in listed.items()}
        names = [f"{test}:{column}" for test, column in counts]
        wide = df.agg(*[F.count_if(bad).alias(n) for n, bad in zip(names, counts.values(),
                                                                  strict=True)])
        parts.append(wide.unpivot([], names, "both", "failures").select(
            F.lit(model).alias("model"), F.split_part("both", F.lit(":"), F.lit(1)).alias("test"),
            F.split_part("both", F.lit(":"), F.lit(2)).alias("column"), "failures"))
        found = [("unique", c, quality.unique(df, [c])) for c in UNIQUE.get(model, [])]
        found += [("relationships", c, quality.relationships(df.select(c), c, table(parent),
                                                             KEY[parent]))
                  for c, parent in FOUND.get(model, {}).items() if parent in given]
        parts += [bad.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(model).alias("model"), F.lit(test).alias("test"), F.lit(c).alias("column"),
            "failures") for test, c, bad in found]
    return reduce(DataFrame.unionByName, parts)


def check(table: Callable[[str], DataFrame], models: Iterable[str]) -> quality.Check:
    given = list(models)
    return quality.Check("declared tests of the staging models",
                         lambda: report(table, given).filter("failures > 0"))


def sql(views: dict[str, str]) -> str:
    """The same report over the views of a comparison engine."""
    rows = []

    def add(model: str, test: str, column: str, failures: str) -> None:
        rows.append(f"select '{model}' as model, '{test}' as test, '{column}' as \"column\", "
                    f"({failures}) as failures")
    for model, view in views.items():
        for c in FILLED[model]:
            add(model, "not_null", c, f"select count(*) from {view} where {c} is null")
        for c, values in LISTED.get(model, {}).items():
            texts = ", ".join(f"'{v}'" for v in values)
            add(model, "accepted_values", c,
                f"select count(*) from {view} where {c} not in ({texts})")
        for c in UNIQUE.get(model, []):
            add(model, "unique", c, f"select count(*) from (select {c} from {view} where {c} is not "
                                    f"null group by {c} having count(*) > 1)")
        for c, parent in FOUND.get(model, {}).items():
            if parent in views:
                add(model, "relationships", c,
                    f"select count(*) from {view} x where {c} is not null and not exists (select 1 "
                    f"from {views[parent]} y where y.{KEY[parent]} = x.{c})")
    return " union all ".join(rows)
