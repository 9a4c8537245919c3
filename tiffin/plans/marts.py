"""Intermediate and mart models with their contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.functions.clock import is_weekend, seconds_between
from tiffin.functions.money import MONEY


def order_economics(orders: DataFrame, lines: DataFrame, refunds: DataFrame) -> DataFrame:
    """One row per order. Children are aggregated first, so the joins cannot fan out."""
    items = lines.groupBy("order_id").agg(F.count(F.lit(1)).alias("_items"))
    returned = refunds.groupBy("order_id").agg(F.sum("refund_amount").cast(MONEY).alias("_back"))
    back = F.coalesce("_back", F.lit(0))
    return (orders.join(items, "order_id", "left").join(returned, "order_id", "left")
            .select("order_id", "order_ref", "customer_id", "restaurant_id", "zone_id",
                    "placed_at", "order_status", "subtotal", "delivery_fee", "commission_pct",
                    "commission_amount", "order_total", back.cast(MONEY).alias("refund_amount"),
                    (F.col("order_total") - back).cast(MONEY).alias("net_revenue"),
                    F.coalesce("_items", F.lit(0)).alias("item_count")))


def order_matching(orders: DataFrame, attempts: DataFrame) -> DataFrame:
    """Offer count and the accepted offer per order, from one pass over the attempts.

    Relies on at most one accepted offer per order, which is tested on the attempts themselves.
    """
    accepted = F.col("response") == "ACCEPTED"
    per_order = attempts.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.max(F.when(accepted, F.col(c))).alias(a) for c, a in (
            ("match_id", "accepted_match_id"), ("rider_id", "accepted_rider_id"),
            ("offered_at", "accepted_offered_at"), ("responded_at", "accepted_at"))])
    return (orders.select("order_id", "placed_at").join(per_order, "order_id", "left")
            .select("order_id", "placed_at", "accepted_match_id", "accepted_rider_id",
                    "accepted_offered_at", "accepted_at",
                    F.coalesce("_n", F.lit(0)).alias("total_attempts"),
                    F.col("accepted_match_id").isNotNull().alias("was_matched")))


def fct_orders(economics: DataFrame) -> DataFrame:
    return economics.select(
        "order_id", "order_ref", "customer_id", "restaurant_id", "zone_id",
        F.to_date("placed_at").alias("date_day"), "placed_at", "order_status", "subtotal",
        "delivery_fee", "commission_pct", "commission_amount", "order_total", "refund_amount",
        "net_revenue", "item_count")


def fct_deliveries(matching: DataFrame, orders: DataFrame) -> DataFrame:
    keys = orders.select("order_id", "customer_id", "restaurant_id", "zone_id")
    return matching.join(keys, "order_id").select(
        "order_id", "customer_id", "restaurant_id", "zone_id",
        F.to_date("placed_at").alias("date_day"), "placed_at", "accepted_rider_id",
        "total_attempts", "was_matched", "accepted_at",
        seconds_between(F.col("placed_at"), F.col("accepted_at")).alias("seconds_to_accept"))


def dim_customer(staged: DataFrame) -> DataFrame:
    return staged.select("customer_id", "customer_ref", "email_hash", "phone_masked", "full_name",
                         "city_id", "home_zone_id", "lat", "lon", "signup_ts")


def dim_zone(zones: DataFrame, cities: DataFrame) -> DataFrame:
    c = cities.select("city_id", F.col("name").alias("city_name"), "country_code", "timezone")
    return zones.withColumnRenamed("name", "zone_name").join(c, "city_id").select(
        "zone_id", "zone_name", "center_lat", "center_lon", "ring", "base_delivery_fee",
        "sla_target_minutes", "is_active", "city_id", "city_name", "country_code", "timezone")


def dim_date(demand_daily: DataFrame) -> DataFrame:
    return demand_daily.select(
        F.col("order_date").alias("date_day"), "day_index", "weekday", "dow_multiplier",
        "event_multiplier", is_weekend(F.col("order_date")).alias("is_weekend"), "event_names")


def dim_restaurant(restaurants: DataFrame) -> DataFrame:
    return restaurants.select("restaurant_id", "restaurant_ref", "name", "cuisine_type", "city_id",
                              "zone_id", "commission_pct", "prep_time_p50_minutes", "is_active")


def dim_rider(riders: DataFrame) -> DataFrame:
    return riders.select("rider_id", "rider_ref", "vehicle_type", "payout_tier", "home_zone_id",
                         "is_active")


def _contract(columns: str) -> list[tuple[str, str]]:
    return [tuple(c.split(" ")) for c in columns.split(", ")]


# The column names and types that each mart promises.
CONTRACTS = {
    "fct_orders": _contract(
        "order_id bigint, order_ref string, customer_id bigint, restaurant_id bigint, "
        "zone_id bigint, date_day date, placed_at timestamp, order_status string, "
        "subtotal decimal(18,2), delivery_fee decimal(18,2), commission_pct decimal(5,4), "
        "commission_amount decimal(18,2), order_total decimal(18,2), "
        "refund_amount decimal(18,2), net_revenue decimal(18,2), item_count bigint"),
    "fct_deliveries": _contract(
        "order_id bigint, customer_id bigint, restaurant_id bigint, zone_id bigint, "
        "date_day date, placed_at timestamp, accepted_rider_id bigint, total_attempts bigint, "
        "was_matched boolean, accepted_at timestamp, seconds_to_accept bigint"),
    "dim_customer": _contract(
        "customer_id bigint, customer_ref string, email_hash string, phone_masked string, "
        "full_name string, city_id bigint, home_zone_id bigint, lat double, lon double, "
        "signup_ts timestamp"),
    "dim_zone": _contract(
        "zone_id bigint, zone_name string, center_lat double, center_lon double, ring int, "
        "base_delivery_fee decimal(18,2), sla_target_minutes int, is_active boolean, "
        "city_id bigint, city_name string, country_code string, timezone string"),
    "dim_date": _contract(
        "date_day date, day_index int, weekday int, dow_multiplier double, "
        "event_multiplier double, is_weekend boolean, event_names string"),
    "dim_restaurant": _contract(
        "restaurant_id bigint, restaurant_ref string, name string, cuisine_type string, "
        "city_id bigint, zone_id bigint, commission_pct decimal(5,4), "
        "prep_time_p50_minutes int, is_active boolean"),
    "dim_rider": _contract(
        "rider_id bigint, rider_ref string, vehicle_type string, payout_tier string, "
        "home_zone_id bigint, is_active boolean"),
}

# What each model reads; the answer key must never appear.
LINEAGE = {
    "stg_orders": ["orders"], "stg_refunds": ["refunds"], "stg_customers": ["customers"],
    "int_order_economics": ["stg_orders", "stg_order_items", "stg_refunds"],
    "int_order_matching": ["stg_orders", "stg_match_attempts"],
    "fct_orders": ["int_order_economics"], "fct_deliveries": ["int_order_matching", "stg_orders"],
    "dim_customer": ["stg_customers"], "dim_zone": ["stg_zones", "stg_cities"],
    "dim_date": ["stg_demand_daily"], "dim_restaurant": ["stg_restaurants"],
    "dim_rider": ["stg_riders"],
}

# Tables that only judge results; a mart that reads one, also through a copy, is refused.
ANSWER_KEY = ["labels"]
