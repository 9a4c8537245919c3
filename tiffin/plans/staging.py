"""Staging models: one row in, one row out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.functions import money, privacy, text

# Column whitelists of the pass-through models.
PASS_THROUGH = {
    "cities": ["city_id", "name", "country_code", "timezone", "lat", "lon", "created_at",
               "updated_at"],
    "zones": ["zone_id", "city_id", "name", "center_lat", "center_lon", "ring",
              "base_delivery_fee", "sla_target_minutes", "is_active", "created_at", "updated_at"],
    "restaurants": ["restaurant_id", "restaurant_ref", "name", "cuisine_type", "city_id",
                    "zone_id", "lat", "lon", "commission_pct", "payout_account_id",
                    "prep_time_p50_minutes", "is_active", "created_at", "updated_at"],
    "riders": ["rider_id", "rider_ref", "vehicle_type", "payout_tier", "home_zone_id",
               "payout_account_id", "is_active", "created_at", "updated_at"],
    "menu_items": ["menu_item_id", "restaurant_id", "name", "category", "price", "is_available",
                   "created_at", "updated_at"],
    "rider_payout_tiers": ["tier", "valid_from", "valid_to", "base_fare", "per_km_rate",
                           "per_minute_rate"],
    "demand_daily": ["day_index", "order_date", "weekday", "dow_multiplier", "event_multiplier",
                     "noise", "total_multiplier", "orders", "event_names"],
    "demand_hourly": ["day_index", "order_date", "hour", "orders"],
    "order_items": ["order_item_id", "order_id", "menu_item_id", "quantity", "unit_price",
                    "line_total"],
    "match_attempts": ["match_id", "order_id", "rider_id", "attempt_number", "offered_at",
                       "response", "responded_at"],
    "payments": ["payment_id", "order_id", "amount", "method", "status", "paid_at"],
}


def passed(df: DataFrame, model: str) -> DataFrame:
    return df.select(*PASS_THROUGH[model])


def stg_orders(orders: DataFrame) -> DataFrame:
    raw = F.col("delivery_notes")
    clean = text.sentence_case(raw)
    return orders.select(
        "order_id", "order_ref", "customer_id", "restaurant_id", "zone_id", "placed_at",
        "order_status", "subtotal", "delivery_fee", "commission_pct", "commission_amount",
        "order_total", clean.alias("delivery_notes"),
        (raw.isNotNull() & (raw != clean)).alias("was_text_noise_defect"))


def stg_refunds(refunds: DataFrame) -> DataFrame:
    raw = F.col("refund_amount_raw")
    return refunds.select(
        "refund_id", "order_id", "payment_id", money.positive_amount(raw).alias("refund_amount"),
        money.is_accounting_text(raw).alias("was_money_text_defect"), "reason", "refunded_at")


def stg_customers(customers: DataFrame, salt: str) -> DataFrame:
    return customers.select(
        "customer_id", "customer_ref", privacy.email_hash(F.col("email"), salt).alias("email_hash"),
        privacy.phone_masked(F.col("phone")).alias("phone_masked"), "full_name", "city_id",
        "home_zone_id", "lat", "lon", "signup_ts", "created_at", "updated_at")


def visible_part(df: DataFrame, hidden: list[str]) -> DataFrame:
    """What the pipeline may read."""
    return df.drop(*hidden)


def profile_part(df: DataFrame, key: str, hidden: list[str]) -> DataFrame:
    """What only the generator may read."""
    return df.select(key, *hidden)
