"""Names and types of the bronze tables, in order (fixed values)."""

from __future__ import annotations


def _columns(text: str) -> list[tuple[str, str]]:
    return [tuple(c.split(" ")) for c in text.split(", ")]


BRONZE = {
    "cities": _columns(
        "city_id bigint, name string, country_code string, timezone string, lat double, "
        "lon double, created_at timestamp, updated_at timestamp"),
    "zones": _columns(
        "zone_id bigint, city_id bigint, name string, center_lat double, center_lon double, "
        "ring int, base_delivery_fee decimal(18,2), sla_target_minutes int, is_active boolean, "
        "created_at timestamp, updated_at timestamp"),
    "restaurants": _columns(
        "restaurant_id bigint, restaurant_ref string, name string, cuisine_type string, "
        "city_id bigint, zone_id bigint, lat double, lon double, commission_pct decimal(5,4), "
        "payout_account_id string, prep_time_p50_minutes int, is_active boolean, "
        "created_at timestamp, updated_at timestamp"),
    "riders": _columns(
        "rider_id bigint, rider_ref string, vehicle_type string, payout_tier string, "
        "home_zone_id bigint, payout_account_id string, is_active boolean, "
        "created_at timestamp, updated_at timestamp"),
    "menu_items": _columns(
        "menu_item_id bigint, restaurant_id bigint, name string, category string, "
        "price decimal(18,2), is_available boolean, created_at timestamp, updated_at timestamp"),
    "rider_payout_tiers": _columns(
        "tier string, valid_from timestamp, valid_to timestamp, base_fare decimal(18,2), "
        "per_km_rate decimal(18,4), per_minute_rate decimal(18,4)"),
    "demand_daily": _columns(
        "day_index int, order_date date, weekday int, dow_multiplier double, "
        "event_multiplier double, noise double, total_multiplier double, orders int, "
        "event_names string"),
    "demand_hourly": _columns("day_index int, order_date date, hour int, orders int"),
    "customers": _columns(
        "customer_id bigint, customer_ref string, email string, phone string, full_name string, "
        "city_id bigint, home_zone_id bigint, lat double, lon double, signup_ts timestamp, "
        "created_at timestamp, updated_at timestamp"),
    "orders": _columns(
        "order_id bigint, order_ref string, customer_id bigint, restaurant_id bigint, "
        "zone_id bigint, placed_at timestamp, order_status string, subtotal decimal(18,2), "
        "delivery_fee decimal(18,2), commission_pct decimal(5,4), "
        "commission_amount decimal(18,2), order_total decimal(18,2), delivery_notes string"),
    "order_items": _columns(
        "order_item_id bigint, order_id bigint, menu_item_id bigint, quantity int, "
        "unit_price decimal(18,2), line_total decimal(18,2)"),
    "match_attempts": _columns(
        "match_id bigint, order_id bigint, rider_id bigint, attempt_number int, "
        "offered_at timestamp, response string, responded_at timestamp"),
    "payments": _columns(
        "payment_id bigint, order_id bigint, amount decimal(18,2), method string, status string, "
        "paid_at timestamp"),
    "refunds": _columns(
        "refund_id bigint, order_id bigint, payment_id bigint, refund_amount_raw string, "
        "reason string, refunded_at timestamp"),
}
