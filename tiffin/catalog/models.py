"""Queries: staging models, intermediate models and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tiffin.catalog.oracle import SALT
from tiffin.catalog.registry import query
from tiffin.operators.quality import enforce
from tiffin.operators.slices import contiguous_ids
from tiffin.plans import marts, staging
from tiffin.plans.demand import actual_daily, actual_hourly
from tiffin.sources.bronze import Bronze


def stg_orders(b: Bronze):
    return staging.stg_orders(b.orders())


def stg_refunds(b: Bronze):
    return staging.stg_refunds(b.refunds())


def economics(b: Bronze):
    return marts.order_economics(stg_orders(b), b.lines(), stg_refunds(b))


def matching(b: Bronze):
    return marts.order_matching(b.order_heads(), b.match_attempts())


def fct_orders(b: Bronze):
    return enforce(marts.fct_orders(economics(b)), marts.CONTRACTS["fct_orders"], "fct_orders")


def order_items(b: Bronze):
    """Order items with a contiguous id; file and row position only separate equal rows."""
    raw = b.raw("lineitem").select("*", F.col("_metadata.file_name").alias("_f"),
                                   F.col("_metadata.row_index").alias("_r"))
    lines = raw.selectExpr(
        "l_orderkey as order_id", "l_linenumber as line_no", "l_partkey as menu_item_id",
        "cast(l_quantity as int) as quantity",
        "cast(cast(cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint) "
        "as double) / 100 as decimal(18,2)) as unit_price",
        "cast(l_extendedprice as decimal(18,2)) as line_total", "_f", "_r")
    return contiguous_ids(lines, ["order_id", "line_no", "menu_item_id", "quantity", "line_total",
                                  "_f", "_r"], "order_item_id").drop("_f", "_r")


_PLAIN = {
    "cities": ("b_cities", Bronze.cities), "zones": ("b_zones", Bronze.zones),
    "restaurants": ("b_restaurants", Bronze.restaurants), "riders": ("b_riders", Bronze.riders),
    "menu_items": ("b_menu_items", Bronze.menu_items),
    "rider_payout_tiers": (None, None),
    "demand_daily": ("m_demand_daily", actual_daily),
    "demand_hourly": ("m_demand_hourly", actual_hourly),
    "order_items": ("b_items", order_items),
    "match_attempts": ("b_attempts", Bronze.match_attempts),
    "payments": ("b_payments", Bronze.payments),
}


def _register_pass_through(model: str, view: str, source) -> None:
    cols = ", ".join(staging.PASS_THROUGH[model])

    @query(f"p01_stg_{model}", f"select {cols} from {view}")
    def _stg(b: Bronze):
        return staging.passed(source(b), model)


for _model, (_view, _source) in _PLAIN.items():
    if _view:
        _register_pass_through(_model, _view, _source)


@query("p01_stg_rider_payout_tiers", """
select t.tier, valid_from, valid_to, base_fare, per_km_rate, per_minute_rate, n_riders
from b_tiers t join (select payout_tier, count(*) as n_riders from b_riders group by payout_tier) r
 on r.payout_tier = t.tier""")
def p01_tiers(b: Bronze):
    """The rate card of the tiers that riders actually hold."""
    held = b.riders().groupBy(F.col("payout_tier").alias("tier")).agg(
        F.count(F.lit(1)).alias("n_riders"))
    card = staging.passed(b.rider_payout_tiers(), "rider_payout_tiers")
    return card.join(held, "tier").select(*staging.PASS_THROUGH["rider_payout_tiers"], "n_riders")


@query("d01_stg_orders", "select * from m_stg_orders")
def d01(b: Bronze):
    return stg_orders(b)


@query("d02_stg_refunds", "select * from m_stg_refunds")
def d02(b: Bronze):
    return stg_refunds(b)


@query("d03_stg_customers", "select * from m_stg_customers")
def d03(b: Bronze):
    return staging.stg_customers(b.customers(), SALT)


@query("d04_int_order_economics", "select * from m_economics")
def d04(b: Bronze):
    return economics(b)


@query("d05_int_order_matching", "select * from m_matching")
def d05(b: Bronze):
    return matching(b)


@query("d06_fct_orders", "select * from m_fct_orders")
def d06(b: Bronze):
    return fct_orders(b)


@query("d07_fct_deliveries", "select * from m_fct_deliveries")
def d07(b: Bronze):
    return enforce(marts.fct_deliveries(matching(b), b.shells()),
                   marts.CONTRACTS["fct_deliveries"], "fct_deliveries")


@query("d08_dim_customer", """select customer_id, customer_ref, email_hash, phone_masked, full_name,
 city_id, home_zone_id, lat, lon, signup_ts from m_stg_customers""")
def d08(b: Bronze):
    return enforce(marts.dim_customer(staging.stg_customers(b.customers(), SALT)),
                   marts.CONTRACTS["dim_customer"], "dim_customer")


@query("d09_dim_zone", """
select z.zone_id, z.name as zone_name, z.center_lat, z.center_lon, z.ring, z.base_delivery_fee,
 z.sla_target_minutes, z.is_active, c.city_id, c.name as city_name, c.country_code, c.timezone
from b_zones z join b_cities c on c.city_id = z.city_id""")
def d09(b: Bronze):
    return enforce(marts.dim_zone(b.zones(), b.cities()), marts.CONTRACTS["dim_zone"], "dim_zone")


@query("d10_dim_date", """
select order_date as date_day, day_index, weekday, dow_multiplier, event_multiplier,
 dayofweek(order_date) in (0, 6) as is_weekend, event_names from m_demand_daily""")
def d10(b: Bronze):
    return enforce(marts.dim_date(actual_daily(b)), marts.CONTRACTS["dim_date"], "dim_date")


@query("d11_dim_restaurant", """select restaurant_id, restaurant_ref, name, cuisine_type, city_id,
 zone_id, commission_pct, prep_time_p50_minutes, is_active from b_restaurants""")
def d11_restaurant(b: Bronze):
    return enforce(marts.dim_restaurant(b.restaurants()), marts.CONTRACTS["dim_restaurant"],
                   "dim_restaurant")


@query("d11_dim_rider", """select rider_id, rider_ref, vehicle_type, payout_tier, home_zone_id,
 is_active from b_riders""")
def d11_rider(b: Bronze):
    return enforce(marts.dim_rider(b.riders()), marts.CONTRACTS["dim_rider"], "dim_rider")
