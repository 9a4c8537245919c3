"""Queries: projections, filters, joins, aggregates, windows, limits and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tiffin.catalog.models import economics, fct_orders, matching
from tiffin.catalog.oracle import draw, view
from tiffin.catalog.registry import query
from tiffin.catalog.synthesis import made_customers
from tiffin.functions.clock import seconds_between
from tiffin.functions.draws import by_threshold, md5_draw
from tiffin.functions.text import match_key
from tiffin.operators import asof, layout, quality, sketches, skew, slices, vectors
from tiffin.operators.islands import capped_shifts, islands, median_length, overlap_flags
from tiffin.plans import events as ev
from tiffin.plans import finance, staging
from tiffin.session import scratch
from tiffin.sources.bronze import Bronze
from tiffin.sources.tables import VersionedTable

# -- shared frames -----------------------------------------------------------------------------

view("m_order_facts", """
select order_id, customer_id, restaurant_id, zone_id, cast(n_regionkey as bigint) as city_id, placed_at,
 cast(placed_at as date) as order_date, order_status, order_id % 7 * 10 as surge_cents,
 order_id % 5 * 20 as tip_cents, case when order_id % 11 = 0 then 150 else 0 end as promo_cents,
 case when order_id % 11 = 0 then 75 else 0 end as platform_promo_cents,
 1500 + order_id % 500 as courier_earned_cents, cast(subtotal * 100 as bigint) as subtotal_cents,
 cast(delivery_fee * 100 as bigint) as delivery_fee_cents,
 30 + cast(subtotal * 100 as bigint) // 50 as psp_fee_cents
from b_orders join nation on n_nationkey = zone_id""")


def order_facts(b: Bronze):
    """Orders in cents with their city; surcharges follow from the key."""
    cities = b.zones().select("zone_id", "city_id")
    return b.orders().join(cities, "zone_id").selectExpr(
        "order_id", "customer_id", "restaurant_id", "zone_id", "city_id", "placed_at",
        "to_date(placed_at) as order_date", "order_status", "order_id % 7 * 10 as surge_cents",
        "order_id % 5 * 20 as tip_cents", "if(order_id % 11 = 0, 150, 0) as promo_cents",
        "if(order_id % 11 = 0, 75, 0) as platform_promo_cents",
        "1500 + order_id % 500 as courier_earned_cents",
        "cast(subtotal * 100 as bigint) as subtotal_cents",
        "cast(delivery_fee * 100 as bigint) as delivery_fee_cents",
        "30 + cast(subtotal * 100 as bigint) div 50 as psp_fee_cents")


# -- projections and filters -------------------------------------------------------------------


@query("p02_restaurants_visible", """select restaurant_id, restaurant_ref, name, cuisine_type,
 city_id, zone_id from b_restaurants""")
def p02_visible(b: Bronze):
    both = b.restaurants().select("restaurant_id", "restaurant_ref", "name", "cuisine_type",
                                  "city_id", "zone_id").withColumn("price_index", F.lit(1.0))
    return staging.visible_part(both, ["price_index"])


@query("p02_customer_profile", f"""select c_custkey as customer_id,
 round(exp(0.75 * sqrt(-2.0 * ln({draw(10, 'c_custkey')} / 1000000.0 + 1e-9))
  * cos(2.0 * pi() * ({draw(11, 'c_custkey')} / 1000000.0))), 6) as order_propensity
from customer""")
def p02_profile(b: Bronze):
    return made_customers(b)[1].withColumn("order_propensity", F.round("order_propensity", 6))


@query("p03_accepted_offers", """select match_id, order_id, rider_id from b_attempts
 where response = 'ACCEPTED'""")
def p03(b: Bronze):
    return b.match_attempts().filter("response = 'ACCEPTED'").select("match_id", "order_id",
                                                                     "rider_id")


@query("p04_date_range", """select order_id, date_day, order_total from m_fct_orders
 where date_day between date '1996-06-03' and date '1996-09-06'""")
def p04(b: Bronze):
    """A range of a computed day, which implies one of the stored date below all joins."""
    lo, hi = "1996-06-03", "1996-09-06"
    inside = b.between_days(lo, hi)
    return fct_orders(inside).filter(F.col("date_day").between(lo, hi)).select(
        "order_id", "date_day", "order_total")


@query("p05_threshold_bucket", f"""select order_id, case when {draw(5, 'order_id')} < 450000
 then 'upi' when {draw(5, 'order_id')} < 750000 then 'card' when {draw(5, 'order_id')} < 900000
 then 'wallet' else 'cod' end as method from b_heads""")
def p05(b: Bronze):
    return b.order_heads().select("order_id", by_threshold(
        md5_draw(5, "order_id"), [(450_000, "upi"), (750_000, "card"), (900_000, "wallet")],
        "cod").alias("method"))


@query("p06_null_guard", """select order_id, accepted_at, case when accepted_at is not null then
 (epoch_us(accepted_at) // 1000000) - (epoch_us(placed_at) // 1000000) end as seconds_to_accept
from m_matching""")
def p06(b: Bronze):
    return matching(b).select("order_id", "accepted_at", F.when(
        F.col("accepted_at").isNotNull(), seconds_between(F.col("placed_at"), F.col("accepted_at")))
        .alias("seconds_to_accept"))


@query("p07_null_safe_difference", """select shift_id, login_at, logout_at from b_shifts
 where logout_at is distinct from login_at + to_hours(3)""")
def p07(b: Bronze):
    planned = F.timestamp_add("HOUR", F.lit(3), "login_at")
    return b.courier_shifts().filter(~F.col("logout_at").eqNullSafe(planned)).select(
        "shift_id", "login_at", "logout_at")


@query("p08_coalesce_after_outer", """select o_orderkey as order_id, coalesce(n, 0) as n_lines
from orders left join (select order_id, count(*) as n from b_lines group by order_id)
 on order_id = o_orderkey""")
def p08(b: Bronze):
    counts = b.lines().groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    orders = b.raw("orders").select(F.col("o_orderkey").alias("order_id"))
    return orders.join(counts, "order_id", "left").select(
        "order_id", F.coalesce("n", F.lit(0)).alias("n_lines"))


view("m_claims", """
select c.*, case when trim(amount_usd) ~ '^\\([0-9]+(\\.[0-9]+)?\\)$' then
 -cast(cast(regexp_replace(amount_usd, '[() ]', '', 'g') as decimal(18,2)) * 100 as bigint) end
 as amount_cents,
 case when not (trim(amount_usd) ~ '^\\([0-9]+(\\.[0-9]+)?\\)$') then 'MONEY_UNPARSEABLE'
  when p.payment_id is null then 'ORPHAN_PAYMENT_REF' end as reason_code
from b_claims c left join b_payments p on p.payment_id = c.payment_id""")


def claims(b: Bronze):
    return finance.flagged_claims(b.refund_claims(), b.payments())


@query("p09_reason_codes", "select refund_id, payment_id, amount_cents, reason_code from m_claims")
def p09(b: Bronze):
    return claims(b).select("refund_id", "payment_id", "amount_cents", "reason_code")


@query("p10_accepted", """select refund_id, order_id, amount_cents from m_claims
 where reason_code is null""")
def p10(b: Bronze):
    return claims(b).filter("reason_code is null").select("refund_id", "order_id", "amount_cents")


@query("p10_rejected", """select refund_id, order_id, reason_code from m_claims
 where reason_code is not null""")
def p10_rejected(b: Bronze):
    return claims(b).filter("reason_code is not null").select("refund_id", "order_id",
                                                              "reason_code")


view("m_lagged", """select *, (epoch_us(received_at) // 1000000)
 - (epoch_us(occurred_at) // 1000000) as lag_seconds from b_events""")


@query("p11_late_rows", "select event_id, lag_seconds from m_lagged where lag_seconds > 72000")
def p11(b: Bronze):
    return ev.with_lag(b.order_events()).filter("lag_seconds > 72000").select("event_id",
                                                                             "lag_seconds")


# -- joins -----------------------------------------------------------------------------------


@query("j01_fact_to_dimension", """select o.order_id, r.cuisine_type, o.zone_id from b_shells o
 join b_restaurants r on r.restaurant_id = o.restaurant_id""")
def j01(b: Bronze):
    dim = b.restaurants().select("restaurant_id", "cuisine_type")
    return b.shells().join(dim, "restaurant_id").select("order_id", "cuisine_type", "zone_id")


@query("j02_left_to_aggregate", """select order_id, item_count, refund_amount from m_economics""")
def j02(b: Bronze):
    return economics(b).select("order_id", "item_count", "refund_amount")


@query("j03_full_outer_compare", """
select coalesce(e.day_index, a.day_index) as day_index, coalesce(e.hour, a.hour) as hour,
 coalesce(e.n, 0) as expected, coalesce(a.n, 0) as actual
from (select day_index, hour, cast(case when hour = 3 then orders + 1 else orders end as bigint) as n
  from m_demand_hourly where hour <> 5) e
full join (select day_index, hour, cast(orders as bigint) as n from m_demand_hourly) a
 on a.day_index = e.day_index and a.hour = e.hour
where coalesce(e.n, 0) <> coalesce(a.n, 0)""")
def j03(b: Bronze):
    """A plan that forgets one hour and overstates another, against what happened."""
    from tiffin.plans.demand import actual_hourly
    hourly = actual_hourly(b).select("day_index", "hour", "orders")
    plan = hourly.filter("hour <> 5").withColumn(
        "orders", F.col("orders") + (F.col("hour") == 3).cast("int"))
    rows = slices.expanded(hourly, "orders", "i").select("day_index", "hour")
    return quality.volume_mismatch(rows, plan)


@query("j04_orphans", "select refund_id, payment_id from m_claims where payment_id < 0")
def j04(b: Bronze):
    return quality.relationships(b.refund_claims().select("refund_id", "payment_id"), "payment_id",
                                 b.payments(), "payment_id", b.tasks("orders")
                                 ).select("refund_id", "payment_id")


view("m_tier_orders", """select a.order_id, r.payout_tier as tier, a.responded_at
 from b_attempts a join b_riders r on r.rider_id = a.rider_id where a.response = 'ACCEPTED'""")


@query("j08_version_asof", """select o.order_id, o.tier, t.base_fare, t.per_km_rate
from m_tier_orders o left join b_tiers t on t.tier = o.tier and o.responded_at >= t.valid_from
 and o.responded_at < coalesce(t.valid_to, timestamp '9999-12-31')""")
def j08(b: Bronze):
    """The payout rate of the rider's tier at the time of acceptance."""
    tiers = b.riders().select("rider_id", F.col("payout_tier").alias("tier"))
    trips = (b.match_attempts().filter("response = 'ACCEPTED'").join(tiers, "rider_id")
             .select("order_id", "tier", "responded_at"))
    card = b.rider_payout_tiers().select("tier", "valid_from", "valid_to", "base_fare",
                                         "per_km_rate")
    return asof.version_join(trips, card, ["tier"], "responded_at").select(
        "order_id", "tier", "base_fare", "per_km_rate")


view("m_fee", """select order_id, order_date, restaurant_id, city_id, platform_fee_cents,
 cast(p as integer) as precedence from (
 select o.*, f.platform_fee_cents, case scope when 'RESTAURANT' then 1 when 'CITY' then 2 else 3 end
  as p, row_number() over (partition by order_id order by case scope when 'RESTAURANT' then 1
   when 'CITY' then 2 else 3 end, fee_schedule_id) as rn
 from m_order_facts o join b_fees f on order_date >= effective_from
  and order_date < coalesce(effective_to, date '9999-12-31')
  and (scope = 'GLOBAL' or (scope = 'CITY' and scope_key = cast(city_id as varchar))
   or (scope = 'RESTAURANT' and scope_key = cast(restaurant_id as varchar)))) where rn = 1""")


@query("j09_fee_precedence_asof", "select * from m_fee")
def j09(b: Bronze):
    facts = order_facts(b).select("order_id", "order_date", "restaurant_id", "city_id")
    return finance.fee_asof(facts, b.fee_schedule())


@query("j10_tax_asof", """select o.order_id, t.tax_rate_bps from m_order_facts o
 join b_taxes t on t.city_id = o.city_id and order_date >= effective_from
 and order_date < coalesce(effective_to, date '9999-12-31')""")
def j10(b: Bronze):
    facts = order_facts(b).select("order_id", "order_date", "city_id")
    return finance.tax_asof(facts, b.tax_jurisdictions()).select("order_id", "tax_rate_bps")


@query("j12_existence_left_join", """select refund_id, payment_id from m_claims
 where reason_code = 'ORPHAN_PAYMENT_REF'""")
def j12(b: Bronze):
    return claims(b).filter("reason_code = 'ORPHAN_PAYMENT_REF'").select("refund_id", "payment_id")


@query("j13_never_captured", """select order_id, amount_cents from b_movements a
 where kind = 'AUTH' and status = 'SUCCEEDED' and not exists (select 1 from b_movements c
  where c.order_id = a.order_id and c.kind = 'CAPTURE' and c.status = 'SUCCEEDED')""")
def j13(b: Bronze):
    done = b.money_movements().filter("status = 'SUCCEEDED'")
    captured = done.filter("kind = 'CAPTURE'").select("order_id")
    return done.filter("kind = 'AUTH'").join(captured, "order_id", "left_anti").select(
        "order_id", "amount_cents")


@query("j14_pending_work", """select review_id, lang from b_reviews
 where lang is distinct from 'en'""")
def j14(b: Bronze):
    """Reviews without a row in the results table for this model and version: version 1 has seen
    English only, version 2 and another model have seen all."""
    from tiffin.functions.text import keyword_sentiment
    from tiffin.plans.reviews import pending
    rows = b.reviews().select("review_id", "lang", "review_text")

    def results(of, model, version):
        return of.select("review_id", F.lit(model).alias("model"),
                         F.lit(version).alias("prompt_version"),
                         keyword_sentiment(F.col("review_text")).alias("sentiment"))
    english = results(rows.filter("lang = 'en'"), "keywords", "v1")
    table = VersionedTable(b.spark, scratch(b.spark, "results"), english.schema,
                           F.concat_ws("-", "model", "prompt_version"))
    table.append(english)
    table.append(results(rows, "keywords", "v2"))
    table.append(results(rows, "other", "v1"))
    done = table.read(F.col("_part") == "keywords-v1")
    return pending(rows.select("review_id", "lang"), done, "review_id", model="keywords",
                   prompt_version="v1")


@query("j15_actual_and_expected", """select
 cast(sum(case when kind = 'CAPTURE' then amount_cents end) as bigint) as captured, (select cast(sum(cast(order_total * 100 as bigint)) as bigint) from b_payments p
  join b_orders o on o.order_id = p.order_id where p.status = 'SUCCESS') as expected
from b_movements where status = 'SUCCEEDED'""")
def j15(b: Bronze):
    """Two one-row results side by side; the second is a scalar subquery."""
    expected = b.payments().filter("status = 'SUCCESS'").agg(
        F.sum((F.col("amount") * 100).cast("bigint"))).scalar()
    return (b.money_movements().filter("status = 'SUCCEEDED'")
            .agg(F.sum(F.when(F.col("kind") == "CAPTURE", F.col("amount_cents"))).alias("captured"))
            .withColumn("expected", expected))


@query("j16_null_safe_match", """select l.shift_id, r.shift_id as other_id, l.logout_at
from b_shifts l join b_shifts r on l.shift_id = r.shift_id + 67
 and l.logout_at is not distinct from r.logout_at""")
def j16(b: Bronze):
    """NULL keys that match each other: pairs of shifts that are both still open."""
    other = b.courier_shifts().select((F.col("shift_id") + 67).alias("k"),
                                      F.col("shift_id").alias("other_id"),
                                      F.col("logout_at").alias("_out"))
    same = (F.col("shift_id") == F.col("k")) & F.col("logout_at").eqNullSafe(F.col("_out"))
    return b.courier_shifts().join(other, same).select("shift_id", "other_id", "logout_at")


# -- aggregates --------------------------------------------------------------------------------


@query("a01_count_per_key", "select order_id, count(*) as n from b_attempts group by order_id")
def a01(b: Bronze):
    return b.match_attempts().groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))


@query("a02_decimal_sum", """select order_id, cast(sum(line_total) as decimal(18,2)) as subtotal
 from b_lines group by order_id""")
def a02(b: Bronze):
    return b.lines().groupBy("order_id").agg(F.sum("line_total").cast("decimal(18,2)")
                                             .alias("subtotal"))


@query("a03_filtered_total", """select count(*) as n, cast(sum(order_total) as decimal(28,2))
 as revenue from m_fct_orders where order_status = 'DELIVERED'""")
def a03(b: Bronze):
    return b.orders().filter("order_status = 'DELIVERED'").agg(
        F.count(F.lit(1)).alias("n"), F.sum("order_total").cast("decimal(28,2)").alias("revenue"))


_ZONE_REVENUE = """select zone_id, order_status, count(*) as n,
 cast(sum(order_total) as decimal(28,2)) as revenue from b_orders group by zone_id, order_status"""


def zone_revenue(b: Bronze):
    return b.orders().groupBy("zone_id", "order_status").agg(
        F.count(F.lit(1)).alias("n"), F.sum("order_total").cast("decimal(28,2)").alias("revenue"))


@query("a04_zone_status_revenue", _ZONE_REVENUE)
def a04(b: Bronze):
    return zone_revenue(b)


@query("k01_top_zones", f"select * from ({_ZONE_REVENUE}) order by revenue desc, zone_id, "
       "order_status limit 20")
def k01(b: Bronze):
    return zone_revenue(b).orderBy(F.desc("revenue"), "zone_id", "order_status").limit(20)


@query("a05_having", """select order_id, line_no, count(*) as n_rows from b_lines
 group by order_id, line_no having count(*) > 1""")
def a05(b: Bronze):
    return b.lines().groupBy("order_id", "line_no").agg(F.count(F.lit(1)).alias("n_rows")) \
        .filter("n_rows > 1")


_MEASURED = """select 'layout_' || cast(l_suppkey % 4 as varchar) as layout,
 cast(l_partkey as varchar) as query_name, cast(l_quantity as double) as duration_ms,
 case when l_suppkey % 4 = 2 and l_partkey % 500 = 7 then null
  else cast(l_quantity as bigint) * 1000 + l_suppkey % 4 end as bytes_scanned from lineitem"""
view("m_measured", _MEASURED)


def measured(b: Bronze):
    """Measurements in the shape of layout results, one layout with a missing value."""
    return b.raw("lineitem", "l_suppkey", "l_partkey", "l_quantity").selectExpr(
        "concat('layout_', cast(l_suppkey % 4 as string)) as layout",
        "cast(l_partkey as string) as query_name", "l_quantity as duration_ms",
        "case when l_suppkey % 4 = 2 and l_partkey % 500 = 7 then null "
        "else cast(l_quantity as bigint) * 1000 + l_suppkey % 4 end as bytes_scanned")


@query("a07_least_bytes_winner", """select layout, cast(sum(bytes_scanned) as bigint) as total_bytes
 from m_measured group by layout having count(*) = count(bytes_scanned)
 order by total_bytes, layout limit 1""")
def a07(b: Bronze):
    return layout.winner(measured(b))


@query("a08_sum_with_missing", """select layout, round(sum(duration_ms), 2) as total_duration_ms,
 cast(sum(coalesce(bytes_scanned, 0)) as bigint) as total_bytes_scanned,
 cast(sum(case when bytes_scanned is null then 1 else 0 end) as bigint) as missing
from m_measured group by layout""")
def a08(b: Bronze):
    return layout.summary(measured(b)).withColumn("total_duration_ms",
                                                  F.round("total_duration_ms", 2))


@query("a09_usage_cost", """
select u.sku, u.quantity, p.unit_price, cast(coalesce(u.quantity * p.unit_price, 0)
 as decimal(18,2)) as cost
from (select p_brand as sku, cast(sum(cast(l_quantity as bigint)) as bigint) as quantity from lineitem
  join part on p_partkey = l_partkey group by 1) u
left join (select p_brand as sku, cast(arg_max(p_retailprice, p_partkey) as decimal(18,2))
  as unit_price from part where p_brand <> 'Brand#7' group by 1) p on p.sku = u.sku""")
def a09(b: Bronze):
    """Usage of brands at their latest price; one brand has none."""
    parts = b.raw("part", "p_partkey", "p_brand", "p_retailprice")
    usage = (b.raw("lineitem", "l_partkey", "l_quantity")
             .join(parts.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("sku")),
                   "l_partkey")
             .select("sku", F.col("l_quantity").cast("bigint").alias("quantity")))
    prices = parts.filter("p_brand <> 'Brand#7'").select(
        F.col("p_brand").alias("sku"), F.col("p_retailprice").cast("decimal(18,2)").alias("price"),
        F.col("p_partkey").alias("price_start"))
    return layout.usage_cost(usage, prices)


view("m_median", """select cast(quantile_disc((epoch_us(logout_at) // 1000000)
 - (epoch_us(login_at) // 1000000), 0.5) as bigint) as med from b_shifts
 where logout_at is not null""")
view("m_capped", """select shift_id, courier_id, login_at as shift_start,
 coalesce(logout_at, login_at + to_seconds((select med from m_median))) as shift_end,
 logout_at is null as was_open from b_shifts""")
view("m_marked", """select *, case when shift_start > max(shift_end) over (partition by courier_id
  order by shift_start, shift_id rows between unbounded preceding and 1 preceding) then 1 else 0 end
 as is_new_island from m_capped""")
view("m_islands", """select *, sum(is_new_island) over (partition by courier_id
 order by shift_start, shift_id rows unbounded preceding) as island_id from m_marked""")


@query("a10_island_bounds", """select courier_id, cast(island_id as bigint) as island_id,
 min(shift_start) as shift_start, max(shift_end) as shift_end, bool_or(was_open) as had_open
from m_islands group by 1, 2""")
def a10(b: Bronze):
    marked = islands(capped_shifts(b.courier_shifts()), "courier_id", "shift_start", "shift_end",
                     "shift_id")
    return marked.groupBy("courier_id", "island_id").agg(
        F.min("shift_start").alias("shift_start"), F.max("shift_end").alias("shift_end"),
        F.bool_or("was_open").alias("had_open"))


@query("a11_conditional_pivot", """select zone_id,
 cast(sum(case when order_status = 'DELIVERED' then 1 else 0 end) as bigint) as delivered,
 cast(sum(case when order_status = 'CANCELLED' then 1 else 0 end) as bigint) as cancelled,
 max(case when order_status = 'DELIVERED' then placed_at end) as last_delivered
from b_shells group by zone_id""")
def a11(b: Bronze):
    s = F.col("order_status")
    return b.shells().groupBy("zone_id").agg(
        F.count_if(s == "DELIVERED").alias("delivered"),
        F.count_if(s == "CANCELLED").alias("cancelled"),
        F.max(F.when(s == "DELIVERED", F.col("placed_at"))).alias("last_delivered"))


view("m_lifecycle", """select order_id,
 min(case when event_type = 'SIGNUP' then occurred_at end) as placed_at,
 min(case when event_type = 'CLICK' then occurred_at end) as matched_at,
 min(case when event_type = 'VIEW' then occurred_at end) as picked_up_at,
 min(case when event_type = 'PURCHASE' then occurred_at end) as delivered_at,
 min(case when event_type = 'ERROR' then occurred_at end) as cancelled_at,
 arg_max(event_type, struct_pack(a := occurred_at, b := event_id)) as terminal_state
from b_events group by order_id""")


@query("a12_lifecycle_pivot", "select * from m_lifecycle")
def a12(b: Bronze):
    return ev.lifecycle(b.order_events())


@query("a13_median_fill", """select m.med as median_seconds, count(*) as n_open from b_shifts,
 m_median m where logout_at is null group by 1""")
def a13(b: Bronze):
    shifts = b.courier_shifts()
    return shifts.agg(F.count_if(F.col("logout_at").isNull()).alias("n_open")).select(
        median_length(shifts).alias("median_seconds"), "n_open")


def _stored_by_day(b: Bronze, rows, sketch, name: str):
    """A sketch table with a partition per day: first half of the days, then the rest, then the last
    day once more, which replaces its own rows."""
    made = sketch(rows)
    table = VersionedTable(b.spark, scratch(b.spark, name), made.schema, F.col("day"))
    for condition in ("day < date'2024-01-16'", "day >= date'2024-01-16'", "day = date'2024-01-30'"):
        table.replace(sketch(rows.filter(condition)))
    return table.read()


_HLL = """select {key}, register, max(rank) as rank from (select *,
 case when low = 0 then 39 else 39 - length(bin(low)) end as rank from (select {key},
 h >> 38 as register, h & 274877906943 as low from (select {key},
 cast(('0x' || substr(md5(cast(order_id as varchar)), 1, 12)) as bigint) as h from b_events
 where order_id is not null))) group by {key}, register"""
_ESTIMATE = """select {key}, cast(round(case when raw <= 2560 and n < 1024
 then 1024.0::double * ln(1024.0::double / (1024 - n)) else raw end) as bigint) as n_orders from (
 select {key}, n, (0.7213::double / (1 + 1.079::double / 1024) * 1024 * 1024) / (s + (1024 - n))
 as raw from (select {key}, count(*) as n, sum(pow(2.0::double, -rank)) as s from ({hll})
 group by {key}))"""


@query("a14_approx_distinct", _ESTIMATE.format(key="event_type",
                                               hll=_HLL.format(key="event_type")))
def a14(b: Bronze):
    """Distinct orders per event type, estimated from registers kept per day and merged."""
    rows = b.order_events().withColumn("day", F.to_date("occurred_at"))
    kept = _stored_by_day(b, rows, lambda r: sketches.distinct_sketch(
        r, ["day", "event_type"], "order_id", hashed=sketches.md5_48), "registers")
    return sketches.estimated_distinct(sketches.merged_distinct(kept, ["event_type"]),
                                       ["event_type"], "n_orders")


@query("a13_lag_quantiles", """with e as (select event_type, (lag_seconds
  >> greatest(length(bin(lag_seconds)) - 8, 0)) << greatest(length(bin(lag_seconds)) - 8, 0) as edge
  from m_lagged where lag_seconds is not null),
 c as (select event_type, edge, sum(count(*)) over (partition by event_type order by edge) as upto,
  sum(count(*)) over (partition by event_type) as total from e group by event_type, edge)
select event_type, min(edge) filter (where upto >= total * 0.5) as median_lag,
 min(edge) filter (where upto >= total * 0.95) as p95_lag from c group by event_type""")
def a13_quantiles(b: Bronze):
    """Median and 95 % quantile of the lag per event type, from counts kept per day and merged."""
    rows = ev.with_lag(b.order_events()).withColumn("day", F.to_date("occurred_at"))
    kept = _stored_by_day(b, rows, lambda r: sketches.value_sketch(
        r, ["day", "event_type"], "lag_seconds"), "lag-counts")
    return sketches.quantiles(kept, ["event_type"], {"median_lag": 0.5, "p95_lag": 0.95})


@query("a15_damage_ratio", """select count(distinct delivery_notes) as raw_values,
 count(distinct lower(trim(delivery_notes))) as clean_values from b_heads""")
def a15(b: Bronze):
    """Distinct values before and after normalising. Values are grouped first, so the distinct
    count works on the few values that exist and not on all rows."""
    values = b.order_heads().groupBy("delivery_notes").agg(F.count(F.lit(1)).alias("_n"))
    return values.agg(F.countDistinct("delivery_notes").alias("raw_values"),
                      F.countDistinct(match_key(F.col("delivery_notes"))).alias("clean_values"))


@query("a21_courier_daily_seconds", """select courier_id, cast(shift_start as date) as work_day,
 cast(sum((epoch_us(shift_end) // 1000000) - (epoch_us(shift_start) // 1000000)) as bigint)
 as worked_seconds from (select courier_id, island_id, min(shift_start) as shift_start,
  max(shift_end) as shift_end from m_islands group by 1, 2) group by 1, 2""")
def a21(b: Bronze):
    from tiffin.operators.islands import merged_shifts
    merged = merged_shifts(b.courier_shifts(), "America/New_York")
    return merged.groupBy("courier_id", F.to_date("shift_start").alias("work_day")).agg(
        F.sum("worked_seconds").alias("worked_seconds"))


@query("a22_kpi_tiles", """
select (select cast(sum(amount_cents) as bigint) from b_movements where status = 'SUCCEEDED'
  and kind in ('CAPTURE', 'REFUND')) as net_cents,
 count(*) as rows_ingested, count(reason_code) as rows_rejected,
 round(cast(count(reason_code) as double) / count(*), 6) as quarantine_rate from m_claims""")
def a22(b: Bronze):
    net = b.money_movements().filter("status = 'SUCCEEDED' and kind in ('CAPTURE', 'REFUND')").agg(
        F.sum("amount_cents")).scalar()
    tiles = claims(b).agg(F.count(F.lit(1)).alias("rows_ingested"),
                          F.count("reason_code").alias("rows_rejected"))
    return tiles.select(net.alias("net_cents"), "rows_ingested", "rows_rejected", F.round(
        F.col("rows_rejected") / F.col("rows_ingested"), 6).alias("quarantine_rate"))


# -- windows -----------------------------------------------------------------------------------


@query("w01_first_per_key", """select order_id, event_type, occurred_at, event_id from (select *,
 row_number() over (partition by order_id, event_type, occurred_at order by received_at, event_id)
 as rn from b_events) where rn = 1""")
def w01(b: Bronze):
    return ev.deduplicated(b.order_events()).select("order_id", "event_type", "occurred_at",
                                                    "event_id")


@query("w05_running_max", "select shift_id, courier_id, is_new_island from m_marked")
def w05(b: Bronze):
    return islands(capped_shifts(b.courier_shifts()), "courier_id", "shift_start", "shift_end",
                   "shift_id").select("shift_id", "courier_id", "is_new_island")


@query("w06_running_sum", "select shift_id, cast(island_id as bigint) as island_id from m_islands")
def w06(b: Bronze):
    return islands(capped_shifts(b.courier_shifts()), "courier_id", "shift_start", "shift_end",
                   "shift_id").select("shift_id", "island_id")


@query("w07_previous_shift", """select shift_id, courier_id, lag(logout_at) over (
 partition by courier_id order by login_at, shift_id) as previous_logout from b_shifts""")
def w07(b: Bronze):
    return overlap_flags(b.courier_shifts()).select("shift_id", "courier_id", "previous_logout")


@query("w08_repeat_captures", """select payment_id, order_id, amount_cents from (select *,
 row_number() over (partition by order_id order by created_at, payment_id) as rn from b_movements
 where kind = 'CAPTURE' and status = 'SUCCEEDED') where rn > 1""")
def w08(b: Bronze):
    """All but the first capture; the first is folded per salt, not ranked in a window."""
    captures = b.money_movements().filter("kind = 'CAPTURE' and status = 'SUCCEEDED'")
    found = skew.attach(captures, ["order_id"], _first=("min", F.struct("created_at",
                                                                       "payment_id")))
    return found.filter("payment_id <> _first.payment_id").select("payment_id", "order_id",
                                                                  "amount_cents")


# -- limits ------------------------------------------------------------------------------------


@query("k02_violation_sample", """select order_id, line_no, n_rows from (select order_id, line_no,
 count(*) as n_rows from b_lines group by 1, 2 having count(*) > 1)
 order by order_id, line_no limit 6""")
def k02(b: Bronze):
    return quality.unique(b.lines(), ["order_id", "line_no"]).orderBy("order_id", "line_no") \
        .limit(quality.SAMPLE)


@query("k03_latest_per_key", """select p_brand as sku, cast(arg_max(p_retailprice, p_partkey)
 as decimal(18,2)) as price from part group by 1""")
def k03(b: Bronze):
    return b.raw("part", "p_brand", "p_partkey", "p_retailprice").groupBy(
        F.col("p_brand").alias("sku")).agg(
        F.max_by("p_retailprice", "p_partkey").cast("decimal(18,2)").alias("price"))


@query("k04_vector_top_k", """
select query_id, cast(position as integer) as position, review_id, round(score, 6) as score from (
 select query_id, review_id, score, row_number() over (partition by query_id
  order by score desc, review_id) as position from (
  select q.review_id as query_id, c.review_id,
   round(list_cosine_similarity(cast(q.vector as double[]), cast(c.vector as double[])), 12)
    as score
  from b_vectors c, (select * from b_vectors where cast(review_id as bigint) % 20 = 0) q))
 where position <= 10""")
def k04(b: Bronze):
    """The ten nearest vectors of every vector whose id is divisible by 20."""
    queries = b.vectors().filter(F.col("review_id").cast("bigint") % 20 == 0)
    return vectors.top_k(b.vectors(), queries, 10)


@query("k05_hash_sample", f"""select o_orderkey as order_id from orders
 where {draw(9, 'o_orderkey')} % 1000 < 71""")
def k05(b: Bronze):
    """A stable sample by key hash, not a limit."""
    return b.raw("orders").select(F.col("o_orderkey").alias("order_id")).filter(
        md5_draw(9, "order_id") % 1000 < 71)


# -- set operations ----------------------------------------------------------------------------


@query("u01_union_candidates", """select order_id, order_status, reason from b_refunds
 join b_heads using (order_id)""")
def u01(b: Bronze):
    from tiffin.functions.draws import pick
    from tiffin.sources.bronze import REASONS
    heads = b.order_heads().select("order_id", "order_status")
    cancelled = heads.filter("order_status = 'CANCELLED'").withColumn("reason", F.lit("CANCELLED"))
    partial = heads.filter("order_status = 'DELIVERED' and order_id % 1000 between 100 and 127") \
        .withColumn("reason", pick(REASONS, F.col("order_id")))
    return cancelled.unionByName(partial)


@query("u02_arrival_paths", """select event_id, order_id, event_type, occurred_at, _arrival_path
from (select *, row_number() over (partition by order_id, event_type, occurred_at
 order by _arrival_path, received_at, event_id) as rn
 from (select *, 'batch' as _arrival_path from b_events where event_id % 3 <> 0
  union all select *, 'stream' from b_events where event_id % 3 = 0 or event_id % 2 = 0)) where rn = 1""")
def u02(b: Bronze):
    """Every event arrives on one path or the other, some on both."""
    events = b.order_events()
    return ev.unioned(events.filter("event_id % 3 <> 0"), events.filter("event_id % 3 = 0 or event_id % 2 = 0")).select(
        "event_id", "order_id", "event_type", "occurred_at", "_arrival_path")


@query("u03_quarantine", """
select 'refunds' as source_table, cast(refund_id as varchar) as natural_key, reason_code from m_claims
 where reason_code is not null
union all select 'order_events', cast(event_id as varchar), 'DUP_EVENT' from (select event_id,
  row_number() over (partition by order_id, event_type, occurred_at order by received_at, event_id)
  as rn from b_events) where rn > 1
union all select 'courier_shifts', cast(shift_id as varchar), 'SHIFT_NULL_LOGOUT' from b_shifts
 where logout_at is null
union all select 'gps_pings', cast(ping_id as varchar), 'GPS_LOW_ACCURACY' from b_pings
 where accuracy_m > 100""")
def u03(b: Bronze):
    return quarantine(b).select("source_table", "natural_key", "reason_code")


def quarantine(b: Bronze):
    """All rejected rows in one shape with enough payload to reproduce them."""
    shifts = b.courier_shifts().withColumn("reason_code", quality.first_reason(
        (F.col("logout_at").isNull(), "SHIFT_NULL_LOGOUT")))
    pings = b.gps_pings().withColumn("reason_code", quality.first_reason(
        (F.col("accuracy_m") > 100, "GPS_LOW_ACCURACY")))
    arms = [("refunds", "refund_id", claims(b), ["payment_id", "order_id", "amount_cents"]),
            ("order_events", "event_id", ev.flagged_events(b.order_events()),
             ["order_id", "event_type"]),
            ("courier_shifts", "shift_id", shifts, ["courier_id"]),
            ("gps_pings", "ping_id", pings, ["courier_id", "accuracy_m"])]
    return quality.quarantined(arms)


@query("u03_quarantine_payload", """
select 'refunds' as source_table, cast(refund_id as varchar) as natural_key, reason_code,
 cast(json_object('payment_id', payment_id, 'order_id', order_id, 'amount_cents', amount_cents)
 as varchar) as raw_payload from m_claims where reason_code is not null
union all select 'order_events', cast(event_id as varchar), 'DUP_EVENT', cast(json_object('order_id',
  order_id, 'event_type', event_type) as varchar) from (select *, row_number() over (partition by
  order_id, event_type, occurred_at order by received_at, event_id) as rn from b_events) where rn > 1
union all select 'courier_shifts', cast(shift_id as varchar), case when logout_at is null
  then 'SHIFT_NULL_LOGOUT' else 'SHIFT_OVERLAP' end, cast(json_object('courier_id', courier_id)
  as varchar) from (select *, lag(logout_at) over (partition by courier_id order by login_at,
  shift_id) as prev from b_shifts) where logout_at is null or login_at < prev
union all select 'gps_pings', cast(ping_id as varchar), 'GPS_LOW_ACCURACY',
 cast(json_object('courier_id', courier_id) as varchar) from b_pings where accuracy_m > 100
union all select 'order_items', order_id || '-' || line_no, case when quantity <= 3
  then 'NEGATIVE_QUANTITY' else 'FK_MISSING' end, cast(json_object('menu_item_id', l.menu_item_id,
  'quantity', quantity - 3) as varchar) from b_lines l left join b_menu_items m
 on m.menu_item_id = l.menu_item_id and m.is_available
 where quantity <= 3 or m.menu_item_id is null
union all select 'orders', cast(o_orderkey as varchar), 'SCHEMA_RESCUED', cast(json_object('order_id',
  o_orderkey, 'customer_id', o_custkey) as varchar) from orders
 where o_orderdate >= timestamp '1998-01-01'""")
def u03_payload(b: Bronze):
    """All nine codes, each with the payload that reproduces the row. Three of every quantity were
    taken back, only available items are on the menu, and a landing of orders grew a column."""
    from tiffin.catalog.streams import rescued_orders
    shifts = overlap_flags(b.courier_shifts()).withColumn("reason_code", quality.first_reason(
        (F.col("logout_at").isNull(), "SHIFT_NULL_LOGOUT"),
        (F.col("login_at") < F.col("previous_logout"), "SHIFT_OVERLAP")))
    pings = b.gps_pings().withColumn("reason_code", quality.first_reason(
        (F.col("accuracy_m") > 100, "GPS_LOW_ACCURACY")))
    menu = b.menu_items().filter("is_available").select("menu_item_id", F.lit(True).alias("_known"))
    lines = b.lines().withColumn("quantity", F.col("quantity") - 3).join(
        menu, "menu_item_id", "left").withColumn("reason_code", quality.first_reason(
            (F.col("quantity") <= 0, "NEGATIVE_QUANTITY"), (F.col("_known").isNull(), "FK_MISSING"))) \
        .withColumn("line_key", F.concat_ws("-", "order_id", "line_no"))
    landed = rescued_orders(b, "json").withColumn("reason_code", quality.first_reason(
        (F.col("was_rescued"), "SCHEMA_RESCUED")))
    return quality.quarantined([
        ("refunds", "refund_id", claims(b), ["payment_id", "order_id", "amount_cents"]),
        ("order_events", "event_id", ev.flagged_events(b.order_events()), ["order_id", "event_type"]),
        ("courier_shifts", "shift_id", shifts, ["courier_id"]),
        ("gps_pings", "ping_id", pings, ["courier_id"]),
        ("order_items", "line_key", lines, ["menu_item_id", "quantity"]),
        ("orders", "order_id", landed, ["order_id", "customer_id"])])


@query("u04_named_terms", """select 'orders' as term, count(*) as n from b_heads
 union all select 'offers', count(*) from b_attempts
 union all select 'events', count(*) from b_events""")
def u04(b: Bronze):
    def term(name, df):
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("term"), "n")
    return term("orders", b.order_heads()).unionByName(term("offers", b.match_attempts())) \
        .unionByName(term("events", b.order_events()))
