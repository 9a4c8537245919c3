"""Queries: one per family of scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tiffin.catalog.oracle import SALT, draw, key, pick
from tiffin.catalog.registry import query
from tiffin.functions import clock, geo, keys, money, privacy, text
from tiffin.functions.draws import md5_draw, uniform
from tiffin.functions.draws import pick as pick_value
from tiffin.operators.slices import expanded
from tiffin.sources.bronze import NOTES, Bronze


@query("f01_positive_amount", """select refund_id,
 cast(regexp_replace(refund_amount_raw, '[()]', '', 'g') as decimal(18,2)) as amount,
 refund_amount_raw like '(%' as was_text from b_refunds""")
def f01(b: Bronze):
    raw = F.col("refund_amount_raw")
    return b.refunds().select("refund_id", money.positive_amount(raw).alias("amount"),
                              money.is_accounting_text(raw).alias("was_text"))


@query("f02_signed_cents", "select refund_id, amount_cents from m_claims")
def f02(b: Bronze):
    return b.refund_claims().select("refund_id", money.signed_cents(F.col("amount_usd"))
                                    .alias("amount_cents"))


@query("f03_accounting_text", """select order_id, line_no, case when quantity % 3 = 0
 then '(' || cast(line_total as varchar) || ')' else cast(line_total as varchar) end as amount_text
from b_lines""")
def f03(b: Bronze):
    return b.lines().select("order_id", "line_no", money.accounting_text(
        F.col("line_total"), F.col("quantity") % 3 == 0).alias("amount_text"))


@query("f04_sentence_case", "select order_id, delivery_notes, was_text_noise_defect from m_stg_orders")
def f04(b: Bronze):
    raw = F.col("delivery_notes")
    clean = text.sentence_case(raw)
    return b.order_heads().select("order_id", clean.alias("delivery_notes"), (
        raw.isNotNull() & (raw != clean)).alias("was_text_noise_defect"))


@query("f05_text_damage", """select p_partkey as part_id, case p_partkey % 5 when 0 then upper(p_name)
 when 1 then lower(p_name) when 2 then '   ' || p_name when 3 then p_name || '   ' else p_name end
 as name from part""")
def f05(b: Bronze):
    return b.raw("part", "p_partkey", "p_name").select(
        F.col("p_partkey").alias("part_id"),
        text.damaged(F.col("p_name"), F.col("p_partkey") % 5).alias("name"))


@query("f06_clean_and_key", """select delivery_notes as raw, trim(delivery_notes) as display,
 lower(trim(delivery_notes)) as match_key, count(*) as n from b_heads
 where delivery_notes is not null group by 1""")
def f06(b: Bronze):
    notes = (b.order_heads().filter("delivery_notes is not null")
             .groupBy(F.col("delivery_notes").alias("raw")).agg(F.count(F.lit(1)).alias("n")))
    return notes.select("raw", text.display_clean(F.col("raw")).alias("display"),
                        text.match_key(F.col("raw")).alias("match_key"), "n")


@query("f07_email_hash", f"""select customer_id, sha256('{SALT}' || lower(trim(email))) as email_hash
 from b_customers""")
def f07(b: Bronze):
    return b.customers().select("customer_id", privacy.email_hash(F.col("email"), SALT)
                                .alias("email_hash"))


@query("f08_phone_mask", "select customer_id, phone_masked from m_stg_customers")
def f08(b: Bronze):
    return b.customers().select("customer_id", privacy.phone_masked(F.col("phone"))
                                .alias("phone_masked"))


@query("f09_references", """select o_orderkey as order_id, printf('O-%07d', o_orderkey) as order_ref,
 printf('C-%07d', o_custkey) as customer_ref from orders""")
def f09(b: Bronze):
    return b.raw("orders", "o_orderkey", "o_custkey").select(
        F.col("o_orderkey").alias("order_id"),
        keys.reference("O", F.col("o_orderkey")).alias("order_ref"),
        keys.reference("C", F.col("o_custkey")).alias("customer_ref"))


@query("f10_uniform_draw", f"""select o_orderkey as order_id, {draw(3, 'o_orderkey')} as bucket,
 cast({draw(3, 'o_orderkey')} as double) / 1000000 as u from orders""")
def f10(b: Bronze):
    ids = b.raw("orders").select(F.col("o_orderkey").alias("order_id"))
    bucket = md5_draw(3, "order_id")
    return ids.select("order_id", bucket.alias("bucket"), uniform(bucket).alias("u"))


@query("f11_lognormal", f"""select c_custkey as customer_id,
 round(exp(0.08 * sqrt(-2.0 * ln({draw(1, 'c_custkey')} / 1000000.0 + 1e-9))
  * cos(2.0 * pi() * ({draw(2, 'c_custkey')} / 1000000.0))), 6) as noise from customer""")
def f11(b: Bronze):
    from tiffin.functions.draws import lognormal
    key_ = F.col("c_custkey")
    return b.raw("customer", "c_custkey").select(
        key_.alias("customer_id"), F.round(lognormal(uniform(md5_draw(1, key_)),
                                                     uniform(md5_draw(2, key_)), 0.08), 6)
        .alias("noise"))


@query("f12_pick_by_index", f"""select o_orderkey as order_id,
 {pick(NOTES, draw(4, 'o_orderkey'))} as note from orders""")
def f12(b: Bronze):
    return b.raw("orders", "o_orderkey").select(
        F.col("o_orderkey").alias("order_id"),
        pick_value(NOTES, md5_draw(4, "o_orderkey")).alias("note"))


@query("f13_expand_by_count", """select day_index, hour, i from (select day_index, hour,
 unnest(generate_series(0, cast(orders as bigint) - 2)) as i from m_demand_hourly where orders > 1)""")
def f13(b: Bronze):
    """One row per unit of a count; hours with a count of zero give none."""
    from tiffin.plans.demand import actual_hourly
    spare = actual_hourly(b).select("day_index", "hour", (F.col("orders") - 1).alias("n"))
    return expanded(spare, "n", "i", chunk=100).select("day_index", "hour", "i")


@query("f14_timestamp_arithmetic", """select order_id, placed_at + to_seconds(order_id % 60)
 as plus_seconds, placed_at + to_minutes(order_id % 30) as plus_minutes,
 placed_at + to_hours(order_id % 48) as plus_hours,
 cast(cast(placed_at as date) as timestamp) as midnight from b_heads""")
def f14(b: Bronze):
    def plus(unit, n):
        return F.timestamp_add(unit, (F.col("order_id") % n).cast("int"), "placed_at")
    return b.order_heads().select(
        "order_id", plus("SECOND", 60).alias("plus_seconds"), plus("MINUTE", 30)
        .alias("plus_minutes"), plus("HOUR", 48).alias("plus_hours"),
        F.to_date("placed_at").cast("timestamp").alias("midnight"))


@query("f15_date_parts", """select order_id, cast(placed_at as date) as date_day,
 dayofweek(placed_at) in (0, 6) as is_weekend from b_heads""")
def f15(b: Bronze):
    day = F.to_date("placed_at")
    return b.order_heads().select("order_id", day.alias("date_day"),
                                  clock.is_weekend(day).alias("is_weekend"))


@query("f16_seconds_between", """select match_id, epoch_us(responded_at) // 1000000
 - epoch_us(offered_at) // 1000000 as seconds from b_attempts""")
def f16(b: Bronze):
    return b.match_attempts().select("match_id", clock.seconds_between(
        F.col("offered_at"), F.col("responded_at")).alias("seconds"))


@query("f17_jitter", f"""select customer_id,
 round(center_lat + ({draw(6, 'customer_id')} / 1000000.0 - 0.5) * 0.018, 6) as lat,
 round(center_lon + ({draw(7, 'customer_id')} / 1000000.0 - 0.5) * 0.018
  / cos(radians(center_lat)), 6) as lon
from b_customers join b_zones on zone_id = home_zone_id""")
def f17(b: Bronze):
    zones = b.zones().select(F.col("zone_id").alias("home_zone_id"), "center_lat", "center_lon")
    people = b.customers().select("customer_id", "home_zone_id").join(zones, "home_zone_id")
    lat, lon = geo.jitter(F.col("center_lat"), F.col("center_lon"),
                          uniform(md5_draw(6, "customer_id")), uniform(md5_draw(7, "customer_id")),
                          0.018)
    return people.select("customer_id", F.round(lat, 6).alias("lat"), F.round(lon, 6).alias("lon"))


@query("f18_great_circle", """select customer_id, round(2 * 6371.0088 * asin(sqrt(least(1.0,
 pow(sin(radians(center_lat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(center_lat))
 * pow(sin(radians(center_lon - lon) / 2), 2)))), 5) as km
from b_customers join b_zones on zone_id = home_zone_id""")
def f18(b: Bronze):
    zones = b.zones().select(F.col("zone_id").alias("home_zone_id"), "center_lat", "center_lon")
    return b.customers().join(zones, "home_zone_id").select("customer_id", F.round(
        geo.great_circle_km(F.col("lat"), F.col("lon"), F.col("center_lat"), F.col("center_lon")),
        5).alias("km"))


@query("f19_commission_and_net", """select order_id, commission_amount, order_total, net_revenue
 from m_economics""")
def f19(b: Bronze):
    from tiffin.catalog.models import stg_refunds
    back = stg_refunds(b).groupBy("order_id").agg(F.sum("refund_amount").alias("_back"))
    total = money.narrow(F.col("subtotal") + F.col("delivery_fee"))
    return b.orders().join(back, "order_id", "left").select(
        "order_id", money.commission(F.col("subtotal"), F.col("commission_pct"))
        .alias("commission_amount"), total.alias("order_total"),
        money.narrow(total - F.coalesce("_back", F.lit(0))).alias("net_revenue"))


@query("f20_tax_cents", """select order_id, cast((subtotal_cents * tax_rate_bps + 5000) // 10000
 as bigint) as tax_cents from m_order_facts o join b_taxes t on t.city_id = o.city_id
 and order_date >= effective_from and order_date < coalesce(effective_to, date '9999-12-31')""")
def f20(b: Bronze):
    from tiffin.catalog.relational import order_facts
    from tiffin.plans.finance import tax_asof
    facts = order_facts(b).select("order_id", "order_date", "city_id", "subtotal_cents")
    return tax_asof(facts, b.tax_jurisdictions()).select("order_id", money.tax_cents(
        F.col("subtotal_cents"), F.col("tax_rate_bps")).alias("tax_cents"))


@query("f22_surrogate_key", f"""select shift_id, {key('courier_id',
 "strftime(logout_at, '%Y-%m-%d %H:%M')")} as shift_key from b_shifts""")
def f22(b: Bronze):
    stamp = F.date_format("logout_at", "yyyy-MM-dd HH:mm")
    return b.courier_shifts().select("shift_id", keys.surrogate_key("courier_id", stamp)
                                     .alias("shift_key"))


@query("f23_date_spine", """
select cast(strftime(d, '%Y%m%d') as integer) as date_key, d as full_date,
 cast(dayofweek(d) + 1 as integer) as day_of_week, dayofweek(d) in (0, 6) as is_weekend,
 cast(floor((d - date '1995-01-02') / 7.0) + 1 as integer) as payout_cycle_id,
 month(d) = 12 and day(d) in (25, 26) as is_holiday,
 dayofweek(d) = 0 and month(d) in (9, 10, 11, 12) as is_autumn_sunday
from (select cast(unnest(generate_series(min(cast(o_orderdate as date)),
 max(cast(o_orderdate as date)), interval 1 day)) as date) as d from orders)""")
def f23(b: Bronze):
    bounds = b.raw("orders").agg(F.to_date(F.min("o_orderdate")).alias("d0"),
                                 F.to_date(F.max("o_orderdate")).alias("d1"))
    d = F.col("full_date")
    return clock.date_spine(bounds, "d0", "d1").select(
        clock.date_key(d).alias("date_key"), "full_date", F.dayofweek(d).alias("day_of_week"),
        clock.is_weekend(d).alias("is_weekend"),
        clock.payout_cycle(d, "1995-01-02").alias("payout_cycle_id"),
        ((F.month(d) == 12) & F.dayofmonth(d).isin(25, 26)).alias("is_holiday"),
        ((F.dayofweek(d) == 1) & F.month(d).isin(9, 10, 11, 12)).alias("is_autumn_sunday"))


@query("f25_json_payload", """select refund_id, payment_id as payment_back, amount_cents as cents_back
 from m_claims""")
def f25(b: Bronze):
    """A payload written as JSON and read back."""
    from tiffin.catalog.relational import claims
    rows = claims(b).select("refund_id", F.to_json(F.struct("payment_id", "amount_cents"))
                            .alias("raw_payload"))
    return rows.select("refund_id", F.get_json_object("raw_payload", "$.payment_id").cast("bigint")
                       .alias("payment_back"),
                       F.get_json_object("raw_payload", "$.amount_cents").cast("bigint")
                       .alias("cents_back"))


@query("f26_ingestion_lag", "select event_id, lag_seconds from m_lagged")
def f26(b: Bronze):
    from tiffin.plans.events import with_lag
    return with_lag(b.order_events()).select("event_id", "lag_seconds")


@query("f24_elapsed_and_wall_clock", """select order_id, 24.0::double as elapsed_hours,
 cast((epoch_us(timezone('America/New_York', timezone('UTC', placed_at + interval 24 hours)))
  // 1000000 - epoch_us(timezone('America/New_York', timezone('UTC', placed_at))) // 1000000)
  as double) / 3600.0 as wall_clock_hours from b_heads""")
def f24(b: Bronze):
    """A day from placement, by elapsed time and by the local clock."""
    start = F.col("placed_at")
    end = F.timestamp_add("HOUR", F.lit(24), "placed_at")
    return b.order_heads().select(
        "order_id", clock.elapsed_hours(start, end).alias("elapsed_hours"),
        clock.wall_clock_hours(start, end, "America/New_York").alias("wall_clock_hours"))


@query("f28_outcome_class", """select order_id, case when order_status <> 'DELIVERED'
  or order_id % 13 = 0 or 1 + order_id % 5 <= 2 or order_id % 45 >= 30 then 'negative'
 when order_id % 45 >= 10 or 1 + order_id % 5 = 3 then 'neutral' else 'positive' end as outcome_class
from b_heads""")
def f28(b: Bronze):
    k = F.col("order_id")
    return b.order_heads().select("order_id", text.outcome_class(
        F.col("order_status") == "DELIVERED", k % 45, k % 13 == 0, k % 5 + 1)
        .alias("outcome_class"))


def hits_sql(words: list[str]) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return (f"len(list_filter(regexp_split_to_array(lower(review_text), '{text.NOT_IN_WORDS}'), "
            f"lambda w: w in ({listed})))")


KEYWORD_SQL = (f"case when {hits_sql(text.POSITIVE_WORDS)} > {hits_sql(text.NEGATIVE_WORDS)} "
               f"then 'positive' when {hits_sql(text.POSITIVE_WORDS)} < {hits_sql(text.NEGATIVE_WORDS)} "
               "then 'negative' else 'neutral' end")


@query("f29_keyword_sentiment", f"select review_id, {KEYWORD_SQL} as sentiment from b_reviews")
def f29(b: Bronze):
    return b.reviews().select("review_id", text.keyword_sentiment(F.col("review_text"))
                              .alias("sentiment"))


_ISSUES = " union all ".join(
    f"select review_id, '{name}' as issue from b_reviews "
    f"where {hits_sql(words)} > 0" for name, words in text.ISSUE_WORDS.items())


@query("a23_issue_categories", f"""
select cast(order_id % (select count(*) from supplier) as bigint) as restaurant_id, issue,
 count(*) as n from (select r.review_id, r.order_id, coalesce(i.issue, 'other') as issue
 from b_reviews r left join ({_ISSUES}) i on i.review_id = r.review_id) group by 1, 2""")
def a23(b: Bronze):
    n = b.size("supplier")
    flagged = b.reviews().select((F.col("order_id") % n).alias("restaurant_id"),
                                 F.explode(text.issues(F.col("review_text"))).alias("issue"))
    return flagged.groupBy("restaurant_id", "issue").agg(F.count(F.lit(1)).alias("n"))
