"""Queries: orders in cents, ledger, tie-out, versioned dimensions, shifts, reviews."""

from __future__ import annotations

from pyspark.sql import functions as F

from tiffin.catalog.oracle import draw, key, view
from tiffin.catalog.registry import query
from tiffin.catalog.relational import claims, order_facts
from tiffin.catalog.scalars import KEYWORD_SQL, hits_sql
from tiffin.functions import text
from tiffin.functions.draws import md5_draw
from tiffin.functions.keys import surrogate_key
from tiffin.operators import history, quality
from tiffin.operators.islands import merged_shifts
from tiffin.plans import events as ev
from tiffin.plans import finance, reviews
from tiffin.session import scratch
from tiffin.sources.bronze import Bronze

# -- versioned restaurants ----------------------------------------------------------------------

CHECK = ["cuisine_type", "is_active", "commission_pct"]
START, CHANGE = "1993-01-01 00:00:00", "1998-01-01 00:00:00"
_ATTRIBUTES = ["restaurant_id", "name", "cuisine_type", "city_id", "zone_id", "commission_pct",
               "is_active"]


def snapshot_before(b: Bronze):
    return b.restaurants().select(*_ATTRIBUTES)


def snapshot_after(b: Bronze):
    """Some restaurants changed cuisine, some only their name (not a checked column), some are gone
    and some are new."""
    n = b.size("supplier")
    k = F.col("restaurant_id")
    kept = snapshot_before(b).filter(k % 31 != 5).withColumn(
        "cuisine_type", F.when(k % 7 == 0, F.lit("Fusion")).otherwise(F.col("cuisine_type"))) \
        .withColumn("name", F.when(k % 5 == 0, F.upper("name")).otherwise(F.col("name")))
    new = snapshot_before(b).filter(k % 13 == 0).withColumn("restaurant_id", k + n)
    return kept.unionByName(new)


def restaurant_history(b: Bronze):
    first = history.scd2_start(snapshot_before(b), F.lit(START).cast("timestamp"))
    return history.scd2_apply(first, snapshot_after(b), "restaurant_id", CHECK,
                              F.lit(CHANGE).cast("timestamp"))


view("m_snap_before", f"select {', '.join(_ATTRIBUTES)} from b_restaurants")
view("m_snap_after", """
select restaurant_id, case when restaurant_id % 5 = 0 then upper(name) else name end as name,
 case when restaurant_id % 7 = 0 then 'Fusion' else cuisine_type end as cuisine_type, city_id,
 zone_id, commission_pct, is_active from m_snap_before where restaurant_id % 31 <> 5
union all select restaurant_id + (select count(*) from supplier), name, cuisine_type, city_id,
 zone_id, commission_pct, is_active from m_snap_before where restaurant_id % 13 = 0""")
view("m_scd2", f"""
select o.*, timestamp '{START}' as valid_from, case when n.restaurant_id is null
  or n.cuisine_type <> o.cuisine_type then timestamp '{CHANGE}' end as valid_to
from m_snap_before o left join m_snap_after n on n.restaurant_id = o.restaurant_id
union all select n.*, timestamp '{CHANGE}', null from m_snap_after n
 left join m_snap_before o on o.restaurant_id = n.restaurant_id
 where o.restaurant_id is null or n.cuisine_type <> o.cuisine_type""")
view("m_dim_restaurant", f"""
select {key('restaurant_id', "strftime(valid_from, '%Y-%m-%d %H:%M:%S')")} as restaurant_key,
 * exclude (valid_from, valid_to), valid_from,
 coalesce(valid_to, timestamp '9999-12-31 00:00:00') as valid_to, valid_to is null as is_current
from m_scd2""")


@query("m03_change_feed", """
select o.*, 'delete' as _change_type from m_snap_before o
 where restaurant_id not in (select restaurant_id from m_snap_after)
union all select n.*, 'insert' from m_snap_after n
 where restaurant_id not in (select restaurant_id from m_snap_before)
union all select o.*, 'update_preimage' from m_snap_before o join m_snap_after n
 on n.restaurant_id = o.restaurant_id
 where n.name <> o.name or n.cuisine_type <> o.cuisine_type
union all select n.*, 'update_postimage' from m_snap_before o join m_snap_after n
 on n.restaurant_id = o.restaurant_id
 where n.name <> o.name or n.cuisine_type <> o.cuisine_type""")
def m03(b: Bronze):
    return history.change_feed(snapshot_before(b), snapshot_after(b), ["restaurant_id"])


@query("m04_scd2_snapshot", "select * from m_scd2")
def m04(b: Bronze):
    """Kept on disk in buckets of the key; the second snapshot writes the buckets that differ."""
    before = snapshot_before(b)
    kept = history.KeptHistory(b.spark, scratch(b.spark, "history"), before.schema,
                               "restaurant_id", CHECK, buckets=16)
    kept.start(before, F.lit(START))
    for _ in range(2):  # the same snapshot again changes nothing
        kept.apply(snapshot_after(b), F.lit(CHANGE).cast("timestamp"))
    return kept.table.read()


@query("m05_scd2_dimension", "select * from m_dim_restaurant")
def m05(b: Bronze):
    return dim_restaurant(b)


def dim_restaurant(b: Bronze):
    return history.scd2_view(restaurant_history(b), "restaurant_id", "restaurant_key")


# -- orders in cents -----------------------------------------------------------------------------

view("m_order_cents", f"""
select *, subtotal_cents + tax_cents + delivery_fee_cents + surge_cents + tip_cents - promo_cents
  as total_cents,
 platform_fee_cents + (delivery_fee_cents + surge_cents - courier_earned_cents)
  - platform_promo_cents as platform_revenue_cents,
 subtotal_cents - platform_fee_cents as restaurant_payout_cents,
 courier_earned_cents + tip_cents as courier_payout_cents
from (select {key('o.order_id')} as order_key, o.order_id, o.order_date,
  cast(strftime(o.order_date, '%Y%m%d') as integer) as date_key, d.restaurant_key,
  {key('o.city_id')} as city_key, {key('o.zone_id')} as zone_key,
  {key('o.customer_id')} as customer_key, cast(o.city_id as bigint) as city_id, o.placed_at,
  subtotal_cents, delivery_fee_cents, surge_cents, tip_cents,
  cast(promo_cents as integer) as promo_cents,
  cast(platform_promo_cents as integer) as platform_promo_cents, courier_earned_cents,
  psp_fee_cents, cast((subtotal_cents * tax_rate_bps + 5000) // 10000 as bigint) as tax_cents,
  f.platform_fee_cents
 from m_order_facts o join m_fee f on f.order_id = o.order_id
 join b_taxes t on t.city_id = o.city_id and o.order_date >= t.effective_from
  and o.order_date < coalesce(t.effective_to, date '9999-12-31')
 left join m_dim_restaurant d on d.restaurant_id = o.restaurant_id
  and o.placed_at >= d.valid_from and o.placed_at < d.valid_to)""")


def order_cents(b: Bronze):
    return finance.order_cents(order_facts(b), b.fee_schedule(), b.tax_jurisdictions(),
                               dim_restaurant(b))


@query("d20_order_cents", "select * from m_order_cents")
def d20(b: Bronze):
    return order_cents(b)


@query("f21_platform_revenue", """select order_id, total_cents, platform_revenue_cents,
 restaurant_payout_cents, courier_payout_cents from m_order_cents""")
def f21(b: Bronze):
    return order_cents(b).select("order_id", "total_cents", "platform_revenue_cents",
                                 "restaurant_payout_cents", "courier_payout_cents")


@query("d21_order_items", """select order_id, line_no, menu_item_id, quantity,
 cast(line_total * 100 as bigint) as line_total_cents from b_lines""")
def d21_items(b: Bronze):
    """Natural key only; an extra surrogate key would hide the grain."""
    return b.lines().select("order_id", "line_no", "menu_item_id", "quantity",
                            finance.cents(F.col("line_total")).alias("line_total_cents"))


@query("d21_payments", "select * from b_movements")
def d21_payments(b: Bronze):
    return b.money_movements()


_LEDGER = " union all ".join(
    f"select order_id, '{t}' as entry_type, '{p}' as party, cast({a} as bigint) as amount_cents, "
    "placed_at as occurred_at from m_order_cents"
    for t, p, a in (("CHARGE", "customer", "-total_cents"),
                    ("PAYOUT", "restaurant", "restaurant_payout_cents"),
                    ("PAYOUT", "courier", "courier_payout_cents"),
                    ("REVENUE", "platform", "platform_revenue_cents"), ("TAX", "authority", "tax_cents"),
                    ("FEE", "processor", "psp_fee_cents")))


@query("d21_ledger", _LEDGER)
def d21_ledger(b: Bronze):
    return finance.ledger(order_cents(b))


@query("u05_ledger_balance", f"""select party, entry_type, count(*) as n,
 cast(sum(amount_cents) as bigint) as amount_cents from ({_LEDGER}) group by 1, 2""")
def u05(b: Bronze):
    return finance.ledger(order_cents(b)).groupBy("party", "entry_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount_cents").alias("amount_cents"))


view("m_tie_out", """
with ok as (select *, row_number() over (partition by order_id, kind order by created_at, payment_id)
  as rn from b_movements where status = 'SUCCEEDED')
select 'captured' as term, cast(coalesce(sum(amount_cents), 0) as bigint) as amount_cents from ok
 where kind = 'CAPTURE'
union all select 'refunded', cast(coalesce(sum(amount_cents), 0) as bigint) from ok
 where kind = 'REFUND'
union all select 'orphan_leak', cast(coalesce(-sum(amount_cents), 0) as bigint) from m_claims
 where reason_code = 'ORPHAN_PAYMENT_REF'
union all select 'pending', cast(coalesce(sum(amount_cents), 0) as bigint) from ok
 where kind = 'AUTH' and order_id not in (select order_id from ok where kind = 'CAPTURE')
union all select 'double_capture', cast(coalesce(sum(amount_cents), 0) as bigint) from ok
 where kind = 'CAPTURE' and rn > 1
union all select 'net', cast(coalesce(sum(amount_cents), 0) as bigint) from ok
 where kind in ('CAPTURE', 'REFUND')""")


def tie_out(b: Bronze):
    return finance.tie_out(b.money_movements(), claims(b))


@query("a16_tie_out", "select * from m_tie_out")
def a16(b: Bronze):
    return tie_out(b)


@query("a17_unit_economics", f"""
select city_key, fee_tier, scenario, platform_revenue_cents, psp_fee_cents,
 cast(case scenario when 'AS_IS' then platform_revenue_cents - psp_fee_cents
  when 'TWO_PART_FEE' then platform_revenue_cents + 30 * n + s // 50 - psp_fee_cents
  else platform_revenue_cents end as bigint) as margin_cents,
 round(cast(psp_fee_cents as double) / nullif(platform_revenue_cents, 0), 6)
  as psp_to_revenue_ratio
from (select city_key, platform_fee_cents as fee_tier,
  cast(sum(platform_revenue_cents) as bigint) as platform_revenue_cents,
  cast(sum(psp_fee_cents) as bigint) as psp_fee_cents, count(*) as n, sum(subtotal_cents) as s
 from m_order_cents group by 1, 2),
 (values {', '.join(f"('{s}')" for s in finance.SCENARIOS)}) as v(scenario)""")
def a17(b: Bronze):
    return finance.unit_economics(order_cents(b))


# -- money checks --------------------------------------------------------------------------------


@query("q17_components_sum", """select order_id, total_cents from m_order_cents where total_cents <>
 subtotal_cents + tax_cents + delivery_fee_cents + surge_cents + tip_cents - promo_cents""")
def q17(b: Bronze):
    return order_cents(b).filter(
        "total_cents <> subtotal_cents + tax_cents + delivery_fee_cents + surge_cents + tip_cents "
        "- promo_cents").select("order_id", "total_cents")


@query("q17_components_broken", """select order_id, total_cents + 1 as total_cents from m_order_cents
 where order_id % 17 = 0""")
def q17_broken(b: Bronze):
    off = F.when(F.col("order_id") % 17 == 0, 1).otherwise(0)
    return order_cents(b).withColumn("total_cents", F.col("total_cents") + off).filter(
        "total_cents <> subtotal_cents + tax_cents + delivery_fee_cents + surge_cents + tip_cents "
        "- promo_cents").select("order_id", "total_cents")


@query("q17_residual_broken", """select captured, refunded, net, net + 1 as expected_net,
 cast(-1 as bigint) as residual from (select
 max(case when term = 'captured' then amount_cents end) as captured,
 max(case when term = 'refunded' then amount_cents end) as refunded,
 max(case when term = 'net' then amount_cents end) as net from m_tie_out)""")
def q17_residual(b: Bronze):
    """The tie-out against an expectation that is one cent off."""
    expected = b.money_movements().filter(
        "status = 'SUCCEEDED' and kind in ('CAPTURE', 'REFUND')").agg(
        F.sum("amount_cents") + 1).scalar()
    return finance.residual(tie_out(b), expected)


@query("q17_revenue_is_not_residual", """select count(*) as n_differ from m_order_cents
 where platform_revenue_cents <> total_cents - restaurant_payout_cents - courier_payout_cents
  - tax_cents - psp_fee_cents""")
def q17_definition(b: Bronze):
    """Zero here would mean that revenue is only what is left over."""
    return order_cents(b).filter(
        "platform_revenue_cents <> total_cents - restaurant_payout_cents - courier_payout_cents "
        "- tax_cents - psp_fee_cents").agg(F.count(F.lit(1)).alias("n_differ"))


@query("q16_boundary_days", """select o.city_id, o.order_date,
 count(distinct f.platform_fee_cents) as n_fees, count(distinct t.tax_rate_bps) as n_taxes
from m_order_facts o join m_fee f on f.order_id = o.order_id and f.precedence <> 1
join b_taxes t on t.city_id = o.city_id and o.order_date >= t.effective_from
 and o.order_date < coalesce(t.effective_to, date '9999-12-31') group by 1, 2""")
def q16(b: Bronze):
    """Fees and taxes per city and day; exactly one of each, also around a change date."""
    facts = order_facts(b).select("order_id", "order_date", "restaurant_id", "city_id")
    priced = finance.tax_asof(finance.fee_asof(facts, b.fee_schedule()), b.tax_jurisdictions())
    # Restaurant fees differ by design; the boundary concerns the city and global scopes.
    return priced.filter("precedence <> 1").groupBy("city_id", "order_date").agg(
        F.countDistinct("platform_fee_cents").alias("n_fees"),
        F.countDistinct("tax_rate_bps").alias("n_taxes"))


@query("q15_scd2_clean", """select restaurant_id, cast(null as varchar) as problem from m_scd2
 group by restaurant_id having count(*) filter (where valid_to is null) > 1""")
def q15(b: Bronze):
    return quality.scd2_problems(restaurant_history(b), "restaurant_id")


@query("q15_scd2_broken", """
select restaurant_id, 'MANY_CURRENT' as problem from (select restaurant_id, case when
  restaurant_id % 3 = 0 then null else valid_to end as valid_to from m_scd2)
 where valid_to is null group by 1 having count(*) > 1
union all select distinct restaurant_id, 'OVERLAP' from (select restaurant_id, valid_from,
  lag(coalesce(case when restaurant_id % 3 = 0 then null else valid_to end,
   timestamp '9999-12-31')) over (partition by restaurant_id order by valid_from) as e from m_scd2)
 where valid_from < e""")
def q15_broken(b: Bronze):
    reopened = restaurant_history(b).withColumn("valid_to", F.when(
        F.col("restaurant_id") % 3 != 0, F.col("valid_to")))
    return quality.scd2_problems(reopened, "restaurant_id")


# -- shifts, lifecycle, pings, dimensions ---------------------------------------------------------


@query("d19_shifts_merged", """
select courier_id, shift_start, shift_end, worked_seconds,
 cast(worked_seconds as double) / 3600.0 as elapsed_hours,
 cast(wall as double) / 3600.0 as wall_clock_hours, wall <> worked_seconds as dst_affected,
 had_open_shift
from (select *, epoch_us(shift_end) // 1000000 - epoch_us(shift_start) // 1000000 as worked_seconds,
  epoch_us(timezone('America/New_York', timezone('UTC', shift_end))) // 1000000
  - epoch_us(timezone('America/New_York', timezone('UTC', shift_start))) // 1000000 as wall
 from (select courier_id, island_id, min(shift_start) as shift_start, max(shift_end) as shift_end,
  bool_or(was_open) as had_open_shift from m_islands group by 1, 2))""")
def d19(b: Bronze):
    return merged_shifts(b.courier_shifts(), "America/New_York")


@query("d22_order_lifecycle", "select * from m_lifecycle")
def d22(b: Bronze):
    """Lifecycle over deduplicated events."""
    return ev.lifecycle(ev.deduplicated(b.order_events()))


@query("d26_pings_clean", """
select ping_id, courier_id, order_id, ping_ts, lat, lon, accuracy_m,
 _ingested_at as device_received_at,
 epoch_us(_ingested_at) // 1000000 - epoch_us(ping_ts) // 1000000 as device_lag_seconds,
 coalesce(_ingested_at < lag(_ingested_at) over (partition by courier_id order by ping_ts, ping_id),
  false) as out_of_order from b_pings where accuracy_m <= 100""")
def d26(b: Bronze):
    return ev.clean_pings(b.gps_pings())


@query("d27_dim_city", f"""select {key('city_id')} as city_key, city_id, name, country_code
 from b_cities""")
def d27_city(b: Bronze):
    return b.cities().select(surrogate_key("city_id").alias("city_key"), "city_id", "name",
                             "country_code")


@query("d27_dim_zone", f"select {key('zone_id')} as zone_key, zone_id, city_id, name from b_zones")
def d27_zone(b: Bronze):
    return b.zones().select(surrogate_key("zone_id").alias("zone_key"), "zone_id", "city_id", "name")


@query("d27_dim_customer", f"""select {key('customer_id')} as customer_key, customer_id, email_hash,
 home_zone_id from m_stg_customers""")
def d27_customer(b: Bronze):
    from tiffin.catalog.oracle import SALT
    from tiffin.plans.staging import stg_customers
    return stg_customers(b.customers(), SALT).select(
        surrogate_key("customer_id").alias("customer_key"), "customer_id", "email_hash",
        "home_zone_id")


@query("d27_dim_payment_method", f"""select distinct {key('method')} as payment_method_key, method
 from b_payments""")
def d27_method(b: Bronze):
    methods = b.payments().select("method").distinct()
    return methods.select(surrogate_key("method").alias("payment_method_key"), "method")


# -- reviews -------------------------------------------------------------------------------------


view("m_outcomes", """
select order_id, delivered, refunded, case when not delivered or refunded or rating <= 2
  or late_minutes >= 30 then 'negative' when late_minutes >= 10 or rating = 3 then 'neutral'
  else 'positive' end as outcome_class
from (select order_id, order_status = 'DELIVERED' as delivered, order_id % 45 as late_minutes,
 order_status = 'CANCELLED' or order_id % 1000 between 100 and 127 as refunded,
 1 + order_id % 5 as rating from b_heads)""")
# The sharp s has two capitals in one engine and one in the other.
view("x_reviews", f"""
select review_id, order_id, case {draw(6, 'review_id')} % 25
  when 0 then upper(replace(review_text, 'ß', 'ss')) when 1 then lower(review_text)
  when 2 then '   ' || review_text when 3 then review_text || '   ' else review_text end
  as review_text, text_sentiment, outcome_class, text_sentiment = outcome_class as agrees,
 ambiguous, refunded, delivered
from b_reviews join (select review_id, text_sentiment, ambiguous from b_truth) using (review_id)
 join m_outcomes using (order_id)""")


def outcomes(b: Bronze):
    return b.order_heads().selectExpr(
        "order_id", "order_status = 'DELIVERED' as delivered", "order_id % 45 as late_minutes",
        "order_status = 'CANCELLED' or order_id % 1000 between 100 and 127 as refunded",
        "1 + order_id % 5 as rating")


def made_reviews(b: Bronze):
    return reviews.labelled(b.reviews(), b.review_truth(), outcomes(b), md5_draw)


@query("d25_reviews", "select * from x_reviews")
def d25(b: Bronze):
    return made_reviews(b)


@query("d25_tickets", """select conv_id as ticket_id, order_id, case when refunded
  then 'REFUND REQUEST: ' else 'ISSUE: ' end || trim(text) as ticket_text, outcome_class
from (select conv_id, conv_id * 31 % (select count(*) from orders) as order_id,
  min_by(text, turn) as text from conversations where role = 'user' group by conv_id)
 join m_outcomes using (order_id) where refunded or not delivered""")
def d25_tickets(b: Bronze):
    return reviews.tickets(b.openings(), outcomes(b))


view("x_scored", f"""select review_id, order_id, text_sentiment as y, {KEYWORD_SQL} as yhat, ambiguous
 from x_reviews""")


def scored(b: Bronze):
    return made_reviews(b).select(
        "review_id", "order_id", F.col("text_sentiment").alias("y"),
        text.keyword_sentiment(F.col("review_text")).alias("yhat"), "ambiguous")


@query("a18_confusion", """select y, yhat, ambiguous, count(*) as n from x_scored
 group by 1, 2, 3""")
def a18(b: Bronze):
    return reviews.confusion(scored(b))


def _metrics_sql() -> str:
    per = []
    for c in reviews.CLASSES:
        tp = f"sum(case when y = '{c}' and yhat = '{c}' then 1 else 0 end)"
        p = f"sum(case when yhat = '{c}' then 1 else 0 end)"
        a = f"sum(case when y = '{c}' then 1 else 0 end)"
        per.append(f"coalesce({tp} / nullif({p}, 0), 0.0) as precision_{c}, "
                   f"coalesce({tp} / nullif({a}, 0), 0.0) as recall_{c}, {a} as support_{c}")
    f1 = ", ".join(
        f"coalesce(2.0 * precision_{c} * recall_{c} / nullif(precision_{c} + recall_{c}, 0), 0.0) "
        f"as f1_{c}" for c in reviews.CLASSES)
    names = [f"{m}_{c}" for c in reviews.CLASSES for m in ("precision", "recall", "f1", "support")]
    names += ["macro_f1", "accuracy", "majority_accuracy"]
    rows = " union all ".join(f"select subset, '{n}' as metric, round(cast({n} as double), 4) "
                              "as value from w" for n in names)
    return f"""with s as (select *, 'all' as subset from x_scored union all select *,
  case when ambiguous then 'ambiguous' else 'clear' end from x_scored),
 g as (select subset, {', '.join(per)}, avg(case when y = yhat then 1.0 else 0.0 end) as accuracy,
  count(*) as n from s group by subset),
 f as (select *, {f1} from g),
 w as (select *, ({' + '.join('f1_' + c for c in reviews.CLASSES)}) / 3 as macro_f1,
  greatest({', '.join('support_' + c for c in reviews.CLASSES)}) / n as majority_accuracy from f)
{rows}"""


@query("a18_scores", _metrics_sql())
def a18_scores(b: Bronze):
    return reviews.scores(scored(b))


@query("a19_sentiment_mix", f"""
select restaurant_id, count(*) as n, round(avg(case when s = 'negative' then 1.0 else 0.0 end), 6)
 as negative_share, round(avg(abs(up - down) / greatest(up + down, 1)), 6) as mean_confidence
from (select h.restaurant_id, {KEYWORD_SQL} as s, {hits_sql(text.POSITIVE_WORDS)} as up,
  {hits_sql(text.NEGATIVE_WORDS)} as down from x_reviews join b_heads h using (order_id))
group by restaurant_id""")
def a19(b: Bronze):
    """Shares of predictions, and how one-sided the words were that they come from."""
    shops = b.order_heads().select("order_id", "restaurant_id")
    s = made_reviews(b).select(
        "order_id", text.keyword_sentiment(F.col("review_text")).alias("yhat"),
        text.keyword_confidence(F.col("review_text")).alias("c"))
    return s.join(shops, "order_id").groupBy("restaurant_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg((F.col("yhat") == "negative").cast("double")), 6).alias("negative_share"),
        F.round(F.avg("c"), 6).alias("mean_confidence"))


@query("a20_sentiment_vs_operations", """
select round(corr(negative_share, late_share), 6) as corr_late,
 round(corr(negative_share, refund_share), 6) as corr_refund, count(*) as n_restaurants
from (select h.restaurant_id, avg(case when text_sentiment = 'negative' then 1.0 else 0.0 end)
  as negative_share, avg(case when order_id % 45 >= 30 then 1.0 else 0.0 end) as late_share,
  avg(case when refunded then 1.0 else 0.0 end) as refund_share
 from x_reviews join b_heads h using (order_id) group by 1)""")
def a20(b: Bronze):
    shops = b.order_heads().select("order_id", "restaurant_id")
    per = made_reviews(b).join(shops, "order_id").groupBy("restaurant_id").agg(
        F.avg((F.col("text_sentiment") == "negative").cast("double")).alias("negative_share"),
        F.avg((F.col("order_id") % 45 >= 30).cast("double")).alias("late_share"),
        F.avg(F.col("refunded").cast("double")).alias("refund_share"))
    return per.agg(F.round(F.corr("negative_share", "late_share"), 6).alias("corr_late"),
                   F.round(F.corr("negative_share", "refund_share"), 6).alias("corr_refund"),
                   F.count(F.lit(1)).alias("n_restaurants"))
