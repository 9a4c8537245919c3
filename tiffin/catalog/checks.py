"""Queries: data tests, each on clean data and on data damaged by a fixed rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from tiffin.catalog.models import stg_orders, stg_refunds
from tiffin.catalog.registry import query
from tiffin.operators import quality
from tiffin.plans import defects, marts, staging, staging_tests
from tiffin.plans import events as ev
from tiffin.plans.demand import actual_daily, actual_hourly
from tiffin.session import materialise, scratch
from tiffin.sources import landing, tables
from tiffin.sources.bronze import NOTES, Bronze


@query("q01_not_null_clean", "select order_id from b_orders where order_status is null")
def q01(b: Bronze):
    return quality.not_null(b.orders(), "order_status").select("order_id")


@query("q01_not_null_broken", "select shift_id from b_shifts where logout_at is null")
def q01_broken(b: Bronze):
    return quality.not_null(b.courier_shifts(), "logout_at").select("shift_id")


@query("q02_unique_clean", """select match_id, count(*) as n_rows from b_attempts
 group by 1 having count(*) > 1""")
def q02(b: Bronze):
    return quality.unique(b.match_attempts(), ["match_id"])


@query("q02_unique_broken", """select order_id, line_no, count(*) as n_rows from b_lines
 group by 1, 2 having count(*) > 1""")
def q02_broken(b: Bronze):
    return quality.unique(b.lines(), ["order_id", "line_no"])


@query("q03_relationships_clean", """select order_id, line_no from b_lines
 where order_id not in (select o_orderkey from orders)""")
def q03(b: Bronze):
    orders = b.raw("orders").select(F.col("o_orderkey").alias("order_id"))
    return quality.relationships(b.lines(), "order_id", orders, "order_id",
                                 b.tasks("lineitem")).select("order_id", "line_no")


@query("q03_relationships_broken", "select refund_id, payment_id from b_claims where payment_id < 0")
def q03_broken(b: Bronze):
    return quality.relationships(b.refund_claims(), "payment_id", b.payments(), "payment_id",
                                 b.tasks("orders")).select("refund_id", "payment_id")


_NOTES = ", ".join(f"'{n}'" for n in NOTES)


@query("q04_accepted_values_clean", f"""select order_id, delivery_notes from m_stg_orders
 where delivery_notes is not null and delivery_notes not in ({_NOTES})""")
def q04(b: Bronze):
    notes = stg_orders(b)
    return quality.accepted_values(notes, "delivery_notes", NOTES,
                                   F.col("delivery_notes").isNotNull()) \
        .select("order_id", "delivery_notes")


@query("q04_accepted_values_broken", f"""select order_id, delivery_notes from b_heads
 where delivery_notes is not null and delivery_notes not in ({_NOTES})""")
def q04_broken(b: Bronze):
    """The same test on the raw notes finds the damage."""
    return quality.accepted_values(b.order_heads(), "delivery_notes", NOTES,
                                   F.col("delivery_notes").isNotNull()) \
        .select("order_id", "delivery_notes")


_ACCEPTED = """select o.order_id, o.order_status, coalesce(n, 0) as accepted_count from b_heads o
 left join (select order_id, count(*) as n from {attempts} where response = 'ACCEPTED' group by 1) a
  on a.order_id = o.order_id
 where coalesce(n, 0) <> case when order_status = 'UNFULFILLED' then 0 else 1 end"""


@query("q05_one_accepted_clean", _ACCEPTED.format(attempts="b_attempts"))
def q05(b: Bronze):
    return quality.one_accepted_match(b.order_heads(), b.match_attempts())


@query("q05_one_accepted_broken", _ACCEPTED.format(
    attempts="(select order_id, case when order_id % 40 = 1 then 'ACCEPTED' when order_id % 40 = 2 "
             "then 'TIMEOUT' else response end as response from b_attempts)"))
def q05_broken(b: Bronze):
    k = F.col("order_id") % 40
    damaged = b.match_attempts().withColumn("response", F.when(k == 1, "ACCEPTED")
                                            .when(k == 2, "TIMEOUT").otherwise(F.col("response")))
    return quality.one_accepted_match(b.order_heads(), damaged)


_SUBTOTAL = """select o.order_id, o.subtotal, cast(coalesce(s, 0) as decimal(18,2))
 as computed_subtotal from {orders} o
 left join (select order_id, cast(sum(line_total) as decimal(18,2)) as s from b_lines group by 1) l
  on l.order_id = o.order_id where o.subtotal is distinct from coalesce(s, 0)"""


@query("q06_subtotal_clean", _SUBTOTAL.format(orders="b_orders"))
def q06(b: Bronze):
    return quality.subtotal_mismatch(b.orders(), b.lines())


@query("q06_subtotal_broken", _SUBTOTAL.format(
    orders="(select order_id, cast(subtotal + case when order_id % 29 = 0 then 0.01 else 0 end "
           "as decimal(18,2)) as subtotal from b_orders)"))
def q06_broken(b: Bronze):
    off = F.expr("cast(subtotal + if(order_id % 29 = 0, 0.01, 0) as decimal(18,2))")
    return quality.subtotal_mismatch(b.orders().withColumn("subtotal", off), b.lines())


_PAID = """select p.order_id, p.amount, o.order_total from {payments} p left join b_orders o
 on o.order_id = p.order_id where p.status = 'SUCCESS' and p.amount is distinct from o.order_total"""


@query("q07_payment_clean", _PAID.format(payments="b_payments"))
def q07(b: Bronze):
    return quality.payment_mismatch(b.orders(), b.payments())


@query("q07_payment_broken", _PAID.format(
    payments="(select order_id, status, cast(case when order_id % 31 = 0 then amount - 1 "
             "else amount end as decimal(18,2)) as amount from b_payments)"))
def q07_broken(b: Bronze):
    off = F.expr("cast(if(order_id % 31 = 0, amount - 1, amount) as decimal(18,2))")
    return quality.payment_mismatch(b.orders(), b.payments().withColumn("amount", off))


_REFUND = """select r.refund_id, r.order_id, r.refund_amount, o.order_total from {refunds} r
 join b_orders o on o.order_id = r.order_id where r.refund_amount > o.order_total"""


@query("q08_refund_clean", _REFUND.format(refunds="m_stg_refunds"))
def q08(b: Bronze):
    return quality.refund_above_total(b.orders(), stg_refunds(b))


@query("q08_refund_broken", _REFUND.format(
    refunds="(select refund_id, order_id, cast(refund_amount * 2 as decimal(18,2)) as refund_amount "
            "from m_stg_refunds)"))
def q08_broken(b: Bronze):
    doubled = F.expr("cast(refund_amount * 2 as decimal(18,2))")
    return quality.refund_above_total(b.orders(), stg_refunds(b).withColumn("refund_amount",
                                                                            doubled))


def _bucketed(b: Bronze):
    """Orders with the day and hour they fall in."""
    first = b.raw("orders").agg(F.to_date(F.min("o_orderdate"))).scalar()
    return b.order_heads().select("order_id", F.datediff(F.to_date("placed_at"), first)
                                  .alias("day_index"), F.hour("placed_at").alias("hour"))


@query("q09_volume_clean", """
select e.day_index, e.hour, e.orders as expected, cast(coalesce(a.n, 0) as integer) as actual
from m_demand_hourly e left join (select cast(cast(placed_at as date)
  - (select min(cast(o_orderdate as date)) from orders) as integer) as day_index,
  hour(placed_at) as hour, count(*) as n from b_heads group by 1, 2) a
 on a.day_index = e.day_index and a.hour = e.hour where e.orders <> coalesce(a.n, 0)""")
def q09(b: Bronze):
    return quality.volume_mismatch(_bucketed(b), actual_hourly(b)).select(
        "day_index", "hour", F.col("expected").cast("int").alias("expected"),
        F.col("actual").cast("int").alias("actual"))


@query("q09_volume_broken", """
select coalesce(e.day_index, a.day_index) as day_index, coalesce(e.hour, a.hour) as hour,
 coalesce(e.n, 0) as expected, coalesce(a.n, 0) as actual
from (select day_index, hour, cast(orders as bigint) as n from m_demand_hourly) e
full join (select day_index, case when hour = 11 then 12 else hour end as hour,
 cast(sum(orders) as bigint) as n from m_demand_hourly group by 1, 2) a
 on a.day_index = e.day_index and a.hour = e.hour where coalesce(e.n, 0) <> coalesce(a.n, 0)""")
def q09_broken(b: Bronze):
    """An hour counted as the next one; the totals still agree."""
    moved = _bucketed(b).withColumn("hour", F.when(F.col("hour") == 11, 12)
                                    .otherwise(F.col("hour")))
    return quality.volume_mismatch(moved, actual_hourly(b))


def _links(b: Bronze, claims: bool):
    orders = b.raw("orders").select(F.col("o_orderkey").alias("order_id"))
    refunds = b.refund_claims() if claims else b.refunds()
    lines = b.lines().withColumn("row_id", F.col("order_id") * 8 + F.col("line_no"))
    return {"item_order": (lines, "row_id", "order_id", orders, "order_id"),
            "attempt_order": (b.match_attempts(), "match_id", "order_id", orders, "order_id"),
            "payment_order": (b.payments(), "payment_id", "order_id", orders, "order_id"),
            "refund_order": (refunds, "refund_id", "order_id", orders, "order_id"),
            "refund_payment": (refunds, "refund_id", "payment_id", b.payments(), "payment_id")}


@query("q10_integrity_clean", """select 'item_order' as link, order_id * 8 + line_no as row_id,
 order_id as missing_key from b_lines where order_id not in (select o_orderkey from orders)
union all select 'refund_payment', refund_id, payment_id from b_refunds
 where payment_id not in (select payment_id from b_payments)""")
def q10(b: Bronze):
    return quality.orphans(_links(b, claims=False), b.tasks("lineitem"))


@query("q10_integrity_broken", """select 'refund_payment' as link, refund_id as row_id,
 payment_id as missing_key from b_claims where payment_id < 0""")
def q10_broken(b: Bronze):
    return quality.orphans(_links(b, claims=True), b.tasks("lineitem"))


@query("q11_parent_orphans", """select 'restaurant_zone' as link, restaurant_id as row_id,
 zone_id as missing_key from b_restaurants where zone_id not in (select zone_id from b_zones)
union all select 'menu_restaurant', menu_item_id, restaurant_id from b_menu_items
 where restaurant_id not in (select restaurant_id from b_restaurants where is_active)""")
def q11_orphans(b: Bronze):
    """Menu items are checked against the active restaurants, so some are orphans."""
    zones = b.zones()
    return quality.orphans({
        "restaurant_zone": (b.restaurants(), "restaurant_id", "zone_id", zones, "zone_id"),
        "rider_zone": (b.riders(), "rider_id", "home_zone_id", zones, "zone_id"),
        "menu_restaurant": (b.menu_items(), "menu_item_id", "restaurant_id",
                            b.restaurants().filter("is_active"), "restaurant_id")})


@query("q11_hour_day_clean", """select d.day_index, d.orders, cast(0 as bigint) as hourly_orders
 from m_demand_daily d where d.orders <> (select sum(orders) from m_demand_hourly h
  where h.day_index = d.day_index)""")
def q11_hours(b: Bronze):
    return quality.hour_day_mismatch(actual_daily(b), actual_hourly(b))


@query("q11_hour_day_broken", """select d.day_index, d.orders, h.n as hourly_orders
from m_demand_daily d join (select day_index, cast(sum(orders + case when hour = 9 then 1 else 0 end)
 as bigint) as n from m_demand_hourly group by 1) h on h.day_index = d.day_index
where d.orders <> h.n""")
def q11_hours_broken(b: Bronze):
    off = actual_hourly(b).withColumn("orders", F.col("orders") + (F.col("hour") == 9).cast("int"))
    return quality.hour_day_mismatch(actual_daily(b), off)


_CAPACITY = """select day_index, orders, (select count(*) from b_riders where {who}) as active_riders
from m_demand_daily where orders > {per} * (select count(*) from b_riders where {who})"""


@query("q11_capacity_clean", _CAPACITY.format(who="is_active", per=12))
def q11_capacity(b: Bronze):
    return quality.over_capacity(actual_daily(b), b.riders())


@query("q11_capacity_broken", _CAPACITY.format(who="is_active and vehicle_type = 'car'", per=1))
def q11_capacity_broken(b: Bronze):
    """Only the cars, and one delivery each: too few for the busy days."""
    return quality.over_capacity(actual_daily(b), b.riders().filter("vehicle_type = 'car'"),
                                 per_rider=1)


@query("q11_zones_without_rider", """select zone_id from b_zones where zone_id not in
 (select home_zone_id from b_riders where is_active and rider_id >= 0)""")
def q11_zones(b: Bronze):
    """Without the floor riders some zones have nobody."""
    return quality.zones_without_rider(b.zones(), b.riders().filter("rider_id >= 0"))


def _built(b: Bronze, times: int):
    """The order mart built and written so many times, each from the raw tables."""
    from tiffin.catalog.models import fct_orders
    mart = fct_orders(b)
    paths = [scratch(b.spark, "rerun") for _ in range(times)]
    for path in paths:
        tables.overwrite(mart, marts.CONTRACTS["fct_orders"], path, "fct_orders")
    return [b.spark.read.schema(mart.schema).parquet(p) for p in paths]


@query("q14_rerun_clean", """select * from (select 'n_rows' as measure,
 cast(count(*) as decimal(38,2)) as before, cast((select count(*) from m_fct_orders)
 as decimal(38,2)) as after from m_fct_orders
union all select 'revenue', cast(sum(net_revenue) as decimal(38,2)), cast((select sum(net_revenue)
 from m_fct_orders) as decimal(38,2)) from m_fct_orders) where before <> after""")
def q14(b: Bronze):
    first, second = _built(b, 2)
    return quality.changed_by_rerun(first, second, {
        "n_rows": F.count(F.lit(1)), "revenue": F.sum("net_revenue")})


@query("q14_fingerprint_clean", """select zone_id, count(*) as rows_before, count(*) as rows_after
 from m_fct_orders group by 1 having count(*) < 0""")
def q14_fingerprint(b: Bronze):
    """Two builds agree in every zone, whatever the order of rows and files."""
    first, second = _built(b, 2)
    return tables.changed_parts(first, second.repartition(5), ["zone_id"])


@query("q14_fingerprint_broken", """select zone_id, count(*) as rows_before, count(*) as rows_after
 from m_fct_orders where zone_id = (select zone_id from m_fct_orders order by order_id limit 1)
 group by 1""")
def q14_fingerprint_broken(b: Bronze):
    """One order has one cent more: its zone is named, and no other."""
    first = _built(b, 1)[0]
    one = F.col("order_id") == first.agg(F.min("order_id")).scalar()
    cent = F.lit("0.01").cast("decimal(18,2)")
    kind = first.schema["net_revenue"].dataType
    second = first.withColumn("net_revenue", (F.col("net_revenue") + F.when(one, cent).otherwise(0))
                              .cast(kind))
    return tables.changed_parts(first, second, ["zone_id"])


@query("q14_rerun_broken", """select * from (select 'n_rows' as measure,
 cast(count(*) as decimal(38,2)) as before, cast((select count(*) * 2 from b_payments)
 as decimal(38,2)) as after from b_payments
union all select 'cents', cast(sum(amount) as decimal(38,2)), cast((select sum(amount) * 2
 from b_payments) as decimal(38,2)) from b_payments)""")
def q14_broken(b: Bronze):
    """A second run that appended instead of replacing."""
    once = b.payments()
    return quality.changed_by_rerun(once, once.unionByName(once), {
        "n_rows": F.count(F.lit(1)), "cents": F.sum("amount")})


_PATHS = """select 'missing arrival path' as problem from (select count(distinct path) as n
 from (select path, row_number() over (partition by order_id, event_type, occurred_at
  order by path, received_at, event_id) as rn from ({arms})) where rn = 1) where n < 2"""


@query("q18_arrival_paths_clean", _PATHS.format(
    arms="select *, 'batch' as path from b_events where event_id % 3 <> 0 union all "
         "select *, 'stream' from b_events where event_id % 3 = 0 or event_id % 2 = 0"))
def q18(b: Bronze):
    e = b.order_events()
    both = ev.unioned(e.filter("event_id % 3 <> 0"),
                      e.filter("event_id % 3 = 0 or event_id % 2 = 0"))
    return _missing_path(both)


@query("q18_arrival_paths_broken", _PATHS.format(arms="select *, 'batch' as path from b_events"))
def q18_broken(b: Bronze):
    return _missing_path(ev.unioned(b.order_events(), None))


def _missing_path(events):
    return events.agg(F.countDistinct("_arrival_path").alias("n")).filter("n < 2").select(
        F.lit("missing arrival path").alias("problem"))


@query("q20_defect_matrix", """
select cast(17 as integer) as defect_id, 'text damage' as defect, 'stg_orders' as repaired_by,
 count(*) filter (where delivery_notes not in ({notes})) as found_raw,
 (select count(*) from m_stg_orders where delivery_notes not in ({notes})) as left_after
from b_heads
union all select 18, 'accounting text', 'stg_refunds',
 count(*) filter (where refund_amount_raw like '(%'),
 (select count(*) from m_stg_refunds where refund_amount is null) from b_refunds
union all select 4, 'out-of-order arrival', 'pings_clean', (select count(*) from (select
  _ingested_at < lag(_ingested_at) over (partition by courier_id order by ping_ts, ping_id) as o
  from b_pings where accuracy_m <= 100) where o), cast(0 as bigint)""".format(notes=_NOTES))
def q20(b: Bronze):
    """Each described defect with how often it occurs and what its repair leaves."""
    def tally(df, condition):
        return df.agg(F.count_if(condition)).scalar()
    bad_note = ~F.col("delivery_notes").isin(NOTES)
    raw_refunds = b.refunds()
    texts = b.order_heads().agg(F.count_if(bad_note).alias("found_raw")).select(
        F.lit(17).alias("defect_id"), F.lit("text damage").alias("defect"),
        F.lit("stg_orders").alias("repaired_by"), "found_raw",
        tally(stg_orders(b), bad_note).alias("left_after"))
    money = raw_refunds.agg(F.count_if(F.col("refund_amount_raw").startswith("("))
                            .alias("found_raw")).select(
        F.lit(18), F.lit("accounting text"), F.lit("stg_refunds"), "found_raw",
        tally(stg_refunds(b), F.col("refund_amount").isNull()).alias("left_after"))
    cleaned = ev.clean_pings(b.gps_pings())
    by_event = defects.REGISTRY[2].violations(cleaned.withColumn("route_clock", F.col("ping_ts")))
    pings = cleaned.agg(F.count_if("out_of_order").alias("found_raw")).select(
        F.lit(4), F.lit("out-of-order arrival"), F.lit("pings_clean"), "found_raw",
        by_event.agg(F.count(F.lit(1))).scalar())
    return texts.union(money).union(pings)


@query("q20_defect_proofs", f"""
select 'text damage' as defect, 'stg_orders' as repaired_by, cast(0 as bigint) as found_clean,
 count(*) filter (where order_id % 25 = 0) as found_damaged, cast(0 as bigint) as left_after
 from m_stg_orders where delivery_notes in ({_NOTES})
union all select 'accounting text', 'stg_refunds', 0, count(*) filter (where refund_id % 10 = 0), 0
 from m_stg_refunds
union all select 'out-of-order arrival', 'pings_clean', 0, count(*) filter (where ping_ts < before),
 0 from (select ping_ts, lag(ping_ts) over (partition by courier_id order by _ingested_at, ping_id)
 as before from b_pings where accuracy_m <= 100)
union all select 'repeated delivery', 'events_deduplicated', 0, count(*) filter (event_id % 20 = 0),
 0 from (select event_id, row_number() over (partition by order_id, event_type, occurred_at
 order by received_at, event_id) as rn from b_events) where rn = 1
union all select 'open shift', 'shifts_merged', 0, count(*) filter (shift_id % 50 = 0), 0
 from b_shifts
union all select 'low accuracy', 'pings_clean', 0, count(*) filter (ping_id % 40 = 0), 0
 from b_pings where accuracy_m <= 100
union all select 'negative quantity', 'quarantine', 0,
 count(*) filter ((order_id + line_no) % 30 = 0), 0 from b_lines where quantity > 0""")
def q20_proofs(b: Bronze):
    """Each defect injected into rows that its test accepts, found there, and gone after repair."""
    return defects.proofs({
        "notes": stg_orders(b).filter(F.col("delivery_notes").isin(NOTES)).select(
            "order_id", "delivery_notes"),
        "refunds": stg_refunds(b).select("refund_id", F.col("refund_amount").cast("string")
                                         .alias("refund_amount_raw")),
        "pings": b.gps_pings().filter("accuracy_m <= 100").withColumn(
            "route_clock", F.col("ping_ts")),
        "events": ev.deduplicated(b.order_events()),
        "shifts": defects.REGISTRY[4].repair(b.courier_shifts()),
        "lines": b.lines().filter("quantity > 0").select("order_id", "line_no", "quantity")})


@query("q21_duplicate_events", """select event_id, order_id, event_type from (select *,
 row_number() over (partition by order_id, event_type, occurred_at order by received_at, event_id)
 as rn from b_events) where rn > 1""")
def q21(b: Bronze):
    return ev.flagged_events(b.order_events()).filter("reason_code = 'DUP_EVENT'").select(
        "event_id", "order_id", "event_type")


@query("q22_shift_flags", """select shift_id, case when logout_at is null then 'SHIFT_NULL_LOGOUT'
 when login_at < prev then 'SHIFT_OVERLAP' end as reason_code from (select *, lag(logout_at) over (
 partition by courier_id order by login_at, shift_id) as prev from b_shifts)""")
def q22(b: Bronze):
    from tiffin.operators.islands import overlap_flags
    return overlap_flags(b.courier_shifts()).select("shift_id", quality.first_reason(
        (F.col("logout_at").isNull(), "SHIFT_NULL_LOGOUT"),
        (F.col("login_at") < F.col("previous_logout"), "SHIFT_OVERLAP")).alias("reason_code"))


@query("q22_ping_accuracy", "select ping_id from b_pings where accuracy_m > 100")
def q22_pings(b: Bronze):
    return b.gps_pings().filter("accuracy_m > 100").select("ping_id")


@query("q22_negative_quantity", "select order_id, line_no from b_lines where quantity - 3 <= 0")
def q22_quantity(b: Bronze):
    """Quantities after three were taken back; some are no longer positive."""
    left = b.lines().withColumn("quantity", F.col("quantity") - 3)
    return left.filter("quantity <= 0").select("order_id", "line_no")


def _gated(b: Bronze, damage=None):
    """Staged orders are written and checked, then a mart is built from what was written."""
    root = scratch(b.spark, "layers")
    staged = staging.stg_orders(b.orders() if damage is None else damage(b.orders()))

    def at(name):
        return b.spark.read.parquet(f"{root}/{name}")

    def marts_layer():
        at("stg_orders").groupBy("zone_id").agg(F.count(F.lit(1)).alias("n_orders")) \
            .write.parquet(f"{root}/orders_by_zone")
    layers = [
        ("staging", lambda: staged.write.parquet(f"{root}/stg_orders"), [
            quality.Check("order_status is set",
                          lambda: quality.not_null(at("stg_orders"), "order_status")),
            quality.Check("order_id is unique",
                          lambda: quality.unique(at("stg_orders"), ["order_id"]))]),
        ("marts", marts_layer, [
            quality.Check("zone_id is unique",
                          lambda: quality.unique(at("orders_by_zone"), ["zone_id"]))])]
    return root, layers


@query("q13_layer_gate", "select 'staging' as layer, count(*) as n_orders from b_orders")
def q13(b: Bronze):
    """Two layers built, each behind its checks; what the first one wrote."""
    root, layers = _gated(b)
    quality.run_layers(layers)
    return b.spark.read.parquet(f"{root}/stg_orders").agg(F.count(F.lit(1)).alias("n_orders")).select(
        F.lit("staging").alias("layer"), "n_orders")


@query("q13_layer_gate_broken", """select 'staging' as layer, 'order_id is unique' as failed_check,
 count(*) + count(*) filter (order_id % 100 = 0) as n_written, false as next_layer_built
from b_orders""")
def q13_broken(b: Bronze):
    """Some orders come twice: the gate stops after staging and the mart is not built."""
    root, layers = _gated(b, lambda o: o.unionByName(o.filter("order_id % 100 = 0")))
    try:
        quality.run_layers(layers)
        failed = None
    except quality.GateError as exc:
        failed = str(exc).split(":")[0]
    built = tables.exists(b.spark, f"{root}/orders_by_zone")
    return b.spark.read.parquet(f"{root}/stg_orders").agg(F.count(F.lit(1)).alias("n_written")).select(
        F.lit("staging").alias("layer"), F.lit(failed).alias("failed_check"), "n_written",
        F.lit(built).alias("next_layer_built"))


_VIEWS = {"cities": "b_cities", "zones": "b_zones", "restaurants": "b_restaurants",
          "riders": "b_riders", "menu_items": "b_menu_items", "rider_payout_tiers": "b_tiers",
          "demand_daily": "m_demand_daily", "demand_hourly": "m_demand_hourly",
          "customers": "m_stg_customers", "orders": "m_stg_orders", "order_items": "b_items",
          "match_attempts": "b_attempts", "payments": "b_payments", "refunds": "m_stg_refunds"}


def _staged(b: Bronze, damage=None):
    """All staging models, written once; ``damage`` changes the orders before the tests.

    Payments and refunds come from the written orders, whose subtotals take the lines to add up.
    """
    from tiffin.catalog import models
    orders = materialise(stg_orders(b), "stg-orders")
    made = {"refunds": staging.stg_refunds(b.refunds(orders)),
            "payments": staging.passed(b.payments(orders), "payments"),
            "customers": models.d03(b), "order_items": models.order_items(b),
            "demand_daily": actual_daily(b), "demand_hourly": actual_hourly(b)}
    for name in _VIEWS.keys() - made.keys() - {"orders"}:
        made[name] = staging.passed(getattr(b, name)(), name)
    written = {name: materialise(df, f"stg-{name}") for name, df in made.items()}
    return written | {"orders": orders if damage is None
                      else materialise(damage(orders), "stg-damaged-orders")}


@query("q13_staging_tests_clean", staging_tests.sql(_VIEWS))
def q13_staging(b: Bronze):
    """Every declared test of every staging model with its number of failures. The rate card has
    two periods per tier, which its test of uniqueness reports."""
    return staging_tests.report(_staged(b).__getitem__, _VIEWS)


@query("q13_staging_tests_broken", "with damaged as (select * replace (case when order_id % 50 = 0 "
       "then 'LOST' else order_status end as order_status, case when order_id % 70 = 0 then null "
       "else zone_id end as zone_id) from m_stg_orders union all select * from m_stg_orders "
       "where order_id % 90 = 1) select * from (" + staging_tests.sql(
           {"orders": "damaged", "customers": "m_stg_customers", "restaurants": "b_restaurants",
            "zones": "b_zones"}) + ") where model = 'orders' and failures > 0")
def q13_staging_broken(b: Bronze):
    """Orders of an unknown status, without a zone, and some twice: three tests fail, by number."""
    def damage(o):
        bad = o.withColumn("order_status", F.when(F.col("order_id") % 50 == 0, "LOST")
                           .otherwise(F.col("order_status"))) \
            .withColumn("zone_id", F.when(F.col("order_id") % 70 != 0, F.col("zone_id")))
        return bad.unionByName(o.filter("order_id % 90 = 1"))
    staged = _staged(b, damage)
    return staging_tests.report(staged.__getitem__, ["orders", "customers", "restaurants", "zones"]) \
        .filter("model = 'orders' and failures > 0")


def _lineage(b: Bronze, extra: dict):
    """Forbidden tables per mart, with the rows of each such mart."""
    from tiffin.catalog import models
    known = {"fct_orders": models.fct_orders(b), "stg_customers": models.d03(b),
             "fct_deliveries": models.d07(b), "int_order_economics": models.economics(b),
             "reviews": b.reviews(), **extra}
    bad = quality.forbidden_sources(known, marts.ANSWER_KEY)
    out = b.spark.createDataFrame([], "mart string, source string, n_rows long")
    for name, found in bad.items():
        for source in found:
            out = out.unionByName(known[name].agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("mart"), F.lit(source).alias("source"), "n_rows"))
    return out


@query("q12_lineage_clean", """select 'none' as mart, 'labels' as source, count(*) as n_rows
 from labels having count(*) < 0""")
def q12_lineage(b: Bronze):
    """No mart's own plan reads the answer key."""
    return _lineage(b, {})


@query("q12_lineage_broken", """select mart, 'labels' as source, count(*) as n_rows
 from documents join labels using (doc_id), (values ('good_reviews'), ('good_reviews_copied'))
 as m(mart) group by mart""")
def q12_lineage_broken(b: Bronze):
    """Reviews with the judges' labels, read straight and through a written copy."""
    labels = b.raw("labels").select(F.col("doc_id").alias("review_id"), "quality")
    copy = materialise(labels, "copied-labels")
    return _lineage(b, {"good_reviews": b.reviews().join(labels, "review_id"),
                        "good_reviews_copied": b.reviews().join(copy, "review_id")})


@query("q12_contract_enforced", "select * from m_fct_deliveries")
def q12(b: Bronze):
    """A mart written only because its names and types are those of its contract."""
    from tiffin.catalog.models import matching
    mart = marts.fct_deliveries(matching(b), b.shells())
    path = scratch(b.spark, "fct_deliveries")
    tables.overwrite(mart, marts.CONTRACTS["fct_deliveries"], path, "fct_deliveries")
    return b.spark.read.schema(mart.schema).parquet(path)


@query("q19_namespace_guard", "select c_custkey, c_name, 'b1' as _bronze_batch_id from customer")
def q19(b: Bronze):
    """Metadata is added only when no source column uses its prefix."""
    source = b.raw("customer", "c_custkey", "c_name")
    quality.free_namespace(source.columns)
    return landing.with_metadata(source, "b1").select("c_custkey", "c_name", "_bronze_batch_id")


@query("q23_landing_contract", """select cast(refund_id as varchar) as refund_id, refund_amount_raw,
 cast(null as varchar) as _bronze_rescued, 'b1' as _bronze_batch_id from b_refunds""")
def q23(b: Bronze):
    """A landing table is all strings and carries its metadata, or it is refused."""
    path = scratch(b.spark, "landing")
    landing.export(b.refunds().select("refund_id", "refund_amount_raw"), path)
    landed = landing.with_metadata(landing.read_csv(b.spark, path, ["refund_id",
                                                                   "refund_amount_raw"]), "b1")
    quality.landing_contract(landed, landing.METADATA)
    return landed.drop("_bronze_ingested_at", "_bronze_source_file")
