"""Queries: generated tables, weighted picks, offsets, ids and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tiffin.catalog.oracle import DOW_SQL, draw, pick, view, wide_draw
from tiffin.catalog.registry import query
from tiffin.functions.draws import md5_draw, md5_wide
from tiffin.operators import allocate, slices
from tiffin.plans import demand, synth
from tiffin.plans.demand import actual_hourly
from tiffin.sources.bronze import NOTES, REASONS, Bronze
from tiffin.session import materialise

EPOCH = "1995-01-01 00:00:00"


def restaurant_weights(b: Bronze):
    """Popularity by rank, as whole numbers so that prefix sums are exact."""
    ranked = slices.block_ranked(b.raw("supplier").selectExpr("s_suppkey as restaurant_id"), [],
                                 "restaurant_id", "rank")
    return ranked.select("restaurant_id", F.round(allocate.zipf_weight(F.col("rank")) * 1_000_000)
                         .cast("bigint").alias("weight"))


def customer_weights(b: Bronze):
    return b.raw("customer").selectExpr("c_custkey as customer_id",
                                        "1 + c_custkey * 7919 % 100 as weight")


def shell(b: Bronze):
    homes = b.raw("customer").selectExpr("c_custkey as customer_id",
                                         "cast(c_nationkey as bigint) as zone_id")
    fees = b.zones().select("zone_id", F.col("base_delivery_fee").alias("delivery_fee"))
    rates = b.raw("supplier").selectExpr("s_suppkey as restaurant_id").selectExpr(
        "restaurant_id", "cast((16 + restaurant_id % 9) / 100 as decimal(5,4)) as commission_pct")
    return synth.orders_shell(actual_hourly(b), restaurant_weights(b), customer_weights(b), homes,
                              fees, rates, md5_draw)


def ranges_sql(table: str, key: str) -> str:
    """Half-open stretches of the cumulative weight per key."""
    return f"""select {key}, sum(weight) over (order by {key}) - weight as lo,
 sum(weight) over (order by {key}) as hi, sum(weight) over () as t from {table} where weight > 0"""


def point(salt: int, key: str, ranges: str) -> str:
    """Where a wide draw falls on the weight axis."""
    return (f"{wide_draw(salt, key)} * (select cast(max(t) as hugeint) from {ranges}) "
            "// 281474976710656")


view("x_restaurant_weights", """select s_suppkey as restaurant_id,
 cast(round(1.0 / pow(row_number() over (order by s_suppkey) - 1 + 5.0, 0.85) * 1000000) as bigint)
 as weight from supplier""")
view("x_customer_weights", """select c_custkey as customer_id, 1 + c_custkey * 7919 % 100 as weight
 from customer""")
view("x_restaurant_ranges", ranges_sql("x_restaurant_weights", "restaurant_id"))
view("x_customer_ranges", ranges_sql("x_customer_weights", "customer_id"))
view("x_offsets", """select *, cast(coalesce(sum(orders) over (order by day_index, hour
 rows between unbounded preceding and 1 preceding), 0) as bigint) as order_offset
from m_demand_hourly""")
view("x_shell", f"""
select order_id, s.customer_id, s.restaurant_id, cast(c_nationkey as bigint) as zone_id,
 cast(order_date as timestamp) + to_seconds(hour * 3600 + {draw(105, 'order_id')} % 3600)
  as placed_at,
 case when {draw(104, 'order_id')} < 25000 then 'UNFULFILLED'
  when {draw(104, 'order_id')} < 85000 then 'CANCELLED' else 'DELIVERED' end as order_status,
 cast(19 + 3 * ((c_nationkey // 5) // 3) as decimal(18,2)) as delivery_fee,
 cast((16 + s.restaurant_id % 9) / 100 as decimal(5,4)) as commission_pct,
 case when {draw(106, 'order_id')} < 250000 then {pick(NOTES, draw(107, 'order_id'))} end
  as delivery_notes, day_index, hour
from (select o.*, r.restaurant_id, c.customer_id from
  (select *, {point(102, 'order_id', 'x_restaurant_ranges')} as p,
    {point(103, 'order_id', 'x_customer_ranges')} as q from
   (select *, order_offset + unnest(generate_series(0, orders - 1)) + 1 as order_id
    from x_offsets)) o
  join x_restaurant_ranges r on o.p >= r.lo and o.p < r.hi
  join x_customer_ranges c on o.q >= c.lo and o.q < c.hi) s
join customer on c_custkey = s.customer_id""")
view("x_menu", """select restaurant_id, menu_item_id, price,
 row_number() over (partition by restaurant_id order by menu_item_id) - 1 as item_idx,
 count(*) over (partition by restaurant_id) as n_items from b_menu_items""")
view("x_items", f"""
select row_number() over (order by order_id, slot) as order_item_id, order_id, menu_item_id,
 quantity, price as unit_price, cast(price * quantity as decimal(18,2)) as line_total
from (select s.order_id, slot, m.menu_item_id, m.price,
  cast({draw(204, 's.order_id', 'slot')} % 3 + 1 as integer) as quantity
 from (select order_id, restaurant_id, unnest(generate_series(0, case
   when {draw(202, 'order_id')} < 450000 then 0 when {draw(202, 'order_id')} < 750000 then 1
   when {draw(202, 'order_id')} < 900000 then 2 else 3 end)) as slot from x_shell) s
 join x_menu m on m.restaurant_id = s.restaurant_id
  and m.item_idx = {draw(203, 's.order_id', 'slot')} % m.n_items)""")
view("x_orders", f"""
select s.order_id, printf('O-%07d', s.order_id) as order_ref, customer_id, restaurant_id, zone_id,
 placed_at, order_status, subtotal, delivery_fee, commission_pct,
 cast(subtotal * commission_pct as decimal(18,2)) as commission_amount,
 cast(subtotal + delivery_fee as decimal(18,2)) as order_total,
 case when {draw(302, 's.order_id')} >= 80000 then delivery_notes
  else case {draw(303, 's.order_id')} % 4 when 0 then upper(delivery_notes)
   when 1 then lower(delivery_notes) when 2 then '   ' || delivery_notes
   else delivery_notes || '   ' end end as delivery_notes
from x_shell s join (select order_id, cast(sum(line_total) as decimal(18,2)) as subtotal
 from x_items group by order_id) t on t.order_id = s.order_id""")
view("x_attempts", f"""
select row_number() over (order by o.order_id, attempt_number) as match_id, o.order_id, r.rider_id,
 cast(attempt_number as integer) as attempt_number,
 placed_at + to_seconds((attempt_number - 1) * 120) as offered_at,
 case when order_status <> 'UNFULFILLED' and attempt_number = n then 'ACCEPTED'
  when {draw(404, 'o.order_id', 'attempt_number')} % 2 = 0 then 'DECLINED' else 'TIMEOUT' end
  as response,
 placed_at + to_seconds((attempt_number - 1) * 120
  + {draw(405, 'o.order_id', 'attempt_number')} % 60 + 15) as responded_at
from (select *, unnest(generate_series(1, n)) as attempt_number from (select order_id, zone_id,
  order_status, placed_at, case when order_status = 'UNFULFILLED'
   then case when {draw(402, 'order_id')} < 500000 then 2 else 3 end
   else case when {draw(402, 'order_id')} < 700000 then 1
    when {draw(402, 'order_id')} < 900000 then 2 else 3 end end as n from x_orders)) o
join b_active_riders r on r.zone_id = o.zone_id
 and r.rider_idx = {draw(403, 'o.order_id', 'attempt_number')} % r.n_riders""")
view("x_payments", f"""
select row_number() over (order by order_id) as payment_id, order_id, order_total as amount,
 case when {draw(503, 'order_id')} < 450000 then 'upi' when {draw(503, 'order_id')} < 750000
  then 'card' when {draw(503, 'order_id')} < 900000 then 'wallet' else 'cod' end as method,
 case when {draw(502, 'order_id')} < 10000 then 'FAILED' else 'SUCCESS' end as status,
 placed_at + to_seconds({draw(504, 'order_id')} % 30 + 5) as paid_at
from x_orders where order_status <> 'UNFULFILLED'""")
view("x_refunds", f"""
select row_number() over (order by order_id) as refund_id, order_id, payment_id,
 case when {draw(605, 'order_id')} < 150000 then '(' || cast(a as varchar) || ')'
  else cast(a as varchar) end as refund_amount_raw, reason,
 placed_at + to_seconds(case when order_status = 'CANCELLED'
  then ({draw(606, 'order_id')} % 30 + 5) * 60
  else ({draw(607, 'order_id')} % 48 + 24) * 3600 end) as refunded_at
from (select o.order_id, order_status, placed_at, payment_id,
  cast(case when order_status = 'CANCELLED' then order_total else cast(order_total as decimal(18,2))
   * cast((3000000 + {draw(603, 'o.order_id')} * 7) / 10000000 as decimal(9,7)) end
   as decimal(18,2)) as a,
  case when order_status = 'CANCELLED' then 'CANCELLED'
   else {pick(REASONS, draw(604, 'o.order_id'))} end as reason
 from x_orders o join x_payments p on p.order_id = o.order_id
 where order_status = 'CANCELLED' or (order_status = 'DELIVERED'
  and {draw(602, 'o.order_id')} < 28000))""")
view("x_zone_weights", """
select zone_id, cast(f + case when row_number() over (partition by city_id
  order by r desc, zone_id) <= total - sum(f) over (partition by city_id) then 1 else 0 end
  as bigint) as n_zone
from (select zone_id, city_id, total, total * w // ws as f, total * w % ws as r
 from (select *, sum(w) over (partition by city_id) as ws from (
  select z.zone_id, z.city_id, cast(round(exp(-cast(ring as double) / 6.0), 4) * 10000 as hugeint)
   as w, cast(n as hugeint) as total from b_zones z join (select city_id, count(*) as n
    from b_customers group by city_id) c on c.city_id = z.city_id)))""")
view("x_zone_ranges", ranges_sql("(select zone_id, n_zone as weight from x_zone_weights)", "zone_id"))


def zone_weights(b: Bronze):
    cities = b.customers().groupBy("city_id").agg(F.count(F.lit(1)).alias("n_customers"))
    zones = b.zones().select("zone_id", "city_id", F.round(
        allocate.density_weight(F.col("ring").cast("double")), 4).cast("decimal(18,4)")
        .alias("zone_weight"))
    return synth.zone_weights(cities, zones)


def made_customers(b: Bronze):
    ids = b.raw("customer").select(F.col("c_custkey").alias("customer_id"))
    return synth.customers(ids, b.zones(), zone_weights(b), EPOCH, md5_draw)


_D = {i: draw(1 + i, "customer_id") for i in range(1, 12)}
_CUSTOMER_SQL = f"""
select customer_id, printf('C-%07d', customer_id) as customer_ref,
 lower(given) || '.' || lower(family) || cast(customer_id as varchar) || '@' || domain as email,
 '+91' || cast(6000000000 + {_D[5]} * 4000 + customer_id % 4000 as varchar) as phone,
 given || ' ' || family as full_name, city_id, zone_id as home_zone_id,
 timestamp '{EPOCH}' - to_seconds(({_D[8]} * 1000000 + {_D[11]}) % 63072000 + 1) as signup_ts,
 round(center_lat + ({_D[6]} / 1000000.0 - 0.5) * 0.018, 6) as lat,
 round(center_lon + ({_D[7]} / 1000000.0 - 0.5) * 0.018 / cos(radians(center_lat)), 6) as lon,
 round(exp(0.75 * sqrt(-2.0 * ln({_D[9]} / 1000000.0 + 1e-9))
  * cos(2.0 * pi() * ({_D[10]} / 1000000.0))), 6) as order_propensity
from (select c_custkey as customer_id, z.*, {pick(synth.GIVEN, draw(3, 'c_custkey'))} as given,
  {pick(synth.FAMILY, draw(4, 'c_custkey'))} as family,
  {pick(synth.DOMAINS, draw(5, 'c_custkey'))} as domain
 from (select *, {point(2, 'c_custkey', 'x_zone_ranges')} as p from customer) u
 join x_zone_ranges r on u.p >= r.lo and u.p < r.hi
 join b_zones z on z.zone_id = r.zone_id)"""


@query("d12_customers_synthesis", _CUSTOMER_SQL)
def d12(b: Bronze):
    visible, profile = made_customers(b)
    rounded = visible.withColumn("lat", F.round("lat", 6)).withColumn("lon", F.round("lon", 6))
    return (rounded.drop("created_at", "updated_at")
            .join(profile.withColumn("order_propensity", F.round("order_propensity", 6)),
                  "customer_id"))


@query("d13_orders_shell", "select * from x_shell")
def d13(b: Bronze):
    return shell(b)


@query("d14_order_items", "select * from x_items")
def d14(b: Bronze):
    return synth.order_items(materialise(shell(b), "shell"), b.menu_items(), md5_draw)


def made_orders(b: Bronze):
    """Each step is written once, as the sorts behind the ids read their rows twice."""
    s = materialise(shell(b), "shell")
    return synth.finalised(s, synth.order_items(s, b.menu_items(), md5_draw), md5_draw)


def written_orders(b: Bronze):
    return materialise(made_orders(b), "orders")


@query("d15_finalised_orders", "select * from x_orders")
def d15(b: Bronze):
    return made_orders(b)


@query("d16_match_attempts", "select * from x_attempts")
def d16(b: Bronze):
    return synth.match_attempts(written_orders(b), b.riders(), md5_draw)


@query("d17_payments", "select * from x_payments")
def d17(b: Bronze):
    return synth.payments(written_orders(b), md5_draw)


@query("d18_refunds", "select * from x_refunds")
def d18(b: Bronze):
    orders = written_orders(b)
    return synth.refunds(orders, synth.payments(orders, md5_draw), md5_draw)


# -- the operators behind them ---------------------------------------------------------------


@query("j05_lookup_join", """select o.order_id, o.zone_id, z.base_delivery_fee, z.sla_target_minutes
 from b_shells o join b_zones z on z.zone_id = o.zone_id""")
def j05(b: Bronze):
    """A lookup without a hint: Spark broadcasts it when its size allows."""
    look = b.zones().select("zone_id", "base_delivery_fee", "sla_target_minutes")
    return b.shells().select("order_id", "zone_id").join(look, "zone_id")


@query("j06_threshold_join", f"""select c_custkey as customer_id, r.zone_id
 from (select *, {point(2, 'c_custkey', 'x_zone_ranges')} as p from customer) u
 join x_zone_ranges r on u.p >= r.lo and u.p < r.hi""")
def j06(b: Bronze):
    ids = b.raw("customer").select(F.col("c_custkey").alias("customer_id"))
    return allocate.weighted_pick(ids, md5_wide(2, "customer_id"), zone_weights(b), "zone_id",
                                  "n_zone")


@query("j07_weighted_pick", f"""select o_orderkey as order_id, r.restaurant_id
from (select *, {point(102, 'o_orderkey', 'x_restaurant_ranges')} as p from orders) o
 join x_restaurant_ranges r on o.p >= r.lo and o.p < r.hi""")
def j07(b: Bronze):
    ids = b.raw("orders").select(F.col("o_orderkey").alias("order_id"))
    return allocate.weighted_pick(ids, md5_wide(102, "order_id"), restaurant_weights(b),
                                  "restaurant_id", "weight")


@query("w02_contiguous_ids", """select row_number() over (order by order_id, attempt_number) as seq,
 order_id, attempt_number, rider_id from b_attempts""")
def w02(b: Bronze):
    rows = b.match_attempts().select("order_id", "attempt_number", "rider_id")
    return slices.contiguous_ids(rows, ["order_id", "attempt_number"], "seq")


@query("w03_prefix_offsets", """select day_index, hour, cast(orders as integer) as orders,
 cast(order_offset as bigint) as order_offset from x_offsets""")
def w03(b: Bronze):
    return synth.hour_offsets(actual_hourly(b)).select("day_index", "hour", "orders",
                                                       "order_offset")


@query("w04_cumulative_weights", """select customer_id, weight,
 round(cast(sum(weight) over (order by customer_id) as double)
  / cast(sum(weight) over () as double), 9) as cumulative
 from x_customer_weights""")
def w04(b: Bronze):
    weights = customer_weights(b)
    total = weights.agg(F.sum("weight")).scalar()
    summed = allocate.cumulative(weights, "customer_id", "weight", "c")
    return summed.select("customer_id", "weight", F.round(
        F.col("c").cast("double") / total.cast("double"), 9).alias("cumulative"))


@query("w09_largest_remainder", """
select order_id, item, order_total, cast((f + case when row_number() over (partition by order_id
  order by r desc, item) <= u - sum(f) over (partition by order_id) then 1 else 0 end) / 100
  as decimal(18,2)) as part
from (select *, u * w // ws as f, u * w % ws as r from (
 select i.order_item_id as item, i.order_id, o.order_total,
  cast(o.order_total * 100 as hugeint) as u, cast(i.line_total * 10000 as hugeint) as w,
  cast(sum(i.line_total) over (partition by i.order_id) * 10000 as hugeint) as ws
 from b_items i join b_orders o on o.order_id = i.order_id))""")
def w09(b: Bronze):
    """The order total split over its lines by their share, to the cent."""
    from tiffin.catalog.models import order_items
    rows = order_items(b).select("order_id", F.col("order_item_id").alias("item"), "line_total")
    totals = b.orders().select("order_id", "order_total")
    return allocate.largest_remainder(rows.join(totals, "order_id"), ["order_id"], "order_total",
                                      "line_total", "item", "part") \
        .select("order_id", "item", "order_total", "part")


@query("w10_rank_weights", """
select restaurant_id, city_id, round(z / sum(z) over (partition by city_id), 9) as zipf_share,
 round(d / sum(d) over (partition by city_id), 9) as density_share
from (select *, 1.0 / pow(r + 5.0, 0.85) as z, exp(-cast(r as double) / 6.0) as d
 from (select restaurant_id, city_id,
  row_number() over (partition by city_id order by restaurant_id) - 1 as r from b_restaurants))""")
def w10(b: Bronze):
    ranked = slices.block_ranked(b.restaurants().select("restaurant_id", "city_id"), ["city_id"],
                                 "restaurant_id", "r")
    weighed = ranked.withColumn("z", allocate.zipf_weight(F.col("r"))).withColumn(
        "d", allocate.density_weight(F.col("r").cast("double")))
    shares = allocate.normalised(allocate.normalised(weighed, "z", ["city_id"], "zs"), "d",
                                 ["city_id"], "ds")
    return shares.select("restaurant_id", "city_id", F.round("zs", 9).alias("zipf_share"),
                         F.round("ds", 9).alias("density_share"))


@query("a06_children_per_parent", """
select restaurant_id, cast(item_idx // 100 as bigint) as part, count(*) as n_items,
 string_agg(cast(menu_item_id as varchar), ',' order by menu_item_id) as item_ids
from x_menu group by 1, 2""")
def a06(b: Bronze):
    """Children as arrays of at most 100; a parent with more gets several rows."""
    ranked = slices.block_ranked(b.menu_items().select("restaurant_id", "menu_item_id"),
                                 ["restaurant_id"], "menu_item_id", "i")
    return (ranked.groupBy("restaurant_id", F.floor(F.col("i") / 100).alias("part"))
            .agg(F.count(F.lit(1)).alias("n_items"),
                 F.concat_ws(",", F.sort_array(F.collect_list("menu_item_id")).cast("array<string>"))
                 .alias("item_ids")))


def planned(b: Bronze):
    """Factors over the days the orders cover; the number of days is one number."""
    bounds = b.raw("orders").agg(F.to_date(F.min("o_orderdate")).alias("d0"),
                                 F.to_date(F.max("o_orderdate")).alias("d1"))
    n_days = bounds.select(F.datediff("d1", "d0") + 1).first()[0]
    per_day = b.raw("orders").count() // n_days
    spine = bounds.select(F.posexplode(F.sequence("d0", "d1", F.expr("interval 1 day")))
                          .alias("day_index", "order_date"))
    return demand.planned_daily(spine, n_days, max(per_day, 1), md5_draw)


_EVENTS = ", ".join(f"('{n}', {p}, {m}, {i})" for i, (n, p, m) in enumerate(demand.EVENTS))
_HOURS = {k: "[" + ", ".join(v) + "]" for k, v in (("day", demand.HOUR_WEEKDAY),
                                                   ("end", demand.HOUR_WEEKEND))}
view("x_planned", f"""
with days as (select cast(unnest(generate_series(d0, d1, interval 1 day)) as date) as order_date, d0,
  n, greatest((select count(*) from orders) // n, 1) as per_day from (select
   min(cast(o_orderdate as date)) as d0, max(cast(o_orderdate as date)) as d1,
   cast(max(cast(o_orderdate as date)) - min(cast(o_orderdate as date)) + 1 as bigint) as n
  from orders)),
 ev as (select name, peak, cast(round(position * (n - 1)) as integer) as event_day
  from (values {_EVENTS}) as e(name, position, peak, i), (select max(n) as n from days)
  where i < greatest(1, round(n / 90.0 * 4))),
 touched as (select event_day + off as day_index, product(1 + (peak - 1) * share) as m,
  string_agg(name, ',' order by event_day) as names from ev,
  (values (-1, 0.30), (0, 1.0), (1, 0.50)) as s(off, share) group by 1)
select day_index, order_date, weekday, dow as dow_multiplier, m as event_multiplier, noise,
 dow * m * noise as total_multiplier,
 cast(greatest(1, round(per_day * (dow * m * noise))) as integer) as orders, names as event_names
from (select cast(order_date - d0 as integer) as day_index, order_date, per_day,
  cast(isodow(order_date) - 1 as integer) as weekday, {DOW_SQL}[isodow(order_date)] as dow,
  coalesce(t.m, 1.0) as m, t.names,
  exp(0.08 * sqrt(-2.0 * ln({draw(1, 'order_date')} / 1000000.0 + 1e-9))
   * cos(2.0 * pi() * ({draw(2, 'order_date')} / 1000000.0))) as noise
 from days left join touched t on t.day_index = cast(order_date - d0 as integer))""")

_ROUNDED = ["dow_multiplier", "event_multiplier", "noise", "total_multiplier"]


@query("f27_demand_factors", f"""select day_index, order_date, weekday, orders, event_names,
 {', '.join(f'round({c}, 6) as {c}' for c in _ROUNDED)} from x_planned""")
def f27(b: Bronze):
    rows = planned(b)
    for c in _ROUNDED:
        rows = rows.withColumn(c, F.round(c, 6))
    return rows


@query("f27_planned_hourly", f"""
select day_index, order_date, hour, cast(f + case when row_number() over (partition by day_index
  order by r desc, hour) <= total - sum(f) over (partition by day_index) then 1 else 0 end
  as integer) as orders
from (select *, total * w // ws as f, total * w % ws as r from (select *, sum(w) over (
   partition by day_index) as ws from (select day_index, order_date, h - 1 as hour,
   cast(orders as hugeint) as total, cast((case when weekday >= 5 then {_HOURS['end']}
    else {_HOURS['day']} end)[h] * 10000 as hugeint) as w
  from x_planned, (select cast(unnest(generate_series(1, 24)) as integer) as h))))""")
def f27_hourly(b: Bronze):
    return demand.planned_hourly(planned(b))
