"""The bronze views again, as DuckDB SQL over the given tables."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}


def view(name: str, sql: str) -> None:
    VIEWS[name] = sql


def assemble(sql: str) -> str:
    """Prepend the views that ``sql`` uses, each after those it depends on."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b[bmx]_[a-z0-9_]+\b", text):
            if name in VIEWS and name not in ordered:
                visit(VIEWS[name])
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    if not ordered:
        return sql
    # Made tables feed several branches; computed once, they stay affordable.
    ctes = ",\n".join(f"{n} as {'materialized ' if n[0] == 'x' else ''}({VIEWS[n]})"
                      for n in ordered)
    return f"with {ctes}\nselect * from ({sql}) as q"


def draw(salt: int, *exprs: str) -> str:
    """The md5 draw of ``tiffin.functions.draws``."""
    parts = ", ".join([f"'{salt}'"] + [f"cast({e} as varchar)" for e in exprs])
    return f"(cast('0x' || substr(md5(concat_ws('|', {parts})), 1, 8) as bigint) % 1000000)"


def wide_draw(salt: int, *exprs: str) -> str:
    parts = ", ".join([f"'{salt}'"] + [f"cast({e} as varchar)" for e in exprs])
    return f"cast('0x' || substr(md5(concat_ws('|', {parts})), 1, 12) as hugeint)"


def pick(values: list[str], index: str) -> str:
    items = ", ".join(f"'{v}'" for v in values)
    return f"([{items}])[cast(({index}) % {len(values)} as bigint) + 1]"


def key(*exprs: str) -> str:
    parts = ", ".join(f"coalesce(cast({e} as varchar), '_NULL_')" for e in exprs)
    return f"md5(concat_ws('||', {parts}))"


_CUISINES = pick(["North Indian", "South Indian", "Chinese", "Biryani", "Pizza", "Burgers",
                  "Desserts", "Healthy Bowls"], "s_suppkey")
_NOTES = pick(["Ring the bell twice", "Leave at the door", "Call on arrival", "No onions please",
               "Extra spicy", "Gate code 1234"], "order_id // 4")
_REASONS = pick(["QUALITY_ISSUE", "LATE_DELIVERY", "MISSING_ITEMS"], "order_id")
CREATED = "timestamp '1994-01-01 00:00:00'"

view("b_cities", f"""
select cast(r_regionkey as bigint) as city_id, r_name as name, 'IN' as country_code,
 'Asia/Kolkata' as timezone, cast(1200 + 300 * r_regionkey as double) / 100 as lat,
 cast(7200 + 200 * r_regionkey as double) / 100 as lon, {CREATED} as created_at,
 {CREATED} as updated_at from region""")

view("b_zones", f"""
select cast(n_nationkey as bigint) as zone_id, cast(n_regionkey as bigint) as city_id,
 n_name as name, cast(1200 + 300 * n_regionkey + 5 * (n_nationkey % 7) as double) / 100 as center_lat,
 cast(7200 + 200 * n_regionkey + 4 * (n_nationkey % 6) as double) / 100 as center_lon,
 cast(n_nationkey // 5 as integer) as ring,
 cast(19 + 3 * ((n_nationkey // 5) // 3) as decimal(18,2)) as base_delivery_fee,
 cast(38 + 2 * ((n_nationkey // 5) // 2) as integer) as sla_target_minutes, true as is_active,
 {CREATED} as created_at, {CREATED} as updated_at from nation""")

view("b_customers", f"""
select c_custkey as customer_id, printf('C-%07d', c_custkey) as customer_ref,
 lower(replace(c_name, '#', '.')) || '@example.com' as email,
 '+91' || cast(6000000000 + c_custkey as varchar) as phone, c_name as full_name, z.city_id,
 cast(c_nationkey as bigint) as home_zone_id,
 z.center_lat + cast(c_custkey * 37 % 181 - 90 as double) / 10000 as lat,
 z.center_lon + cast(c_custkey * 53 % 181 - 90 as double) / 10000 as lon,
 {CREATED} - to_seconds(c_custkey * 7919 % 63072000 + 1) as signup_ts,
 {CREATED} - to_seconds(c_custkey * 7919 % 63072000 + 1) as created_at,
 {CREATED} - to_seconds(c_custkey * 7919 % 63072000 + 1) as updated_at
from customer left join b_zones z on z.zone_id = c_nationkey""")

view("b_restaurants", f"""
select s_suppkey as restaurant_id, printf('R-%07d', s_suppkey) as restaurant_ref, s_name as name,
 {_CUISINES} as cuisine_type, z.city_id, cast(s_nationkey as bigint) as zone_id,
 z.center_lat as lat, z.center_lon as lon,
 cast((16 + s_suppkey % 9) / 100 as decimal(5,4)) as commission_pct,
 'acct-' || cast(s_suppkey as varchar) as payout_account_id,
 cast(10 + s_suppkey % 17 as integer) as prep_time_p50_minutes, s_suppkey % 50 <> 0 as is_active,
 {CREATED} as created_at, {CREATED} as updated_at
from supplier left join b_zones z on z.zone_id = s_nationkey""")

view("b_riders", f"""
select rider_id, 'D' || cast(rider_id as varchar) as rider_ref,
 case when abs(rider_id) % 100 < 70 then 'bike' when abs(rider_id) % 100 < 92 then 'scooter'
  else 'car' end as vehicle_type,
 case when abs(rider_id) // 20 % 20 < 10 then 'bronze' when abs(rider_id) // 20 % 20 < 17
  then 'silver' else 'gold' end as payout_tier,
 home_zone_id, 'pay-' || cast(rider_id as varchar) as payout_account_id, is_active,
 {CREATED} as created_at, {CREATED} as updated_at
from (select c_custkey as rider_id, cast(c_nationkey as bigint) as home_zone_id,
  c_custkey % 25 <> 0 as is_active from customer where c_custkey % 20 = 0
 union all select cast(-1 - n_nationkey as bigint), cast(n_nationkey as bigint), true from nation)""")

view("b_menu_items", f"""
select p_partkey as menu_item_id, p_partkey % (select count(*) from supplier) as restaurant_id,
 p_name as name, p_type as category, cast(p_retailprice as decimal(18,2)) as price,
 p_partkey % 17 <> 0 as is_available, {CREATED} as created_at, {CREATED} as updated_at from part""")

view("b_tiers", """
select tier, valid_from, valid_to, cast(b * x as decimal(18,2)) as base_fare,
 cast(k * x as decimal(18,4)) as per_km_rate, cast(m * x as decimal(18,4)) as per_minute_rate
from (values ('bronze', 20.00, 6.5000, 0.5000), ('silver', 25.00, 7.2500, 0.6000),
 ('gold', 30.00, 8.0000, 0.7500)) as t(tier, b, k, m),
 (values (timestamp '1993-01-01 00:00:00', timestamp '1998-07-01 00:00:00', 1.0),
  (timestamp '1998-07-01 00:00:00', null, 1.1)) as p(valid_from, valid_to, x)""")

view("b_lines", """
select l_orderkey as order_id, l_linenumber as line_no, l_partkey as menu_item_id,
 cast(l_quantity as integer) as quantity,
 cast(cast(cast(round(l_extendedprice * 100) as bigint) // cast(l_quantity as bigint) as double)
  / 100 as decimal(18,2)) as unit_price, cast(l_extendedprice as decimal(18,2)) as line_total
from lineitem""")

view("b_items", """
select row_number() over (order by order_id, line_no, menu_item_id, quantity, line_total)
 as order_item_id, * from b_lines""")

view("b_heads", f"""
select order_id, printf('O-%07d', order_id) as order_ref, customer_id, restaurant_id,
 d + to_seconds(order_id * 7919 % 86400) as placed_at,
 case when order_id % 1000 < 25 then 'UNFULFILLED' when order_id % 1000 < 85 then 'CANCELLED'
  else 'DELIVERED' end as order_status,
 cast((16 + restaurant_id % 9) / 100 as decimal(5,4)) as commission_pct,
 case (order_id // 4) % 50 when 0 then upper(note) when 1 then lower(note)
  when 2 then '   ' || note when 3 then note || '   ' else note end as delivery_notes
from (select *, case when order_id % 4 = 0 then {_NOTES} end as note
 from (select o_orderkey as order_id, o_custkey as customer_id,
   o_orderkey % (select count(*) from supplier) as restaurant_id,
   cast(o_orderdate as timestamp) as d from orders))""")

view("b_shells", """
select h.*, cast(c_nationkey as bigint) as zone_id,
 cast(19 + 3 * ((c_nationkey // 5) // 3) as decimal(18,2)) as delivery_fee
from b_heads h join customer on c_custkey = customer_id""")

view("b_orders", """
select order_id, order_ref, customer_id, restaurant_id, zone_id, placed_at, order_status, subtotal,
 delivery_fee, commission_pct, cast(subtotal * commission_pct as decimal(18,2)) as commission_amount,
 cast(subtotal + delivery_fee as decimal(18,2)) as order_total, delivery_notes
from (select h.*, cast(coalesce(s, 0) as decimal(18,2)) as subtotal from b_shells h
 left join (select order_id, sum(line_total) as s from b_lines group by order_id) using (order_id))""")

view("b_active_riders", """
select home_zone_id as zone_id, rider_id,
 row_number() over (partition by home_zone_id order by rider_id) - 1 as rider_idx,
 count(*) over (partition by home_zone_id) as n_riders from b_riders where is_active""")

view("b_attempts", """
select o.order_id * 4 + attempt as match_id, o.order_id, r.rider_id,
 cast(attempt as integer) as attempt_number,
 placed_at + to_seconds((attempt - 1) * 120) as offered_at,
 case when order_status <> 'UNFULFILLED' and attempt = n then 'ACCEPTED'
  when (o.order_id + attempt) % 2 = 0 then 'DECLINED' else 'TIMEOUT' end as response,
 placed_at + to_seconds((attempt - 1) * 120 + 15 + (o.order_id * 13 + attempt * 7) % 60)
  as responded_at
from (select *, unnest(generate_series(1, n)) as attempt from (select order_id, zone_id,
  order_status, placed_at, case when order_status = 'UNFULFILLED' then 2 + order_id % 2
  else 1 + order_id // 7 % 3 end as n from b_shells)) o
join b_active_riders r on r.zone_id = o.zone_id
 and r.rider_idx = (o.order_id * 31 + attempt * 17) % r.n_riders""")

view("b_payments", """
select order_id as payment_id, order_id, order_total as amount,
 case when order_id % 100 < 45 then 'upi' when order_id % 100 < 75 then 'card'
  when order_id % 100 < 90 then 'wallet' else 'cod' end as method,
 case when order_id % 100 = 7 then 'FAILED' else 'SUCCESS' end as status,
 placed_at + to_seconds(5 + order_id % 30) as paid_at
from b_orders where order_status <> 'UNFULFILLED'""")

view("b_refunds", f"""
select order_id as refund_id, order_id, order_id as payment_id,
 case when order_id % 20 < 3 then '(' || cast(a as varchar) || ')' else cast(a as varchar) end
  as refund_amount_raw,
 case when order_status = 'CANCELLED' then 'CANCELLED' else {_REASONS} end as reason,
 placed_at + to_seconds(case when order_status = 'CANCELLED' then (5 + order_id % 30) * 60
  else (24 + order_id % 48) * 3600 end) as refunded_at
from (select *, cast(case when order_status = 'CANCELLED' then order_total
   else order_total * cast((30 + order_id % 71) / 100 as decimal(5,2)) end as decimal(18,2)) as a
  from b_orders where order_status = 'CANCELLED'
   or (order_status = 'DELIVERED' and order_id % 1000 between 100 and 127))""")

view("b_events", """
select k * 2 + copy as event_id, order_id, event_type, occurred_at,
 occurred_at + to_seconds(k * 37 % 259200 + copy * 60) as received_at
from (select event_id as k, event_id % (select count(*) from orders) as order_id,
  upper(trim(event_type)) as event_type, cast(ts as timestamp) as occurred_at,
  unnest(case when event_id % 20 = 0 then [0, 1] else [0] end) as copy from events)""")

view("b_shifts", """
select event_id as shift_id, user_id as courier_id, cast(ts as timestamp) as login_at,
 case when event_id % 67 = 0 then null else cast(ts as timestamp) + to_hours(1 + event_id % 8) end
  as logout_at from events""")

view("b_pings", """
select event_id as ping_id, user_id as courier_id,
 event_id % (select count(*) from orders) as order_id, cast(ts as timestamp) as ping_ts,
 cast(1297 + event_id % 90 as double) / 100 as lat,
 cast(7759 + event_id % 70 as double) / 100 as lon,
 cast(event_id * 13 % 150 as double) as accuracy_m,
 cast(ts as timestamp) + to_seconds(event_id * 37 % 7200) as _ingested_at from events""")

view("b_fees", """
select cast(-2 as bigint) as fee_schedule_id, 'GLOBAL' as scope, cast(null as varchar) as scope_key,
 cast(75 as bigint) as platform_fee_cents, date '1993-01-01' as effective_from,
 date '1997-01-01' as effective_to from region where r_regionkey = 0
union all select -1, 'GLOBAL', null, 100, date '1997-01-01', null from region where r_regionkey = 0
union all select r_regionkey * 10, 'CITY', cast(r_regionkey as varchar), 50 + r_regionkey,
 date '1998-07-01', null from region where r_regionkey % 2 = 0
union all select s_suppkey * 10 + 5, 'RESTAURANT', cast(s_suppkey as varchar), s_suppkey % 40,
 date '1996-03-01', date '1999-03-01' from supplier where s_suppkey % 10 = 0""")

view("b_taxes", """
select cast(r_regionkey as bigint) as city_id, cast(500 + 25 * r_regionkey as integer)
 as tax_rate_bps, date '1993-01-01' as effective_from, date '1998-07-01' as effective_to from region
union all select r_regionkey, 825 + 25 * r_regionkey, date '1998-07-01', null from region""")

view("b_movements", """
select k * 4 + i as payment_id, k as order_id, kind,
 case when k % 100 = 7 then 'FAILED' else 'SUCCEEDED' end as status,
 case when kind = 'REFUND' then -cents else cents end as amount_cents,
 placed_at + to_seconds(i * 3600 + 5) as created_at
from (select order_id as k, placed_at, order_status, cast(order_total * 100 as bigint) as cents
 from b_orders where order_status <> 'UNFULFILLED') o,
 (values (0, 'AUTH'), (1, 'CAPTURE'), (2, 'CAPTURE'), (3, 'REFUND')) as m(i, kind)
where i = 0 or (i = 1 and k % 50 <> 3) or (i = 2 and k % 97 = 5 and k % 50 <> 3)
 or (i = 3 and order_status = 'CANCELLED' and k % 50 <> 3)""")

view("b_claims", """
select refund_id, order_id,
 case when order_id % 53 = 0 then -payment_id - 1 else payment_id end as payment_id,
 case when order_id % 59 = 0 then 'n/a'
  else '  (' || regexp_replace(refund_amount_raw, '[()]', '', 'g') || ')' end as amount_usd,
 reason, refunded_at from b_refunds""")

view("b_reviews", """
select doc_id as review_id, doc_id % (select count(*) from orders) as order_id,
 text as review_text, lang from documents""")

view("b_truth", """
select doc_id as review_id, case when toxic = 1 then 'negative' when quality = 1 then 'positive'
  else 'neutral' end as text_sentiment,
 case when doc_id % 1000 < 85 then 'negative' when doc_id % 7 = 0 then 'neutral'
  else 'positive' end as outcome_class, doc_id % 20 < 3 as ambiguous from labels""")

view("b_vectors", """
select cast(vec_id as varchar) as review_id, 'fixture-64' as model,
 cast(len(embedding) as integer) as dim, embedding as vector from embeddings""")

_DOW = [0.85, 0.82, 0.90, 1.10, 1.35, 1.45, 1.20]
DOW_SQL = "[" + ", ".join(f"cast('{w / (sum(_DOW) / 7)!r}' as double)" for w in _DOW) + "]"

view("m_demand_daily", f"""
select cast(order_date - (select min(cast(o_orderdate as date)) from orders) as integer)
  as day_index, order_date, cast(isodow(order_date) - 1 as integer) as weekday,
 {DOW_SQL}[isodow(order_date)] as dow_multiplier, cast(1.0 as double) as event_multiplier,
 cast(1.0 as double) as noise, {DOW_SQL}[isodow(order_date)] as total_multiplier, orders,
 cast(null as varchar) as event_names
from (select cast(o_orderdate as date) as order_date, cast(count(*) as integer) as orders
 from orders group by 1)""")

view("m_demand_hourly", """
select cast(order_date - (select min(cast(o_orderdate as date)) from orders) as integer)
 as day_index, order_date, hour, orders
from (select cast(o_orderdate as date) as order_date,
  cast(o_orderkey * 7919 % 86400 // 3600 as integer) as hour, cast(count(*) as integer) as orders
 from orders group by 1, 2)""")

# -- models -----------------------------------------------------------------------------------

SALT = "tiffin-demo-salt"

view("m_stg_orders", """
select order_id, order_ref, customer_id, restaurant_id, zone_id, placed_at, order_status, subtotal,
 delivery_fee, commission_pct, commission_amount, order_total, clean as delivery_notes,
 (delivery_notes is not null and delivery_notes <> clean) as was_text_noise_defect
from (select *, upper(substr(trim(delivery_notes), 1, 1)) || lower(substr(trim(delivery_notes), 2))
 as clean from b_orders)""")

view("m_stg_refunds", """
select refund_id, order_id, payment_id,
 cast(regexp_replace(refund_amount_raw, '[()]', '', 'g') as decimal(18,2)) as refund_amount,
 refund_amount_raw like '(%' as was_money_text_defect, reason, refunded_at from b_refunds""")

view("m_stg_customers", f"""
select customer_id, customer_ref, sha256('{SALT}' || lower(trim(email))) as email_hash,
 substr(phone, 1, 3) || repeat('*', length(phone) - 6) || substr(phone, length(phone) - 2, 3)
  as phone_masked, full_name, city_id, home_zone_id, lat, lon, signup_ts, created_at, updated_at
from b_customers""")

view("m_economics", """
select o.order_id, order_ref, customer_id, restaurant_id, zone_id, placed_at, order_status, subtotal,
 delivery_fee, commission_pct, commission_amount, order_total,
 cast(coalesce(r.t, 0) as decimal(18,2)) as refund_amount,
 cast(order_total - coalesce(r.t, 0) as decimal(18,2)) as net_revenue,
 coalesce(i.n, 0) as item_count
from m_stg_orders o
left join (select order_id, count(*) as n from b_lines group by order_id) i on i.order_id = o.order_id
left join (select order_id, sum(refund_amount) as t from m_stg_refunds group by order_id) r
 on r.order_id = o.order_id""")

view("m_matching", """
select o.order_id, o.placed_at, a.match_id as accepted_match_id, a.rider_id as accepted_rider_id,
 a.offered_at as accepted_offered_at, a.responded_at as accepted_at,
 coalesce(c.n, 0) as total_attempts, a.match_id is not null as was_matched
from b_heads o
left join (select order_id, count(*) as n from b_attempts group by order_id) c
 on c.order_id = o.order_id
left join (select * from b_attempts where response = 'ACCEPTED') a on a.order_id = o.order_id""")

view("m_fct_orders", """
select order_id, order_ref, customer_id, restaurant_id, zone_id, cast(placed_at as date) as date_day,
 placed_at, order_status, subtotal, delivery_fee, commission_pct, commission_amount, order_total,
 refund_amount, net_revenue, item_count from m_economics""")

view("m_fct_deliveries", """
select m.order_id, o.customer_id, o.restaurant_id, o.zone_id, cast(m.placed_at as date) as date_day,
 m.placed_at, m.accepted_rider_id, m.total_attempts, m.was_matched, m.accepted_at,
 case when m.accepted_at is not null then (epoch_us(m.accepted_at) // 1000000)
  - (epoch_us(m.placed_at) // 1000000) end as seconds_to_accept
from m_matching m join b_shells o on o.order_id = m.order_id""")
