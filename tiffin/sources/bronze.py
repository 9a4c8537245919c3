"""The given tables seen as bronze tables of the order domain.

Every derived value is plain arithmetic on keys, so another SQL engine can repeat it. Nothing here
depends on row order or on a hash function.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.functions.draws import pick
from tiffin.functions.keys import reference
from tiffin.functions.money import MONEY
from tiffin.functions.text import damaged
from tiffin.operators.skew import lookup
from tiffin.operators.slices import block_ranked
from tiffin.session import tasks

# Delivery notes, cuisines, damage-free and in sentence case.
NOTES = ["Ring the bell twice", "Leave at the door", "Call on arrival", "No onions please",
         "Extra spicy", "Gate code 1234"]
CUISINES = ["North Indian", "South Indian", "Chinese", "Biryani", "Pizza", "Burgers", "Desserts",
            "Healthy Bowls"]
REASONS = ["QUALITY_ISSUE", "LATE_DELIVERY", "MISSING_ITEMS"]

# Payout tier rates (tier, base fare, per km, per minute).
TIER_RATES = [("bronze", "20.00", "6.5000", "0.5000"), ("silver", "25.00", "7.2500", "0.6000"),
              ("gold", "30.00", "8.0000", "0.7500")]
HISTORY_START = "1993-01-01 00:00:00"
CREATED = "1994-01-01 00:00:00"
RATE_CHANGE = "1998-07-01 00:00:00"

COMMISSION = "cast((16 + restaurant_id % 9) / 100 as decimal(5,4))"
RING = "cast(zone_id div 5 as int)"
ZONE_FEE = "cast(19 + 3 * ((zone_id div 5) div 3) as decimal(18,2))"


def _seconds(ts: str, expr: str) -> Column:
    return F.expr(f"timestampadd(SECOND, cast({expr} as int), {ts})")


class Bronze:
    """Lazy bronze tables over one folder of parquet files."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.days: tuple[str, str] | None = None

    def path(self, table: str) -> str:
        return f"{self.root}/{table}.parquet"

    def raw(self, table: str, *cols: str) -> DataFrame:
        df = self.spark.read.parquet(self.path(table))
        if self.days and table == "orders":
            kind = df.schema["o_orderdate"].dataType
            lo, hi = (F.lit(d).cast(kind) for d in self.days)
            df = df.filter((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi))
        return df.select(*cols) if cols else df

    def between_days(self, first: str, last: str) -> Bronze:
        """The same tables with the orders placed from one day to another only.

        An order is placed within the day of its stored date, so the range holds for the stored
        column as well, where the scan can skip files and row groups.
        """
        other = Bronze(self.spark, self.root)
        after = dt.date.fromisoformat(last) + dt.timedelta(days=1)
        other.days = (first, after.isoformat())
        return other

    def size(self, table: str) -> Column:
        """Row count as a scalar subquery; parquet answers it from footers."""
        return self.spark.read.parquet(self.path(table)).agg(F.count(F.lit(1))).scalar()

    def tasks(self, table: str) -> int:
        """Tasks for a shuffle of a table's keys."""
        return tasks(self.spark.read.parquet(self.path(table)))

    # -- reference tables ------------------------------------------------------------------

    def cities(self) -> DataFrame:
        return self.raw("region").selectExpr(
            "cast(r_regionkey as bigint) as city_id", "r_name as name", "'IN' as country_code",
            "'Asia/Kolkata' as timezone", "cast(1200 + 300 * r_regionkey as double) / 100 as lat",
            "cast(7200 + 200 * r_regionkey as double) / 100 as lon",
            f"timestamp'{CREATED}' as created_at", f"timestamp'{CREATED}' as updated_at")

    def zones(self) -> DataFrame:
        return self.raw("nation").selectExpr(
            "cast(n_nationkey as bigint) as zone_id", "cast(n_regionkey as bigint) as city_id",
            "n_name as name",
            "cast(1200 + 300 * n_regionkey + 5 * (n_nationkey % 7) as double) / 100 as center_lat",
            "cast(7200 + 200 * n_regionkey + 4 * (n_nationkey % 6) as double) / 100 as center_lon",
        ).selectExpr(
            "*", f"{RING} as ring", f"{ZONE_FEE} as base_delivery_fee",
            f"cast(38 + 2 * ({RING} div 2) as int) as sla_target_minutes", "true as is_active",
            f"timestamp'{CREATED}' as created_at", f"timestamp'{CREATED}' as updated_at")

    def customers(self) -> DataFrame:
        zones = self.zones().select("zone_id", "city_id", "center_lat", "center_lon")
        people = self.raw("customer", "c_custkey", "c_name", "c_nationkey").selectExpr(
            "c_custkey as customer_id", "c_name as full_name",
            "concat(lower(replace(c_name, '#', '.')), '@example.com') as email",
            "concat('+91', cast(6000000000 + c_custkey as string)) as phone",
            "cast(c_nationkey as bigint) as zone_id")
        joined = people.join(zones, "zone_id", "left")
        return (joined.withColumn("customer_ref", reference("C", F.col("customer_id")))
                .withColumn("signup_ts", _seconds(f"timestamp'{CREATED}'",
                                                  "-(customer_id * 7919 % 63072000) - 1"))
                .selectExpr("customer_id", "customer_ref", "email", "phone", "full_name",
                            "city_id", "zone_id as home_zone_id",
                            "center_lat + (customer_id * 37 % 181 - 90) / 10000 as lat",
                            "center_lon + (customer_id * 53 % 181 - 90) / 10000 as lon",
                            "signup_ts", "signup_ts as created_at", "signup_ts as updated_at"))

    def restaurants(self) -> DataFrame:
        zones = self.zones().select("zone_id", "city_id", "center_lat", "center_lon")
        base = self.raw("supplier", "s_suppkey", "s_name", "s_nationkey").selectExpr(
            "s_suppkey as restaurant_id", "s_name as name", "cast(s_nationkey as bigint) as zone_id")
        return (base.join(zones, "zone_id", "left")
                .withColumn("restaurant_ref", reference("R", F.col("restaurant_id")))
                .withColumn("cuisine_type", pick(CUISINES, F.col("restaurant_id")))
                .selectExpr(
                    "restaurant_id", "restaurant_ref", "name", "cuisine_type", "city_id", "zone_id",
                    "center_lat as lat", "center_lon as lon", f"{COMMISSION} as commission_pct",
                    "concat('acct-', cast(restaurant_id as string)) as payout_account_id",
                    "cast(10 + restaurant_id % 17 as int) as prep_time_p50_minutes",
                    "restaurant_id % 50 <> 0 as is_active",
                    f"timestamp'{CREATED}' as created_at", f"timestamp'{CREATED}' as updated_at"))

    def riders(self) -> DataFrame:
        hired = self.raw("customer", "c_custkey", "c_nationkey").filter("c_custkey % 20 = 0") \
            .selectExpr("c_custkey as rider_id", "cast(c_nationkey as bigint) as home_zone_id",
                        "c_custkey % 25 <> 0 as is_active")
        # A floor rider per zone below zero, so ids never meet customer keys at any scale.
        floor = self.raw("nation", "n_nationkey").selectExpr(
            "cast(-1 - n_nationkey as bigint) as rider_id",
            "cast(n_nationkey as bigint) as home_zone_id", "true as is_active")
        return hired.unionByName(floor).selectExpr(
            "rider_id", "concat('D', cast(rider_id as string)) as rider_ref",
            "case when abs(rider_id) % 100 < 70 then 'bike' when abs(rider_id) % 100 < 92 "
            "then 'scooter' else 'car' end as vehicle_type",
            "case when abs(rider_id) div 20 % 20 < 10 then 'bronze' "
            "when abs(rider_id) div 20 % 20 < 17 then 'silver' else 'gold' end as payout_tier",
            "home_zone_id", "concat('pay-', cast(rider_id as string)) as payout_account_id",
            "is_active", f"timestamp'{CREATED}' as created_at",
            f"timestamp'{CREATED}' as updated_at")

    def menu_items(self) -> DataFrame:
        n = self.size("supplier")
        return self.raw("part", "p_partkey", "p_name", "p_type", "p_retailprice").select(
            F.col("p_partkey").alias("menu_item_id"),
            (F.col("p_partkey") % n).alias("restaurant_id"), F.col("p_name").alias("name"),
            F.col("p_type").alias("category"), F.col("p_retailprice").cast(MONEY).alias("price"),
            (F.col("p_partkey") % 17 != 0).alias("is_available"),
            F.lit(CREATED).cast("timestamp").alias("created_at"),
            F.lit(CREATED).cast("timestamp").alias("updated_at"))

    def rider_payout_tiers(self) -> DataFrame:
        """Two periods per tier: the published rates, then ten percent more."""
        rows = ", ".join(f"('{t}', {b}, {k}, {m})" for t, b, k, m in TIER_RATES)
        base = self.spark.sql(f"select * from values {rows} as t(tier, base, km, minute)")
        periods = F.array(
            F.struct(F.lit(HISTORY_START).alias("f"), F.lit(RATE_CHANGE).alias("t"),
                     F.lit("1.0").alias("x")),
            F.struct(F.lit(RATE_CHANGE).alias("f"), F.lit(None).cast("string").alias("t"),
                     F.lit("1.1").alias("x")))
        return base.withColumn("p", F.explode(periods)).selectExpr(
            "tier", "cast(p.f as timestamp) as valid_from", "cast(p.t as timestamp) as valid_to",
            "cast(base * cast(p.x as decimal(3,1)) as decimal(18,2)) as base_fare",
            "cast(km * cast(p.x as decimal(3,1)) as decimal(18,4)) as per_km_rate",
            "cast(minute * cast(p.x as decimal(3,1)) as decimal(18,4)) as per_minute_rate")

    # -- facts -----------------------------------------------------------------------------

    def lines(self) -> DataFrame:
        """Order items without a surrogate id; ``l_orderkey, l_linenumber`` is not unique."""
        return self.raw("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                        "l_extendedprice").selectExpr(
            "l_orderkey as order_id", "l_linenumber as line_no", "l_partkey as menu_item_id",
            "cast(l_quantity as int) as quantity",
            "cast(cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint) "
            "as double) / 100 as up", "cast(l_extendedprice as decimal(18,2)) as line_total",
        ).selectExpr("order_id", "line_no", "menu_item_id", "quantity",
                     "cast(up as decimal(18,2)) as unit_price", "line_total")

    def order_heads(self) -> DataFrame:
        """Orders without the columns that need a join."""
        n = self.size("supplier")
        heads = self.raw("orders", "o_orderkey", "o_custkey", "o_orderdate").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
            (F.col("o_orderkey") % n).alias("restaurant_id"),
            F.col("o_orderdate").cast("timestamp").alias("_day"))
        note = F.when(F.col("order_id") % 4 == 0,
                      pick(NOTES, F.floor(F.col("order_id") / 4)))
        mode = F.floor(F.col("order_id") / 4) % 50
        return heads.select(
            "order_id", reference("O", F.col("order_id")).alias("order_ref"), "customer_id",
            "restaurant_id", _seconds("_day", "order_id * 7919 % 86400").alias("placed_at"),
            F.expr("case when order_id % 1000 < 25 then 'UNFULFILLED' "
                   "when order_id % 1000 < 85 then 'CANCELLED' else 'DELIVERED' end")
            .alias("order_status"),
            F.expr(COMMISSION).alias("commission_pct"), damaged(note, mode).alias("delivery_notes"))

    def shells(self) -> DataFrame:
        """Heads with the customer's zone and its fee."""
        homes = self.raw("customer", "c_custkey", "c_nationkey").selectExpr(
            "c_custkey as customer_id", "cast(c_nationkey as bigint) as zone_id")
        return (self.order_heads().join(homes, "customer_id")
                .withColumn("delivery_fee", F.expr(ZONE_FEE)))

    def orders(self) -> DataFrame:
        # Whole cents add up as longs inside code generation; a wide decimal sum would not.
        subtotals = (self.raw("lineitem", "l_orderkey", "l_extendedprice")
                     .groupBy(F.col("l_orderkey").alias("order_id"))
                     .agg(F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("s")))
        return (self.shells().join(subtotals, "order_id", "left")
                .withColumn("subtotal", F.expr(
                    "cast(cast(coalesce(s, 0) as decimal(20,0)) * 0.01 as decimal(18,2))"))
                .selectExpr("order_id", "order_ref", "customer_id", "restaurant_id", "zone_id",
                            "placed_at", "order_status", "subtotal", "delivery_fee",
                            "commission_pct",
                            "cast(subtotal * commission_pct as decimal(18,2)) as commission_amount",
                            "cast(subtotal + delivery_fee as decimal(18,2)) as order_total",
                            "delivery_notes"))

    def match_attempts(self) -> DataFrame:
        """One to three offers per order to active riders of its zone; the last one is accepted
        unless the order stayed unfulfilled. Riders are found by rank, not from a collected list."""
        active = block_ranked(self.riders().filter("is_active").select("rider_id", "home_zone_id"),
                              ["home_zone_id"], "rider_id", "rider_idx")
        sizes = active.groupBy(F.col("home_zone_id").alias("zone_id")).agg(
            F.count(F.lit(1)).alias("n_riders"))
        heads = self.shells().select("order_id", "zone_id", "order_status", "placed_at")
        offers = (lookup(heads, sizes, ["zone_id"])
                  .selectExpr("*", "case when order_status = 'UNFULFILLED' then 2 + order_id % 2 "
                              "else 1 + order_id div 7 % 3 end as n")
                  .withColumn("attempt", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")))
                  .selectExpr("*", "(order_id * 31 + attempt * 17) % n_riders as rider_idx"))
        matched = offers.join(active.withColumnRenamed("home_zone_id", "zone_id"),
                              ["zone_id", "rider_idx"])
        return (matched.withColumn("offered_at", _seconds("placed_at", "(attempt - 1) * 120"))
                .withColumn("responded_at",
                            _seconds("offered_at", "15 + (order_id * 13 + attempt * 7) % 60"))
                .selectExpr(
                    "order_id * 4 + attempt as match_id", "order_id", "rider_id",
                    "cast(attempt as int) as attempt_number", "offered_at",
                    "case when order_status <> 'UNFULFILLED' and attempt = n then 'ACCEPTED' "
                    "when (order_id + attempt) % 2 = 0 then 'DECLINED' else 'TIMEOUT' end "
                    "as response", "responded_at"))

    def payments(self, orders: DataFrame | None = None) -> DataFrame:
        """``orders`` may be given when they are already written, here and in ``refunds``."""
        return ((self.orders() if orders is None else orders)
                .filter("order_status <> 'UNFULFILLED'")
                .withColumn("paid_at", _seconds("placed_at", "5 + order_id % 30"))
                .selectExpr(
                    "order_id as payment_id", "order_id", "order_total as amount",
                    "case when order_id % 100 < 45 then 'upi' when order_id % 100 < 75 then 'card' "
                    "when order_id % 100 < 90 then 'wallet' else 'cod' end as method",
                    "case when order_id % 100 = 7 then 'FAILED' else 'SUCCESS' end as status",
                    "paid_at"))

    def refunds(self, orders: DataFrame | None = None) -> DataFrame:
        due = (self.orders() if orders is None else orders).filter(
            "order_status = 'CANCELLED' or (order_status = 'DELIVERED' "
            "and order_id % 1000 between 100 and 127)")
        amount = F.expr("cast(case when order_status = 'CANCELLED' then order_total else "
                        "order_total * cast((30 + order_id % 71) / 100 as decimal(5,2)) end "
                        "as decimal(18,2))")
        return (due.withColumn("_amount", amount.cast("string"))
                .withColumn("reason", F.when(F.col("order_status") == "CANCELLED", "CANCELLED")
                            .otherwise(pick(REASONS, F.col("order_id"))))
                .withColumn("refunded_at", _seconds(
                    "placed_at", "case when order_status = 'CANCELLED' then (5 + order_id % 30) "
                    "* 60 else (24 + order_id % 48) * 3600 end"))
                .selectExpr("order_id as refund_id", "order_id", "order_id as payment_id",
                            "case when order_id % 20 < 3 then concat('(', _amount, ')') "
                            "else _amount end as refund_amount_raw", "reason", "refunded_at"))

    # -- event tables ----------------------------------------------------------------------

    def order_events(self) -> DataFrame:
        """Events with both clocks; every 20th is delivered twice under a second id."""
        n = self.size("orders")
        base = self.raw("events", "event_id", "ts", "event_type").select(
            F.col("event_id").alias("k"), (F.col("event_id") % n).alias("order_id"),
            F.upper(F.trim("event_type")).alias("event_type"),
            F.col("ts").cast("timestamp").alias("occurred_at"))
        copies = F.when(F.col("k") % 20 == 0, F.array(F.lit(0), F.lit(1))) \
            .otherwise(F.array(F.lit(0)))
        return (base.withColumn("copy", F.explode(copies))
                .withColumn("received_at", _seconds("occurred_at", "k * 37 % 259200 + copy * 60"))
                .selectExpr("k * 2 + copy as event_id", "order_id", "event_type", "occurred_at",
                            "received_at"))

    def courier_shifts(self) -> DataFrame:
        return self.raw("events", "event_id", "user_id", "ts").selectExpr(
            "event_id as shift_id", "user_id as courier_id", "cast(ts as timestamp) as login_at",
            "case when event_id % 67 = 0 then null else timestampadd(HOUR, "
            "cast(1 + event_id % 8 as int), cast(ts as timestamp)) end as logout_at")

    def gps_pings(self) -> DataFrame:
        n = self.size("orders")
        return (self.raw("events", "event_id", "user_id", "ts")
                .withColumn("order_id", F.col("event_id") % n)
                .withColumn("t", F.col("ts").cast("timestamp"))
                .withColumn("_ingested_at", _seconds("t", "event_id * 37 % 7200"))
                .selectExpr("event_id as ping_id", "user_id as courier_id", "order_id",
                            "t as ping_ts", "cast(1297 + event_id % 90 as double) / 100 as lat",
                            "cast(7759 + event_id % 70 as double) / 100 as lon",
                            "cast(event_id * 13 % 150 as double) as accuracy_m", "_ingested_at"))

    # -- rates, cents and text ---------------------------------------------------------------

    def fee_schedule(self) -> DataFrame:
        """Platform fees: everyone in two periods, a change per city, some restaurants."""
        city = self.raw("region", "r_regionkey")
        everyone = city.filter("r_regionkey = 0").selectExpr(
            "explode(array(struct(-2 as id, 75 as c, date'1993-01-01' as f, date'1997-01-01' as t),"
            " struct(-1 as id, 100 as c, date'1997-01-01' as f, cast(null as date) as t))) as x"
        ).selectExpr("cast(x.id as bigint) as fee_schedule_id", "'GLOBAL' as scope",
                     "cast(null as string) as scope_key", "cast(x.c as bigint) as platform_fee_cents",
                     "x.f as effective_from", "x.t as effective_to")
        cities = city.filter("r_regionkey % 2 = 0").selectExpr(
            "cast(r_regionkey * 10 as bigint) as fee_schedule_id", "'CITY' as scope",
            "cast(r_regionkey as string) as scope_key",
            "cast(50 + r_regionkey as bigint) as platform_fee_cents",
            "date'1998-07-01' as effective_from", "cast(null as date) as effective_to")
        shops = self.raw("supplier", "s_suppkey").filter("s_suppkey % 10 = 0").selectExpr(
            "s_suppkey * 10 + 5 as fee_schedule_id", "'RESTAURANT' as scope",
            "cast(s_suppkey as string) as scope_key",
            "s_suppkey % 40 as platform_fee_cents", "date'1996-03-01' as effective_from",
            "date'1999-03-01' as effective_to")
        return everyone.unionByName(cities).unionByName(shops)

    def tax_jurisdictions(self) -> DataFrame:
        return self.raw("region", "r_regionkey").selectExpr(
            "cast(r_regionkey as bigint) as city_id",
            "explode(array(struct(500 + 25 * r_regionkey as bps, date'1993-01-01' as f, "
            "date'1998-07-01' as t), struct(825 + 25 * r_regionkey as bps, date'1998-07-01' as f, "
            "cast(null as date) as t))) as x").selectExpr(
            "city_id", "cast(x.bps as int) as tax_rate_bps", "x.f as effective_from",
            "x.t as effective_to")

    def money_movements(self) -> DataFrame:
        """Payments of mixed grain in cents: AUTH, CAPTURE (some missing, some twice), REFUND."""
        due = self.orders().filter("order_status <> 'UNFULFILLED'").selectExpr(
            "order_id as k", "placed_at", "order_status",
            "cast(order_total * 100 as bigint) as cents")
        kinds = F.array(*[
            F.struct(F.lit(i).alias("i"), F.lit(kind).alias("kind"), F.expr(when).alias("on"))
            for i, kind, when in (
                (0, "AUTH", "true"), (1, "CAPTURE", "k % 50 <> 3"),
                (2, "CAPTURE", "k % 97 = 5 and k % 50 <> 3"),
                (3, "REFUND", "order_status = 'CANCELLED' and k % 50 <> 3"))])
        return (due.withColumn("m", F.explode(kinds)).filter("m.on")
                .withColumn("created_at", _seconds("placed_at", "m.i * 3600 + 5"))
                .selectExpr("k * 4 + m.i as payment_id", "k as order_id", "m.kind as kind",
                            "case when k % 100 = 7 then 'FAILED' else 'SUCCEEDED' end as status",
                            "case when m.kind = 'REFUND' then -cents else cents end "
                            "as amount_cents", "created_at"))

    def refund_claims(self) -> DataFrame:
        """Refund text as delivered: some point at a payment that never existed, some unreadable."""
        return self.refunds().selectExpr(
            "refund_id", "order_id",
            "case when order_id % 53 = 0 then -payment_id - 1 else payment_id end as payment_id",
            "case when order_id % 59 = 0 then 'n/a' else concat('  (', "
            "regexp_replace(refund_amount_raw, '[()]', ''), ')') end as amount_usd",
            "reason", "refunded_at")

    def reviews(self) -> DataFrame:
        n = self.size("orders")
        return self.raw("documents", "doc_id", "text", "lang").select(
            F.col("doc_id").alias("review_id"), (F.col("doc_id") % n).alias("order_id"),
            F.col("text").alias("review_text"), "lang")

    def openings(self) -> DataFrame:
        """The first thing the customer wrote in each conversation."""
        n = self.size("orders")
        said = self.raw("conversations", "conv_id", "turn", "role", "text").filter("role = 'user'")
        return said.groupBy("conv_id").agg(F.min_by("text", "turn").alias("text")).select(
            F.col("conv_id").alias("ticket_id"), (F.col("conv_id") * 31 % n).alias("order_id"),
            "text")

    def review_truth(self) -> DataFrame:
        """Answer key from the labels; only the evaluation may read it."""
        return self.raw("labels", "doc_id", "quality", "toxic").selectExpr(
            "doc_id as review_id",
            "case when toxic = 1 then 'negative' when quality = 1 then 'positive' "
            "else 'neutral' end as text_sentiment",
            "case when doc_id % 1000 < 85 then 'negative' when doc_id % 7 = 0 then 'neutral' "
            "else 'positive' end as outcome_class", "doc_id % 20 < 3 as ambiguous")

    def vectors(self) -> DataFrame:
        return self.raw("embeddings", "vec_id", "embedding", "label").selectExpr(
            "cast(vec_id as string) as review_id", "'fixture-64' as model",
            "size(embedding) as dim", "embedding as vector")
