from pyspark.sql import functions as F

from tiffin.catalog import ORACLE, QUERIES
from tiffin.catalog.oracle import SALT
from tiffin.operators import quality
from tiffin.plans import demand, events, marts, reviews, staging, synth
from tiffin.session import tasks


def plan(df):
    return df._jdf.queryExecution().toString()


def test_personal_data_stops_at_staging(bronze):
    mart = marts.dim_customer(staging.stg_customers(bronze.customers(), SALT))
    assert not {"email", "phone"} & set(mart.columns)
    raw = bronze.customers().select("customer_id", "email", "phone")
    leaks = mart.join(raw, "customer_id").filter(
        (F.col("email_hash") == F.col("email")) | (F.col("phone_masked") == F.col("phone")))
    assert leaks.count() == 0
    assert mart.filter(~F.col("email_hash").rlike("^[0-9a-f]{64}$")).count() == 0


def test_no_pairwise_plans(bronze):
    for key in ("d06_fct_orders", "d07_fct_deliveries", "d20_order_cents", "j09_fee_precedence_asof",
                "a16_tie_out"):
        text = plan(QUERIES[key](bronze))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, key


def test_columns_and_filters_reach_the_scan(bronze):
    df = bronze.raw("lineitem").filter("l_quantity > 10").select("l_orderkey")
    text = plan(df)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text


def test_item_counts_do_not_fan_out(bronze):
    orders = bronze.orders()
    mart = marts.order_economics(staging.stg_orders(orders), bronze.lines(),
                                 staging.stg_refunds(bronze.refunds()))
    assert mart.count() == orders.count() == mart.select("order_id").distinct().count()


def test_noise_belongs_to_the_date(spark):
    spine = spark.sql("select posexplode(sequence(date'2026-06-01', date'2026-06-20', interval 1 day))"
                      " as (day_index, order_date)")
    long = demand.planned_daily(spine, 20, 100)
    short = demand.planned_daily(spine.filter("day_index >= 10").withColumn(
        "day_index", F.col("day_index") - 10), 10, 100)
    joined = long.select("order_date", F.col("noise").alias("a")).join(
        short.select("order_date", F.col("noise").alias("b")), "order_date")
    assert joined.count() == 10 and joined.filter("a <> b").count() == 0


def test_hours_sum_to_the_day_and_events_have_shoulders(spark):
    spine = spark.sql("select posexplode(sequence(date'2026-06-01', date'2026-08-29', interval 1 day))"
                      " as (day_index, order_date)")
    daily = demand.planned_daily(spine, 90, 1000)
    hourly = demand.planned_hourly(daily)
    assert quality.hour_day_mismatch(daily, hourly).count() == 0
    assert hourly.count() == 90 * 24
    peak = {r["day_index"]: r["event_multiplier"] for r in daily.filter("event_names = 'storm'")
            .collect()}
    assert [round(peak[d], 4) for d in (33, 34, 35)] == [1.135, 1.45, 1.225]


def world(spark):
    hourly = spark.createDataFrame([(d, h, 30 if h == 12 else 1 if h < 12 else 0)
                                    for d in range(2) for h in range(24)],
                                   "day_index int, hour int, orders int").withColumn(
        "order_date", F.date_add(F.lit("2026-06-01").cast("date"), F.col("day_index")))
    weights = spark.createDataFrame([(i, 10 + i) for i in range(1, 6)], "restaurant_id long, weight long")
    people = spark.createDataFrame([(i, 1 + i % 4, 1 + i % 3) for i in range(1, 21)],
                                   "customer_id long, weight long, zone_id long")
    fees = spark.sql("select id as zone_id, cast(19 + id as decimal(18,2)) as delivery_fee "
                     "from range(1, 4)")
    rates = spark.sql("select id as restaurant_id, cast(0.18 as decimal(5,4)) as commission_pct "
                      "from range(1, 6)")
    shell = synth.orders_shell(hourly, weights, people.select("customer_id", "weight"),
                               people.select("customer_id", "zone_id"), fees, rates)
    return hourly, shell


def test_synthetic_orders(spark):
    hourly, shell = world(spark)
    assert quality.volume_mismatch(shell, hourly).count() == 0
    ids = sorted(r[0] for r in shell.select("order_id").collect())
    assert ids == list(range(1, 85))
    again = world(spark)[1]
    assert shell.exceptAll(again).count() == 0
    menu = spark.sql("select id as menu_item_id, id % 5 + 1 as restaurant_id, "
                     "cast(100 + id as decimal(18,2)) as price from range(20)")
    items = synth.order_items(shell, menu)
    own = items.join(menu, "menu_item_id").join(shell.select("order_id", F.col("restaurant_id")
                                                             .alias("r")), "order_id")
    assert own.filter("restaurant_id <> r").count() == 0
    orders = synth.finalised(shell, items)
    assert quality.subtotal_mismatch(orders, items).count() == 0
    riders = spark.sql("select id as rider_id, id % 3 + 1 as home_zone_id, id <> 4 as is_active "
                       "from range(9)")
    attempts = synth.match_attempts(orders, riders)
    assert quality.one_accepted_match(orders, attempts).count() == 0
    assert attempts.filter("rider_id = 4").count() == 0
    paid = synth.payments(orders)
    assert quality.payment_mismatch(orders, paid).count() == 0
    back = staging.stg_refunds(synth.refunds(orders, paid))
    assert quality.refund_above_total(orders, back).count() == 0


def test_reviews_keep_both_truths(spark):
    texts = spark.createDataFrame([(1, 10, "fine"), (2, 11, "x"), (3, 12, "no facts")],
                                  "review_id long, order_id long, review_text string")
    truth = spark.createDataFrame([(1, "positive", False), (2, "positive", True), (3, "neutral",
                                                                                  False)],
                                  "review_id long, text_sentiment string, ambiguous boolean")
    facts = spark.createDataFrame([(10, True, 0, False, 5), (11, True, 40, True, 5)],
                                  "order_id long, delivered boolean, late_minutes int, "
                                  "refunded boolean, rating int")
    got = {r["review_id"]: r for r in reviews.labelled(texts, truth, facts).collect()}
    assert set(got) == {1, 2} and got[1]["agrees"] and not got[2]["agrees"]
    opened = spark.createDataFrame([(7, 11, " hi "), (8, 10, "hi")],
                                   "ticket_id long, order_id long, text string")
    rows = reviews.tickets(opened, facts).collect()
    assert [(r["ticket_id"], r["ticket_text"]) for r in rows] == [(7, "REFUND REQUEST: hi")]


def test_issue_words_are_whole_words(spark):
    from tiffin.functions import text
    rows = spark.createDataFrame([("Chocolate cake on a plate",), ("late!",), ("élate",)], "t string")
    got = [r["i"] for r in rows.select(text.issues(F.col("t")).alias("i")).collect()]
    assert got == [["other"], ["late"], ["other"]]


def test_absent_arrival_path(spark):
    rows = spark.sql("select 1 as event_id, 1 as order_id, 'A' as event_type, "
                     "timestamp'2024-01-01 00:00:00' as occurred_at, "
                     "timestamp'2024-01-01 00:00:01' as received_at")
    assert events.unioned(rows, None).count() == 1
    both = events.unioned(rows, rows.withColumn("event_id", F.lit(2)))
    assert [r["_arrival_path"] for r in both.collect()] == ["batch"]


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_keys_of_links_are_dealt_to_a_given_number_of_tasks(bronze):
    """Spark puts partitions together by bytes, and one task sorted the keys of all payments."""
    for key, links in (("q03_relationships_clean", 1), ("q03_relationships_broken", 1),
                       ("j04_orphans", 1), ("q10_integrity_clean", 5),
                       ("q10_integrity_broken", 5)):
        dealt = QUERIES[key](bronze)._jdf.queryExecution().executedPlan().toString()
        assert dealt.count("REPARTITION_BY_NUM") == 2 * links, key


def test_tasks_grow_with_rows(spark):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert tasks(spark.range(10)) == least
    assert tasks(spark.range(0, 1000), rows=10) == 100
    child = spark.range(3000).selectExpr("id % 1500 as k", "id")
    parent = spark.range(1000).withColumnRenamed("id", "p")
    lost = quality.relationships(child, "k", parent, "p", tasks(child, rows=100))
    assert lost.count() == 1000 and lost.agg(F.min("k"), F.max("k")).first()[:] == (1000, 1499)


def test_staging_adds_up_the_lines_of_orders_once(bronze, monkeypatch):
    from tiffin.catalog import checks
    calls, whole = [], type(bronze).orders

    def counted(self):
        calls.append(1)
        return whole(self)
    monkeypatch.setattr(type(bronze), "orders", counted)
    staged = checks._staged(bronze)
    assert len(calls) == 1
    wanted = {"payments": staging.passed(bronze.payments(), "payments"),
              "refunds": staging.stg_refunds(bronze.refunds())}
    for name, df in wanted.items():
        assert staged[name].dtypes == df.dtypes
        assert staged[name].exceptAll(df).isEmpty() and df.exceptAll(staged[name]).isEmpty()
