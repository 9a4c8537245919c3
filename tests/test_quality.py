"""Every check has a case that passes and one that fails."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tiffin.operators import quality
from tiffin.plans import marts
from tiffin.sources import landing


def money(*rows):
    return [tuple(Decimal(v) if isinstance(v, str) and v[0].isdigit() else v for v in r)
            for r in rows]


def test_generic_checks(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, None), (None, "z")], "k int, v string")
    assert quality.not_null(df, "v").count() == 1
    assert quality.not_null(df, "v", F.col("k") == 1).count() == 0
    assert [tuple(r) for r in quality.unique(df, ["k"]).collect()] == [(2, 2)]
    assert quality.unique(df, ["k", "v"]).count() == 0
    parent = spark.createDataFrame([(1,)], "id int")
    assert quality.relationships(df, "k", parent, "id").count() == 2
    assert quality.relationships(df.filter("k is null"), "k", parent, "id").count() == 0
    assert quality.accepted_values(df, "v", ["a", "b"]).count() == 1
    assert quality.accepted_values(df, "v", ["a", "b", "z"]).count() == 0


ORDERS = "order_id long, order_status string, subtotal decimal(18,2), order_total decimal(18,2)"


def orders(spark):
    return spark.createDataFrame(money((1, "DELIVERED", "10.00", "12.00"),
                                       (2, "UNFULFILLED", "5.00", "7.00")), ORDERS)


@pytest.mark.parametrize("attempts, bad", [
    ([(1, "ACCEPTED"), (2, "DECLINED")], set()), ([(1, "DECLINED")], {1}),
    ([(1, "ACCEPTED"), (1, "ACCEPTED")], {1}), ([(1, "ACCEPTED"), (2, "ACCEPTED")], {2}), ([], {1})])
def test_one_accepted(spark, attempts, bad):
    df = spark.createDataFrame(attempts, "order_id long, response string")
    got = quality.one_accepted_match(orders(spark), df).collect()
    assert {r["order_id"] for r in got} == bad


def test_money_checks(spark):
    lines = spark.createDataFrame(money((1, "4.00"), (1, "6.00"), (2, "5.01")),
                                  "order_id long, line_total decimal(18,2)")
    assert [r["order_id"] for r in quality.subtotal_mismatch(orders(spark), lines).collect()] == [2]
    paid = spark.createDataFrame(money((1, "12.00", "SUCCESS"), (2, "1.00", "FAILED"),
                                       (3, "1.00", "SUCCESS")),
                                 "order_id long, amount decimal(18,2), status string")
    assert [r["order_id"] for r in quality.payment_mismatch(orders(spark), paid).collect()] == [3]
    back = spark.createDataFrame(money((1, 1, "12.00"), (2, 2, "7.01")),
                                 "refund_id long, order_id long, refund_amount decimal(18,2)")
    assert [r["refund_id"] for r in quality.refund_above_total(orders(spark), back).collect()] == [2]


def test_volume_mismatch_behind_a_correct_total(spark):
    plan = spark.createDataFrame([(0, 1, 2), (0, 2, 1)], "day_index int, hour int, orders int")
    good = spark.createDataFrame([(0, 1), (0, 1), (0, 2)], "day_index int, hour int")
    moved = spark.createDataFrame([(0, 1), (0, 2), (0, 2)], "day_index int, hour int")
    assert quality.volume_mismatch(good, plan).count() == 0
    assert quality.volume_mismatch(moved, plan).count() == 2
    extra = good.unionByName(spark.createDataFrame([(0, 9)], "day_index int, hour int"))
    assert [tuple(r) for r in quality.volume_mismatch(extra, plan).collect()] == [(0, 9, 0, 1)]


def test_capacity_and_empty_zones(spark):
    daily = spark.createDataFrame([(0, 24), (1, 25)], "day_index int, orders int")
    riders = spark.createDataFrame([(1, 1, True), (2, 1, True), (3, 2, False)],
                                   "rider_id long, home_zone_id long, is_active boolean")
    assert [r["day_index"] for r in quality.over_capacity(daily, riders).collect()] == [1]
    zones = spark.createDataFrame([(1,), (2,)], "zone_id long")
    assert [r["zone_id"] for r in quality.zones_without_rider(zones, riders).collect()] == [2]


def test_contracts():
    with pytest.raises(quality.ContractError):
        quality.free_namespace(["order_id", "_Bronze_batch_id"])
    quality.free_namespace(["order_id"])
    quality.no_answer_key(marts.LINEAGE)
    with pytest.raises(quality.ContractError, match="_gen_truth"):
        quality.no_answer_key({**marts.LINEAGE, "bad": ["_gen_truth"]})


def test_landing_contract(spark):
    df = spark.createDataFrame([("1", "b")], "order_id string, _bronze_batch_id string")
    quality.landing_contract(df, ["_bronze_batch_id"])
    with pytest.raises(quality.ContractError, match="missing metadata"):
        quality.landing_contract(df, landing.METADATA)
    with pytest.raises(quality.ContractError, match="not string"):
        quality.landing_contract(df.withColumn("order_id", F.lit(1)), ["_bronze_batch_id"])


def test_gate_stops_at_the_first_failing_layer(spark):
    built = []
    df = spark.createDataFrame([(1,), (None,)], "k int")
    good = quality.Check("good", lambda: quality.not_null(df.filter("k = 1"), "k"))
    bad = quality.Check("bad", lambda: quality.not_null(df, "k"))
    layers = [("a", lambda: built.append("a"), [good]), ("b", lambda: built.append("b"), [bad]),
              ("c", lambda: built.append("c"), [good])]
    with pytest.raises(quality.GateError, match="bad"):
        quality.run_layers(layers)
    assert built == ["a", "b"]
    assert quality.run_layers(layers[:1]) == ["a"]


def test_first_reason_wins(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    code = quality.first_reason((F.col("k") <= 1, "A"), (F.col("k") <= 2, "B"))
    assert [r[0] for r in df.select(code).collect()] == ["A", "B", None]


def test_rerun_changes_nothing_or_is_reported(spark):
    df = spark.createDataFrame([(1,), (2,)], "v int")
    m = {"n": F.count(F.lit(1)), "s": F.sum("v")}
    assert quality.changed_by_rerun(df, df, m).count() == 0
    assert quality.changed_by_rerun(df, df.union(df), m).count() == 2
