import bisect
import itertools
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tiffin.operators import allocate, asof


def split(spark, total, weights, places=2):
    rows = [("g", Decimal(total), Decimal(w), i) for i, w in enumerate(weights)]
    df = spark.createDataFrame(rows, "g string, t decimal(18,2), w decimal(18,4), i int")
    out = allocate.largest_remainder(df, ["g"], "t", "w", "i", "part", places)
    return [r["part"] for r in out.orderBy("i").collect()]


def test_parts_sum_exactly(spark):
    parts = split(spark, "100.00", ["1", "1", "1"])
    assert sum(parts) == Decimal("100.00") and parts[0] == Decimal("33.34")


def test_largest_remainder_gets_the_unit(spark):
    assert split(spark, "10", ["1.1", "1.7", "1.2"], 0) == [3, 4, 3]


def test_zero_weights_fail(spark):
    with pytest.raises(Exception, match="weights sum to zero"):
        split(spark, "10.00", ["0", "0"])


def test_negative_totals_and_fine_weights(spark):
    assert split(spark, "-1.00", ["1", "1", "1"]) == [Decimal("-0.34"), Decimal("-0.33"),
                                                      Decimal("-0.33")]
    rows = [("g", Decimal("1.00"), Decimal("0.00001"), i) for i in range(3)]
    df = spark.createDataFrame(rows, "g string, t decimal(18,2), w decimal(18,5), i int")
    parts = allocate.largest_remainder(df, ["g"], "t", "w", "i", "part").collect()
    assert sum(r["part"] for r in parts) == Decimal("1.00")


def test_weighted_pick_equals_inverse_cdf(spark):
    weights = [5, 0, 1, 300, 44, 2]
    table = spark.createDataFrame(list(enumerate(weights)), "id long, w long")
    cum = list(itertools.accumulate(weights))
    draws = [0, 1, 2**48 - 1] + [2**48 * k // 997 for k in range(997)]
    rows = spark.createDataFrame([(d,) for d in draws], "d long")
    got = {r["d"]: r["id"] for r in allocate.weighted_pick(rows, F.col("d"), table, "id", "w")
           .collect()}
    assert got == {d: bisect.bisect_right(cum, d * cum[-1] >> 48) for d in draws}


def test_more_than_a_million_keys_keep_their_weight(spark):
    n = 1_200_000
    keys = spark.range(n).select("id", F.lit(1).alias("w"))
    rows = spark.range(n).select((F.col("id").cast("decimal(38,0)") * F.lit(2**48)
                                  / F.lit(n) + 1).cast("long").alias("d"))
    picked = allocate.weighted_pick(rows, F.col("d"), keys, "id", "w")
    got = picked.agg(F.count("*").alias("n"), F.countDistinct("id").alias("k")).first()
    assert (got["n"], got["k"]) == (n, n)


def test_half_open_boundaries(spark):
    facts = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2023, 12, 31, 23, 59)),
                                   (3, datetime(2030, 1, 1)), (4, datetime(2019, 1, 1))],
                                  "id int, at timestamp").withColumn("k", F.lit("a"))
    cards = spark.createDataFrame([("a", datetime(2020, 1, 1), datetime(2024, 1, 1), 10),
                                   ("a", datetime(2024, 1, 1), None, 20)],
                                  "k string, valid_from timestamp, valid_to timestamp, rate int")
    got = {r["id"]: r["rate"] for r in asof.version_join(facts, cards, ["k"], "at").collect()}
    assert got == {1: 20, 2: 10, 3: 20, 4: None}


SCOPES = [("RESTAURANT", "r"), ("CITY", "c"), ("GLOBAL", None)]
CARD = "id long, scope string, scope_key string, fee long, effective_from date, effective_to date"


def resolve(spark, card, facts):
    df = spark.createDataFrame(facts, "o int, r long, c long, d date")
    rates = spark.createDataFrame(card, CARD)
    out = asof.by_precedence(df, rates, SCOPES, "d", "fee", "id")
    return {row["o"]: (row["fee"], row["precedence"]) for row in out.collect()}


def test_precedence_and_boundary(spark):
    d = date
    card = [(1, "GLOBAL", None, 100, d(2020, 1, 1), None),
            (2, "CITY", "7", 75, d(2026, 10, 1), None),
            (3, "RESTAURANT", "5", 0, d(2026, 9, 1), d(2026, 10, 1))]
    got = resolve(spark, card, [(1, 5, 7, d(2026, 9, 30)), (2, 5, 7, d(2026, 10, 1)),
                                (3, 6, 7, d(2026, 9, 30)), (4, 6, 8, d(2026, 12, 1)),
                                (5, 6, 8, d(2019, 1, 1))])
    assert got == {1: (0, 1), 2: (75, 2), 3: (100, 3), 4: (100, 3)}


def test_a_tie_has_one_winner(spark):
    d = date
    card = [(9, "CITY", "7", 90, d(2020, 1, 1), None), (4, "CITY", "7", 40, d(2020, 1, 1), None)]
    assert resolve(spark, card, [(1, 5, 7, d(2026, 1, 1))]) == {1: (40, 2)}


@pytest.mark.parametrize("scope, key", [("RESTAURANT", "5"), ("CITY", "7"), ("GLOBAL", None)])
def test_overlapping_windows_give_one_row(spark, scope, key):
    d = date
    card = [(2, scope, key, 20, d(2020, 1, 1), None),
            (1, scope, key, 10, d(2022, 1, 1), d(2023, 1, 1)),
            (3, scope, key, 30, d(2019, 1, 1), d(2021, 1, 1))]
    facts = [(1, 5, 7, d(2022, 6, 1)), (2, 5, 7, d(2020, 6, 1)), (3, 5, 7, d(2019, 6, 1)),
             (4, 5, 7, d(2024, 1, 1))]
    df = spark.createDataFrame(facts, "o int, r long, c long, d date")
    got = asof.by_precedence(df, spark.createDataFrame(card, CARD), SCOPES, "d", "fee", "id")
    assert sorted((r["o"], r["fee"]) for r in got.collect()) == [(1, 10), (2, 20), (3, 30), (4, 20)]


def test_no_nested_loop_for_precedence(spark):
    df = spark.createDataFrame([(1, 5, 7, date(2026, 1, 1))], "o int, r long, c long, d date")
    rates = spark.createDataFrame([(1, "GLOBAL", None, 1, date(2020, 1, 1), None)], CARD)
    plan = asof.by_precedence(df, rates, SCOPES, "d", "fee", "id")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_weights_that_would_vanish_are_refused(spark):
    """A fraction in a pick, a longer decimal or a tiny float in a split: errors, not losses."""
    rows = spark.range(3).withColumn("d", F.lit(5).cast("long"))
    for w in ("cast(0.4 as double)", "cast(0.4 as decimal(5,2))", "-1"):
        weights = spark.sql(f"select 1 as k, {w} as w")
        with pytest.raises(Exception, match="not a whole number"):
            allocate.weighted_pick(rows, F.col("d"), weights, "k", "w").collect()
    whole = spark.sql("select 1 as k, cast(3 as decimal(5,2)) as w union all select 2, 0")
    assert {r["k"] for r in allocate.weighted_pick(rows, F.col("d"), whole, "k", "w").collect()} == {1}
    for w in ("cast(0.12345678901 as decimal(20,11))", "cast(1e-12 as double)"):
        df = spark.sql(f"select 1 as g, 10 as t, {w} as w, 1 as i")
        with pytest.raises(Exception, match="digits after the point"):
            allocate.largest_remainder(df, ["g"], "t", "w", "i", "part").collect()


@pytest.mark.parametrize("few", [0, 1 << 16])
@pytest.mark.parametrize("scale", [1, 10 ** 13])
def test_picks_equal_a_plain_search(spark, monkeypatch, few, scale):
    """Small and large tables, products in longs and in decimals: the same keys."""
    monkeypatch.setattr(allocate, "FEW_KEYS", few)
    weights = [(k, (k * 37 % 11) * scale) for k in range(40)]
    total, bounds = sum(w for _, w in weights), []
    for k, w in weights:
        bounds.append(((bounds[-1][0] if bounds else 0) + w, k))
    rows = spark.range(500).select("id", F.shiftrightunsigned(F.xxhash64("id"), 16).alias("d"))
    got = allocate.weighted_pick(rows, F.col("d"), spark.createDataFrame(weights, "k long, w long"),
                                 "k", "w").collect()
    assert len(got) == 500
    for r in got:
        point = r["d"] * total >> 48
        assert r["k"] == next(k for top, k in bounds if point < top)
