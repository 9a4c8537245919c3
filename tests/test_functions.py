from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tiffin.functions import clock, draws, geo, keys, money, privacy, text


def one(spark, column, **values):
    names = list(values)
    df = spark.createDataFrame([tuple(values.values())], names) if names else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("raw, cents", [("(20.47)", -2047), ("12.00", 1200), ("", None),
                                        ("  (0.01) ", -1), ("n/a", None), ("1.2.3", None)])
def test_signed_cents(spark, raw, cents):
    assert one(spark, money.signed_cents(F.col("t")), t=raw) == cents


@pytest.mark.parametrize("amount", ["5.00", "0.47", "1234.50", "99999999.99", "0.00"])
@pytest.mark.parametrize("flag", [True, False])
def test_accounting_text_round_trip(spark, amount, flag):
    df = spark.createDataFrame([(Decimal(amount), flag)], "a decimal(18,2), f boolean")
    row = df.select(money.accounting_text(F.col("a"), F.col("f")).alias("t")).select(
        "t", money.positive_amount(F.col("t")).alias("back")).first()
    assert row["t"] == (f"({amount})" if flag else amount)
    assert row["back"] == Decimal(amount)


def test_tax_rounds_half_up(spark):
    assert one(spark, money.tax_cents(F.col("c"), F.col("b")), c=1250, b=1000) == 125
    assert one(spark, money.tax_cents(F.col("c"), F.col("b")), c=5, b=1000) == 1
    assert one(spark, money.tax_cents(F.col("c"), F.col("b")), c=4, b=1000) == 0


@pytest.mark.parametrize("mode", range(5))
def test_damage_is_repaired(spark, mode):
    note = "Ring the bell twice"
    bad = one(spark, text.damaged(F.col("t"), F.lit(mode)), t=note)
    assert (bad == note) == (mode == 4)
    assert one(spark, text.sentence_case(F.col("t")), t=bad) == note
    assert one(spark, text.match_key(F.col("t")), t=bad) == note.lower()


def test_display_keeps_inner_capitals(spark):
    assert one(spark, text.display_clean(F.col("t")), t="  BBQ ") == "BBQ"


@pytest.mark.parametrize("facts, expected", [
    ((True, 0, False, 5), "positive"), ((True, 12, False, 5), "neutral"),
    ((True, 0, False, 3), "neutral"), ((True, 30, False, 5), "negative"),
    ((True, 0, True, 5), "negative"), ((False, 0, False, 5), "negative"),
    ((True, 0, False, 2), "negative")])
def test_outcome_class(spark, facts, expected):
    d, late, r, rating = facts
    got = one(spark, text.outcome_class(F.col("d"), F.col("l"), F.col("r"), F.col("g")),
              d=d, l=late, r=r, g=rating)
    assert got == expected


def test_whole_text_is_read(spark):
    long = "word " * 50_000 + "great"
    assert one(spark, text.keyword_sentiment(F.col("t")), t=long) == "positive"


@pytest.mark.parametrize("salt", ["", "   ", None])
def test_empty_salt_fails(salt):
    with pytest.raises(ValueError):
        privacy.email_hash(None, salt)


def test_mask_and_hash(spark):
    assert one(spark, privacy.phone_masked(F.col("p")), p="+916000000042") == "+91*******042"
    a = one(spark, privacy.email_hash(F.col("e"), "s"), e=" A@B.c ")
    assert a == one(spark, privacy.email_hash(F.col("e"), "s"), e="a@b.c")
    assert a != one(spark, privacy.email_hash(F.col("e"), "t"), e="a@b.c")


def test_surrogate_key_is_null_safe(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (1, 1)], "a int, b int")
    found = [r[0] for r in df.select(keys.surrogate_key("a", "b")).collect()]
    assert None not in found and len(set(found)) == 3


def test_daylight_saving_hour(spark):
    start, end = datetime(2026, 11, 1, 4, 0), datetime(2026, 11, 1, 8, 0)
    df = spark.createDataFrame([(start, end)], "a timestamp, b timestamp")
    row = df.select(clock.elapsed_hours(F.col("a"), F.col("b")).alias("e"),
                    clock.wall_clock_hours(F.col("a"), F.col("b"), "America/New_York")
                    .alias("w")).first()
    assert (row["e"], row["w"]) == (4.0, 3.0)


def test_payout_cycle(spark):
    df = spark.sql("select date'2026-09-07' as a, date'2026-09-13' as b, date'2026-09-14' as c")
    assert df.select(*[clock.payout_cycle(F.col(c), "2026-09-07") for c in "abc"]).first() == (1, 1, 2)


def test_draws_repeat_and_cover(spark):
    ids = spark.range(20_000)
    for draw in (draws.xx_draw, draws.md5_draw):
        a = ids.select(draw(1, "id").alias("d"))
        assert a.exceptAll(ids.select(draw(1, "id").alias("d"))).count() == 0
        lo, hi, mean = a.agg(F.min("d"), F.max("d"), F.avg("d")).first()
        assert 0 <= lo < 1000 and 999_000 < hi < 1_000_000 and 490_000 < mean < 510_000
        assert ids.select((draw(1, "id") == draw(2, "id")).cast("int").alias("s")) \
            .agg(F.sum("s")).first()[0] < 10


def test_great_circle(spark):
    km = one(spark, geo.great_circle_km(*[F.col(c) for c in "abcd"]), a=0.0, b=0.0, c=0.0, d=1.0)
    assert abs(km - 111.195) < 0.01
