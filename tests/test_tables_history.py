from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tiffin.operators import history, quality
from tiffin.session import scratch
from tiffin.sources import tables


def table(spark, df, part=None):
    return tables.VersionedTable(spark, scratch(spark, "test"), df.schema, part)


def as_dict(df):
    return {r[0]: r[1] for r in df.collect()}


def test_upsert(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    b = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    t = table(spark, a)
    for _ in range(2):
        t.upsert(a, ["k"])
    for _ in range(2):
        t.upsert(b, ["k"])
    assert as_dict(t.read()) == {1: "a", 2: "B", 3: "c"}
    t.upsert(a.unionByName(b.filter("k = 3")), ["k"], update=False)
    assert as_dict(t.read()) == {1: "a", 2: "B", 3: "c"}


def test_null_keys_match(spark):
    a = spark.createDataFrame([(None, "a")], "k int, v string")
    t = table(spark, a)
    t.upsert(a, ["k"])
    t.upsert(a.withColumn("v", F.lit("b")), ["k"])
    assert as_dict(t.read()) == {None: "b"}


def test_replayed_batch_is_skipped(spark):
    a = spark.createDataFrame([(1, "a")], "k int, v string")
    t = table(spark, a)
    assert t.append(a, "app", 7) and not t.append(a, "app", 7) and t.append(a, "app", 8)
    assert t.read().count() == 2


def test_unfinished_commit_is_invisible(spark):
    a = spark.createDataFrame([(1, "a")], "k int, v string")
    t = table(spark, a)
    t.append(a)
    (a.withColumn("_part", F.lit("all")).write.partitionBy("_part")
     .parquet(f"{t.path}/data/_version=2"))  # files without a log row
    assert as_dict(t.read()) == {1: "a"}
    t.upsert(a.withColumn("v", F.lit("z")), ["k"])
    assert as_dict(t.read()) == {1: "z"}


def test_replace_empties_days(spark):
    rows = spark.createDataFrame([(date(2024, 1, d), d) for d in range(1, 6)], "d date, n int")
    t = table(spark, rows, F.col("d"))
    t.replace(rows)
    again = spark.createDataFrame([(date(2024, 1, 2), 20)], "d date, n int")
    for _ in range(2):
        t.replace(again, (F.col("_part") >= "2024-01-02") & (F.col("_part") < "2024-01-04"))
    assert as_dict(t.read()) == {date(2024, 1, 1): 1, date(2024, 1, 2): 20, date(2024, 1, 4): 4,
                                 date(2024, 1, 5): 5}


def test_chunks_and_capacity(spark):
    bounds = spark.sql("select date'2024-01-01' as a, date'2024-01-07' as b")
    got = [tuple(r) for r in tables.chunks(bounds, "a", "b", 3).orderBy("chunk").collect()]
    assert got == [(0, date(2024, 1, 1), date(2024, 1, 4)), (1, date(2024, 1, 4), date(2024, 1, 7)),
                   (2, date(2024, 1, 7), date(2024, 1, 8))]
    tables.check_capacity(9, 1, 10)
    with pytest.raises(tables.CapacityError):
        tables.check_capacity(10, 1, 10)


def test_overwrite_refuses_another_schema(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    path = scratch(spark, "contract")
    assert tables.overwrite(df, [("k", "int"), ("v", "string")], path) == 1
    with pytest.raises(quality.ContractError):
        tables.overwrite(df, [("k", "bigint"), ("v", "string")], path)
    with pytest.raises(quality.ContractError):
        tables.overwrite(df, [("v", "string"), ("k", "int")], path)


def test_change_feed(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], "k int, v string")
    got = sorted((r["k"], r["v"] or "", r["_change_type"])
                 for r in history.change_feed(old, new, ["k"]).collect())
    assert got == [(2, "", "update_preimage"), (2, "b", "update_postimage"), (3, "c", "delete"),
                   (4, "d", "insert")]


def test_scd2(spark):
    def ts(y):
        return F.lit(f"{y}-01-01 00:00:00").cast("timestamp")
    first = spark.createDataFrame([(1, "a", "x"), (2, "b", "x")], "k int, v string, free string")
    second = spark.createDataFrame([(1, "A", "x"), (2, "b", "y"), (3, "c", "x")], first.schema)
    third = spark.createDataFrame([(1, "A", "x"), (3, "c", "x")], first.schema)
    h = history.scd2_start(first, ts(2020))
    h = history.scd2_apply(h, second, "k", ["v"], ts(2021))
    assert history.scd2_apply(h, second, "k", ["v"], ts(2021)).exceptAll(h).count() == 0
    h = history.scd2_apply(h, third, "k", ["v"], ts(2022))
    got = sorted((r["k"], r["v"], r["valid_from"].year, r["valid_to"].year if r["valid_to"] else 0)
                 for r in h.collect())
    assert got == [(1, "A", 2021, 0), (1, "a", 2020, 2021), (2, "b", 2020, 2022), (3, "c", 2021, 0)]
    assert quality.scd2_problems(h, "k").count() == 0
    view = history.scd2_view(h, "k", "key")
    assert view.select("key").distinct().count() == 4
    assert view.filter("is_current").count() == 2


def test_scd2_problems_can_fail(spark):
    rows = [(1, datetime(2020, 1, 1), datetime(2021, 6, 1)), (1, datetime(2021, 1, 1), None),
            (2, datetime(2020, 1, 1), None), (2, datetime(2021, 1, 1), None)]
    df = spark.createDataFrame(rows, "k int, valid_from timestamp, valid_to timestamp")
    got = {tuple(r) for r in quality.scd2_problems(df, "k").collect()}
    assert got == {(1, "OVERLAP"), (2, "OVERLAP"), (2, "MANY_CURRENT")}
