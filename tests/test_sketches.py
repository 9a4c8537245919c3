import pytest
from pyspark.sql import functions as F

from tiffin.catalog.relational import p04
from tiffin.operators import history, sketches
from tiffin.session import scratch


@pytest.mark.parametrize("hashed", [sketches.xx48, sketches.md5_48])
def test_distinct_counts_within_the_error_bound(spark, hashed):
    """Merged from days that overlap; four standard errors, and nearly exact when there are few."""
    df = spark.range(400_000).select(
        (F.col("id") % 10).alias("day"), F.expr("case when id % 100 = 0 then 'few' else 'many' end")
        .alias("kind"), F.expr("case when id % 100 = 0 then id % 5000 else id % 90000 end").alias("v"))
    daily = sketches.distinct_sketch(df, ["day", "kind"], "v", hashed=hashed)
    assert daily.groupBy("day", "kind").count().agg(F.max("count")).first()[0] <= 1024
    merged = sketches.merged_distinct(daily, ["kind"])
    got = {r["kind"]: r["n"] for r in sketches.estimated_distinct(merged, ["kind"], "n").collect()}
    want = {r["kind"]: r["n"] for r in df.groupBy("kind").agg(F.countDistinct("v").alias("n")).collect()}
    assert abs(got["many"] / want["many"] - 1) < 4 * 1.04 / 32
    assert abs(got["few"] - want["few"]) <= 2
    whole = sketches.distinct_sketch(df, ["kind"], "v", hashed=hashed)
    assert whole.exceptAll(merged.select(*whole.columns)).count() == 0  # merging loses nothing


def test_quantiles_within_the_error_bound(spark):
    df = spark.range(100_000).select((F.col("id") % 7).alias("day"), F.lit("a").alias("k"),
                                     F.pmod(F.xxhash64("id"), F.lit(3_000_000)).alias("v"))
    kept = sketches.value_sketch(df, ["day", "k"], "v")
    got = sketches.quantiles(kept, ["k"], {"q10": 0.1, "q50": 0.5, "q99": 0.99}).first()
    exact = df.agg(*[F.expr(f"percentile_disc({q}) within group (order by v)") for q in
                     (0.1, 0.5, 0.99)]).first()
    for name, want in zip(("q10", "q50", "q99"), exact, strict=True):
        assert want * (1 - 2 ** -7) <= got[name] <= want
    assert kept.groupBy("day").count().agg(F.max("count")).first()[0] <= 64 * 256


def test_small_empty_and_null_values(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1), ("a", 3), ("b", None)], "k string, v long")
    got = sketches.quantiles(sketches.value_sketch(df, ["k"], "v"), ["k"], {"m": 0.5}).collect()
    assert [tuple(r) for r in got] == [("a", 1)]
    few = sketches.estimated_distinct(sketches.distinct_sketch(df, ["k"], "v"), ["k"], "n")
    assert [tuple(r) for r in few.collect()] == [("a", 3)]
    with pytest.raises(Exception, match="negative"):
        sketches.value_sketch(df.withColumn("v", F.lit(-1)), ["k"], "v").collect()


def files(kept):
    """(bucket, version) pairs: the folders that readers see."""
    return {tuple(r) for r in kept.table.visible().collect()}


def test_a_snapshot_writes_only_the_buckets_that_differ(spark):
    rows = spark.range(2000).selectExpr("id as k", "id % 5 as v", "cast(id as string) as note")
    kept = history.KeptHistory(spark, scratch(spark, "kept"), rows.schema, "k", ["v"], buckets=32)
    day = [F.lit(f"2026-01-0{i} 00:00:00").cast("timestamp") for i in (1, 2, 3)]
    kept.start(rows, day[0])
    before = files(kept)
    after = rows.filter("k <> 7").withColumn("v", F.when(F.col("k") == 9, 99).otherwise(F.col("v"))) \
        .withColumn("note", F.lit("not checked"))
    assert 1 <= kept.apply(after, day[1]) <= 2
    assert len(before & files(kept)) >= 30  # untouched buckets keep their files
    assert kept.apply(after, day[2]) == 0
    got = kept.table.read()
    assert got.count() == 2001
    assert {(r["k"], r["v"], r["valid_from"].day, r["valid_to"] and r["valid_to"].day)
            for r in got.filter("k in (7, 9)").collect()} == {
        (7, 2, 1, 2), (9, 4, 1, 2), (9, 99, 2, None)}
    plan = kept.compared(after)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1 and "note" not in plan.split("Relation")[0]


def test_a_range_of_days_reaches_the_scan(spark, bronze):
    plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        p04(bronze)._jdf.queryExecution(), "formatted")
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line
                  and "o_orderdate" in line)
    assert "GreaterThanOrEqual(o_orderdate,1996-06-03" in pushed
    assert "LessThan(o_orderdate,1996-09-07" in pushed
