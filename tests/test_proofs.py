import dataclasses

import pytest
from pyspark.sql import functions as F

from tiffin import lineage
from tiffin.operators import quality
from tiffin.plans import defects
from tiffin.session import materialise, scratch
from tiffin.sources import tables


def test_sources_come_from_the_plan(spark, bronze):
    labels, orders = bronze.raw("labels"), bronze.raw("orders")
    assert lineage.sources(orders.join(bronze.raw("customer"), F.lit(True))) == {"orders", "customer"}
    hidden = orders.withColumn("best", labels.agg(F.max("quality")).scalar())
    assert lineage.sources(hidden) == {"orders", "labels"}
    copy = materialise(materialise(labels, "copy"), "copy-of-copy")
    assert lineage.sources(copy) == {"labels"}
    path = scratch(spark, "mart")
    tables.overwrite(labels, quality.fields(labels.schema), path)
    assert lineage.sources(spark.read.parquet(path)) == {"labels"}
    assert lineage.sources(spark.createDataFrame([(1,)], "a int")) == {"local"}


def test_a_mart_that_reads_the_answer_key_fails(bronze):
    models = {"good": bronze.raw("orders"), "bad": materialise(bronze.raw("labels"), "k")}
    assert quality.forbidden_sources(models, ["labels"]) == {"bad": ["labels"]}
    with pytest.raises(quality.ContractError, match="bad"):
        quality.no_forbidden_source(models, ["labels"])
    quality.no_forbidden_source({"good": models["good"]}, ["labels"])


def test_fingerprints(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 as part", "cast(id as decimal(18,2)) as cents",
                                      "if(id = 5, null, 'x') as note")
    assert tables.changed_parts(df, df.repartition(9).sort("note"), ["part"]).count() == 0
    cent = df.withColumn("cents", F.when(F.col("id") == 8, F.col("cents") + 1).otherwise(
        F.col("cents")).cast("decimal(18,2)"))
    assert [tuple(r) for r in tables.changed_parts(df, cent, ["part"]).collect()] == [(1, 143, 143)]
    twice = df.unionByName(df.filter("id = 8"))  # xor alone would miss a pair of copies
    assert [tuple(r) for r in tables.changed_parts(df, twice, ["part"]).collect()] == [(1, 143, 144)]
    less = df.filter("part <> 3")
    assert [tuple(r) for r in tables.changed_parts(df, less, ["part"]).collect()] == [(3, 143, 0)]


def shifts(spark):
    return spark.range(100).selectExpr(
        "id as shift_id", "timestamp'2026-01-01 00:00:00' as login_at",
        "timestamp'2026-01-01 08:00:00' as logout_at")


def test_a_repair_that_was_taken_out_shows(spark):
    """The last column is counted by the test, so it is not zero when nothing is repaired."""
    found = next(d for d in defects.REGISTRY if d.name == "open shift")
    broken = dataclasses.replace(found, name="no repair", repair=lambda df: df)
    blind = dataclasses.replace(found, name="blind test", violations=lambda df: df.filter("false"))
    got = {r["defect"]: (r["found_clean"], r["found_damaged"], r["left_after"])
           for r in defects.proofs({"shifts": shifts(spark)}, [found, broken, blind]).collect()}
    assert got == {"open shift": (0, 2, 0), "no repair": (0, 2, 2), "blind test": (0, 0, 0)}


def test_backfill_of_one_chunk_leaves_the_others(spark):
    bounds = spark.sql("select date'2026-01-01' as a, date'2026-01-10' as b")
    plan = tables.chunks(bounds, "a", "b", 4)
    rows = spark.sql("select explode(sequence(date'2025-12-30', date'2026-01-12')) as day, 1 as v")
    path = scratch(spark, "backfill")
    tables.backfill(rows, "day", plan, path)
    names = {r[0] for r in spark.read.parquet(path).select(F.col("_metadata.file_path")).collect()}
    assert spark.read.parquet(path).count() == 10  # days outside the plan are not written
    tables.backfill(rows.withColumn("v", F.lit(2)), "day", plan.filter("chunk = 1"), path)
    again = spark.read.parquet(path)
    assert {(r["v"], r["n"]) for r in again.groupBy("v").agg(F.count("*").alias("n")).collect()} == {
        (1, 6), (2, 4)}
    kept = {r[0] for r in again.filter("v = 1").select(F.col("_metadata.file_path")).collect()}
    assert kept <= names


def test_backfill_reads_its_source_once(spark):
    bounds = spark.sql("select date'2026-01-01' as a, date'2026-03-10' as b")
    plan = tables.chunks(bounds, "a", "b", 7)
    source = spark.range(100).selectExpr("date_add(date'2026-01-01', cast(id % 60 as int)) as day")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    tables.backfill(source.mapInArrow(count, "day date"), "day", plan, scratch(spark, "once"))
    assert seen.value == 100
