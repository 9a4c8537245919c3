from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tiffin.operators import measure
from tiffin.session import scratch
from tiffin.sources import landing
from tiffin.sources.keyed import KeyedTable
from tiffin.streaming import gold, silver
from tiffin.streaming.ingest import BronzeStream
from tiffin.streaming.progress import finish

COLUMNS = ["event_id", "order_id", "event_type", "occurred_at", "received_at"]


def events(spark, first, n):
    return spark.range(first, first + n).select(
        F.col("id").alias("event_id"), (F.col("id") % 9).alias("order_id"),
        F.lit(" placed ").alias("event_type"),
        F.lit("2026-09-08 10:00:00").alias("occurred_at"),
        F.lit("2026-09-08 10:00:05").alias("received_at"))


def feed(spark, kind="json", max_files=8):
    root = scratch(spark, "stream-test")
    return BronzeStream(spark, f"{root}/landing", f"{root}/bronze", COLUMNS, kind, max_files)


@pytest.mark.parametrize("kind", ["json", "csv"])
def test_only_new_files_are_read(spark, kind):
    stream = feed(spark, kind, max_files=1)
    landing.write_shard(events(spark, 0, 800), stream.landing, 0, kind)
    landing.write_shard(events(spark, 800, 800), stream.landing, 1, kind)
    assert stream.ingest_once("run-1") == 1600
    landing.write_shard(events(spark, 1600, 250), stream.landing, 2, kind)
    assert stream.ingest_once("run-2") == 250
    assert stream.ingest_once("run-3") == 0
    twice = stream.read().groupBy("_bronze_source_file").agg(
        F.count_distinct("_bronze_batch_id").alias("n")).filter("n > 1")
    assert twice.count() == 0 and stream.read().count() == 1850
    assert stream.read().filter(F.col(landing.RESCUED).isNotNull()).count() == 0
    assert stream.read().filter("event_type = ' placed '").count() == 1850  # not trimmed


def test_checkpoint_outside_landing(spark):
    with pytest.raises(ValueError):
        BronzeStream(spark, "/a/landing", "/a/landing/bronze", COLUMNS)


def test_malformed_lines_are_kept(spark):
    stream = feed(spark)
    spark.createDataFrame([('{"event_id": "1"}',), ("not json",), ('{"event_id": "2", "x": 1}',)],
                          "value string").write.text(stream.landing + "/shard=0000")
    stream.ingest_once("only")
    got = {(r["event_id"], r[landing.RESCUED]) for r in stream.read().collect()}
    assert got == {("1", None), (None, "not json"), ("2", '{"event_id": "2", "x": 1}')}


def batch(spark, *rows):
    return spark.createDataFrame(rows, "event_id string, order_id string, event_type string, "
                                 "occurred_at string, received_at string, _change_type string")


A = ("1", "1", "placed", "2026-09-08 10:00:00", "2026-09-08 10:00:05", "insert")
B = ("2", "1", "Matched ", "2026-09-08 10:01:00", "2026-09-08 10:01:04", "insert")


def test_replayed_batch(spark):
    target = silver.table(spark, scratch(spark, "silver-test"))
    assert silver.upsert_batch(target, batch(spark, A, B), 7)
    assert not silver.upsert_batch(target, batch(spark, A, B), 7)
    silver.upsert_batch(target, batch(spark, A, B), 8)
    rows = {r["event_id"]: r for r in target.read().collect()}
    assert set(rows) == {1, 2} and rows[2]["event_type"] == "MATCHED" and rows[1]["lag_seconds"] == 5


def test_duplicates_in_a_batch_and_other_changes(spark):
    target = silver.table(spark, scratch(spark, "silver-test"))
    later = A[:4] + ("2026-09-08 10:00:09", "insert")
    gone = B[:5] + ("delete",)
    silver.upsert_batch(target, batch(spark, later, A, gone), 1)
    assert [(r["event_id"], r["lag_seconds"]) for r in target.read().collect()] == [(1, 5)]


def test_window_rows_are_revised_not_added(spark):
    target = gold.table(spark, scratch(spark, "gold-test"))

    def counts(n):
        t = datetime(2026, 9, 8, 10, 0)
        return spark.createDataFrame([(t, t, t.date(), 1, "PLACED", n, 0, n, 5)], gold.SCHEMA)
    target.upsert(counts(3), gold.KEYS, app="w", batch_id=0)
    target.upsert(counts(5), gold.KEYS, app="w", batch_id=1)
    target.upsert(counts(5), gold.KEYS, app="w", batch_id=1)
    assert [r["n_events"] for r in target.read().collect()] == [5]


def test_rows_past_the_watermark_are_reported(spark):
    """A watermark below the lag drops late rows; the lag column and the metric both show it."""
    stream = feed(spark)
    zones = spark.createDataFrame([(0, 1)], "order_id long, zone_id long")
    root = scratch(spark, "late-test")
    target = gold.table(spark, f"{root}/gold")

    def run(day):
        rows = events(spark, 0, 1).withColumn("occurred_at", F.lit(f"2026-09-{day} 10:00:00")) \
            .withColumn("received_at", F.lit("2026-09-28 10:00:00"))
        landing.write_shard(rows, stream.landing, int(day), "json")
        counts = gold.windowed(silver.typed(stream.source()), zones, "1 hours", 3600)
        query = gold.run(counts, target, f"{root}/checkpoint")
        query.awaitTermination()
        return sum(s.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress
                   for s in p["stateOperators"])
    assert run("27") == 0
    assert run("08") == 1
    assert target.read().count() == 1
    lagged = silver.typed(spark.read.json(stream.landing))
    assert gold.measured_lag(lagged).first()["watermark_hours"] == 20 * 24 + 1


def test_dropped_rows_are_counted_exactly(spark):
    """A watermark that is too short, several batches per run: rows read are rows kept and dropped."""
    stream = feed(spark, max_files=1)
    root = scratch(spark, "dropped-test")
    path, kept = f"{root}/timely", 0
    for i, (hour, n) in enumerate([(12, 40), (3, 20), (11, 10)]):
        rows = events(spark, 100 * i, n).coalesce(2).withColumn(
            "occurred_at", F.lit(f"2026-09-08 {hour:02d}:00:00"))
        landing.write_shard(rows, stream.landing, i, "json")
        run = finish(gold.timely(silver.typed(stream.source()), "2 hours").writeStream
                     .format("parquet").option("path", path)
                     .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
                     .start())
        assert (run.rows_in, run.rows_dropped) == (n, n if hour == 3 else 0)
        kept += run.rows_in - run.rows_dropped
        assert spark.read.parquet(path).count() == kept
    assert gold.watermark_for(silver.typed(spark.read.json(stream.landing))) == "9 hours"


def test_lookups_read_the_ranges_of_the_batch(spark):
    """Bytes follow the batch: shown by the plan and by what tasks read."""
    rows = spark.range(200_000).select(F.col("id").alias("order_id"),
                                       F.xxhash64("id").alias("zone_id"))
    table = KeyedTable(spark, scratch(spark, "keyed"), "order_id", 10_000).write(rows)
    few = spark.createDataFrame([(15_000,), (15_001,), (None,), (999_999_999,)], "order_id long")
    plan = table.near(few.filter("order_id < 20000"))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(_range" in plan and "(_range" in plan and "= 1)" in plan
    assert "PushedFilters: [IsNotNull(order_id), GreaterThanOrEqual(order_id,15000)" in plan
    got = {r["order_id"]: r["zone_id"] for r in table.attach(few).collect()}
    assert got[None] is None and got[999_999_999] is None and got[15_000] is not None
    near, whole = (measure.scanned(spark, lambda f=f: measure.parquet(spark, table.path).filter(f)
                                   .agg(F.max("zone_id")).collect()).n_bytes
                   for f in ("_range = 1", "true"))
    assert near * 15 < whole
    empty = table.attach(few.filter("order_id < 0"))
    assert empty.columns == ["order_id", "zone_id"] and empty.count() == 0


def test_enriched_events_follow_the_table(spark):
    """A batch sees the static table as it is when the batch runs; a missing order keeps its event."""
    stream = feed(spark)
    root = scratch(spark, "enrich-test")
    zones = KeyedTable(spark, f"{root}/zones", "order_id", 3)
    for i, zone in enumerate((10, 20)):
        zones.write(spark.range(5).select(F.col("id").alias("order_id"),
                                          F.lit(zone).cast("long").alias("zone_id")))
        landing.write_shard(events(spark, 9 * i, 9).coalesce(2), stream.landing, i, "json")
        silver.enrich(stream.source(), zones, f"{root}/out", f"{root}/ckpt").awaitTermination()
    got = silver.enriched(spark, f"{root}/out", "event_id long, order_id long, zone_id long", False)
    want = {(e, e % 9, (10 if e < 9 else 20) if e % 9 < 5 else None) for e in range(18)}
    assert {tuple(r) for r in got.collect()} == want


def test_ranges_of_the_lookup_do_not_grow_with_the_orders(spark, bronze, tmp_path):
    from pyspark.sql import functions as F

    from tiffin.catalog import streams

    class Wide:
        """Orders whose ids are far apart, as in a large table."""
        def __init__(self):
            self.spark = spark

        def raw(self, table):
            return bronze.raw(table).withColumn("o_orderkey", F.col("o_orderkey") * 5_000)

        def shells(self):
            return bronze.shells().withColumn("order_id", F.col("order_id") * 5_000)

    written = streams._order_zones(Wide(), str(tmp_path))
    table = spark.read.parquet(written.path)
    assert table.select("_range").distinct().count() <= streams.RANGES
    assert table.count() == bronze.shells().count()
