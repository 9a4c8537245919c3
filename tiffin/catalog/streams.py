"""Queries: streams run to completion; their sink equals the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from tiffin.catalog.oracle import view
from tiffin.catalog.registry import query
from tiffin.plans.events import with_lag
from tiffin.session import scratch
from tiffin.sources import landing
from tiffin.sources.bronze import Bronze
from tiffin.sources.keyed import KeyedTable
from tiffin.streaming import gold, silver
from tiffin.streaming.ingest import BronzeStream
from tiffin.streaming.progress import finish

EVENT_COLUMNS = ["event_id", "order_id", "event_type", "occurred_at", "received_at"]
ALL_AT_ONCE = 100_000  # files per batch: a whole pass is one batch


class Feed:
    """A landing folder that receives the events of the given table in passes."""

    def __init__(self, b: Bronze, name: str, kind: str = "json"):
        self.b, self.kind = b, kind
        root = scratch(b.spark, name)
        self.landing, self.root = f"{root}/landing", f"{root}/bronze"
        self.events = b.order_events()

    def drop(self, index: int, condition: str) -> None:
        landing.write_shard(self.events.filter(condition), self.landing, index, self.kind)

    def bronze(self, max_files: int = ALL_AT_ONCE) -> BronzeStream:
        return BronzeStream(self.b.spark, self.landing, self.root, EVENT_COLUMNS, self.kind,
                            max_files)


# Three passes in order of arrival; together they hold every event.
PASSES = ["received_at < timestamp'2024-01-10 00:00:00'",
          "received_at >= timestamp'2024-01-10 00:00:00' "
          "and received_at < timestamp'2024-01-20 00:00:00'",
          "received_at >= timestamp'2024-01-20 00:00:00'"]


def _ingested(b: Bronze, name: str):
    """All passes ingested, then one run that finds nothing."""
    feed = Feed(b, name)
    stream, added = feed.bronze(), []
    for i, condition in enumerate(PASSES):
        feed.drop(i, condition)
        added.append(stream.ingest_once(f"run-{i}"))
    added.append(stream.ingest_once("run-3"))
    return stream, added


@query("t01_incremental_ingest", """select event_id, order_id, event_type, occurred_at, case
 when received_at < timestamp '2024-01-10' then 'run-0' when received_at < timestamp '2024-01-20'
 then 'run-1' else 'run-2' end as batch from b_events""")
def t01(b: Bronze):
    stream, _ = _ingested(b, "t01")
    return stream.read().select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("order_id").cast("bigint").alias("order_id"), "event_type",
        F.col("occurred_at").cast("timestamp").alias("occurred_at"),
        F.col("_bronze_batch_id").alias("batch"))


@query("t02_exactly_once_files", """select case when received_at < timestamp '2024-01-10' then 'run-0'
 when received_at < timestamp '2024-01-20' then 'run-1' else 'run-2' end as batch, count(*) as n_rows,
 cast(0 as bigint) as n_files_twice from b_events group by 1""")
def t02(b: Bronze):
    """Rows per run, and files that appear under more than one run (none)."""
    rows = _ingested(b, "t02")[0].read()
    per_file = rows.groupBy("_bronze_source_file").agg(
        F.count_distinct("_bronze_batch_id").alias("n"), F.min("_bronze_batch_id").alias("batch"),
        F.count(F.lit(1)).alias("rows"))
    return per_file.groupBy("batch").agg(F.sum("rows").alias("n_rows"),
                                         F.count_if(F.col("n") > 1).alias("n_files_twice"))


@query("t12_rows_added", """select 'run-0' as run, count(*) as added from b_events
 where received_at < timestamp '2024-01-10'
union all select 'run-1', count(*) from b_events where received_at >= timestamp '2024-01-10'
 and received_at < timestamp '2024-01-20'
union all select 'run-2', count(*) from b_events where received_at >= timestamp '2024-01-20'
union all select 'run-3', count(*) from b_events where received_at is null""")
def t12(b: Bronze):
    """Table deltas of each run; the last one found nothing."""
    added = _ingested(b, "t12")[1]
    return b.spark.createDataFrame([(f"run-{i}", n) for i, n in enumerate(added)],
                                   "run string, added bigint")


_RESCUE = """select o_orderkey as order_id, o_custkey as customer_id,
 o_orderdate >= timestamp '1998-01-01' as was_rescued from orders"""


def rescued_orders(b: Bronze, kind: str):
    """Landed orders, and which of them came with a column that the table does not have."""
    root = scratch(b.spark, f"t03-{kind}")
    rows = b.raw("orders", "o_orderkey", "o_custkey", "o_orderdate").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.lit("GOLD").alias("loyalty_tier"),
        (F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).alias("wide"))
    landing.write_shard(rows.filter("not wide").drop("loyalty_tier", "wide"), f"{root}/landing", 0,
                        kind)
    landing.write_shard(rows.filter("wide").drop("wide"), f"{root}/landing", 1, kind)
    stream = BronzeStream(b.spark, f"{root}/landing", f"{root}/bronze",
                          ["order_id", "customer_id"], kind)
    stream.ingest_once("only")
    return stream.read().select(
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        F.col(landing.RESCUED).isNotNull().alias("was_rescued"))


@query("t03_rescue_json", _RESCUE)
def t03_json(b: Bronze):
    """A source that grew a column: the rows stay, the lines are kept for inspection."""
    return rescued_orders(b, "json")


@query("t03_rescue_csv", _RESCUE)
def t03_csv(b: Bronze):
    return rescued_orders(b, "csv")


@query("t04_continuous_ingest", "select event_id, event_type from b_events")
def t04(b: Bronze):
    """The unending query, stopped once it has caught up."""
    feed = Feed(b, "t04")
    feed.drop(0, "event_id is not null")
    stream = feed.bronze(max_files=2)
    running = stream.start("continuous", "0 seconds")
    running.processAllAvailable()
    running.stop()
    return stream.read().select(F.col("event_id").cast("bigint").alias("event_id"), "event_type")


@query("s08_file_stream", "select event_id, order_id from b_events")
def s08(b: Bronze):
    """Nested CSV folders, few files per batch, frozen schema."""
    feed = Feed(b, "s08", kind="csv")
    for i, condition in enumerate(PASSES):
        feed.drop(i, condition)
    stream = feed.bronze(max_files=4)
    stream.ingest_once("all")
    return stream.read().select(F.col("event_id").cast("bigint").alias("event_id"),
                                F.col("order_id").cast("bigint").alias("order_id"))


_SILVER = "select event_id, order_id, event_type, occurred_at, lag_seconds from m_lagged"
_COLUMNS = ["event_id", "order_id", "event_type", "occurred_at", "lag_seconds"]


@query("t05_change_feed_to_silver", _SILVER)
def t05(b: Bronze):
    """Landing to bronze to silver in three passes; every pass delivers one day again."""
    feed = Feed(b, "t05")
    bronze = feed.bronze()
    target = silver.table(b.spark, f"{feed.root}/silver")
    again = "received_at >= timestamp'2024-01-09 00:00:00' and received_at < " \
            "timestamp'2024-01-10 00:00:00'"
    for i, condition in enumerate(PASSES):
        feed.drop(i, f"({condition}) or ({again})")
        bronze.ingest_once(f"run-{i}")
        source = (b.spark.readStream.schema(bronze.schema()).parquet(bronze.path)
                  .withColumn("_change_type", F.lit("insert")))
        silver.run(source, target, f"{feed.root}/silver_checkpoint").awaitTermination()
    return target.read().select(*_COLUMNS)


@query("t09_replayed_batch", _SILVER)
def t09(b: Bronze):
    """The same batch number delivered three times."""
    target = silver.table(b.spark, scratch(b.spark, "t09"))
    for _ in range(3):
        silver.upsert_batch(target, b.order_events(), 7)
    return target.read().select(*_COLUMNS)


@query("t10_duplicates_in_batch", _SILVER)
def t10(b: Bronze):
    """A batch that holds every event twice, the second time with a later arrival."""
    target = silver.table(b.spark, scratch(b.spark, "t10"))
    events = b.order_events()
    later = events.withColumn("received_at", F.timestamp_add("SECOND", F.lit(4), "received_at"))
    silver.upsert_batch(target, events.unionByName(later), 1)
    return target.read().select(*_COLUMNS)


view("m_windows", """select time_bucket(interval 5 minutes, occurred_at) as window_start,
 time_bucket(interval 5 minutes, occurred_at) + interval 5 minutes as window_end, zone_id,
 event_type, count(*) as n_events,
 cast(sum(case when lag_seconds > 72000 then 1 else 0 end) as bigint) as n_late_events,
 max(lag_seconds) as max_lag_seconds
from m_lagged e left join b_shells o on o.order_id = e.order_id group by 1, 2, 3, 4""")
_WINDOW_COLUMNS = ["window_start", "window_end", "zone_id", "event_type", "n_events",
                   "n_late_events", "max_lag_seconds"]


SPAN = 4096  # order ids per range of the lookup table at least
RANGES = 64  # ranges at most: each is a folder that a batch lists and opens
ENRICHED = ("event_id long, order_id long, event_type string, occurred_at timestamp, "
            "received_at timestamp, lag_seconds long, zone_id long")


def _order_zones(b: Bronze, root: str) -> KeyedTable:
    top = b.raw("orders").agg(F.max("o_orderkey")).first()[0] or 0
    return KeyedTable(b.spark, f"{root}/order_zones", "order_id", max(SPAN, top // RANGES + 1)).write(
        b.shells().select("order_id", F.col("zone_id").cast("long").alias("zone_id")))


def _enriched(b: Bronze, feed: Feed, zones: KeyedTable, stream: bool):
    """What landed so far, each batch with the zones of its orders."""
    path = f"{feed.root}/enriched"
    silver.enrich(feed.bronze().source(), zones, path, f"{feed.root}/enriched_checkpoint") \
        .awaitTermination()
    return silver.enriched(b.spark, path, ENRICHED, stream)


def _windows(b: Bronze, name: str, passes: list[str], watermark: str):
    feed = Feed(b, name)
    target = gold.table(b.spark, f"{feed.root}/gold")
    zones = _order_zones(b, feed.root)
    for i, condition in enumerate(passes):
        feed.drop(i, condition)
        counts = gold.windowed(_enriched(b, feed, zones, True), None, watermark, 72_000)
        gold.run_to_end(counts, target, f"{feed.root}/gold_checkpoint")
    return target.read().select(*_WINDOW_COLUMNS)


@query("t06_windowed_counts", "select * from m_windows")
def t06(b: Bronze):
    """Events in order of arrival under a watermark above their measured lag: nothing is dropped."""
    return _windows(b, "t06", ["received_at < timestamp'2024-01-15 00:00:00'",
                               "received_at >= timestamp'2024-01-15 00:00:00'"],
                    gold.watermark_for(with_lag(b.order_events())))


@query("t11_revised_windows", "select * from m_windows")
def t11(b: Bronze):
    """Every window is revised: the second pass brings the other half of the same time span."""
    return _windows(b, "t11", ["event_id % 4 < 2", "event_id % 4 >= 2"], "60 days")


@query("t07_measured_watermark", """select max(lag_seconds) as max_lag_seconds,
 cast(ceil(max(lag_seconds) / 3600.0) + 1 as bigint) as watermark_hours from m_lagged""")
def t07(b: Bronze):
    return gold.measured_lag(with_lag(b.order_events()))


@query("t08_late_rows_counted", """select event_type, cast(occurred_at as date) as day,
 count(*) as n_events, cast(sum(case when lag_seconds > 36000 then 1 else 0 end) as bigint)
 as n_late_events from m_lagged group by 1, 2""")
def t08(b: Bronze):
    """Late rows per day and type in a stream without watermark, so that none can be dropped; the
    state is one row per day and type."""
    feed = Feed(b, "t08")
    for i, condition in enumerate(PASSES):
        feed.drop(i, condition)
    events = silver.typed(feed.bronze().source())
    counts = events.groupBy("event_type", F.to_date("occurred_at").alias("day")).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum((F.col("lag_seconds") > 36_000).cast("bigint")).alias("n_late_events"))
    from tiffin.sources.tables import VersionedTable
    target = VersionedTable(b.spark, f"{feed.root}/late", counts.schema, None)

    def write(df, batch_id):
        target.upsert(df, ["event_type", "day"], app="late", batch_id=batch_id)
    (counts.writeStream.foreachBatch(write).outputMode("update")
     .option("checkpointLocation", f"{feed.root}/late_checkpoint").trigger(availableNow=True)
     .start().awaitTermination())
    return target.read()


_SHORT = 2  # hours of a watermark that is shorter than the lag


@query("t08_rows_dropped", f"""with a as (select *, received_at >= timestamp '2024-01-15' as second
 from b_events), w as (select max(occurred_at) - interval {_SHORT} hours as mark from a
 where not second)
select cast(second as integer) as run, count(*) as rows_in,
 count(*) filter (where second and occurred_at <= mark) as rows_dropped,
 count(*) filter (where not (second and occurred_at <= mark)) as rows_kept
from a, w group by second""")
def t08_dropped(b: Bronze):
    """A watermark that is too short: what each run read and dropped by its own progress, and what
    arrived. The newest event of the first run sets the mark for the second."""
    feed = Feed(b, "t08d")
    path, out = f"{feed.root}/timely", []
    for i, condition in enumerate(["received_at < timestamp'2024-01-15 00:00:00'",
                                   "received_at >= timestamp'2024-01-15 00:00:00'"]):
        feed.drop(i, condition)
        kept = gold.timely(silver.typed(feed.bronze().source()), f"{_SHORT} hours")
        done = finish(kept.withColumn("run", F.lit(i)).writeStream.format("parquet")
                      .option("path", path).option("checkpointLocation", f"{path}_checkpoint")
                      .trigger(availableNow=True).start())
        out.append((i, done.rows_in, done.rows_dropped))
    arrived = b.spark.read.schema("event_id long, run int").parquet(path).groupBy("run").agg(
        F.count(F.lit(1)).alias("rows_kept"))
    return b.spark.createDataFrame(out, "run int, rows_in long, rows_dropped long").join(
        arrived, "run")


@query("j11_stream_static_join", """select e.event_id, e.event_type, o.zone_id from b_events e
 left join b_shells o on o.order_id = e.order_id""")
def j11(b: Bronze):
    """Events joined to the orders as they are when each batch runs; a batch reads the ranges of
    its own keys."""
    feed = Feed(b, "j11")
    feed.drop(0, "event_id is not null")
    joined = _enriched(b, feed, _order_zones(b, feed.root), False)
    return joined.select("event_id", "event_type", "zone_id")
