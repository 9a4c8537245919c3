"""Windowed event counts as a stream, with late rows counted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tiffin.sources.tables import VersionedTable
from tiffin.streaming.progress import Run, finish

WINDOW = "5 minutes"
MARGIN_HOURS = 1
KEYS = ["window_start", "zone_id", "event_type"]
SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampType()), T.StructField("window_end", T.TimestampType()),
    T.StructField("window_date", T.DateType()), T.StructField("zone_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("n_events", T.LongType()),
    T.StructField("n_late_events", T.LongType()), T.StructField("n_orders_approx", T.LongType()),
    T.StructField("max_lag_seconds", T.LongType())])


def measured_lag(events: DataFrame) -> DataFrame:
    """The largest lag of the data and the watermark that keeps every row: lag plus a margin."""
    return events.agg(F.max("lag_seconds").alias("max_lag_seconds")).withColumn(
        "watermark_hours",
        (F.ceil(F.col("max_lag_seconds") / 3600) + MARGIN_HOURS).cast("bigint"))


def watermark_for(events: DataFrame) -> str:
    """The watermark that keeps every row of such data: a function of its measured lag."""
    return f"{measured_lag(events).first()['watermark_hours'] or MARGIN_HOURS} hours"


def timely(events: DataFrame, watermark: str) -> DataFrame:
    """Each event once, without those behind the watermark.

    Every row reaches the state as it came, so the progress of this stream counts dropped rows
    exactly; an aggregation would count groups. The state holds the events within the watermark.
    """
    return events.withWatermark("occurred_at", watermark).dropDuplicates(
        ["event_id", "occurred_at"])


def windowed(events: DataFrame, zones: DataFrame | None, watermark: str, late_after: int
             ) -> DataFrame:
    """Counts per window, zone and type.

    ``zones`` (order_id, zone_id) is a small static table that is read whole in every batch; None
    if the events carry their zone (``silver.enrich`` looks it up for the keys of a batch). A row is
    late by its own arrival lag, measured before the watermark can drop it.
    """
    timed = events.withWatermark("occurred_at", watermark)
    joined = timed if zones is None else timed.join(zones, "order_id", "left")
    late = (F.col("lag_seconds") > late_after).cast("bigint")
    grouped = joined.groupBy(F.window("occurred_at", WINDOW), "zone_id", "event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum(late).alias("n_late_events"),
        F.approx_count_distinct("order_id").alias("n_orders_approx"),
        F.max("lag_seconds").alias("max_lag_seconds"))
    return grouped.select(F.col("window.start").alias("window_start"),
                          F.col("window.end").alias("window_end"),
                          F.to_date("window.start").alias("window_date"), "zone_id", "event_type",
                          "n_events", "n_late_events", "n_orders_approx", "max_lag_seconds")


def table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, SCHEMA, F.to_date("window_start"))


def run(counts: DataFrame, target: VersionedTable, checkpoint: str) -> StreamingQuery:
    """Update mode: only changed windows are sent, and each replaces its earlier row."""
    def write(df: DataFrame, batch_id: int) -> None:
        target.upsert(df, KEYS, app="gold_windows", batch_id=batch_id)
    return (counts.writeStream.foreachBatch(write).outputMode("update")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def run_to_end(counts: DataFrame, target: VersionedTable, checkpoint: str) -> Run:
    """As ``run``, and wait; gives the rows read and dropped over all batches."""
    return finish(run(counts, target, checkpoint))
