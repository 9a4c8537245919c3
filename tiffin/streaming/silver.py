"""Bronze events to a silver table that a repeated batch cannot double."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tiffin.functions.clock import seconds_between
from tiffin.operators.slices import first_per_key
from tiffin.sources.keyed import KeyedTable
from tiffin.sources.tables import VersionedTable

APP = "silver_events"
SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("order_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("occurred_at", T.TimestampType()),
    T.StructField("received_at", T.TimestampType()), T.StructField("lag_seconds", T.LongType()),
    T.StructField("_stream_batch_id", T.LongType())])


def table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, SCHEMA, F.to_date("occurred_at"))


def typed(rows: DataFrame) -> DataFrame:
    """Landing text to typed events; both clocks stay."""
    return rows.select(
        F.col("event_id").try_cast("bigint").alias("event_id"),
        F.col("order_id").try_cast("bigint").alias("order_id"),
        F.upper(F.trim("event_type")).alias("event_type"),
        F.col("occurred_at").try_cast("timestamp").alias("occurred_at"),
        F.col("received_at").try_cast("timestamp").alias("received_at")).withColumn(
        "lag_seconds", seconds_between(F.col("occurred_at"), F.col("received_at")))


def upsert_batch(target: VersionedTable, batch: DataFrame, batch_id: int) -> bool:
    """One micro-batch: inserts only, one row per event, skipped when it was already applied.

    Delivery to this function is at least once. The table's log knows the batch number, and the key
    upsert covers events that came in an earlier batch.
    """
    if "_change_type" in batch.columns:
        batch = batch.filter("_change_type = 'insert'")
    rows = typed(batch).withColumn("_stream_batch_id", F.lit(batch_id).cast("bigint"))
    unique = first_per_key(rows, ["event_id"], ["received_at", "occurred_at"])
    return target.upsert(unique, ["event_id"], update=False, app=APP, batch_id=batch_id)


def run(source: DataFrame, target: VersionedTable, checkpoint: str) -> StreamingQuery:
    return (source.writeStream.foreachBatch(lambda df, i: upsert_batch(target, df, i) and None)
            .option("checkpointLocation", checkpoint).outputMode("update")
            .trigger(availableNow=True).start())


def enrich(source: DataFrame, static: KeyedTable, path: str, checkpoint: str) -> StreamingQuery:
    """Typed events with the columns of a static table, as it is when each batch runs.

    The batch says which ranges of the table are read. A batch has its own folder, which a repeated
    delivery writes again.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = typed(batch).persist()
        try:
            static.attach(rows).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            rows.unpersist()
    return (source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def enriched(spark: SparkSession, path: str, schema: str, stream: bool) -> DataFrame:
    """What ``enrich`` wrote, as a table or as the next stream's source."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(schema).option("recursiveFileLookup", "true").parquet(path)
