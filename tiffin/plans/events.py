"""Order events, couriers and pings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.functions.clock import seconds_between
from tiffin.operators.quality import first_reason
from tiffin.operators.skew import attach
from tiffin.operators.slices import POS, SLICE, first_per_key, previous, sliced

NATURAL_KEY = ["order_id", "event_type", "occurred_at"]

# Which event marks which step of an order.
STEPS = {"placed_at": "SIGNUP", "matched_at": "CLICK", "picked_up_at": "VIEW",
         "delivered_at": "PURCHASE", "cancelled_at": "ERROR"}


def deduplicated(events: DataFrame) -> DataFrame:
    """One event per natural key: the first that arrived."""
    return first_per_key(events, NATURAL_KEY, ["received_at", "event_id"])


def flagged_events(events: DataFrame) -> DataFrame:
    """Later deliveries of an event carry DUP_EVENT although their id differs.

    The first delivery of each key is folded per salt, so a key with very many copies neither sits
    in one task nor is ranked in a window.
    """
    arrival = F.struct("received_at", "event_id")
    found = attach(events, NATURAL_KEY, _first=("min", arrival))
    return found.withColumn("reason_code", first_reason(
        (F.col("event_id") != F.col("_first.event_id"), "DUP_EVENT"))).drop("_first")


def lifecycle(events: DataFrame) -> DataFrame:
    """First time of every step and the step that came last, one row per order."""
    steps = [F.min(F.when(F.col("event_type") == t, F.col("occurred_at"))).alias(c)
             for c, t in STEPS.items()]
    return events.groupBy("order_id").agg(
        *steps, F.max(F.struct("occurred_at", "event_id", "event_type"))["event_type"]
        .alias("terminal_state"))


def with_lag(events: DataFrame) -> DataFrame:
    return events.withColumn("lag_seconds", seconds_between(F.col("occurred_at"),
                                                            F.col("received_at")))


def unioned(batch: DataFrame, streamed: DataFrame | None) -> DataFrame:
    """Both arrival paths, one row per natural key, the batch row first; either may be absent."""
    arms = [batch.withColumn("_arrival_path", F.lit("batch"))]
    if streamed is not None:
        arms.append(streamed.withColumn("_arrival_path", F.lit("stream")))
    both = arms[0] if len(arms) == 1 else arms[0].unionByName(arms[1])
    return first_per_key(both, NATURAL_KEY, ["_arrival_path", "received_at", "event_id"])


def clean_pings(pings: DataFrame, max_accuracy: float = 100.0) -> DataFrame:
    """Usable pings in event order with both lags; a ping is out of order when it arrived before
    the ping that precedes it in event time."""
    good = pings.filter(F.col("accuracy_m") <= max_accuracy)
    placed = sliced(good, ["courier_id", "ping_ts", "ping_id"])
    arrived = previous(placed, ["courier_id"], "_ingested_at", "_prev").drop(SLICE, POS)
    return arrived.select(
        "ping_id", "courier_id", "order_id", "ping_ts", "lat", "lon", "accuracy_m",
        F.col("_ingested_at").alias("device_received_at"),
        seconds_between(F.col("ping_ts"), F.col("_ingested_at")).alias("device_lag_seconds"),
        F.coalesce(F.col("_ingested_at") < F.col("_prev"), F.lit(False)).alias("out_of_order"))
