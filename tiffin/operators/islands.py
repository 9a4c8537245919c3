"""Merging overlapping spans per owner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.functions.clock import elapsed_hours, seconds_between, wall_clock_hours
from tiffin.operators.slices import POS, SLICE, previous, running, sliced


def median_length(shifts: DataFrame) -> Column:
    """The discrete median length of closed shifts as a scalar subquery, exact.

    The aggregate counts per length, on the map side first, so it holds one entry per length that
    occurs and does not grow with the number of shifts.
    """
    length = seconds_between(F.col("login_at"), F.col("logout_at"))
    return (shifts.filter("logout_at is not null").select(length.alias("length"))
            .agg(F.expr("percentile_disc(0.5) within group (order by length)").cast("bigint"))
            ).scalar()


def capped_shifts(shifts: DataFrame) -> DataFrame:
    """Close open shifts at login plus the median length of closed ones (one value, not per row)."""
    return shifts.select(
        "shift_id", "courier_id", F.col("login_at").alias("shift_start"),
        F.coalesce("logout_at", F.timestamp_add("SECOND", median_length(shifts).cast("int"),
                                                "login_at")).alias("shift_end"),
        F.col("logout_at").isNull().alias("was_open"))


def islands(spans: DataFrame, owner: str, start: str, end: str, tie: str) -> DataFrame:
    """Each span with the number of its island; a new one starts after every earlier end."""
    placed = sliced(spans, [owner, start, tie])
    marked = running(placed, [owner], end, "max", "_reach", include_current=False) \
        .withColumn("is_new_island", F.coalesce((F.col(start) > F.col("_reach")).cast("int"),
                                                F.lit(0)))
    return running(marked, [owner], "is_new_island", "sum", "island_id", include_current=True) \
        .drop("_reach", SLICE, POS)


def merged_shifts(shifts: DataFrame, zone: str) -> DataFrame:
    marked = islands(capped_shifts(shifts), "courier_id", "shift_start", "shift_end", "shift_id")
    merged = marked.groupBy("courier_id", "island_id").agg(
        F.min("shift_start").alias("shift_start"), F.max("shift_end").alias("shift_end"),
        F.bool_or("was_open").alias("had_open_shift"))
    start, end = F.col("shift_start"), F.col("shift_end")
    return merged.select(
        "courier_id", "shift_start", "shift_end",
        seconds_between(start, end).alias("worked_seconds"),
        elapsed_hours(start, end).alias("elapsed_hours"),
        wall_clock_hours(start, end, zone).alias("wall_clock_hours"),
        (wall_clock_hours(start, end, zone) != elapsed_hours(start, end)).alias("dst_affected"),
        "had_open_shift")


def overlap_flags(shifts: DataFrame) -> DataFrame:
    """Shifts that start before the previous one of the same courier ended, or never ended."""
    placed = sliced(shifts, ["courier_id", "login_at", "shift_id"])
    return previous(placed, ["courier_id"], "logout_at", "previous_logout").drop(SLICE, POS)
