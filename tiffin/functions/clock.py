"""Time: spans, calendars, payout cycles and local clocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds; NULL when either side is missing."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def open_end(valid_to: Column, kind: str = "timestamp") -> Column:
    return F.coalesce(valid_to, F.lit(OPEN_END).cast(kind))


def date_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")


def payout_cycle(day: Column, anchor_monday: str) -> Column:
    """Cycle 1 starts on the anchor; cycles are seven days."""
    return (F.floor(F.datediff(day, F.lit(anchor_monday).cast("date")) / 7) + 1).cast("int")


def date_spine(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day between two columns of a one-row frame."""
    return bounds.select(F.explode(F.sequence(first, last, F.expr("interval 1 day")))
                         .alias("full_date"))


def wall_clock_hours(start: Column, end: Column, zone: str) -> Column:
    """Difference of the local clocks, which jumps when daylight saving changes."""
    return seconds_between(F.from_utc_timestamp(start, zone),
                           F.from_utc_timestamp(end, zone)) / 3600.0


def elapsed_hours(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / 3600.0

