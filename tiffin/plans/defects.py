"""Known defects: how each gets into clean rows, the test that finds it, and its repair."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.functions import money, text
from tiffin.operators import quality
from tiffin.operators.islands import median_length
from tiffin.operators.slices import POS, SLICE, previous, sliced
from tiffin.plans import events
from tiffin.sources.bronze import NOTES

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Defect:
    """``inject`` damages clean rows, ``violations`` gives the rows that a test rejects, ``repair``
    is what the pipeline does about it."""
    name: str
    table: str
    repaired_by: str
    inject: Step
    violations: Step
    repair: Step


def _set(column: str, when: str, value: str) -> Step:
    return lambda df: df.withColumn(column, F.when(F.expr(when), F.expr(value))
                                    .otherwise(F.col(column)))


def _unreadable(df: DataFrame) -> DataFrame:
    amount = F.col("refund_amount_raw").try_cast("decimal(18,2)")
    return df.filter("refund_amount_raw is not null").filter(amount.isNull())


def _backward(df: DataFrame) -> DataFrame:
    """Steps of a courier's route that go back in time when rows are taken as they are numbered by
    ``route_clock``."""
    placed = sliced(df, ["courier_id", "route_clock", "ping_id"])
    return previous(placed, ["courier_id"], "ping_ts", "_before").drop(SLICE, POS) \
        .filter("ping_ts < _before")


def _again(df: DataFrame) -> DataFrame:
    twice = df.filter("event_id % 20 = 0").withColumn("event_id", F.col("event_id") + 10 ** 12)
    return df.unionByName(twice)


def _closed(df: DataFrame) -> DataFrame:
    return df.withColumn("logout_at", F.coalesce("logout_at", F.timestamp_add(
        "SECOND", median_length(df).cast("int"), "login_at")))


REGISTRY = [
    Defect("text damage", "notes", "stg_orders",
           _set("delivery_notes", "order_id % 25 = 0", "upper(delivery_notes)"),
           lambda df: quality.accepted_values(df, "delivery_notes", NOTES),
           lambda df: df.withColumn("delivery_notes", text.sentence_case(F.col("delivery_notes")))),
    Defect("accounting text", "refunds", "stg_refunds",
           _set("refund_amount_raw", "refund_id % 10 = 0", "concat('(', refund_amount_raw, ')')"),
           _unreadable,
           lambda df: df.withColumn("refund_amount_raw", money.positive_amount(
               F.col("refund_amount_raw")).cast("string"))),
    Defect("out-of-order arrival", "pings", "pings_clean",
           _set("route_clock", "true", "_ingested_at"), _backward,
           _set("route_clock", "true", "ping_ts")),
    Defect("repeated delivery", "events", "events_deduplicated", _again,
           lambda df: quality.unique(df, events.NATURAL_KEY), events.deduplicated),
    Defect("open shift", "shifts", "shifts_merged",
           _set("logout_at", "shift_id % 50 = 0", "null"),
           lambda df: quality.not_null(df, "logout_at"), _closed),
    Defect("low accuracy", "pings", "pings_clean",
           _set("accuracy_m", "ping_id % 40 = 0", "250"),
           lambda df: df.filter("accuracy_m > 100"), events.clean_pings),
    Defect("negative quantity", "lines", "quarantine",
           _set("quantity", "(order_id + line_no) % 30 = 0", "-quantity"),
           lambda df: df.filter("quantity <= 0"), lambda df: df.filter("quantity > 0")),
]


def proofs(clean: dict[str, DataFrame], defects: list[Defect] | None = None) -> DataFrame:
    """One row per defect: what its test finds in clean rows, in damaged ones and in repaired ones.

    A test that cannot fail shows as zero in the second column, a repair that was taken out as more
    than zero in the third.
    """
    def count(df: DataFrame, out: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(out))

    def row(d: Defect) -> DataFrame:
        rows = clean[d.table]
        damaged = d.inject(rows)
        found = count(d.violations(damaged), "found_damaged")
        return found.select(
            F.lit(d.name).alias("defect"), F.lit(d.repaired_by).alias("repaired_by"),
            count(d.violations(rows), "n").scalar().alias("found_clean"), "found_damaged",
            count(d.violations(d.repair(damaged)), "n").scalar().alias("left_after"))
    return reduce(DataFrame.unionByName, [row(d) for d in defects or REGISTRY])
