"""Demand per day and hour: as observed in the orders, and as planned from factors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.functions.draws import Draw, lognormal, uniform, xx_draw
from tiffin.operators.allocate import largest_remainder
from tiffin.sources.bronze import Bronze

# Day-of-week weights (Monday first) and hour weights (index 0 = midnight).
DOW_WEIGHTS = [0.85, 0.82, 0.90, 1.10, 1.35, 1.45, 1.20]
HOUR_WEEKDAY = ["0.02", "0.01", "0.01", "0.005", "0.005", "0.01", "0.03", "0.05", "0.08", "0.06",
                "0.05", "0.15", "0.20", "0.12", "0.08", "0.06", "0.08", "0.12", "0.22", "0.25",
                "0.18", "0.12", "0.08", "0.05"]
HOUR_WEEKEND = ["0.04", "0.03", "0.02", "0.01", "0.01", "0.01", "0.02", "0.03", "0.05", "0.07",
                "0.10", "0.14", "0.16", "0.14", "0.10", "0.08", "0.09", "0.12", "0.18", "0.22",
                "0.24", "0.16", "0.10", "0.07"]
SHOULDER_BEFORE, SHOULDER_AFTER = 0.30, 0.50
NOISE_SIGMA = 0.08

# Events (name, position in the window, peak multiplier).
EVENTS = [("sports_final", 0.13, 1.80), ("storm", 0.38, 1.45), ("festival", 0.66, 2.10),
          ("long_weekend", 0.87, 1.30)]


def monday_first(day: Column) -> Column:
    """0 = Monday."""
    return F.weekday(day).cast("int")


def dow_multiplier(day: Column) -> Column:
    mean = sum(DOW_WEIGHTS) / 7
    return F.element_at(F.array(*[F.lit(w / mean) for w in DOW_WEIGHTS]), monday_first(day) + 1)


def _days(b: Bronze) -> DataFrame:
    return b.raw("orders", "o_orderkey", "o_orderdate").select(
        F.col("o_orderkey").alias("order_id"), F.to_date("o_orderdate").alias("order_date"))


def _first_day(b: Bronze) -> Column:
    return _days(b).agg(F.min("order_date")).scalar()


def actual_daily(b: Bronze) -> DataFrame:
    """Orders per day as a demand table with neutral event and noise factors."""
    counts = _days(b).groupBy("order_date").agg(F.count(F.lit(1)).cast("int").alias("orders"))
    day = F.col("order_date")
    return counts.select(
        F.datediff(day, _first_day(b)).alias("day_index"), "order_date",
        monday_first(day).alias("weekday"), dow_multiplier(day).alias("dow_multiplier"),
        F.lit(1.0).alias("event_multiplier"), F.lit(1.0).alias("noise"),
        dow_multiplier(day).alias("total_multiplier"), "orders",
        F.lit(None).cast("string").alias("event_names"))


def actual_hourly(b: Bronze) -> DataFrame:
    """Orders per (day, hour) of their placement."""
    hour = F.hour(F.expr("timestampadd(SECOND, cast(order_id * 7919 % 86400 as int), "
                         "cast(order_date as timestamp))"))
    return (_days(b).groupBy("order_date", hour.alias("hour"))
            .agg(F.count(F.lit(1)).cast("int").alias("orders"))
            .select(F.datediff("order_date", _first_day(b)).alias("day_index"), "order_date",
                    "hour", "orders"))


# -- planned demand ------------------------------------------------------------------------


def resolved_events(spine: DataFrame, n_days: int) -> DataFrame:
    """Events that land in a window of ``n_days``; of two on one day the first stays."""
    wanted = max(1, round(n_days / 90 * len(EVENTS)))
    by_day: dict[int, tuple] = {}
    for name, position, peak in EVENTS[:wanted]:
        by_day.setdefault(round(position * (n_days - 1)), (name, peak))
    return spine.sparkSession.createDataFrame(
        [(d, n, p) for d, (n, p) in by_day.items()], "event_day int, event_name string, peak double")


def planned_daily(spine: DataFrame, n_days: int, per_day: int, draw: Draw = xx_draw,
                  seed: int = 1) -> DataFrame:
    """Factors and the order count of every day of a ``(day_index, order_date)`` spine.

    Noise is keyed on the date itself, so a window generated alone equals the same days of a long
    run. Events touch their day fully and the neighbours by a share.
    """
    events = resolved_events(spine, n_days)
    share = F.explode(F.array(
        F.struct(F.lit(-1).alias("at"), F.lit(SHOULDER_BEFORE).alias("share")),
        F.struct(F.lit(0).alias("at"), F.lit(1.0).alias("share")),
        F.struct(F.lit(1).alias("at"), F.lit(SHOULDER_AFTER).alias("share"))))
    touched = (events.withColumn("s", share)
               .select((F.col("event_day") + F.col("s.at")).alias("day_index"), "event_day",
                       "event_name", (1 + (F.col("peak") - 1) * F.col("s.share")).alias("boost"))
               .groupBy("day_index").agg(
                   F.product("boost").alias("event_multiplier"),
                   F.concat_ws(",", F.transform(
                       F.sort_array(F.collect_list(F.struct("event_day", "event_name"))),
                       lambda e: e["event_name"])).alias("event_names")))
    day = F.col("order_date")
    noise = lognormal(uniform(draw(seed, F.col("order_date"))),
                      uniform(draw(seed + 1, F.col("order_date"))), NOISE_SIGMA)
    factors = (spine.join(F.broadcast(touched), "day_index", "left")  # at most 3 rows per event
               .withColumn("weekday", monday_first(day))
               .withColumn("dow_multiplier", dow_multiplier(day))
               .withColumn("event_multiplier", F.coalesce("event_multiplier", F.lit(1.0)))
               .withColumn("noise", noise)
               .withColumn("total_multiplier", F.col("dow_multiplier") * F.col("event_multiplier")
                           * F.col("noise")))
    orders = F.greatest(F.lit(1), F.round(F.lit(per_day) * F.col("total_multiplier")).cast("int"))
    return factors.withColumn("orders", orders).select(
        "day_index", "order_date", "weekday", "dow_multiplier", "event_multiplier", "noise",
        "total_multiplier", "orders", "event_names")


def hour_weights(daily: DataFrame) -> DataFrame:
    """24 rows per day with the weight of each hour."""
    def table(values: list[str]) -> Column:
        return F.array(*[F.lit(v).cast("decimal(18,4)") for v in values])
    weights = F.when(F.weekday("order_date") >= 5, table(HOUR_WEEKEND)).otherwise(
        table(HOUR_WEEKDAY))
    return daily.select("day_index", "order_date", F.col("orders").alias("day_orders"),
                        F.posexplode(weights).alias("hour", "hour_weight"))


def planned_hourly(daily: DataFrame) -> DataFrame:
    """Split each day over its hours so that the hours sum to the day exactly."""
    split = largest_remainder(hour_weights(daily), ["day_index"], "day_orders", "hour_weight",
                              "hour", "orders", places=0)
    return split.select("day_index", "order_date", "hour", F.col("orders").cast("int").alias("orders"))
