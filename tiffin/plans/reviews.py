"""Reviews with two independent truths, tickets, evaluation, enrichment tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.functions.draws import Draw, xx_draw
from tiffin.functions.text import damaged, outcome_class

CLASSES = ["positive", "neutral", "negative"]


def _happened(outcomes: DataFrame) -> DataFrame:
    return outcomes.select("order_id", "refunded", "delivered", outcome_class(
        F.col("delivered"), F.col("late_minutes"), F.col("refunded"), F.col("rating"))
        .alias("outcome_class"))


def labelled(texts: DataFrame, truth: DataFrame, outcomes: DataFrame, draw: Draw = xx_draw,
             seed: int = 1) -> DataFrame:
    """Review texts with what they say (``truth``, from people) and what measurably happened
    (``outcomes``, from facts); the two know nothing of each other. Some texts are damaged."""
    key = F.col("review_id")
    known = truth.select("review_id", "text_sentiment", "ambiguous")
    rows = texts.select("review_id", "order_id", "review_text").join(known, "review_id") \
        .join(_happened(outcomes), "order_id")
    return rows.select(
        "review_id", "order_id",
        damaged(F.col("review_text"), draw(seed + 5, key) % 25).alias("review_text"),
        "text_sentiment", "outcome_class",
        (F.col("text_sentiment") == F.col("outcome_class")).alias("agrees"), "ambiguous",
        "refunded", "delivered")


def tickets(openings: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Support tickets exist only where money went back or nothing arrived; ``openings`` has the
    first thing a customer wrote."""
    prefix = F.when(F.col("refunded"), "REFUND REQUEST: ").otherwise("ISSUE: ")
    return openings.join(_happened(outcomes), "order_id").filter("refunded or not delivered").select(
        "ticket_id", "order_id", F.concat(prefix, F.trim("text")).alias("ticket_text"),
        "outcome_class")


def confusion(scored: DataFrame) -> DataFrame:
    """Counts per (truth, prediction, ambiguous): 18 rows at most, whatever the volume."""
    return scored.groupBy("y", "yhat", "ambiguous").agg(F.count(F.lit(1)).alias("n"))


def scores(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, and macro F1, accuracy and the majority share,
    for all reviews and for the clear and the ambiguous ones."""
    counts = confusion(scored).withColumn("subset", F.explode(F.array(
        F.lit("all"), F.when(F.col("ambiguous"), "ambiguous").otherwise("clear"))))

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    y, p = F.col("y"), F.col("yhat")
    aggs = [F.sum("n").alias("n"), total(y == p).alias("correct")]
    for c in CLASSES:
        aggs += [total((y == c) & (p == c)).alias(f"tp_{c}"), total(p == c).alias(f"p_{c}"),
                 total(y == c).alias(f"y_{c}")]
    wide = counts.groupBy("subset").agg(*aggs)

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))

    for c in CLASSES:
        wide = (wide.withColumn(f"precision_{c}", ratio(F.col(f"tp_{c}"), F.col(f"p_{c}")))
                .withColumn(f"recall_{c}", ratio(F.col(f"tp_{c}"), F.col(f"y_{c}")))
                .withColumn(f"f1_{c}", ratio(2 * F.col(f"precision_{c}") * F.col(f"recall_{c}"),
                                             F.col(f"precision_{c}") + F.col(f"recall_{c}")))
                .withColumn(f"support_{c}", F.col(f"y_{c}").cast("double")))
    wide = (wide.withColumn("macro_f1", sum((F.col(f"f1_{c}") for c in CLASSES), F.lit(0.0)) / 3)
            .withColumn("accuracy", F.col("correct") / F.col("n"))
            .withColumn("majority_accuracy", F.greatest(*[F.col(f"y_{c}") for c in CLASSES])
                        / F.col("n")))
    names = [f"{m}_{c}" for c in CLASSES for m in ("precision", "recall", "f1", "support")]
    names += ["macro_f1", "accuracy", "majority_accuracy"]
    return wide.unpivot(["subset"], names, "metric", "value").withColumn(
        "value", F.round("value", 4))


def pending(items: DataFrame, done: DataFrame, key: str, **version: str) -> DataFrame:
    """Items with no result yet for exactly this model version."""
    current = done
    for col, value in version.items():
        current = current.filter(F.col(col) == value)
    return items.join(current.select(key), key, "left_anti")
