"""A lookup table in ranges of its key, of which a batch reads only the ranges it needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPAN = 1_000_000  # keys per range; a range is a folder, so its files hold at most as many rows
RANGE = "_range"


class KeyedTable:
    """One row per whole-number key.

    Keys given in order of time stay together, so a batch of recent rows reads recent ranges and
    the bytes read follow the batch, not the table. A batch that touches every range reads all.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, span: int = SPAN):
        self.spark, self.path, self.key, self.span = spark, path.rstrip("/"), key, span

    def write(self, rows: DataFrame) -> KeyedTable:
        ranged = rows.withColumn(RANGE, F.floor(F.col(self.key) / F.lit(self.span)))
        (ranged.filter(F.col(self.key).isNotNull()).repartition(RANGE)
         .sortWithinPartitions(RANGE, self.key).write.mode("overwrite").partitionBy(RANGE)
         .parquet(self.path))
        return self

    def near(self, batch: DataFrame) -> DataFrame:
        """The table's rows in the batch's ranges and between its smallest and largest key: a
        partition filter, and a pushed filter inside. Range numbers are folders of the table, and
        those of the batch are listed on the driver."""
        asked = batch.agg(F.collect_set(F.floor(F.col(self.key) / F.lit(self.span))).alias("r"),
                          F.min(self.key).alias("lo"), F.max(self.key).alias("hi")).first()
        table = self.spark.read.parquet(self.path)
        inside = F.lit(False) if not asked["r"] else (
            F.col(RANGE).isin(asked["r"]) & F.col(self.key).between(asked["lo"], asked["hi"]))
        return table.filter(inside).drop(RANGE)

    def attach(self, batch: DataFrame) -> DataFrame:
        """Left join; rows without a match keep NULLs. ``batch`` is read twice: persist it."""
        return batch.join(self.near(batch), self.key, "left")
