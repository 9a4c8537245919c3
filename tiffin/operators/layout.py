"""Physical layouts of one table and the bytes each lets a query skip."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.operators import measure


def compacted(df: DataFrame, path: str, files: int) -> None:
    df.repartition(files).write.mode("overwrite").parquet(path)


def partitioned(df: DataFrame, path: str, by: str) -> None:
    """Rebalance keeps one file or few per value and splits a value that is too large."""
    (df.hint("rebalance", F.col(by)).write.mode("overwrite").partitionBy(by).parquet(path))


def clustered(df: DataFrame, path: str, cols: list[str], files: int) -> None:
    """Range-clustered files, sorted inside, so that min/max skip most of them. A salt after the
    cluster columns lets a value that holds a large share spread over several files; it is a hash of
    the row, so the table should have a unique column."""
    salt = F.xxhash64(*df.columns)
    (df.repartitionByRange(files, *[F.col(c) for c in cols], salt).sortWithinPartitions(*cols)
     .write.mode("overwrite").parquet(path))


def quantile_code(df: DataFrame, col: str, bits: int = 8, error: float = 0.001) -> Column:
    """The quantile bucket of a numeric column; the cut points are at most 2^bits numbers."""
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = sorted(set(df.approxQuantile(col, steps, error)))
    points = F.array(*[F.lit(float(c)) for c in cuts])
    return F.size(F.filter(points, lambda p: p < F.col(col))).cast("bigint")


def morton(codes: list[Column], bits: int = 8) -> Column:
    """Interleave the bits of several bucket codes into one key."""
    width = len(codes)
    pieces = [
        F.shiftleft(F.shiftright(code, b).bitwiseAND(F.lit(1).cast("bigint")), b * width + i)
        for b in range(bits) for i, code in enumerate(codes)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), pieces)


def z_ordered(df: DataFrame, path: str, cols: list[str], files: int, bits: int = 8) -> None:
    keyed = df.withColumn("_z", morton([quantile_code(df, c, bits) for c in cols], bits))
    salt = F.xxhash64(*df.columns)
    (keyed.repartitionByRange(files, "_z", salt).sortWithinPartitions("_z").drop("_z")
     .write.mode("overwrite").parquet(path))


def fanned_out(df: DataFrame, copies: int, strides: dict[str, int], clock: str) -> DataFrame:
    """A larger corpus: every copy is shifted by whole days and its fact ids by a stride, while
    dimension keys stay as they are."""
    out = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    for col, stride in strides.items():
        out = out.withColumn(col, F.col(col) + F.col("_copy") * F.lit(stride).cast("bigint"))
    return out.withColumn(clock, F.timestamp_add("DAY", F.col("_copy"), F.col(clock))).drop("_copy")


def surviving(spark: SparkSession, path: str, name: str, cols: list[str],
              predicates: dict[str, Column]) -> DataFrame:
    """Bytes per query that min/max statistics cannot skip.

    One pass gives the bounds of the filtered columns per file; a predicate over ``<col>_min`` and
    ``<col>_max`` says whether a file may hold a match.
    """
    bounds = (spark.read.parquet(path)
              .groupBy(F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_size").alias("size"))
              .agg(*[f(c).alias(f"{c}_{s}") for c in cols for f, s in ((F.min, "min"),
                                                                      (F.max, "max"))]))
    totals = bounds.agg(*[F.sum(F.when(p, F.col("size")).otherwise(0)).alias(q)
                          for q, p in predicates.items()])
    return totals.unpivot([], list(predicates), "query_name", "bytes_scanned") \
        .select(F.lit(name).alias("layout"), "query_name", "bytes_scanned")


def winner(results: DataFrame) -> DataFrame:
    """The layout with the fewest bytes among those with no missing measurement."""
    totals = results.groupBy("layout").agg(
        F.count(F.lit(1)).alias("n"), F.count("bytes_scanned").alias("n_known"),
        F.sum("bytes_scanned").alias("total_bytes"))
    return (totals.filter("n = n_known").select("layout", "total_bytes")
            .orderBy("total_bytes", "layout").limit(1))


def summary(results: DataFrame) -> DataFrame:
    return results.groupBy("layout").agg(
        F.sum("duration_ms").alias("total_duration_ms"),
        F.sum(F.coalesce("bytes_scanned", F.lit(0))).alias("total_bytes_scanned"),
        F.sum(F.col("bytes_scanned").isNull().cast("bigint")).alias("missing"))


def duration_note(results: DataFrame) -> DataFrame:
    """One row when the fastest layout is not the one that reads least."""
    fastest = (summary(results).orderBy("total_duration_ms", "layout").limit(1)
               .select(F.col("layout").alias("fastest")))
    best = winner(results).select(F.col("layout").alias("fewest_bytes"))
    return fastest.withColumn("fewest_bytes", best.scalar()).filter("fastest <> fewest_bytes")


def usage_cost(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Quantity per SKU at its latest price; a SKU without price keeps its quantity and costs 0."""
    used = usage.groupBy("sku").agg(F.sum("quantity").alias("quantity"))
    latest = prices.groupBy("sku").agg(F.max_by("price", "price_start").alias("unit_price"))
    return used.join(latest, "sku", "left").withColumn(
        "cost", F.coalesce(F.col("quantity") * F.col("unit_price"), F.lit(0)).cast("decimal(18,2)"))


def column_statistics(spark: SparkSession, table: str) -> None:
    spark.sql(f"analyze table {table} compute statistics for all columns")


def layouts(day: str, cluster: str) -> dict:
    """The compared layouts of a table: by chance, by day, along a curve, in ranges of a column."""
    return {
        "compacted": lambda df, path, files: compacted(df, path, files),
        "partitioned": lambda df, path, files: partitioned(df, path, day),
        "z_ordered": lambda df, path, files: z_ordered(df, path, [cluster], files),
        "clustered": lambda df, path, files: clustered(df, path, [cluster], files),
    }


LAYOUTS = layouts("date_day", "zone_id")

# The fixed query set of the benchmark.
QUERIES = {
    "date_range": "select count(*), sum(order_total) from {t} where date_day between "
                  "date'1996-06-03' and date'1996-06-06'",
    "zone": "select count(*), sum(order_total) from {t} where zone_id = 1",
    "status": "select count(*), sum(order_total) from {t} where order_status = 'DELIVERED'",
    "zone_revenue": "select zone_id, order_status, count(*) as n, sum(order_total) as revenue "
                    "from {t} group by zone_id, order_status order by revenue desc limit 20",
}


def measured(spark: SparkSession, paths: dict[str, str], queries: dict[str, str] | None = None,
             **others: DataFrame) -> DataFrame:
    """Every query once per layout, one after the other: milliseconds, and the bytes that its tasks
    read. A query names its table ``{t}``; its result is small (a total or a top list), and
    ``result`` is a digest of it that does not depend on the order of rows."""
    rows = []
    for name, path in paths.items():
        table = measure.parquet(spark, path)
        for query, sql in (queries or QUERIES).items():
            read = measure.scanned(spark, lambda sql=sql, table=table: spark.sql(
                sql, t=table, **others).collect())
            lines = "\n".join(sorted(str(tuple(r)) for r in read.result))
            rows.append((name, query, read.milliseconds, read.n_bytes,
                         hashlib.sha256(lines.encode()).hexdigest()))
    return spark.createDataFrame(rows, "layout string, query_name string, duration_ms double, "
                                       "bytes_scanned long, result string")


def disparity(results: DataFrame) -> DataFrame:
    """Queries that do not give the same result in every layout."""
    return results.groupBy("query_name").agg(F.countDistinct("result").alias("n")) \
        .filter("n > 1").select("query_name")


def apply_winner(df: DataFrame, results: DataFrame, path: str, files: int) -> str:
    """Rewrite a table in the layout that read least; refuses when no layout is fully measured."""
    best = winner(results).first()
    if best is None:
        raise ValueError("every layout has a missing measurement")
    LAYOUTS[best["layout"]](df, path, files)
    return best["layout"]
