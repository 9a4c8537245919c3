"""Versioned parquet tables: replace, append and upsert by partition, safe to repeat.

A commit writes new files under ``_version=N/_part=…`` and only then appends one row per touched
partition to a small log; readers follow the log. A job that dies before the log row leaves the old
state visible, and a repeated ``(app, batch)`` is recognised and skipped.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.lineage import copied
from tiffin.operators.quality import Contract, enforce

_LOG = "_part string, _version bigint, _replaces boolean, _app string, _batch bigint"


def overwrite(df: DataFrame, contract: Contract, path: str, name: str = "table") -> int:
    """Full-table overwrite behind a schema check; gives the row count of what was written.

    The new files are complete before the old table goes, so a job that dies leaves one of the two.
    """
    fresh = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    enforce(df, contract, name).write.parquet(fresh)
    swap(df.sparkSession, fresh, path)
    copied(path, df)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def swap(spark: SparkSession, fresh: str, path: str) -> None:
    """Put the folder ``fresh`` in the place of ``path``; the old folder is kept until then."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    new, old = (jvm.org.apache.hadoop.fs.Path(p.rstrip("/")) for p in (fresh, path))
    aside = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    fs = new.getFileSystem(conf)
    was = fs.exists(old)
    if was and not fs.rename(old, aside):
        raise OSError(f"cannot set {path} aside")
    if not fs.rename(new, old):
        if was:
            fs.rename(aside, old)
        raise OSError(f"cannot publish {path}")
    if was:
        fs.delete(aside, True)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, part: Column | None):
        """``part`` gives the partition of a row, for example a date; it must be a function of the
        upsert key, so that a key never moves. None keeps one partition, for small tables."""
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self._part = F.lit("all") if part is None else part.cast("string")

    def log(self) -> DataFrame:
        """Commits so far; empty before the first one."""
        try:
            return self.spark.read.schema(_LOG).parquet(f"{self.path}/log")
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            return self.spark.createDataFrame([], _LOG)

    def visible(self) -> DataFrame:
        """(partition, version) pairs that readers see: from the last replacing version on."""
        log = self.log()
        floor = log.groupBy("_part").agg(
            F.max(F.when(F.col("_replaces"), F.col("_version"))).alias("_floor"))
        return (log.join(floor, "_part").filter("_version >= coalesce(_floor, 0)")
                .select("_part", "_version").distinct())

    def exists(self) -> bool:
        return not self.log().isEmpty()

    def _raw(self, visible: DataFrame) -> DataFrame:
        """The files of the versions that ``visible`` names. Versions and partitions are table
        metadata, few next to the rows, so they are listed on the driver and prune the scan."""
        seen = visible.collect()
        stored = T.StructType(self.schema.fields + [T.StructField("_part", T.StringType()),
                                                    T.StructField("_version", T.LongType())])
        if not seen:
            return self.spark.createDataFrame([], stored)
        paths = sorted({self._folder(r["_version"]) for r in seen})
        parts = sorted({r["_part"] for r in seen})
        files = (self.spark.read.schema(stored).option("basePath", f"{self.path}/data")
                 .parquet(*paths).filter(F.col("_part").isin(parts)))
        # `visible` was just listed on the driver, so it is small enough to broadcast.
        return files.join(F.broadcast(visible), ["_part", "_version"], "left_semi")

    def _folder(self, version: int) -> str:
        return f"{self.path}/data/_version={version}"

    def read(self, parts: Column | None = None) -> DataFrame:
        """Current rows; ``parts``, a condition on ``_part``, limits the files that are read."""
        visible = self.visible()
        return self._raw(visible if parts is None else visible.filter(parts)).select(
            *self.schema.names)

    def seen(self, app: str, batch: int) -> bool:
        return not self.log().filter((F.col("_app") == app) & (F.col("_batch") == batch)).isEmpty()

    def _commit(self, rows: DataFrame, replaces: bool, app: str, batch: int,
                cleared: DataFrame | None = None) -> None:
        """One writer at a time. The folder of a version is overwritten as a whole, so a second try
        after a failure starts clean."""
        last = self.log().agg(F.max("_version")).first()[0]
        version = (last or 0) + 1
        out = rows.select(*self.schema.names).withColumn("_part", self._part)
        # Rebalance keeps a hot partition from becoming one task and small ones from many files.
        (out.hint("rebalance", F.col("_part")).write.mode("overwrite").partitionBy("_part")
         .parquet(self._folder(version)))
        written = (self.spark.read.schema(out.schema).parquet(self._folder(version))
                   .select("_part").distinct())
        touched = written if cleared is None else written.unionByName(cleared).distinct()
        entry = touched.select("_part", F.lit(version).cast("bigint").alias("_version"),
                               F.lit(replaces).alias("_replaces"), F.lit(app).alias("_app"),
                               F.lit(batch).cast("bigint").alias("_batch"))
        # A row per touched partition, in one file, so that the commit appears at once.
        entry.coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def append(self, rows: DataFrame, app: str = "append", batch: int | None = None) -> bool:
        """Add rows; a batch that was already added is skipped. Returns whether it was written."""
        if batch is not None and self.seen(app, batch):
            return False
        self._commit(rows, False, app, -1 if batch is None else batch)
        return True

    def replace(self, rows: DataFrame, slice_: Column | None = None) -> None:
        """Replace whole partitions: those of ``rows`` and the present ones that ``slice_`` (a
        condition on ``_part``) selects, so a day that became empty is emptied."""
        cleared = None
        if slice_ is not None:
            cleared = self.visible().filter(slice_).select("_part").distinct()
        self._commit(rows, True, "replace", -1, cleared)

    def upsert(self, batch: DataFrame, keys: list[str], update: bool = True, app: str = "upsert",
               batch_id: int | None = None) -> bool:
        """Insert new keys and, with ``update``, let the batch win on known keys.

        ``batch`` has one row per key. Only the partitions of the batch are read. Insert-only
        commits add files next to the old ones; updates rewrite the touched partitions.
        """
        if batch_id is not None and self.seen(app, batch_id):
            return False
        number = -1 if batch_id is None else batch_id
        if not self.exists():
            self._commit(batch, False, app, number)
            return True
        source = batch.select(*self.schema.names).persist()
        try:
            touched = [r[0] for r in source.select(self._part.alias("_part")).distinct().collect()]
            current = self._raw(self.visible().filter(F.col("_part").isin(touched))) \
                .select(*self.schema.names)
            if update:
                kept = _without(current, source, keys)
                self._commit(kept.unionByName(source), True, app, number)
            else:
                self._commit(_without(source, current, keys), False, app, number)
        finally:
            source.unpersist()
        return True


def _without(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``; NULL keys match each other."""
    other = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(other, same, "left_anti")


def append_keyed(df: DataFrame, path: str, app_id: str, version: int) -> None:
    """Append that a retry cannot double: its own partition, overwritten dynamically."""
    (df.withColumn("app_id", F.lit(app_id)).withColumn("app_version", F.lit(version))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("app_id", "app_version").parquet(path))


# -- chunked backfill ------------------------------------------------------------------------


class CapacityError(ValueError):
    pass


def chunks(bounds: DataFrame, first: str, last: str, days: int) -> DataFrame:
    """Half-open day ranges of ``days`` days that cover ``[first, last]``; the last may be short."""
    step = F.expr(f"interval {days} days")
    return (bounds.select(F.posexplode(F.sequence(first, last, step)).alias("chunk", "chunk_start"),
                          F.col(last).alias("_last"))
            .select("chunk", "chunk_start",
                    F.least(F.date_add("chunk_start", days), F.date_add("_last", 1))
                    .alias("chunk_end")))


def check_capacity(projected: int, blocks: int, block_size: int) -> None:
    """Refuse to start when the ids of a window would run into the next window's block."""
    if projected >= blocks * block_size:
        raise CapacityError(f"{projected} rows do not fit in {blocks} blocks of {block_size} ids")


def backfill(source: DataFrame, day: str, plan: DataFrame, path: str) -> None:
    """Write the days of all chunks of ``plan`` (chunk, chunk_start, chunk_end) in one pass.

    Each chunk is a folder named by its first day, and the write replaces the folders that it
    touches and no other, so any chunk can be run again. A row finds its chunk by a join on the
    days of the plan, which are as many as the window has. A chunk without rows in the source
    keeps what it had.
    """
    days = plan.select("chunk_start", F.explode(F.sequence(
        "chunk_start", F.date_sub("chunk_end", 1))).alias("_day"))
    rows = source.join(days, source[day] == F.col("_day")).drop("_day")
    (rows.hint("rebalance", F.col("chunk_start")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("chunk_start").parquet(path))


# -- statistics --------------------------------------------------------------------------------


def file_stats(df: DataFrame) -> DataFrame:
    """Files, bytes and rows of a file-based frame, from the hidden metadata columns."""
    per_file = df.groupBy(F.col("_metadata.file_path").alias("path"),
                          F.col("_metadata.file_size").alias("size")).agg(
        F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("n_bytes"),
                        F.sum("n").alias("n_rows"))


def fingerprint(df: DataFrame, by: list[str]) -> DataFrame:
    """Per value of ``by``: rows, and sum and xor of row hashes. Order and files do not matter, one
    changed cent does; folded on the map side, so a large partition is no one task's work."""
    row = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    return df.withColumn("_h", row).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("_h").cast("decimal(38,0)")).alias("sum"),
        F.bit_xor("_h").alias("xor"))


def changed_parts(first: DataFrame, second: DataFrame, by: list[str]) -> DataFrame:
    """Parts whose fingerprint differs between two builds, with the rows of each."""
    a, b = fingerprint(first, by), fingerprint(second, by)
    left = a.select(*[F.col(c).alias(f"_a_{c}") for c in by], F.struct("n_rows", "sum", "xor")
                    .alias("_a"))
    right = b.select(*by, F.struct("n_rows", "sum", "xor").alias("_b"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(f"_a_{c}").eqNullSafe(F.col(c))
    key = [F.coalesce(c, f"_a_{c}").alias(c) for c in by]
    return left.join(right, same, "full_outer").filter(~F.col("_a").eqNullSafe(F.col("_b"))).select(
        *key, F.coalesce("_a.n_rows", F.lit(0)).alias("rows_before"),
        F.coalesce("_b.n_rows", F.lit(0)).alias("rows_after"))


def freshness(df: DataFrame, loaded_at: str, as_of: Column, warn_hours: int = 6,
              error_hours: int = 24) -> DataFrame:
    age = F.unix_timestamp(as_of) - F.unix_timestamp(F.col("max_loaded_at"))
    return (df.agg(F.max(loaded_at).alias("max_loaded_at")).withColumn("age_seconds", age)
            .withColumn("status", F.when(F.col("age_seconds") > error_hours * 3600, "error")
                        .when(F.col("age_seconds") > warn_hours * 3600, "warn")
                        .otherwise("pass")))
