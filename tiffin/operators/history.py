"""Change feeds between snapshots and versioned dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.functions.clock import open_end
from tiffin.functions.keys import surrogate_key
from tiffin.sources.tables import VersionedTable, changed_parts


def _paired(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer pairs of whole rows by unique key; NULL keys match each other."""
    left = old.select(*[F.col(k).alias(f"_o_{k}") for k in keys],
                      F.struct(*old.columns).alias("_old"))
    right = new.select(*[F.col(k).alias(f"_n_{k}") for k in keys],
                       F.struct(*new.columns).alias("_new"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"_o_{k}").eqNullSafe(F.col(f"_n_{k}"))
    return left.join(right, same, "full_outer").select("_old", "_new")


def _version(kind: str, row: str) -> Column:
    return F.struct(F.lit(kind).alias("_change_type"), F.col(row).alias("_row"))


def change_feed(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """insert, delete and both images of an update, one row each."""
    new = new.select(*old.columns)
    o, n = F.col("_old"), F.col("_new")
    rows = (F.when(o.isNull(), F.array(_version("insert", "_new")))
            .when(n.isNull(), F.array(_version("delete", "_old")))
            .when(~o.eqNullSafe(n), F.array(_version("update_preimage", "_old"),
                                            _version("update_postimage", "_new"))))
    changes = _paired(old, new, keys).select(F.explode(rows).alias("_c"))
    return changes.select("_c._row.*", "_c._change_type")


def scd2_start(snapshot: DataFrame, as_of: Column) -> DataFrame:
    return snapshot.select("*", as_of.alias("valid_from"),
                           F.lit(None).cast("timestamp").alias("valid_to"))


def scd2_apply(history: DataFrame, snapshot: DataFrame, key: str, check: list[str],
               as_of: Column) -> DataFrame:
    """The next state of a versioned table: changed rows close and reopen, deleted ones close.

    Only ``check`` columns count as a change. One join over the current versions; closed versions
    pass through untouched.
    """
    attributes = [c for c in history.columns if c not in ("valid_from", "valid_to")]
    current = history.filter("valid_to is null").select(*attributes, "valid_from")
    pairs = _paired(current, snapshot.select(*attributes), [key])
    o, n = F.col("_old"), F.col("_new")

    def images(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{c}") for c in check])

    def row(side: str, start: Column, end: Column) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in attributes],
                        start.cast("timestamp").alias("valid_from"),
                        end.cast("timestamp").alias("valid_to"))

    still_open = F.lit(None).cast("timestamp")
    started = F.col("_old.valid_from")
    kept = row("_old", started, still_open)
    closed = row("_old", started, as_of)
    opened = row("_new", as_of, still_open)
    rows = (F.when(o.isNull(), F.array(opened))
            .when(n.isNull(), F.array(closed))
            .when(images("_old").eqNullSafe(images("_new")), F.array(kept))
            .otherwise(F.array(closed, opened)))
    moved = pairs.select(F.explode(rows).alias("_r")).select("_r.*")
    return history.filter("valid_to is not null").select(*moved.columns).unionByName(moved)


class KeptHistory:
    """A versioned table on disk, in buckets of its key.

    A snapshot is compared with the open versions by a fingerprint per bucket, for which only the
    key and the checked columns are read and one row per bucket is shuffled. Only buckets that
    differ are joined and written again; the files of all others stay as they are.
    """

    def __init__(self, spark: SparkSession, path: str, snapshot: T.StructType, key: str,
                 check: list[str], buckets: int = 1024):
        self.key, self.check, self.buckets = key, check, buckets
        self.schema = T.StructType([*snapshot.fields, *(
            T.StructField(c, T.TimestampType()) for c in ("valid_from", "valid_to"))])
        self.table = VersionedTable(spark, path, self.schema, self.bucket())

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets))

    def start(self, snapshot: DataFrame, as_of: Column) -> None:
        self.table.replace(scd2_start(snapshot.select(*self.schema.names[:-2]),
                                      as_of.cast("timestamp")))

    def compared(self, snapshot: DataFrame) -> DataFrame:
        """Buckets in which an open version is new, gone or changed."""
        def marks(df: DataFrame) -> DataFrame:
            return df.select(self.bucket().alias("bucket"), self.key, *self.check)
        return changed_parts(marks(self.table.read().filter("valid_to is null")), marks(snapshot),
                             ["bucket"]).select("bucket")

    def apply(self, snapshot: DataFrame, as_of: Column) -> int:
        """Close and open versions; the number of buckets that were written. Bucket numbers are
        folders of the table, listed on the driver."""
        touched = [r[0] for r in self.compared(snapshot).collect()]
        if touched:
            inside = self.bucket().isin(touched)
            history = self.table.read(F.col("_part").isin([str(t) for t in touched]))
            self.table.replace(scd2_apply(history, snapshot.filter(inside), self.key, self.check,
                                          as_of))
        return len(touched)


def scd2_view(history: DataFrame, key: str, name: str) -> DataFrame:
    """A key per version, a closed end for range joins, and the current flag."""
    attributes = [c for c in history.columns if c not in ("valid_from", "valid_to")]
    return history.select(
        surrogate_key(key, F.date_format("valid_from", "yyyy-MM-dd HH:mm:ss")).alias(name),
        *attributes, "valid_from", open_end(F.col("valid_to")).alias("valid_to"),
        F.col("valid_to").isNull().alias("is_current"))


def recent(df: DataFrame, clock: str, target: DataFrame, days: int) -> DataFrame:
    """Rows the next incremental run must look at: from the target's newest event time back."""
    newest = target.agg(F.max(clock)).scalar()
    floor = F.coalesce(newest, F.lit("1900-01-01").cast("timestamp")) - F.expr(
        f"interval {days} days")
    return df.filter(F.col(clock) >= floor)
