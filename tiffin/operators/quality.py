"""Data tests: every check is a frame of violating rows, empty when the data is good."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.lineage import sources

SAMPLE = 6


def not_null(df: DataFrame, col: str, where: Column | None = None) -> DataFrame:
    scope = df if where is None else df.filter(where)
    return scope.filter(F.col(col).isNull())


def unique(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keys that occur more than once; NULL keys are ignored."""
    present = df.dropna(subset=cols).select(*cols)
    return (present.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter("n_rows > 1"))


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str,
                  parts: int | None = None) -> DataFrame:
    """Child rows whose key has no parent; a NULL child passes.

    ``parts`` deals both sides to that many tasks by key. Without it Spark puts partitions together by
    their compressed bytes, which are few for keys, and one task may sort the keys of a whole table.
    A child key of very many rows stays in one task then, whose sort spills.
    """
    keys = parent.select(F.col(parent_col).alias(col))
    child = child.filter(F.col(col).isNotNull())
    if parts:
        child, keys = child.repartition(parts, col), keys.repartition(parts, col)
    return child.join(keys, col, "left_anti")


def accepted_values(df: DataFrame, col: str, values: Iterable, where: Column | None = None
                    ) -> DataFrame:
    scope = df if where is None else df.filter(where)
    return scope.filter(~F.col(col).isin(list(values)))


def one_accepted_match(orders: DataFrame, attempts: DataFrame) -> DataFrame:
    """Fulfilled and cancelled orders need exactly one accepted offer, unfulfilled ones none."""
    counts = (attempts.filter("response = 'ACCEPTED'").groupBy("order_id")
              .agg(F.count(F.lit(1)).alias("n")))
    expected = F.when(F.col("order_status") == "UNFULFILLED", 0).otherwise(1)
    return (orders.select("order_id", "order_status").join(counts, "order_id", "left")
            .withColumn("accepted_count", F.coalesce("n", F.lit(0)))
            .filter(F.col("accepted_count") != expected).drop("n"))


def subtotal_mismatch(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders whose subtotal is not the sum of their lines; no lines sum to zero."""
    sums = lines.groupBy("order_id").agg(
        F.sum("line_total").cast("decimal(18,2)").alias("computed_subtotal"))
    zero = F.lit(0).cast("decimal(18,2)")
    return (orders.select("order_id", "subtotal").join(sums, "order_id", "left")
            .withColumn("computed_subtotal", F.coalesce("computed_subtotal", zero))
            .filter(~F.col("subtotal").eqNullSafe(F.col("computed_subtotal"))))


def payment_mismatch(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Successful payments that differ from the order total or have no order."""
    paid = payments.filter("status = 'SUCCESS'").select("order_id", "amount")
    return (paid.join(orders.select("order_id", "order_total"), "order_id", "left")
            .filter(~F.col("amount").eqNullSafe(F.col("order_total"))))


def refund_above_total(orders: DataFrame, refunds: DataFrame) -> DataFrame:
    return (refunds.select("refund_id", "order_id", "refund_amount")
            .join(orders.select("order_id", "order_total"), "order_id")
            .filter("refund_amount > order_total"))


def volume_mismatch(shells: DataFrame, demand: DataFrame) -> DataFrame:
    """Buckets where the rows differ from the plan, in either direction."""
    grain = ["day_index", "hour"]
    actual = shells.groupBy(*grain).agg(F.count(F.lit(1)).alias("a"))
    planned = demand.select(*grain, F.col("orders").cast("bigint").alias("e"))
    return (planned.join(actual, grain, "full_outer")
            .select(*grain, F.coalesce("e", F.lit(0)).alias("expected"),
                    F.coalesce("a", F.lit(0)).alias("actual"))
            .filter("expected <> actual"))


def orphans(links: dict[str, tuple[DataFrame, str, str, DataFrame, str]],
            parts: int | None = None) -> DataFrame:
    """All orphan rows over named links: name -> (child, id, key, parent, parent key). ``parts`` is
    for links between large tables, see ``relationships``."""
    out = None
    for name, (child, row_id, key, parent, parent_key) in links.items():
        cols = list(dict.fromkeys([row_id, key]))
        bad = relationships(child.select(*cols), key, parent, parent_key, parts).select(
            F.lit(name).alias("link"), F.col(row_id).cast("bigint").alias("row_id"),
            F.col(key).cast("bigint").alias("missing_key"))
        out = bad if out is None else out.unionByName(bad)
    return out


def hour_day_mismatch(daily: DataFrame, hourly: DataFrame) -> DataFrame:
    sums = hourly.groupBy("day_index").agg(F.sum("orders").alias("hourly_orders"))
    return (daily.select("day_index", "orders").join(sums, "day_index", "left")
            .withColumn("hourly_orders", F.coalesce("hourly_orders", F.lit(0)))
            .filter("orders <> hourly_orders"))


def over_capacity(daily: DataFrame, riders: DataFrame, per_rider: int = 12) -> DataFrame:
    """Days whose orders exceed what the active riders can deliver."""
    active = riders.filter("is_active").agg(F.count(F.lit(1))).scalar()
    return (daily.select("day_index", "orders")
            .withColumn("active_riders", active)
            .filter(F.col("orders") > F.col("active_riders") * per_rider))


def zones_without_rider(zones: DataFrame, riders: DataFrame) -> DataFrame:
    manned = riders.filter("is_active").select(F.col("home_zone_id").alias("zone_id"))
    return zones.select("zone_id").join(manned, "zone_id", "left_anti")


# -- contracts -----------------------------------------------------------------------------


Contract = list[tuple[str, str]]  # (column, type) in order


class ContractError(ValueError):
    pass


def fields(schema: T.StructType) -> Contract:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def enforce(df: DataFrame, contract: Contract, name: str) -> DataFrame:
    """Names and types, in order; raises before anything is written."""
    actual, expected = fields(df.schema), list(contract)
    if actual != expected:
        wrong = [p for p in actual if p not in expected]
        missing = [p for p in expected if p not in actual]
        raise ContractError(f"{name}: unexpected {wrong}, missing {missing}")
    return df


def landing_contract(df: DataFrame, metadata: Iterable[str]) -> None:
    """Every business column is a string and the metadata columns are there."""
    meta = set(metadata)
    wrong = [f.name for f in df.schema.fields
             if not f.name.startswith("_bronze_") and f.dataType != T.StringType()]
    absent = sorted(meta - set(df.columns))
    if wrong or absent:
        raise ContractError(f"not string: {wrong}; missing metadata: {absent}")


def free_namespace(columns: Iterable[str], prefix: str = "_bronze_") -> None:
    taken = [c for c in columns if c.lower().startswith(prefix)]
    if taken:
        raise ContractError(f"source columns use the reserved prefix {prefix}: {taken}")


def no_answer_key(lineage: dict[str, Iterable[str]], prefix: str = "_gen_") -> None:
    """Models must not read generator-only tables."""
    bad = {m: sorted(i for i in inputs if i.startswith(prefix)) for m, inputs in lineage.items()}
    bad = {m: i for m, i in bad.items() if i}
    if bad:
        raise ContractError(f"models read the answer key: {bad}")


def forbidden_sources(models: dict[str, DataFrame], forbidden: Iterable[str]) -> dict[str, list[str]]:
    """Models whose own plan reads a forbidden table, and which."""
    closed = set(forbidden)
    found = {name: sorted(sources(df) & closed) for name, df in models.items()}
    return {name: tables for name, tables in found.items() if tables}


def no_forbidden_source(models: dict[str, DataFrame], forbidden: Iterable[str]) -> None:
    """Raises before anything is written when a mart reads the answer key."""
    bad = forbidden_sources(models, forbidden)
    if bad:
        raise ContractError(f"models read the answer key: {bad}")


# -- layer gate ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    name: str
    violations: Callable[[], DataFrame]


class GateError(AssertionError):
    pass


def assert_clean(check: Check) -> None:
    """Fetches a few violating rows at most."""
    rows = check.violations().limit(SAMPLE).collect()
    if rows:
        raise GateError(f"{check.name}: {[r.asDict() for r in rows]}")


def run_layers(layers: list[tuple[str, Callable[[], None], list[Check]]]) -> list[str]:
    """Build each layer and run its checks; the first failing layer stops the rest."""
    done = []
    for name, build, checks in layers:
        build()
        for check in checks:
            assert_clean(check)
        done.append(name)
    return done


# -- scorecards ----------------------------------------------------------------------------


def first_reason(*rules: tuple[Column, str]) -> Column:
    """The code of the first rule that holds; NULL means clean."""
    return F.coalesce(*[F.when(condition, F.lit(code)) for condition, code in rules])


def quarantined(arms: list[tuple[str, str, DataFrame, list[str]]]) -> DataFrame:
    """All rejected rows in one shape: (source table, key column, rows with ``reason_code``, payload
    columns) per arm; the payload is JSON that keeps NULL fields."""
    out = None
    for name, row_key, flagged, payload in arms:
        rows = flagged.filter("reason_code is not null").select(
            F.lit(name).alias("source_table"), F.col(row_key).cast("string").alias("natural_key"),
            "reason_code", F.to_json(F.struct(*payload), {"ignoreNullFields": "false"})
            .alias("raw_payload"))
        out = rows if out is None else out.unionByName(rows)
    return out


def scd2_problems(versions: DataFrame, key: str) -> DataFrame:
    """Keys with more than one current row, or with windows that overlap.

    Windows of one key overlap exactly when some window starts before an earlier one has ended;
    a running end over ordered slices finds that for a key with any number of versions.
    """
    from tiffin.functions.clock import open_end
    from tiffin.operators.slices import running, sliced
    current = (versions.filter("valid_to is null").groupBy(key)
               .agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
               .select(F.col(key), F.lit("MANY_CURRENT").alias("problem")))
    spans = versions.select(key, "valid_from", open_end(F.col("valid_to")).alias("_end"))
    placed = sliced(spans, [key, "valid_from", "_end"])
    reach = running(placed, [key], "_end", "max", "_reach", include_current=False)
    overlap = (reach.filter("valid_from < _reach").select(key).distinct()
               .select(key, F.lit("OVERLAP").alias("problem")))
    return current.unionByName(overlap)


def changed_by_rerun(first: DataFrame, second: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """Named measures (row count, sums) that differ between two runs."""
    def measure(df: DataFrame, out: str) -> DataFrame:
        row = df.agg(*[c.cast("decimal(38,2)").alias(n) for n, c in measures.items()])
        return row.unpivot([], list(measures), "measure", out)
    return (measure(first, "before").join(measure(second, "after"), "measure")
            .filter(~F.col("before").eqNullSafe(F.col("after"))))
