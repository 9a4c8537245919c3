"""Whole jobs: generate the fact tables, build the layers."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.functions.draws import Draw, xx_draw
from tiffin.operators import quality
from tiffin.operators.quality import Check
from tiffin.plans import marts, model_tests, staging, staging_tests, synth
from tiffin.session import materialise, tasks
from tiffin.sources.contracts import BRONZE
from tiffin.sources.tables import overwrite, swap

# Order of the rows in a mart's files; the second column spreads a hot first one over files.
CLUSTERED = {"fct_orders": ["zone_id", "order_id"]}
FACTS = ["orders", "order_items", "match_attempts", "payments", "refunds"]


def fact_checks(t: dict[str, DataFrame]) -> list[Check]:
    """What must hold between the generated tables before any of them is published."""
    orders = t["orders"]
    links = {
        "item_order": (t["order_items"], "order_item_id", "order_id", orders, "order_id"),
        "attempt_order": (t["match_attempts"], "match_id", "order_id", orders, "order_id"),
        "payment_order": (t["payments"], "payment_id", "order_id", orders, "order_id"),
        "refund_order": (t["refunds"], "refund_id", "order_id", orders, "order_id"),
        "refund_payment": (t["refunds"], "refund_id", "payment_id", t["payments"], "payment_id")}
    return [
        Check("no orphans", lambda: quality.orphans(links, tasks(t["order_items"]))),
        Check("one accepted offer per matched order",
              lambda: quality.one_accepted_match(orders, t["match_attempts"])),
        Check("subtotal equals its items",
              lambda: quality.subtotal_mismatch(orders, t["order_items"])),
        Check("payment equals the order total",
              lambda: quality.payment_mismatch(orders, t["payments"]))]


def generate_facts(reference: dict[str, DataFrame], out: str, draw: Draw = xx_draw, seed: int = 1
                   ) -> dict[str, int]:
    """Generate, check, then publish the five fact tables; row counts by table.

    ``reference`` holds demand_hourly, restaurant_weights, customer_weights, customers, zones,
    restaurants, menu_items and riders. Each table is staged once in the shared folder, so checks
    and children read it instead of computing the chain again, and nothing is published when a
    check fails. A second run with the same seed gives the same tables.
    """
    r = reference
    shell = materialise(synth.orders_shell(
        r["demand_hourly"], r["restaurant_weights"], r["customer_weights"],
        r["customers"].selectExpr("customer_id", "home_zone_id as zone_id"),
        r["zones"].selectExpr("zone_id", "base_delivery_fee as delivery_fee"),
        r["restaurants"].select("restaurant_id", "commission_pct"), draw, seed), "shell")
    quality.assert_clean(Check("volume equals demand", lambda: quality.volume_mismatch(
        shell, r["demand_hourly"])))
    t: dict[str, DataFrame] = {}
    t["order_items"] = materialise(synth.order_items(shell, r["menu_items"], draw, seed), "items")
    t["orders"] = materialise(synth.finalised(shell, t["order_items"], draw, seed), "orders")
    t["match_attempts"] = materialise(synth.match_attempts(t["orders"], r["riders"], draw, seed),
                                      "attempts")
    t["payments"] = materialise(synth.payments(t["orders"], draw, seed), "payments")
    t["refunds"] = materialise(synth.refunds(t["orders"], t["payments"], draw, seed), "refunds")
    for check in fact_checks(t):
        quality.assert_clean(check)
    return {name: overwrite(t[name], BRONZE[name], f"{out}/{name}", name) for name in FACTS}


def build_layers(bronze: Callable[[str], DataFrame], out: str, salt: str) -> dict[str, int]:
    """Staging checks, then the marts with their checks, layer by layer; row counts by mart.

    ``bronze`` gives a bronze table by name. Staging stays lazy, so each mart is planned from
    bronze to gold at once and reads only the columns it needs. Marts are written beside their
    place, checked there, and take it only when all checks have passed.
    """
    quality.no_answer_key(marts.LINEAGE)
    spark: SparkSession = bronze("orders").sparkSession
    orders = staging.stg_orders(bronze("orders"))
    refunds = staging.stg_refunds(bronze("refunds"))
    items = staging.passed(bronze("order_items"), "order_items")
    attempts = staging.passed(bronze("match_attempts"), "match_attempts")
    customers = staging.stg_customers(bronze("customers"), salt)
    zones, cities = (staging.passed(bronze(n), n) for n in ("zones", "cities"))
    matching = marts.order_matching(orders, attempts)
    models = {
        "dim_customer": marts.dim_customer(customers), "dim_zone": marts.dim_zone(zones, cities),
        "dim_date": marts.dim_date(staging.passed(bronze("demand_daily"), "demand_daily")),
        "dim_restaurant": marts.dim_restaurant(
            staging.passed(bronze("restaurants"), "restaurants")),
        "dim_rider": marts.dim_rider(staging.passed(bronze("riders"), "riders")),
        "fct_orders": marts.fct_orders(marts.order_economics(orders, items, refunds)),
        "fct_deliveries": marts.fct_deliveries(matching, orders)}
    quality.no_forbidden_source(models, marts.ANSWER_KEY)
    held = {"orders": orders, "refunds": refunds, "order_items": items, "match_attempts": attempts,
            "customers": customers, "zones": zones, "cities": cities} | {
        n: staging.passed(bronze(n), n) for n in ("restaurants", "riders")}
    counts: dict[str, int] = {}

    beside = f"{out.rstrip('/')}/_unchecked-{uuid.uuid4().hex}"

    def gold(name: str) -> DataFrame:
        return spark.read.schema(models[name].schema).parquet(f"{beside}/{name}")

    def write() -> None:
        for name, df in models.items():
            if name in CLUSTERED:
                keys = [F.col(c) for c in CLUSTERED[name]]
                df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
            counts[name] = overwrite(df, marts.CONTRACTS[name], f"{beside}/{name}", name)

    statuses = ["DELIVERED", "CANCELLED", "UNFULFILLED"]
    staged = [
        Check("order_id is unique", lambda: quality.unique(orders, ["order_id"])),
        Check("order_status is known",
              lambda: quality.accepted_values(orders, "order_status", statuses)),
        Check("refund amounts are readable", lambda: quality.not_null(refunds, "refund_amount")),
        Check("one accepted offer", lambda: quality.one_accepted_match(orders, attempts)),
        staging_tests.check(held.__getitem__, held),
        Check("refund within the order total", lambda: quality.refund_above_total(orders, refunds))]
    built = [
        Check("subtotal equals its items",
              lambda: quality.subtotal_mismatch(gold("fct_orders"), items)),
        *[model_tests.check(name, gold) for name in models]]
    quality.run_layers([("staging", lambda: None, staged), ("marts", write, built)])
    for name in models:
        swap(spark, f"{beside}/{name}", f"{out.rstrip('/')}/{name}")
    return counts
