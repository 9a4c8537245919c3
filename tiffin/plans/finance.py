"""Orders in cents, the ledger, the tie-out and unit economics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.functions.clock import date_key
from tiffin.functions.keys import surrogate_key
from tiffin.functions.money import signed_cents, tax_cents
from tiffin.operators.asof import by_precedence, version_join

# Strongest scope first.
SCOPES = [("RESTAURANT", "restaurant_id"), ("CITY", "city_id"), ("GLOBAL", None)]
SCENARIOS = ["AS_IS", "FEE_PASSTHROUGH", "RESTAURANT_PAYS", "TWO_PART_FEE"]


def fee_asof(orders: DataFrame, fees: DataFrame) -> DataFrame:
    """Exactly one platform fee per order as of its date."""
    return by_precedence(orders, fees, SCOPES, "order_date", "platform_fee_cents",
                         "fee_schedule_id")


def tax_asof(orders: DataFrame, taxes: DataFrame) -> DataFrame:
    return version_join(orders, taxes, ["city_id"], "order_date", "effective_from", "effective_to",
                        "date", "inner")


def cents(amount: Column) -> Column:
    return (amount * 100).cast("bigint")


def order_cents(orders: DataFrame, fees: DataFrame, taxes: DataFrame, dim_restaurant: DataFrame
                ) -> DataFrame:
    """One row per order in cents. Platform revenue comes from its own definition, never as what
    is left over, so that the sum check can fail."""
    priced = tax_asof(fee_asof(orders, fees), taxes)
    versions = dim_restaurant.select("restaurant_id", "restaurant_key", "valid_from", "valid_to")
    keyed = version_join(priced, versions, ["restaurant_id"], "placed_at")
    parts = keyed.select(
        surrogate_key("order_id").alias("order_key"), "order_id", "order_date",
        date_key(F.col("order_date")).alias("date_key"), "restaurant_key",
        surrogate_key("city_id").alias("city_key"), surrogate_key("zone_id").alias("zone_key"),
        surrogate_key("customer_id").alias("customer_key"), "city_id", "placed_at",
        "subtotal_cents", "delivery_fee_cents", "surge_cents", "tip_cents", "promo_cents",
        "platform_promo_cents", "courier_earned_cents", "psp_fee_cents",
        tax_cents(F.col("subtotal_cents"), F.col("tax_rate_bps")).alias("tax_cents"),
        "platform_fee_cents")
    return (parts.withColumn("total_cents", F.expr(
        "subtotal_cents + tax_cents + delivery_fee_cents + surge_cents + tip_cents - promo_cents"))
        .withColumn("platform_revenue_cents", F.expr(
            "platform_fee_cents + (delivery_fee_cents + surge_cents - courier_earned_cents) "
            "- platform_promo_cents"))
        .withColumn("restaurant_payout_cents", F.expr("subtotal_cents - platform_fee_cents"))
        .withColumn("courier_payout_cents", F.expr("courier_earned_cents + tip_cents")))


def ledger(orders: DataFrame) -> DataFrame:
    """One signed row per money movement of an order, from one pass."""
    entries = [("CHARGE", "customer", -F.col("total_cents")),
               ("PAYOUT", "restaurant", F.col("restaurant_payout_cents")),
               ("PAYOUT", "courier", F.col("courier_payout_cents")),
               ("REVENUE", "platform", F.col("platform_revenue_cents")),
               ("TAX", "authority", F.col("tax_cents")),
               ("FEE", "processor", F.col("psp_fee_cents"))]
    rows = F.array(*[F.struct(F.lit(t).alias("entry_type"), F.lit(p).alias("party"),
                              a.alias("amount_cents")) for t, p, a in entries])
    return orders.select("order_id", F.explode(rows).alias("e"),
                         F.col("placed_at").alias("occurred_at")).select(
        "order_id", "e.entry_type", "e.party", "e.amount_cents", "occurred_at")


def flagged_claims(claims: DataFrame, payments: DataFrame) -> DataFrame:
    """Refund claims with their cents and the first reason to reject them, NULL when clean."""
    # No distinct on the payments: a side that is an aggregate would disable skew splitting. The
    # claims are reduced to those with a payment instead, which cannot fan out.
    read = claims.withColumn("amount_cents", signed_cents(F.col("amount_usd")))
    ids = payments.select("payment_id")
    known = read.join(ids, "payment_id", "left_semi").withColumn("_known", F.lit(True))
    unknown = read.join(ids, "payment_id", "left_anti").withColumn("_known",
                                                                   F.lit(None).cast("boolean"))
    joined = known.unionByName(unknown)
    reason = F.coalesce(F.when(F.col("amount_cents").isNull(), "MONEY_UNPARSEABLE"),
                        F.when(F.col("_known").isNull(), "ORPHAN_PAYMENT_REF"))
    return joined.withColumn("reason_code", reason).drop("_known")


def tie_out(movements: DataFrame, flagged: DataFrame) -> DataFrame:
    """Every term of the money equation by name.

    Captures are folded to one row per order first (with map-side combine), which yields the first
    capture, the repeats and the authorised-only orders in the same shuffle.
    """
    ok = F.col("status") == "SUCCEEDED"
    capture, auth = ok & (F.col("kind") == "CAPTURE"), ok & (F.col("kind") == "AUTH")
    per_order = movements.groupBy("order_id").agg(
        F.sum(F.when(capture, F.col("amount_cents"))).alias("captured"),
        F.min_by(F.when(capture, F.col("amount_cents")),
                 F.when(capture, F.struct("created_at", "payment_id"))).alias("first_capture"),
        F.sum(F.when(auth, F.col("amount_cents"))).alias("authorised"),
        F.sum(F.when(ok & (F.col("kind") == "REFUND"), F.col("amount_cents"))).alias("refunded"))
    zero = F.lit(0)
    leak = flagged.filter("reason_code = 'ORPHAN_PAYMENT_REF'").agg(
        F.coalesce(-F.sum("amount_cents"), zero)).scalar()
    terms = per_order.agg(
        F.coalesce(F.sum("captured"), zero).alias("captured"),
        F.coalesce(F.sum("refunded"), zero).alias("refunded"),
        F.coalesce(F.sum(F.when(F.col("captured").isNull(), F.col("authorised"))), zero)
        .alias("pending"),
        F.coalesce(F.sum(F.col("captured") - F.col("first_capture")), zero).alias("double_capture"))
    named = (terms.withColumn("orphan_leak", leak)
             .withColumn("net", F.col("captured") + F.col("refunded")))
    return named.unpivot([], ["captured", "refunded", "orphan_leak", "pending", "double_capture",
                              "net"], "term", "amount_cents")


def residual(terms: DataFrame, expected_net: Column) -> DataFrame:
    """Rows when the net differs from the expectation or from its parts; no tolerance."""
    def term(name: str) -> Column:
        return F.max(F.when(F.col("term") == name, F.col("amount_cents")))
    wide = terms.agg(term("captured").alias("captured"), term("refunded").alias("refunded"),
                     term("net").alias("net")).withColumn("expected_net", expected_net)
    return wide.withColumn("residual", F.col("net") - F.col("expected_net")).filter(
        "net <> expected_net or net <> captured + refunded")


def unit_economics(orders: DataFrame) -> DataFrame:
    """Margin per city and fee tier under four ways to pay the processor."""
    base = orders.groupBy("city_key", F.col("platform_fee_cents").alias("fee_tier")).agg(
        F.sum("platform_revenue_cents").alias("platform_revenue_cents"),
        F.sum("psp_fee_cents").alias("psp_fee_cents"),
        F.sum("subtotal_cents").alias("_subtotal"), F.count(F.lit(1)).alias("_n"))
    out = base.withColumn("scenario", F.explode(F.array(*[F.lit(s) for s in SCENARIOS])))
    revenue, psp = F.col("platform_revenue_cents"), F.col("psp_fee_cents")
    two_part = revenue + 30 * F.col("_n") + F.floor(F.col("_subtotal") / 50) - psp
    margin = (F.when(F.col("scenario") == "AS_IS", revenue - psp)
              .when(F.col("scenario") == "TWO_PART_FEE", two_part).otherwise(revenue))
    ratio = F.round(psp.cast("double") / F.nullif(revenue, F.lit(0)).cast("double"), 6)
    return out.select("city_key", "fee_tier", "scenario", "platform_revenue_cents",
                      "psp_fee_cents", margin.alias("margin_cents"),
                      ratio.alias("psp_to_revenue_ratio"))
