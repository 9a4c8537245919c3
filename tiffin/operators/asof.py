"""Resolving a version or a rate as of a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tiffin.functions.clock import open_end


def version_join(facts: DataFrame, versions: DataFrame, on: list[str], at: str,
                 valid_from: str = "valid_from", valid_to: str = "valid_to",
                 kind: str = "timestamp", how: str = "left") -> DataFrame:
    """Join each fact to the version whose half-open window holds the fact's time.

    An equi join on the key with the window as residual condition. No broadcast hint: Spark
    broadcasts the versions when they are small and sort-merges, with skew splitting, when not.
    """
    v = versions.select(*[F.col(c).alias(f"_v_{c}") for c in versions.columns])
    match = [F.col(c) == F.col(f"_v_{c}") for c in on]
    inside = ((F.col(at) >= F.col(f"_v_{valid_from}"))
              & (F.col(at) < open_end(F.col(f"_v_{valid_to}"), kind)))
    condition: Column = inside
    for m in match:
        condition = m & condition
    kept = [c for c in versions.columns if c not in on + [valid_from, valid_to]]
    joined = facts.join(v, condition, how)
    return joined.select(*[F.col(c) for c in facts.columns],
                         *[F.col(f"_v_{c}").alias(c) for c in kept])


def by_precedence(facts: DataFrame, rates: DataFrame, scopes: list[tuple[str, str | None]],
                  at: str, value: str, tiebreak: str, out_rank: str = "precedence") -> DataFrame:
    """The winning rate per fact when several scopes may apply.

    ``scopes`` lists (scope name, key column of the fact or None for everyone), strongest first.
    Rates of one scope and key may overlap; the lowest tiebreak wins in every scope. Each scope is
    its own lookup of at most one row per fact and the first hit wins, so there is no OR join, no
    fan-out and no second shuffle to pick the winner.
    """
    out = facts
    hits, ranks = [], []
    for i, (scope, key) in enumerate(scopes, start=1):
        rows = rates.filter(F.col("scope") == scope)
        card = disjoint_windows(rows, value, tiebreak)
        if key is None:
            out = out.withColumn("_card", _calendar(card))
            live = F.filter("_card", lambda w: (F.col(at) >= w["effective_from"])
                            & (F.col(at) < w["effective_to"]))
            out = out.withColumn(f"_hit{i}", F.get(live, F.lit(0))["v"]).drop("_card")
        else:
            named = card.select(F.col("scope_key").alias("_key"), "effective_from",
                                "effective_to", F.col("_value").alias(f"_hit{i}"))
            probe = out.withColumn("_key", F.col(key).cast("string"))
            out = version_join(probe, named, ["_key"], at, "effective_from", "effective_to",
                               "date", "left").drop("_key")
        hits.append(F.col(f"_hit{i}"))
        ranks.append(F.when(F.col(f"_hit{i}").isNotNull(), F.lit(i)))
    return (out.withColumn(value, F.coalesce(*hits)).withColumn(out_rank, F.coalesce(*ranks))
            .filter(F.col(out_rank).isNotNull())
            .drop(*[f"_hit{i}" for i in range(1, len(scopes) + 1)]))


def disjoint_windows(rows: DataFrame, value: str, tiebreak: str) -> DataFrame:
    """The card of one scope as windows that do not overlap: on each stretch between two dates of a
    key, the rate of the lowest ``tiebreak`` that covers it. A fact meets one window at most."""
    card = rows.select("scope_key", "effective_from",
                       open_end(F.col("effective_to"), "date").alias("effective_to"),
                       F.col(value).alias("_value"), F.col(tiebreak).alias("_tie"))
    dates = card.select("scope_key", F.explode(F.array("effective_from", "effective_to"))
                        .alias("_from")).distinct()
    # One row per date of a rate card's key, however many facts use the key.
    stretch = dates.withColumn("_to", F.lead("_from").over(
        W.partitionBy("scope_key").orderBy("_from"))).filter("_to is not null")
    over = stretch.select(F.col("scope_key").alias("_key"), "_from", "_to")
    met = over.join(card, F.col("_key").eqNullSafe(F.col("scope_key"))
                    & (F.col("effective_from") <= F.col("_from"))
                    & (F.col("effective_to") >= F.col("_to")))
    return met.groupBy("scope_key", "_from", "_to").agg(
        F.min_by("_value", "_tie").alias("_value")).select(
        "scope_key", F.col("_from").alias("effective_from"), F.col("_to").alias("effective_to"),
        "_value")


def _calendar(card: DataFrame) -> Column:
    """The rates of a scope without key. Its card has one row per start date, so it is read as one
    array (a scalar subquery) instead of a join that would have no equal key."""
    row = F.struct("effective_from", open_end(F.col("effective_to"), "date").alias("effective_to"),
                   F.col("_value").alias("v"))
    return card.agg(F.sort_array(F.collect_list(row))).scalar()
