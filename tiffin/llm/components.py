"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.session import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point the neighbours of each vertex at the smallest one in its neighbourhood.

    A vertex of very many links is no single task's work: its minimum is a map-side combined
    aggregate, and its links go back to it over a join that Spark can split by size.
    """
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("w"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("w")))
    else:
        both = edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("w"))
    low = both.groupBy("v").agg(F.min("w").alias("low")).select(
        F.col("v").alias("_v"), F.least("v", "low").alias("low"))
    near = both.join(low, F.col("v") == F.col("_v"))
    if large:
        out = near.where("w > v").select(F.col("w").alias("a"), F.col("low").alias("b"))
    else:
        out = near.select(F.col("w").alias("a"), F.col("low").alias("b")).unionByName(
            low.select(F.col("_v").alias("a"), F.col("low").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(id, component) for every vertex of ``edges`` (a, b); component is the smallest id reached.

    Rows with a NULL end and self links are ignored. Each round is written to the shared folder; the
    number of rounds grows with the logarithm of the number of vertices.
    """
    now = materialise(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    for _ in range(rounds):
        now = materialise(_star(_star(now, large=True), large=False), "links")
        seen = now.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x"),
                       F.expr("sum(cast(b as decimal(38, 0)))").alias("s")).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError("components did not settle")
    return now.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component")).unionByName(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
