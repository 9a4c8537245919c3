from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tiffin.llm import mixing

DOCS = "doc_id long, source string, text string"


def test_targets_share_the_excess(spark):
    rows = [("a", 10), ("b", 100), ("c", 100), (None, 0), ("d", 1000)]
    got = {r["source"]: r["target"] for r in mixing.targets(
        spark.createDataFrame(rows, "source string, source_size long")).collect()}
    # weights in order a, b, c, d, NULL: 5 2 1 5 2; a stops at 30, NULL at 0
    assert got["a"] == 30 and got[None] == 0
    level = (1210 - 30) / (2 + 1 + 5)
    assert got["b"] == pytest.approx(2 * level) and got["c"] == pytest.approx(level)
    assert got["d"] == pytest.approx(5 * level)


def test_targets_after_several_rounds(spark):
    """Every source but the last is full, and each round fills another one."""
    rows = [(chr(97 + i), 4 ** i) for i in range(9)]
    got = {r["source"]: r["target"] for r in mixing.targets(
        spark.createDataFrame(rows, "source string, source_size long"), (1,)).collect()}
    total, want = sum(n for _, n in rows), {}
    left, open_ = total, sorted(rows, key=lambda r: r[1])
    while open_ and 3 * open_[0][1] <= left / len(open_):
        s, n = open_.pop(0)
        want[s] = 3 * n
        left -= 3 * n
    want |= {s: left / len(open_) for s, _ in open_}
    assert got == pytest.approx(want)


@pytest.fixture(scope="module")
def planned(spark):
    """A source with most rows, and one that is used three times."""
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 == 8, "few")
        .otherwise("rare").alias("source"),
        F.repeat(F.lit("w "), (F.pmod(F.xxhash64("id"), F.lit(50))).cast("int")).alias("text"))
    return docs, mixing.plan(docs)


def test_taken_words_meet_targets(planned):
    docs, plan = planned
    rows = plan.join(docs, "doc_id").collect()
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    assert len(rows) == 4000
    for group in by.values():
        longest = max(r["size"] for r in group)
        assert abs(sum(r["taken"] for r in group) - group[0]["target"]) <= longest
        rate = group[0]["target"] / group[0]["source_size"]
        for r in group:
            if r["size"]:
                assert r["taken"] in (int(rate) * r["size"], -int(-rate) * r["size"],
                                      (int(rate) + 1) * r["size"]) and r["taken"] <= 3 * r["size"]
    assert by["few"][0]["target"] == 3 * by["few"][0]["source_size"]
    assert all(r["taken"] == 3 * r["size"] for r in by["few"])


def test_same_as_a_plain_prefix_sum(spark, planned):
    """Reruns agree, with other partitions too, and equal a scan of each source."""
    docs, plan = planned
    got = {r["doc_id"]: r["taken"] for r in plan.collect()}
    again = {r["doc_id"]: r["taken"] for r in mixing.plan(docs.repartition(13)).collect()}
    assert got == again
    shifts = {r["source"]: r["u"] for r in docs.select("source").distinct().select(
        "source", mixing.offset(F.concat(F.lit("="), F.col("source")), mixing.SEED).alias("u"))
        .collect()}
    groups = defaultdict(list)
    for r in plan.join(docs, "doc_id").collect():
        groups[r["source"]].append(r)
    for source, rows in groups.items():
        at = shifts[source]
        for r in sorted(rows, key=lambda r: (r["size"], r["doc_id"])):
            unit = round(r["target"] / r["source_size"] * mixing.UNIT)
            assert got[r["doc_id"]] == ((at + unit) // mixing.UNIT - at // mixing.UNIT) * r["size"]
            at += unit


def test_mixture_repeats_documents(planned):
    docs, plan = planned
    mixed = mixing.mixture(docs.withColumn("copy", F.lit("clash")).withColumn("_slice", F.lit(1)))
    assert mixed.columns == ["doc_id", "source", "text", "_slice", "copy"]
    assert mixed.select(F.sum(mixing.words(F.col("text")))).first() == \
        plan.select(F.sum("taken")).first()


def test_odd_rows(spark, odd, nothing):
    rows = mixing.plan(odd).collect()
    assert len(rows) == odd.count()
    assert {r["size"] for r in rows if r["doc_id"] in (3, 4, 5)} == {0}
    unnamed = [r for r in rows if r["doc_id"] == 2 and r["size"] == 10]  # the NULL source
    assert unnamed[0]["source_size"] == 10
    assert sum(r["size"] for r in rows) == 10 + {r["source_size"] for r in rows if r["doc_id"] == 6}.pop()
    assert mixing.plan(nothing).collect() == [] and mixing.mixture(nothing).count() == 0
    empty = spark.createDataFrame([(1, None, None), (2, "a", "")], DOCS)
    assert {(r["target"], r["taken"]) for r in mixing.plan(empty).collect()} == {(0.0, 0)}
