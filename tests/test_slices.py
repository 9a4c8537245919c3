"""Ordered scans against brute force, with one key that holds a third of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from tiffin.operators import skew, slices
from tiffin.operators.islands import islands, median_length


@pytest.fixture(scope="module", autouse=True)
def many_slices(spark):
    """Small data would be merged into one slice."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    out = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(200)}"
        out.append((i, key, rng.randrange(500), rng.randrange(1, 40)))
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "id long, key string, at long, len long").repartition(7)


def groups(rows):
    by = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        by.setdefault(r[1], []).append(r)
    return by


def test_hot_key_spans_slices(df):
    placed = slices.sliced(df, ["key", "at", "id"])
    assert placed.filter("key = 'hot'").select(slices.SLICE).distinct().count() > 1


def test_ranked(df, rows):
    want = {r[0]: n for g in groups(rows).values() for n, r in enumerate(g)}
    got = {r["id"]: r["n"] for r in slices.ranked(df, ["key"], ["at", "id"], "n").collect()}
    assert got == want


def test_contiguous_ids(df, rows):
    want = {r[0]: n for n, r in enumerate(sorted(rows, key=lambda r: (r[2], r[0])), start=1)}
    got = {r["id"]: r["n"] for r in slices.contiguous_ids(df, ["at", "id"], "n").collect()}
    assert got == want


@pytest.mark.parametrize("block", [1, 50, 10_000])
def test_block_ranked(df, rows, block):
    by = {}
    for r in sorted(rows):
        by.setdefault(r[1], []).append(r[0])
    want = {i: n for g in by.values() for n, i in enumerate(g)}
    got = {r["id"]: r["n"] for r in slices.block_ranked(df, ["key"], "id", "n", block).collect()}
    assert got == want


@pytest.mark.parametrize("current", [True, False])
@pytest.mark.parametrize("fold", ["max", "sum"])
def test_running(df, rows, fold, current):
    f = max if fold == "max" else sum
    want = {}
    for g in groups(rows).values():
        for n, r in enumerate(g):
            seen = [x[3] for x in g[:n + (1 if current else 0)]]
            want[r[0]] = f(seen) if seen else (None if fold == "max" else 0)
    placed = slices.sliced(df, ["key", "at", "id"])
    got = slices.running(placed, ["key"], "len", fold, "x", current)
    assert {r["id"]: r["x"] for r in got.collect()} == want


def test_previous(df, rows):
    want = {r[0]: (g[n - 1][3] if n else None) for g in groups(rows).values()
            for n, r in enumerate(g)}
    got = slices.previous(slices.sliced(df, ["key", "at", "id"]), ["key"], "len", "p")
    assert {r["id"]: r["p"] for r in got.collect()} == want


def test_islands(df, rows):
    want = {}
    for g in groups(rows).values():
        reach, island = None, 0
        for r in g:
            if reach is not None and r[2] > reach:
                island += 1
            reach = r[2] + r[3] if reach is None else max(reach, r[2] + r[3])
            want[r[0]] = island
    spans = df.withColumn("end", F.col("at") + F.col("len"))
    got = islands(spans, "key", "at", "end", "id")
    assert {r["id"]: r["island_id"] for r in got.collect()} == want


def test_first_per_key(df, rows):
    want = {k: g[0][0] for k, g in groups(rows).items()}
    got = slices.first_per_key(df, ["key"], ["at", "id"])
    assert {r["key"]: r["id"] for r in got.collect()} == want


def test_attach(df, rows):
    by = groups(rows)
    got = skew.attach(df, ["key"], s=("sum", F.col("len")), m=("min", F.col("at"))).collect()
    assert len(got) == len(rows)
    for r in got:
        g = by[r["key"]]
        assert (r["s"], r["m"]) == (sum(x[3] for x in g), min(x[2] for x in g))


def test_attach_folds_to_one_row_per_key(spark):
    """A row per key and salt would be as many rows as there are, where groups are small."""
    df = spark.range(400).selectExpr("if(id < 40, null, id % 90) as k", "id as v")
    found = skew.attach(df, ["k"], s=("sum", F.col("v")))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    groups = [line for line in plan.splitlines() if "Aggregate [" in line]
    assert len(groups) == 1 and "_salt" not in groups[0].split("],")[0] and "Window" not in plan
    total = {}
    for r in df.collect():
        total[r["k"]] = total.get(r["k"], 0) + r["v"]
    assert {(r["k"], r["v"], r["s"]) for r in found.collect()} == {
        (r["k"], r["v"], total[r["k"]]) for r in df.collect()}


def test_attach_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 5)], "k string, v long")
    got = {(r["k"], r["v"]): r["s"] for r in skew.attach(df, ["k"], s=("sum", F.col("v"))).collect()}
    assert got == {(None, 1): 3, (None, 2): 3, ("a", 5): 5}


def test_lookup(df, rows, spark):
    keys = sorted({r[1] for r in rows})
    table = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, n int")
    got = skew.lookup(df, table, ["key"])
    assert {r["id"]: r["n"] for r in got.collect()} == {r[0]: keys.index(r[1]) for r in rows}


def test_expanded(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 25), ("d", None)], "k string, n long")
    got = {}
    for r in slices.expanded(df, "n", "i", chunk=10).collect():
        got.setdefault(r["k"], []).append(r["i"])
    assert {k: sorted(v) for k, v in got.items()} == {"b": [0], "c": list(range(25))}


def test_median_is_the_lower_middle(spark):
    df = spark.sql("""select timestamp'2024-01-01 00:00:00' as login_at,
        timestampadd(SECOND, s, timestamp'2024-01-01 00:00:00') as logout_at
        from values (1), (1), (5), (9) as t(s) union all
        select timestamp'2024-01-01 00:00:00', null""")
    assert df.limit(1).select(median_length(df)).first()[0] == 1


def test_rows_without_a_group_stay(spark):
    """As in a SQL window, NULL is a group of its own."""
    rows = [(i, None if i % 3 == 0 else f"k{i % 2}", i % 7) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, key string, at long")

    def by_key(got, column):
        return {r["id"]: r[column] for r in got.collect()}
    order = {}
    for i, key, at in sorted(rows, key=lambda r: (r[2], r[0])):
        order.setdefault(key, []).append(i)
    rank = {i: n for ids in order.values() for n, i in enumerate(ids)}
    before = {i: ids[n - 1] if n else None for ids in order.values() for n, i in enumerate(ids)}
    assert by_key(slices.ranked(df, ["key"], ["at", "id"], "n"), "n") == rank
    placed = slices.sliced(df, ["key", "at", "id"])
    assert by_key(slices.previous(placed, ["key"], "id", "p"), "p") == before
    total = by_key(slices.running(placed, ["key"], "id", "sum", "s", True), "s")
    assert total == {i: sum(ids[:n + 1]) for ids in order.values() for n, i in enumerate(ids)}
    blocks = by_key(slices.block_ranked(df, ["key"], "id", "b", block=10), "b")
    assert blocks == {i: n for ids in order.values() for n, i in enumerate(sorted(ids))}


def test_expanded_rows_are_made_by_several_tasks(spark):
    few = spark.range(40).selectExpr("id", "50 + id as n")
    rows = slices.expanded(few, "n", "k").withColumn("task", F.spark_partition_id())
    tasks = rows.groupBy("task").count().collect()
    assert sum(r["count"] for r in tasks) == sum(50 + i for i in range(40)) and len(tasks) > 4


def test_generated_shell_is_made_once(bronze, monkeypatch):
    """The rows behind the orders are written, not made again by every step that reads them."""
    from tiffin.catalog import synthesis
    made = []
    whole = synthesis.shell
    monkeypatch.setattr(synthesis, "shell", lambda b: made.append(whole(b)) or made[-1])
    orders = synthesis.written_orders(bronze)
    plan = orders._jdf.queryExecution().optimizedPlan().toString()
    assert len(made) == 1 and "md5" not in plan and orders.count() == 1500
