import tracemalloc
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiffin.operators import layout, vectors
from tiffin.session import scratch
from tiffin.sources import tables


def test_morton_interleaves(spark):
    df = spark.sql("select 5L as a, 3L as b")
    key = df.select(layout.morton([F.col("a"), F.col("b")], 3)).first()[0]
    assert key == 0b011011  # bits of b and a in turns, from the top: 0,1 1,0 1,1


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(40_000).select(
        F.col("id").alias("order_id"), (F.xxhash64("id") % 25).alias("zone_id"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("price"))


def scanned(spark, path, zone):
    p = {"zone": (F.col("zone_id_min") <= zone) & (F.col("zone_id_max") >= zone)}
    return layout.surviving(spark, path, "x", ["zone_id"], p).first()["bytes_scanned"]


def test_clustering_skips_files_and_keeps_rows(spark, rows):
    plain, near, curve = (scratch(spark, n) for n in ("plain", "near", "curve"))
    layout.compacted(rows, plain, 16)
    layout.clustered(rows, near, ["zone_id"], 16)
    layout.z_ordered(rows, curve, ["zone_id", "price"], 16, bits=5)
    assert scanned(spark, near, 3) < scanned(spark, plain, 3) / 4
    assert scanned(spark, curve, 3) < scanned(spark, plain, 3)
    for path in (near, curve):
        assert spark.read.parquet(path).exceptAll(rows).count() == 0
        assert spark.read.parquet(path).count() == 40_000


def test_a_hot_value_spreads_over_files(spark, rows):
    path = scratch(spark, "hot")
    layout.clustered(rows.withColumn("zone_id", F.lit(1)), path, ["zone_id"], 8)
    assert tables.file_stats(spark.read.parquet(path)).first()["n_files"] == 8


def test_measured_bytes_and_disparity(spark, rows):
    """Bytes are those of the tasks, a filter on the cluster column reads few of them; a layout that
    lost a row is found."""
    paths = {n: scratch(spark, n) for n in ("plain", "near", "less")}
    layout.compacted(rows, paths["plain"], 16)
    layout.clustered(rows, paths["near"], ["zone_id"], 16)
    layout.compacted(rows.filter("order_id > 0"), paths["less"], 16)
    queries = {"zone": "select count(*), sum(price) from {t} where zone_id = 3",
               "all": "select count(*), sum(price), sum(order_id) from {t}"}
    found = layout.measured(spark, paths, queries)
    size = {(r["layout"], r["query_name"]): r["bytes_scanned"] for r in found.collect()}
    assert size["near", "zone"] * 3 < size["plain", "zone"]
    assert size["near", "all"] * 2 > size["plain", "all"] > 0
    assert [r[0] for r in layout.disparity(found).collect()] == ["all"]
    assert layout.disparity(found.filter("layout <> 'less'")).count() == 0


def test_file_statistics(spark, rows):
    path = scratch(spark, "files")
    layout.compacted(rows, path, 5)
    names = [p for p in Path(path.removeprefix("file:")).iterdir() if p.suffix == ".parquet"]
    assert tuple(tables.file_stats(spark.read.parquet(path)).first()) == (
        5, sum(p.stat().st_size for p in names), 40_000)


RESULTS = "layout string, query_name string, duration_ms double, bytes_scanned long"


def test_missing_bytes_never_win(spark):
    df = spark.createDataFrame([("a", "q", 5.0, None), ("b", "q", 9.0, 10), ("c", "q", 1.0, 20)],
                               RESULTS)
    assert layout.winner(df).first()["layout"] == "b"
    assert layout.winner(df.filter("layout = 'a'")).count() == 0
    assert {r["layout"]: r["missing"] for r in layout.summary(df).collect()} == {"a": 1, "b": 0, "c": 0}
    assert tuple(layout.duration_note(df).first()) == ("c", "b")
    assert layout.duration_note(df.filter("layout = 'b'")).count() == 0


def test_unpriced_usage_costs_nothing(spark):
    usage = spark.createDataFrame([("a", 2), ("a", 1), ("b", 4)], "sku string, quantity long")
    prices = spark.createDataFrame([("a", 1.0, 1), ("a", 2.5, 2)],
                                   "sku string, price double, price_start int")
    got = {r["sku"]: (r["quantity"], float(r["cost"]))
           for r in layout.usage_cost(usage, prices).collect()}
    assert got == {"a": (3, 7.5), "b": (4, 0.0)}


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(300, 8))
    df = spark.createDataFrame([(str(i), v.tolist()) for i, v in enumerate(data)],
                               "review_id string, vector array<double>").repartition(5)
    queries = df.filter("cast(review_id as int) < 3")
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    got = {}
    for r in vectors.top_k(df, queries, 5).collect():
        got.setdefault(int(r["query_id"]), {})[r["position"]] = int(r["review_id"])
    for q in range(3):
        want = np.argsort(-(unit @ unit[q]), kind="stable")[:5].tolist()
        assert [got[q][i] for i in range(1, 6)] == want


def test_other_dimension_is_an_error(spark):
    corpus = spark.createDataFrame([("1", [1.0, 2.0])], "review_id string, vector array<double>")
    query = spark.createDataFrame([("2", [1.0, 2.0, 3.0])], corpus.schema)
    with pytest.raises(Exception, match="dimensions"):
        vectors.top_k(corpus, query, 1).collect()


@pytest.mark.parametrize("query_block,corpus_block", [(1, 1), (3, 7), (1000, 50)])
def test_blocks_of_any_size(spark, query_block, corpus_block):
    """Ties of exact copies over many blocks go to the smaller id."""
    rng = np.random.default_rng(5)
    data = rng.normal(size=(60, 4))
    data[10:40] = data[10]
    df = spark.createDataFrame([(str(i), v.tolist()) for i, v in enumerate(data)],
                               "review_id string, vector array<double>").repartition(6)
    got = {}
    queries = df.filter("cast(review_id as int) % 9 = 1")
    for r in vectors.top_k(df, queries, 4, query_block, corpus_block).collect():
        got.setdefault(int(r["query_id"]), []).append((r["position"], r["review_id"]))
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    for q in range(1, 60, 9):
        score = np.round(unit @ unit[q], 12)
        want = sorted(range(60), key=lambda i: (-score[i], str(i)))[:4]
        assert [int(i) for _, i in sorted(got[q])] == want


def test_nothing_passes_the_driver(spark):
    """Query vectors stay rows: the plan joins blocks by key, with no nested loop and no local
    table."""
    df = spark.range(100).selectExpr("cast(id as string) as review_id",
                                     "array(cast(id as double), 1D) as vector")
    plan = vectors.top_k(df, df, 3, 10, 10)._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "LocalTableScan" not in plan


def test_zero_vectors_come_last(spark):
    rows = [("a", [1.0, 0.0]), ("b", [0.0, 0.0]), ("c", [-1.0, 0.0]), ("d", None)]
    df = spark.createDataFrame(rows, "review_id string, vector array<double>")
    got = vectors.top_k(df, df.filter("review_id = 'a'"), 4).orderBy("position").collect()
    assert [(r["review_id"], r["score"]) for r in got] == [("a", 1.0), ("c", -1.0), ("b", None),
                                                          ("d", None)]


def test_scoring_holds_a_few_tiles_only():
    """The room that a block of queries takes against a block of the corpus does not grow with the
    number of queries."""
    rng = np.random.default_rng(5)
    corpus, queries = rng.normal(size=(8_192, 64)), rng.normal(size=(2_048, 64))
    best = vectors._Best([f"{i:05}" for i in range(len(queries))], queries, 3)
    tracemalloc.start()
    best.add([f"{i:05}" for i in range(len(corpus))], corpus)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 64e6
    got = best.batch().slice(3 * 777, 3)
    want = np.argsort(-(queries[777] @ corpus.T), kind="stable")[:3]
    assert got.column("review_id").to_pylist() == [f"{i:05}" for i in want]
