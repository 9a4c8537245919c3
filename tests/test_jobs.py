import pytest
from pyspark.sql import functions as F

from tiffin.catalog.models import order_items
from tiffin.catalog.oracle import SALT
from tiffin.catalog.synthesis import customer_weights, restaurant_weights
from tiffin.operators import layout, quality
from tiffin.plans import demand, jobs
from tiffin.session import scratch
from tiffin.sources.contracts import BRONZE


def tables(b):
    return {"cities": b.cities, "zones": b.zones, "restaurants": b.restaurants, "riders": b.riders,
            "menu_items": b.menu_items, "rider_payout_tiers": b.rider_payout_tiers,
            "demand_daily": lambda: demand.actual_daily(b),
            "demand_hourly": lambda: demand.actual_hourly(b), "customers": b.customers,
            "orders": b.orders, "match_attempts": b.match_attempts, "payments": b.payments,
            "refunds": b.refunds, "order_items": lambda: order_items(b)}


def bronze_table(b):
    known = tables(b)

    def get(name):
        return known[name]().select(*[c for c, _ in BRONZE[name]])
    return get


@pytest.mark.parametrize("name", sorted(BRONZE))
def test_bronze_contracts(bronze, name):
    quality.enforce(bronze_table(bronze)(name), BRONZE[name], name)


def reference(b):
    get = bronze_table(b)
    out = {n: get(n) for n in ("demand_hourly", "customers", "zones", "restaurants", "menu_items",
                               "riders")}
    return out | {"restaurant_weights": restaurant_weights(b),
                  "customer_weights": customer_weights(b)}


def read(spark, path, name):
    return spark.read.parquet(f"{path}/{name}")


def test_generate_facts_twice(spark, bronze):
    a, b = scratch(spark, "facts"), scratch(spark, "facts")
    counts = jobs.generate_facts(reference(bronze), a)
    assert counts == jobs.generate_facts(reference(bronze), b)
    assert counts["orders"] == bronze.raw("orders").count()
    for name in jobs.FACTS:
        assert read(spark, a, name).exceptAll(read(spark, b, name)).count() == 0, name


def test_nothing_is_published_when_a_check_fails(spark, bronze, monkeypatch):
    out = scratch(spark, "facts")
    monkeypatch.setattr(jobs, "fact_checks", lambda t: [
        quality.Check("broken", lambda: t["orders"])])
    with pytest.raises(quality.GateError, match="broken"):
        jobs.generate_facts(reference(bronze), out)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read(spark, out, "orders")


def test_build_layers(spark, bronze):
    out = scratch(spark, "gold")
    counts = jobs.build_layers(bronze_table(bronze), out, SALT)
    assert counts["fct_orders"] == counts["fct_deliveries"] == bronze.raw("orders").count()
    assert counts == jobs.build_layers(bronze_table(bronze), out, SALT)


def test_a_bad_layer_stops_the_build(spark, bronze):
    out, get = scratch(spark, "gold"), bronze_table(bronze)

    def damaged(name):
        df = get(name)
        return df.unionByName(df) if name == "orders" else df
    with pytest.raises(quality.GateError, match="order_id is unique"):
        jobs.build_layers(damaged, out, SALT)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read(spark, out, "dim_zone")


def test_apply_winner(spark, bronze):
    rows = bronze.shells().select("order_id", "zone_id")
    results = spark.createDataFrame([("clustered", 1), ("compacted", 5), ("partitioned", None)],
                                    "layout string, bytes_scanned long")
    path = scratch(spark, "winner")
    assert layout.apply_winner(rows, results, path, 4) == "clustered"
    assert spark.read.parquet(path).exceptAll(rows).count() == 0
    with pytest.raises(ValueError):
        layout.apply_winner(rows, results.filter(F.col("bytes_scanned").isNull()), path, 4)


def test_marts_take_their_place_only_when_checked(spark, bronze, monkeypatch):
    out = scratch(spark, "gold")
    counts = jobs.build_layers(bronze_table(bronze), out, SALT)
    before = {n: read(spark, out, n).collect() for n in counts}
    monkeypatch.setattr(quality, "subtotal_mismatch", lambda orders, lines: orders)
    with pytest.raises(quality.GateError):
        jobs.build_layers(bronze_table(bronze), out, SALT)
    monkeypatch.undo()
    assert {n: read(spark, out, n).collect() for n in counts} == before
    jobs.build_layers(bronze_table(bronze), out, SALT)  # the same build twice, row by row
    for name in counts:
        again = read(spark, out, name)
        kept = spark.createDataFrame(before[name], again.schema)
        assert again.exceptAll(kept).count() == kept.exceptAll(again).count() == 0, name
