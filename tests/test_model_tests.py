"""Each declared test finds the damage it is there for."""

from pyspark.sql import functions as F

from tiffin.plans import marts, model_tests
from tiffin.session import materialise


def small(spark, name):
    """Three good rows of a mart."""
    spine = spark.range(3)
    columns = []
    for column, kind in marts.CONTRACTS[name]:
        value = F.col("id") if kind in ("bigint", "int") else F.lit(None)
        if kind == "date":
            value = F.date_add(F.lit("2024-01-01"), F.col("id").cast("int"))
        if kind == "boolean":
            value = F.lit(True)
        if column == "net_revenue":
            value = F.lit(1)
        columns.append(value.cast(kind).alias(column))
    return spine.select(*columns)


def failing(mart, name):
    return {(r["test"], r["column"]) for r in model_tests.report(name, mart).collect()
            if r["failures"]}


def test_good_marts_pass_and_damage_is_found(spark):
    good = {name: materialise(small(spark, name), "mart") for name in marts.CONTRACTS}
    for name in marts.CONTRACTS:
        assert failing(good.get, name) == set(), name
    for name in ("fct_orders", "fct_deliveries", "dim_zone"):
        for column in model_tests.FILLED[name]:
            bad = dict(good)
            kind = dict(marts.CONTRACTS[name])[column]
            bad[name] = good[name].withColumn(column, F.lit(None).cast(kind))
            assert ("not_null", column) in failing(bad.get, name)
        double = dict(good) | {name: good[name].unionByName(good[name])}
        assert ("unique", model_tests.UNIQUE[name]) in failing(double.get, name)
        for column, (parent, _) in model_tests.FOUND.get(name, {}).items():
            less = dict(good) | {parent: good[parent].limit(0)}
            assert ("relationship", column) in failing(less.get, name)
