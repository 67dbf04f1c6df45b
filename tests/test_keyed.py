"""Keyed operators: ties, hot groups, NULL keys, input order."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from milepost.operators.keyed import add_any, add_group_values, add_total, dedupe, latest_per_key, primary_flag


@pytest.fixture(scope="module")
def events(spark):
    """900 rows; a third of them on one key, some without key."""
    rng = random.Random(7)
    data = [(i, "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{rng.randrange(40)}"), rng.randrange(5)) for i in range(900)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "id int, key string, v int").repartition(5)


def test_latest_has_one_row_per_key(events, rows):
    out = latest_per_key(events, ["key"], [F.col("v").desc(), F.col("id").desc()])
    assert out.count() == events.select("key").distinct().count()
    again = latest_per_key(events.orderBy("id"), ["key"], [F.col("v").desc(), F.col("id").desc()])
    assert rows(out) == rows(again)


def test_dedupe_first_and_last(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", None, "z"), ("b", 3, "w")], "k string, t int, v string")
    assert rows(dedupe(df, ["k"], ["t"], "first"), "v") == [("x",), ("z",)]
    assert rows(dedupe(df, ["k"], ["t"], "last"), "v") == [("w",), ("y",)]
    with pytest.raises(ValueError):
        dedupe(df, ["k"], ["t"], "any")


def test_group_values_equal_a_window(events, rows):
    """NULL keys are one group."""
    out = add_group_values(events, ["key"], {"total": F.sum("v"), "top": F.max("id")})
    w = Window.partitionBy("key")
    expected = events.withColumns({"total": F.sum("v").over(w), "top": F.max("id").over(w)})
    assert rows(out) == rows(expected)


def test_both_sides_of_group_values_have_their_own_exchange(spark, shuffle_joins):
    """So AQE can split the partition of a hot group."""
    df = spark.range(4000).select("id", F.when(F.col("id") >= 0, "hot").otherwise("cold").alias("key"), F.lit(1).alias("v"))
    out = add_group_values(df, ["key"], {"n": F.sum("v")})
    assert out.filter("n = 4000").count() == 4000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3  # the aggregation's, and one of each side


def test_total_is_exact_and_counts_null_as_zero(spark, rows):
    df = spark.createDataFrame([("a", "0.1"), ("a", "0.2"), ("a", None), ("b", None)], "k string, q string")
    got = rows(add_total(df, "k", F.col("q"), "t").select("k", F.col("t").cast("string")))
    assert got == [("a", "0.300000000")] * 3 + [("b", "0.000000000")]


def test_any_flag(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    assert rows(add_any(df, "k", {"f": F.col("v") == 2})) == [("a", 1, 1), ("a", 2, 1), ("b", 1, 0)]


def test_primary_flag(spark, rows):
    df = spark.createDataFrame([(1, "s"), (2, "s"), (3, None), (4, None)], "b int, s string")
    labels = ("P", "S")
    assert rows(primary_flag(df, "s", ["b"], "f", labels)) == [(1, "s", "P"), (2, "s", "S"), (3, None, None), (4, None, None)]
    assert rows(primary_flag(df, "s", ["b"], "f", labels, null_group=True))[2:] == [(3, None, "P"), (4, None, "S")]
