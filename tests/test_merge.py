"""Merge family: algebra, duplicates, windowed delete."""

import pytest
from pyspark.sql import functions as F

from milepost.operators import merge


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([("a", 1, "h1", 10), ("b", 2, "h2", 20), ("c", 3, None, 30), ("d", 4, "h4", 5)], "k string, v int, h string, day int")


@pytest.fixture(scope="module")
def source(spark):
    return spark.createDataFrame([("a", 9, "h1", 10), ("b", 8, "hx", 20), ("e", 7, "h5", 50), (None, 0, "h0", 1)], "k string, v int, h string, day int")


def test_insert_twice_is_insert_once(target, source, rows):
    source, _ = merge.split_keys(source, ["k"])
    once = merge.merge_insert(target, source, ["k"])
    assert rows(once, "k") == [("a",), ("b",), ("c",), ("d",), ("e",)]
    assert rows(merge.merge_insert(once, source, ["k"])) == rows(once)


def test_update_only_touches_listed_columns(target, source, rows):
    out = merge.merge_update(target, source, ["k"], ["v"])
    assert rows(out, "k", "v", "h") == [("a", 9, "h1"), ("b", 8, "h2"), ("c", 3, None), ("d", 4, "h4")]


def test_upsert_sets_load_and_update_columns(spark, target, source, rows):
    t = target.withColumns({"cargado": F.lit(0), "movido": F.lit(0)})
    out = merge.merge_upsert(t, source, ["k"], ["v"], {"cargado": F.lit(5), "movido": F.lit(5)}, {"movido": F.lit(5)})
    assert rows(out, "k", "v", "cargado", "movido", "day") == [
        ("a", 9, 0, 5, 10), ("b", 8, 0, 5, 20), ("c", 3, 0, 0, 30), ("d", 4, 0, 0, 5), ("e", 7, 5, 5, None),
        (None, 0, 5, 5, None)
    ]


def test_upsert_to_an_empty_target(target, source, rows):
    out = merge.merge_upsert(target.limit(0), source, ["k"])
    assert rows(out, "k") == [("a",), ("b",), ("e",), (None,)]


def test_sync_actions(target, source, rows):
    out = merge.merge_actions(target, source, ["k"], "h", F.col("day") >= 10)
    assert rows(out, "k", "v", "_action") == [
        ("a", 1, "keep"), ("b", 8, "update"), ("c", 3, "delete"), ("d", 4, "keep"), ("e", 7, "insert"), (None, 0, "insert")
    ]


def test_sync_with_itself_changes_nothing(target, rows):
    out = merge.merge_sync(target, target, ["k"], "h", F.lit(True))
    assert rows(out) == rows(target)


def test_repeated_source_keys(spark, target):
    twice = spark.createDataFrame([("e", 1, "x", 1), ("e", 2, "y", 2)], target.schema)
    with pytest.raises(Exception, match="several rows for key"):
        merge.merge_upsert(target, twice, ["k"]).collect()
    with pytest.raises(Exception, match="several rows for key"):
        merge.merge_insert(target, twice, ["k"]).collect()
    kept = merge.merge_insert(target, twice, ["k"], on_dup="latest", order_by=[F.col("v").desc()])
    assert kept.filter("k = 'e'").head().v == 2
    assert merge.merge_insert(target, twice, ["k"], on_dup="keep_all").count() == 6
    with pytest.raises(ValueError):
        merge.merge_insert(target, twice, ["k"], on_dup="latest")


def test_every_mode_inserts_rows_without_a_key(target, source, rows):
    for mode in ({}, {"on_dup": "unique"}, {"on_dup": "keep_all"}, {"on_dup": "latest", "order_by": [F.col("v").desc()]}):
        assert rows(merge.merge_insert(target, source, ["k"], **mode), "k").count((None,)) == 1
        assert rows(merge.merge_upsert(target, source, ["k"], **mode), "k").count((None,)) == 1
        actions = rows(merge.merge_actions(target, source, ["k"], "h", F.col("day") >= 10, **mode), "k", "_action")
        assert (None, "insert") in actions
    good, bad = merge.split_keys(source, ["k"])
    assert rows(good, "k") == [("a",), ("b",), ("e",)] and rows(bad, "k") == [(None,)]


def test_a_bucketed_target_is_not_moved(spark, target, source, shuffle_joins):
    spark.sql("DROP TABLE IF EXISTS merge_target")
    target.write.bucketBy(4, "k").sortBy("k").saveAsTable("merge_target")
    stored = spark.table("merge_target")
    plan = merge._matched(stored, source, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    whole = merge.merge_upsert(stored, source, ["k"], on_dup="unique")
    exchanged = [line for line in whole._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in line]
    assert len(exchanged) <= 3  # the source for each of its two uses, and its keys
    spark.sql("DROP TABLE merge_target")


@pytest.mark.parametrize("whole", ["keyed", "spread"])
def test_whole_source_gives_the_same_and_moves_once(spark, rows, shuffle_joins, whole):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), (None, 3, "z"), (None, 3, "z"), ("e", 9, "h")], "k string, n int, h string")
    source = spark.createDataFrame([("a", 1, "x"), ("b", 5, "w"), ("c", 6, "v"), (None, 7, "u"), (None, 7, "u")], "k string, n int, h string")
    for f in (lambda **w: merge.merge_upsert(target, source, ["k"], on_dup="keep_all", **w), lambda **w: merge.merge_sync(target, source, ["k"], "h", F.col("n") > 5, on_dup="keep_all", **w),
              lambda **w: merge.change_feed(target, source, ["k"], "h", F.col("n") > 5, on_dup="keep_all", **w)):
        assert rows(f(whole=whole)) == rows(f())
        assert f(whole=whole)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2
