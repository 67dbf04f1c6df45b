"""Splitting frequent keys, bitmaps over histories, checksums of days, change feeds, counters."""

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from milepost.operators import history, joins, merge
from milepost.operators.quality import counted, missed
from milepost.plans import services
from milepost.sources.days import DayTable, checksums, differing_days, sync_days


def sides(spark, n=400):
    """Half of either side has one key; some keys are on one side only, some are NULL."""
    key = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 7 != 0, F.concat(F.lit("k"), F.col("id") % 31))
    left = spark.range(n).select("id", key.alias("k"))
    right = spark.range(n // 2).select((F.col("id") * 10).alias("s"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 47)).alias("rk"))
    return left, right


@pytest.mark.parametrize("what", ["left", "inner"])
@pytest.mark.parametrize("size", [3, 16, 100_000])
def test_cells_give_the_plain_join(spark, rows, what, size):
    left, right = sides(spark)
    got = joins.split_join(left, right, "k", "rk", ["s"], size, what)
    plain = left.join(right, F.col("k") == F.col("rk"), what).select("id", "k", "s")
    assert rows(got) == rows(plain)


def test_match_of_documents_with_cells(spark, rows):
    left, right = sides(spark, 100)
    right = right.withColumn("rk", F.when(F.col("s") % 50 == 0, "").otherwise(F.col("rk")))
    for strict in (False, True):
        plain = services.match_documents(left, right, "k", "rk", ["s"], strict=strict)
        assert rows(services.match_documents(left, right, "k", "rk", ["s"], strict=strict, split=4), *plain.columns) == rows(plain)


def test_no_task_has_more_than_its_share(spark, shuffle_joins):
    """One document with half of both sides: the largest task makes at most three times the pairs of the median one."""
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        left, right = sides(spark, 4000)
        pairs = joins.split_join(left.withColumn("pad", F.md5(F.col("id").cast("string"))), right, "k", "rk", ["s"], 100, "inner")
        tasks = sorted(r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect())
        whole = sorted(r["count"] for r in left.join(right, F.col("k") == F.col("rk")).groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(tasks) == sum(whole) and len(tasks) == 8
    assert tasks[-1] <= 3 * tasks[4] and whole[-1] > 10 * whole[4]


BITS = history.BUCKET * 2


def test_bitmap_has_every_key_and_some_others(spark, rows):
    past = spark.range(0, 3000, 1, 4).select(F.concat(F.lit(" p"), "id").alias("k"), (F.col("id") % 3).alias("dia"))
    parts = history.key_bitmap(past, "k", BITS, by=["dia"])
    bitmap = history.merged_bitmap(parts)
    assert rows(bitmap) == rows(history.key_bitmap(past, "k", BITS)) and parts.count() <= 6
    known = history.maybe_known(past, bitmap, "k", BITS)
    assert known.filter("NOT _maybe").isEmpty()
    fresh = spark.range(20_000).select(F.concat(F.lit("n"), "id").alias("k"))
    alarms = history.maybe_known(fresh, bitmap, "k", BITS).filter("_maybe").count()
    assert 0 < alarms < 20_000 * 3000 / BITS * 1.5


def test_bitmap_filter_equals_the_exact_one(spark, rows):
    """With a bitmap so small that false alarms are certain; NULL keys stay."""
    past = spark.range(3000).select(F.concat(F.lit(" p"), "id").alias("h"))
    df = spark.range(9000).select("id", F.when(F.col("id") % 11 != 0, F.concat(F.lit("p"), F.col("id"))).alias("k"))
    bitmap = history.key_bitmap(past, "h", BITS)
    alarms = history.maybe_known(df, bitmap, "k", BITS).filter("_maybe AND id >= 3000").count()
    got = history.not_in_history_by_bitmap(df, past, "k", bitmap, BITS, "h")
    assert alarms > 0 and rows(got) == rows(joins.not_in_history(df, past, "k", history_key="h"))
    nothing = history.key_bitmap(past.limit(0), "h", BITS)
    assert history.not_in_history_by_bitmap(df, past.limit(0), "k", nothing, BITS, "h").count() == 9000
    with pytest.raises(ValueError, match="multiple"):
        history.key_bitmap(past, "h", 100)


def test_history_is_not_shuffled_for_fresh_keys(spark):
    past = spark.range(0, 200_000, 1, 8).select(F.concat(F.lit("p"), "id").alias("h"))
    bitmap = history.key_bitmap(past, "h", 1 << 22).cache()
    df = spark.range(500).select(F.concat(F.lit("n"), "id").alias("k"))
    out = history.not_in_history_by_bitmap(df, past, "k", bitmap, 1 << 22, "h")
    plan = out._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Range (0, 200000")]
    # Nothing moves the history before the broadcast semi join has thinned it out.
    assert "Exchange" not in above[above.rindex("LeftSemi, BuildRight") :] and "SortMergeJoin" not in plan
    assert out.count() == 500
    bitmap.unpersist()


SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("h", T.StringType()), T.StructField("d", T.DateType())])


def frame(spark, data):
    return spark.createDataFrame([(k, v, f"h{v}", dt.date(2024, 1, d)) for k, v, d in data], SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    found = DayTable(str(tmp_path / "days"), SCHEMA, ("k",), "d")
    found.replace(frame(spark, [(i, f"v{i}", 1 + i % 10) for i in range(100)]))
    return found


def stamps(table):
    from pathlib import Path

    out = {}
    for p in Path(table.path).rglob("*.parquet"):
        out.setdefault(p.parent.name[-2:], {})[p.name] = p.stat().st_mtime_ns
    return out


def test_days_that_differ_are_rewritten(spark, table, rows):
    since = dt.date(2024, 1, 6)
    src = table.read(spark).filter(F.col("d") >= since)
    before = stamps(table)
    assert sync_days(table, src, "h", since) == [] and stamps(table) == before
    # One row changes, one is gone, one is new, one moves within the window, one comes from an older day.
    data = [(r.k, r.v, r.d.day) for r in src.collect() if r.k not in (15, 26, 37)]
    data += [(15, "new", 6), (1000, "x", 9), (37, "v37", 9), (3, "v3", 10)]
    src = frame(spark, data)
    plain = rows(merge.merge_sync(table.read(spark), src, ["k"], "h", F.col("d") >= since))
    days = sync_days(table, src, "h", since)
    after = stamps(table)
    assert rows(table.read(spark), "k", "v") == sorted(((k, v) for k, v, _, _ in plain), key=repr)
    assert sorted(d.day for d in days) == [4, 6, 7, 8, 9, 10]
    assert all(before[d] == after[d] for d in ("01", "02", "03", "05"))
    assert sync_days(table, src, "h", since) == [] and stamps(table) == after


def test_a_day_without_rows_is_gone(spark, table):
    src = table.read(spark).filter("d >= '2024-01-06' AND d <> '2024-01-08'")
    assert [d.day for d in sync_days(table, src, "h", dt.date(2024, 1, 6))] == [8]
    assert "08" not in stamps(table) and table.read(spark).count() == 90


def test_checksums_see_changes_that_cancel_out(spark):
    """Equal counts and equal sums, or equal xors, still differ in the other."""
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "d int, v string")
    b = spark.createDataFrame([(3, "z"), (2, "y"), (1, "x")], "d int, v string").repartition(3)
    assert sorted(checksums(a, "d", ["v"]).collect()) == sorted(checksums(b, "d", ["v"]).collect())
    twice = [spark.createDataFrame([(1, v) for v in values], "d int, v string") for values in (["x", "x", "y"], ["z", "z", "y"])]
    c, d = (checksums(x, "d", ["v"]).first() for x in twice)
    assert c["xor"] == d["xor"] and c["n"] == d["n"] and c["sum"] != d["sum"]
    assert differing_days(*twice, "d", ["v"]) == [1] and differing_days(a, b, "d", ["v"]) == []


def test_only_differing_days_are_read(spark, table):
    plan = table.read(spark, [dt.date(2024, 1, 7)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan or "PartitionFilters: [(d" in plan


def test_change_feed(spark, table, rows):
    old = table.read(spark)
    src = frame(spark, [(r.k, r.v, r.d.day) for r in old.filter("d >= '2024-01-06' AND k NOT IN (15, 26)").collect()] + [(15, "new", 6), (1000, "x", 9)])
    where = F.col("d") >= "2024-01-06"
    feed = merge.change_feed(old, src, ["k"], "h", where)
    got = rows(feed.select("k", "accion", "antes.v", F.col("despues.v").alias("w")))
    assert got == [(1000, "insert", None, "x"), (15, "update", "v15", "new"), (26, "delete", "v26", None)]
    assert rows(merge.apply_changes(old, feed, ["k"])) == rows(merge.merge_sync(old, src, ["k"], "h", where))


def test_counters_ride_along(spark, tmp_path):
    df = spark.createDataFrame([("1",), ("x",), (" ",), (None,), ("2",)], "a string")
    seen = Observation()
    out = counted(df, {"malos": missed("a", F.col("a").try_cast("int"))}, seen)
    out.select(F.col("a").try_cast("int").alias("n")).write.parquet(str(tmp_path / "out"))
    assert seen.get == {"filas": 5, "malos": 1}


def _shuffled(plan) -> int:
    """Rows that the exchanges of a plan wrote."""
    own = plan.metrics().get("shuffleRecordsWritten") if plan.nodeName() == "Exchange" else None
    children = plan.children()
    return (own.get().value() if own and own.isDefined() else 0) + sum(_shuffled(children.apply(i)) for i in range(children.size()))


def test_pairs_of_split_documents_are_not_shuffled(spark, shuffle_joins, tmp_path):
    """Also with repeated orders, orders of several documents and NULL keys."""
    rows = [(i, i % 7, "F" if i % 3 else "O") for i in range(0, 12_000)]
    rows += [(11, c, "F") for c in range(7)] + [(21, c, "F") for c in (1, 1, 2)] + [(11, 2, "F"), (None, 3, "F"), (5, None, "F"), (7, None, "O"), (7, 99, "O"), (7, 98, "O")]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string").write.parquet(str(tmp_path / "orders.parquet"))
    from __spark_entry__ import queries

    df = queries()["document_match_split"](spark, str(tmp_path))
    got = {r[0]: tuple(r)[1:] for r in df.collect()}
    docs = [(o, s, "B0" if o is not None and o % 2 == 0 else None if c is None else f"B{c}") for o, c, s in rows]
    by_key, want = {}, {}
    for o, s, k in docs:
        if k and s == "F" and o is not None and o % 10 < 4:
            by_key.setdefault(k, []).append(o)
    for o, _, k in docs:
        for survey in by_key.get(k, [None]):
            n, seen = want.setdefault(survey, [0, set()])
            want[survey][0] = n + 1
            seen.update(() if o is None else (o,))
    assert got == {k: (n, len(seen)) for k, (n, seen) in want.items()}
    pairs = sum(n for n, _ in want.values())
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    assert _shuffled(execution.executedPlan()) < pairs / 20
