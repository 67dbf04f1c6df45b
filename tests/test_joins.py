"""Joins: cardinality, missing keys, events, matching."""

import pytest
from pyspark.sql import functions as F

from milepost.operators import joins
from milepost.operators.joins import enrich
from milepost.plans import delivery, services


@pytest.fixture(scope="module")
def fact(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "a"), (5, "z")], "id int, k string")


def test_one_keeps_rows_and_replaces_columns(spark, fact, rows):
    dim = spark.createDataFrame([("a", 10), ("b", 20), (None, 30)], "k string, id int")
    assert rows(enrich(fact, dim, ["k"]), "k", "id") == rows(
        spark.createDataFrame([("a", 10), ("b", 20), (None, None), ("a", 10), ("z", None)], "k string, id int")
    )


def test_repeated_lookup_key_is_an_error(spark, fact):
    dim = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(Exception, match="several rows for key"):
        enrich(fact, dim, ["k"], what="districts").collect()
    with pytest.raises(ValueError, match="several rows"):
        joins.assert_unique(dim, ["k"])
    assert joins.assert_unique(dim, ["v"]).count() == 2


def test_order_picks_one_and_many_fans_out(spark, fact, rows):
    dim = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", None, "n"), ("b", 0, "m")], "k string, t int, v string")
    got = rows(enrich(fact, dim, ["k"], ["v"], order_by=["t desc"]), "id", "v")
    assert got == [(1, "y"), (2, "m"), (3, None), (4, "y"), (5, None)]
    assert enrich(fact, dim, ["k"], ["v"], expect="many").count() == 8
    with pytest.raises(ValueError):
        enrich(fact, dim, ["k"], expect="some")


def test_cast_normalise_and_residual(spark, rows):
    left = spark.createDataFrame([("7.0",), ("x",), (None,)], "c string")
    right = spark.createDataFrame([("7", "s7", 1), ("8", "s8", 0)], "cc string, v string, active int")
    assert rows(enrich(left, right, [("c", "cc")], ["v"], cast="double")) == [("7.0", "s7"), ("x", None), (None, None)]
    assert rows(enrich(left, right, [("c", "cc")], ["v"], cast="double", where=F.col("active") == 0), "v") == [(None,)] * 3
    up = enrich(right, spark.createDataFrame([("S7", 1)], "k string, n int"), [("v", "k")], ["n"], normalise=F.upper)
    assert rows(up, "v", "n") == [("s7", 1), ("s8", None)]


def test_hot_and_missing_keys_through_a_shuffle_join(spark, shuffle_joins):
    """Aggregated side, a third of the rows on one key, a third without key."""
    third = F.col("id") % 3
    left = spark.range(3000).select(
        "id", F.when(third == 0, "h").when(third == 1, F.concat(F.lit("k"), F.col("id") % 7)).alias("k")
    )
    side = spark.createDataFrame([("h", 1), ("h", 2), ("k1", 3)], "k string, t int")
    out = enrich(left, side, ["k"], {"t": "v"}, order_by=["t desc"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "_zero" in plan
    got = {tuple(r) for r in out.groupBy("k", "v").count().collect()}
    assert ("h", 2, 1000) in got and (None, None, 1000) in got and sum(g[2] for g in got) == 3000
    # Rows without a key are dealt over the partitions.
    sizes = [r["count"] for r in out.filter("k is null").groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 500


def test_history_compares_trimmed_text(spark, rows):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "k double")
    seen = spark.createDataFrame([(" 1 ",), ("1",)], "k string")
    assert rows(joins.not_in_history(df, seen, "k")) == [(2.0,), (None,)]
    assert rows(joins.in_history(df, seen, "k")) == [(1.0,)]


def test_events_without_date_do_not_count(spark, rows):
    lines = spark.createDataFrame([(i,) for i in range(1, 6)], "r int")
    events = spark.createDataFrame(
        [(1, 110, "2024-01-01"), (1, 110, "2024-01-02"), (2, 110, None), (3, 110, "2024-01-01"), (3, 300, "2024-01-01"),
         (4, 110, "2024-01-01"), (4, 300, None), (4, 9, "2024-01-05"), (6, 110, "2024-01-01")], "r int, c int, d string",
    )
    out = joins.with_events(lines, events, ["r"], "c", "d", {110: "prep"}, {9: "res"}, [300, 112])
    assert rows(out) == [(1, "2024-01-02", None), (4, "2024-01-01", "2024-01-05")]


def test_match_one_keeps_survey_count(spark, rows):
    surveys = spark.createDataFrame([("s1", "B-0012"), ("s2", "12"), ("s3", "x"), ("s4", None)], "s string, doc string")
    lines = spark.createDataFrame(
        [("12", "2024-01-01", "2024-01-03", 1), ("12", "2024-01-01", "2024-01-09", 2), ("99", "2024-01-01", None, 3), ("", "2024-01-01", "2024-02-01", 4)],
        "d string, p string, e string, n int",
    ).withColumns({"p": F.to_date("p"), "e": F.to_date("e")})
    out = delivery.survey_deliveries(surveys, lines, "doc", "d", "p", "e", ["n asc"], ["n"])
    assert rows(out, "s", "dias_atraso", "n") == [("s1", 8, 2), ("s2", 8, 2), ("s3", None, None), ("s4", None, None)]


def test_document_match_modes(spark):
    left = spark.createDataFrame([(1, "B-1"), (2, ""), (3, None)], "i int, k string")
    surveys = spark.createDataFrame([("a", "B-1", 1), ("b", "B-1", 2), ("c", "", 3), ("d", "", 4)], "a_surveyid string, q string, e_responsedate int")

    def n(**options):
        return services.match_documents(left, surveys, "k", "q", ["a_surveyid"], **options).count()

    assert n(match="latest") == 3 and n() == 4 and n(strict=True) == 5
    with pytest.raises(ValueError):
        n(match="some")
