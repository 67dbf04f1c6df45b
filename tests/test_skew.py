"""Hot keys: AQE splits their partitions in the shuffle joins of the library."""

import pytest
from pyspark.sql import functions as F

from milepost.operators.joins import enrich, not_in_history
from milepost.operators.merge import merge_upsert

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_limits(spark):
    """The size limits of the cluster, scaled down to test data."""
    saved = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in saved.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_left(spark):
    """A third of the rows on one key, a third without key."""
    third = F.col("id") % 3
    key = F.when(third == 0, "h").when(third == 1, F.concat(F.lit("k"), F.col("id") % 997))
    return spark.range(0, 100_000, 1, 8).select("id", key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def side(spark):
    key = F.when(F.col("id") % 3 == 0, "h").otherwise(F.concat(F.lit("k"), F.col("id") % 997))
    return spark.range(0, 3000, 1, 4).select(key.alias("k"), F.col("id").alias("t"))


def final_plan(df) -> str:
    """Plan after the query ran, with the splits AQE made."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString()


def test_aggregated_side(spark, small_limits):
    assert "skew=true" in final_plan(enrich(hot_left(spark), side(spark), ["k"], ["t"], order_by=["t desc"]))


def test_checked_and_declared_lookup(spark, small_limits, tmp_path):
    path = str(tmp_path / "dim")
    side(spark).groupBy("k").agg(F.max("t").alias("t")).write.parquet(path)
    dim = spark.read.parquet(path)
    for expect in ("one", "unique"):
        assert "skew=true" in final_plan(enrich(hot_left(spark), dim, ["k"], ["t"], expect=expect))


def test_history(spark, small_limits):
    assert "skew=true" in final_plan(not_in_history(hot_left(spark), side(spark), "k"))


def test_small_merge_source_moves_no_target_row(spark):
    target = spark.range(0, 1000, 1, 4).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    src = spark.range(990, 1010, 1, 1).select(F.col("id").alias("k"), F.lit("y").alias("v"))
    out = merge_upsert(target, src, ["k"], on_dup="unique")
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 1010 and out.filter("v = 'y'").count() == 20
