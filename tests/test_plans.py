"""Shape of the physical plans: what reaches the scan, what is shuffled, what must not appear."""

import os
import re

import pytest
from pyspark.sql import functions as F

from milepost.catalog import QUERIES
from milepost.operators.keyed import latest_per_key
from milepost.plans import express, reasons

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan


def test_latest_is_limited_before_the_shuffle(spark):
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    plan = plan_of(latest_per_key(events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]))
    assert re.search(r"WindowGroupLimit .* Final[\s\S]*Exchange[\s\S]*WindowGroupLimit .* Partial", plan)


def test_windows_reach_the_scan(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").select(
        F.col("l_shipdate").alias("FECHA_ENTREGA_ORI"), F.lit(10).alias("CC_ORIGEN"), F.col("l_returnflag").alias("RANGO_HORARIO")
    )
    plan = plan_of(express.open_lines(lines, "1998-06-15 13:20:00"))
    assert "GreaterThan(l_shipdate,1998-06-14T00:00)" in plan and "LessThan(l_shipdate,1998-06-17T00:00)" in plan
    assert "In(l_returnflag, [E1,E2])" in plan


def test_resync_window_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.sql("select date'2024-01-01' as FECHA_PACTADA_RESERVA, 1 as x").write.parquet(path)
    plan = plan_of(spark.read.parquet(path).filter(reasons.resync_window("2024-01-15")))
    assert "GreaterThanOrEqual(FECHA_PACTADA_RESERVA,2024-01-11)" in plan


def test_only_needed_columns_are_read(spark):
    plan = plan_of(QUERIES["star_enrich"](spark, FOLDER))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert any(s == "o_orderkey:bigint,o_custkey:bigint" for s in schemas)
    assert not any("l_extendedprice" in s for s in schemas)
