"""Tables, versions, lookups, JDBC options."""

import pytest
from pyspark.sql import functions as F

from milepost.session import RUNTIME_SETTINGS, scratch_path, shared_dir, written
from milepost.sources import jdbc, tables
from milepost.sources.schemas import ALERTS, EXPRESS_LINES, SENDS


def test_missing_table_is_empty(spark, tmp_path):
    out = tables.read_or_empty(spark, str(tmp_path / "none"), SENDS)
    assert out.count() == 0 and out.schema == SENDS
    assert tables.read_or_empty(spark, "no_such_table", SENDS).count() == 0


def test_append_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "log")
    df = spark.range(3)
    tables.write_table(df, path, "append")
    tables.write_table(df, path, "append")
    assert tables.read_or_empty(spark, path, df.schema).count() == 6
    tables.write_table(df, path, "overwrite")
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(ValueError):
        tables.write_table(df, path, "merge")


def test_bucketed_table_joins_without_shuffling_it(spark, shuffle_joins):
    spark.sql("DROP TABLE IF EXISTS master_t")
    for _ in range(2):
        tables.ensure_table(spark, "master_t", SENDS, ["NUM_RESERVA"], buckets=4)
    assert spark.table("master_t").schema.fieldNames() == SENDS.fieldNames()
    other = spark.range(5).select(F.col("id").cast("string").alias("NUM_RESERVA"))
    plan = other.join(spark.table("master_t"), "NUM_RESERVA")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    spark.sql("DROP TABLE master_t")


def test_conform(spark):
    df = spark.createDataFrame([("7.9", None, "x", "2024-01-02 03:04:05"), ("x", "a", "nan", "no")], "CANTIDAD string, IDE string, CC_ORIGEN string, FECHA_ENTREGA_ORI string")
    a, b = tables.conform(df, EXPRESS_LINES).collect()
    assert (a.CANTIDAD, a.IDE, a.CC_ORIGEN, a.FECHA_ENTREGA_ORI.day) == (7.9, "", 0, 2)
    assert (b.CANTIDAD, b.IDE, b.CC_ORIGEN, b.FECHA_ENTREGA_ORI) == (None, "a", 0, None)


def test_lookup_upload_and_report(spark, tmp_path, rows):
    (tmp_path / "u.csv").write_text("region,city,U\n Lima ,Lima,1\nIca,Ica , 2\n")
    path = str(tmp_path / "u.csv")
    assert rows(tables.lookup(spark, path, ["region", "city"])) == [("Ica", "Ica", "2"), ("Lima", "Lima", "1")]
    (tmp_path / "d.csv").write_text("region,U\nLima,1\nLima ,2\n")
    with pytest.raises(Exception, match="several rows for key"):
        tables.lookup(spark, str(tmp_path / "d.csv"), ["region"]).collect()
    up = tables.read_upload(spark, path)
    assert set(dict(up.dtypes).values()) == {"string"}
    out = str(tmp_path / "report")
    tables.export_report(up, ["U", "none", "region"], out)
    assert spark.read.option("header", True).csv(out).columns == ["U", "region"]


def test_jdbc_options():
    got = jdbc.read_options("jdbc:x", "(select 1) t", "id", (1, 9), 4, {"user": "u"})
    assert got["partitionColumn"] == "id" and got["numPartitions"] == "4" and got["user"] == "u"
    assert "partitionColumn" not in jdbc.read_options("jdbc:x", "t")
    with pytest.raises(ValueError):
        jdbc.read_options("jdbc:x", "t", "id")


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_dir(spark)
    assert folder == shared_dir(spark) and (named is None or folder == named.rstrip("/"))
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    df = written(spark.range(3), "x")
    assert df.count() == 3 and f"{folder}/x-" in df.inputFiles()[0]


def test_run_time_settings(spark):
    assert {k: spark.conf.get(k) for k in RUNTIME_SETTINGS} == RUNTIME_SETTINGS


def test_alert_schema_has_its_time():
    assert ALERTS.fieldNames()[-1] == "FECHA_ALERTA"
