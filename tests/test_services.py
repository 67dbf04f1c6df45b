"""Services: lifecycle, budgets, projects, labels of the mart, indicators."""

import pytest
from pyspark.sql import functions as F

from milepost.catalog import services as services_queries
from milepost.catalog.registry import Tables
from milepost.plans import delivery, services, survey

FOLDER = "/root/testdata/sf0.001"


def test_lifecycle_ties_and_padded_states(spark, rows):
    log = spark.createDataFrame(
        [(1, 7, "created", "d1", 70), (2, 7, " Done ", "d2", 71), (3, 7, "CANCELLED", "d2", 72), (4, 8, "accepted", "d1", 80),
         (5, 9, "Created", None, 90), (6, 9, "created", "d3", 91)], "id long, booking_id long, new_status string, updated_date string, user_id long",
    )
    out = services.booking_lifecycle(log.repartition(4))
    assert rows(out, "booking_id", "ultimo_estado", "actor_ultimo_estado", "fecha_creacion", "actor_creacion") == [
        (7, "cancelled", 72, "d1", 70), (8, "accepted", 80, None, None), (9, "created", 91, None, 90)
    ]


def test_budget_total_and_state(spark, rows):
    b = spark.createDataFrame([(1, "d1", "n", "created", 7, "10.5"), (2, "d2", "m", "otro", 7, None), (3, "d2", "m", "created", 8, "1")],
                              "id int, created_date string, name string, status string, budget_booking_id int, total_quote string")
    out = services.latest_budget(b).withColumn("costo_total", F.col("costo_total").cast("double"))
    assert rows(out, "budget_booking_id", "id", "Estado_presupuesto", "costo_total") == [(7, 2, "otro", 10.5), (8, 3, "Cargado por el Proveedor", 1.0)]


def test_projects(spark, rows):
    df = spark.createDataFrame([("1", 10, "Presupuestado", "x"), ("2", 10, "No Presupuestado", "Completado"), ("3", 11, "Presupuestado", "Completado"),
                                ("4", None, "Presupuestado", "x"), ("5", None, "No Presupuestado", "Completado")],
                               "booking_id string, Proyecto_id int, Presupuesto_flag string, estado_del_servicio string")
    out = services.project_state(df)
    assert rows(out, "booking_id", "rol_booking_en_proyecto", "estado_proyecto") == [
        ("1", "PRESUPUESTO", "EJECUTADO"), ("2", "EJECUCION", "EJECUTADO"), ("3", "PRESUPUESTO", "PENDIENTE DE EJECUTAR"),
        ("4", "PRESUPUESTO", "PENDIENTE DE EJECUTAR"), ("5", "EJECUCION", "SIN PRESUPUESTO")
    ]
    grouped = services.project_state(df, null_group=True)
    assert rows(grouped.filter("Proyecto_id is null"), "estado_proyecto") == [("EJECUTADO",), ("EJECUTADO",)]


def test_mart_keeps_one_row_per_booking(spark):
    tables = services_queries.tables(Tables(spark, FOLDER))
    out = services.services_mart(tables, match="latest")
    assert out.count() == tables["booking"].count() == out.select("booking_id").distinct().count()
    assert services.services_mart(tables).count() >= out.count()
    first = services.services_mart(tables, match="latest", creator="first")
    same = first.filter("creador_email is not null").filter(F.col("creador_email") != F.concat(F.lit("u"), "creador_user_id", F.lit("@x")))
    assert same.count() == 0


def test_nps(spark, rows):
    df = spark.createDataFrame([("a", 11), ("a", 9), ("a", 1), ("a", 10), ("b", None)], "k string, s int")
    assert rows(survey.nps_by(df, ["k"], "s")) == [("a", 4, 2, 1, 1, 25.0), ("b", 0, 0, 0, 0, None)]


def test_delay_loss_and_fragments(spark, rows):
    df = spark.createDataFrame([(0, 11), (-3, 11), (2, 1), (30, 9), (None, 11)], "dias_atraso int, s int")
    got = rows(delivery.nps_by_delay(df, "s"), "tramo_atraso", "nps", "puntos_perdidos")
    assert got == [(0, 100.0, 0.0), (2, -100.0, 200.0), (8, 0.0, 100.0), (None, 100.0, 0.0)]
    lines = spark.createDataFrame([("a", "d1", 5), ("a", "d2", 5), ("b", "d1", 3), ("c", None, 1)], "o string, d string, s int")
    assert rows(delivery.fragmentation_effect(lines, "o", "d", "s")) == [(False, 2, 2.0), (True, 1, 5.0)]


def test_wide_rows_are_moved_few_times(spark, shuffle_joins):
    """Lookups of lookups are joined to each other, and the flags come back to the staged rows in one join."""
    plan = services.services_mart(services_queries.tables(Tables(spark, FOLDER)))._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning" in x and "_row" in x for x in plan.splitlines()) == 1
    assert plan.count("Exchange hashpartitioning") < 12
