"""Rows that large jobs move or write no more than once."""

import datetime as dt

from pyspark.sql import functions as F

from milepost.operators import joins
from milepost.operators.merge import change_feed
from milepost.plans import reasons, services
from milepost.sources.tables import clustered


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_clustered_rows_stay_where_they_are(spark, rows, shuffle_joins):
    df = spark.createDataFrame([(1, "a", "h1"), (2, None, "h2"), (None, "c", "h3"), (2, None, "h2"), (4, "d", "h4")], "k long, s string, h string")
    old = clustered(df, ["k", "s"], "clustered-test")
    assert rows(old) == rows(df)
    assert not [t.name for t in spark.catalog.listTables() if "clustered_test" in t.name]
    new = spark.createDataFrame([(1, "a", "h9"), (5, "e", "h5")], "k long, s string, h string")
    feed = change_feed(old, new, ["k", "s"], "h", F.lit(False), on_dup="unique", whole="keyed")
    assert plan(feed).count("Exchange ") == 1  # the source; the stored side is read by its buckets
    assert rows(feed, "k", "s", "accion") == [(1, "a", "update"), (5, "e", "insert")]


def test_audit_reads_the_feed_once(spark, rows):
    fields = "Control_Contabilizado string, ON_TIME string, SUB_TIPO_SERVICIO string, Motivo string"
    late = {"Control_Contabilizado": "Contabilizado", "ON_TIME": "0", "SUB_TIPO_SERVICIO": "RT STS", "Motivo": None}
    done = late | {"Motivo": "Stock"}
    feed = spark.createDataFrame([(late, done), (None, late), (None, late), (late, None), (done, done)], f"antes struct<{fields.replace(' string', ':string')}>, despues struct<{fields.replace(' string', ':string')}>")
    name = reasons.audit_summary(feed.filter("despues IS NOT NULL").select("despues.*")).first()["tipo"]
    before = spark.createDataFrame([(name, 3), ("other", 2)], "tipo string, total_pendientes long")
    after = reasons.audit_after(before, feed)
    assert rows(after) == [(name, 3), ("other", 2)]
    assert after._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD [antes") == 1


def test_mart_moves_variants_and_providers_by_their_keys(spark, rows, shuffle_joins):
    """What a lookup adds to a booking is moved once, and never together with what its survey adds; ids that repeat multiply as before."""
    def table(fields, *data):
        return spark.createDataFrame(list(data), fields)

    score = "q_sdm_instalaciones_{}_sat5 string"
    kinds = ("amabilidad", "calidad", "fechas", "orden_limpieza")
    tables = {
        "booking": table("id string, professional_id string, shopping_cart_id string, done_date timestamp_ntz, date timestamp_ntz, payment_status string, service_name string, "
                         "final_cost string, final_price string, service_variant_area_id string, category_id string, sale_channel_id string",
                         *[(i, p, c, None, None, "approved", "s", "1", "x", v, "1", "1") for i, p, c, v in (("1", "5", "10", "7"), ("2", "6", "10", "8"), (None, None, None, None))]),
        "booking_log": table("id long, booking_id long, new_status string, updated_date timestamp_ntz, user_id long", (1, 1, "done", None, 30), (2, 2, "done", None, 30)),
        "professional": table("id long, user_id long, parent_id long", (5, 30, None), (6, 31, 5)),
        "users": table("id long, name string, lastname string, email string", (30, "a", "b", "a@x"), (31, "c", "d", "c@x")),
        "shopping_cart": table("id long, user_id long, project_id long", (10, 31, 77)),
        "creator_team": table("Correo_creador string, gestion string", ("a@x", "g")),
        "incident": table("id long, entity_id string, booking_incident_reason_id long", (1, "2", 3)),
        "incident_reason": table("id long, name string, description string, booking_incident_category_id long", (3, "r", "d", 4)),
        "incident_category": table("id long, name string", (4, "ic")),
        "variant_operation": table("id long, name string, service_variant_id long", (7, "v7", 1), (8, "v8", 2), (8, "v8b", 1)),
        "service_variant": table("id long, service_id long, is_budget boolean", (1, 1, True), (2, 1, False)),
        "service": table("id long, name string, service_type_id long", (1, "se", 1)), "service_type": table("id long, name string", (1, "ty")),
        "category": table("id long, name string", (1, "PISO - c")), "sale_channel": table("id long, name string", (1, "1 - sc")),
        "external_transaction": table("id long, shopping_cart_id long, reference string", (1, 10, "B000123456")),
        "budget_execution": table("budget_booking_id long, created_date timestamp_ntz, id long, name string, status string, total_quote string", (1, None, 1, "n", "created", "5")),
        "surveys": table("a_surveyid string, e_creationdate timestamp_ntz, e_responsedate timestamp_ntz, e_sdm_transaction_number_text string, q_sdm_instalaciones_ltr string, "
                         f"e_sdm_instalaciones_proveedor_servicio string, e_sdm_country_alt string, {', '.join(map(score.format, kinds))}, q_sdm_instalaciones_comment string, "
                         "q_sdm_instalaciones_comment_2 string, a_topics_sentiments_tagged_original string"),
    }
    day = dt.datetime(2025, 5, 5)
    tables["surveys"] = table(tables["surveys"].schema, *[(s, day, day, "B000123456", "9", "p", services.fixed.SURVEY_COUNTRY, *"1234", "bien", None, None) for s in ("e1", "e2")])
    out = services.services_mart(tables)
    got = rows(out, "booking_id", "a_surveyid", "servicio_solicitado", "nombre_contratista", "estado_encuesta", "rol_booking_en_proyecto", "estado_proyecto")
    assert got == sorted([
        (b, s, v, n, first, role, state) for s in ("e1", "e2") for b, v, n, first, role, state in (
            ("1", "v7", "a b", "PRINCIPAL", "PRESUPUESTO", "EJECUTADO"), ("2", "v8", "a b", "SECUNDARIO", "EJECUCION", "EJECUTADO"),
            ("2", "v8b", "a b", "SECUNDARIO", "PRESUPUESTO", "EJECUTADO"))
    ] + [(None, None, None, None, None, "OTRO", "SIN PRESUPUESTO")], key=repr), got
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    moved = [x for x in out._jdf.queryExecution().explainString(mode).split("\n\n") if ") Exchange" in x]
    assert len(moved) > 3 and not [x for x in moved if "servicio_solicitado" in x and "comentario_principal" in x]
    assert not [x for x in moved if "profesional_email" in x and "comentario_principal" in x]


def test_rows_of_a_frequent_key_are_dealt_a_bounded_number_of_times(spark, shuffle_joins):
    left = spark.range(600).select(F.col("id").alias("a"), F.lit("k").alias("k"))
    right = spark.range(400).select(F.col("id").alias("b"), F.lit("k").alias("r"))
    pairs = joins.split_join(left, right, "k", "r", ["b"], 2)
    got = pairs.agg(F.count("*"), F.count_distinct("a", "b")).first()
    assert tuple(got) == (240_000, 240_000)
    largest = spark.range(1).select(joins.cells(F.lit(27_000_000), 500), joins.cells(F.lit(1_200), 500), joins.cells(F.lit(7), 500)).first()
    assert tuple(largest) == (joins.CELLS, 3, 1)


def test_order_columns_are_moved_once(spark, rows, shuffle_joins):
    fact = spark.createDataFrame([(1, "old"), (2, "old"), (None, "old")], "id long, v string")
    dim = spark.createDataFrame([(1, "b", 3, 1), (1, "a", 3, 2), (1, "c", 2, 3), (2, None, 1, 4)], "id long, v string, t int, w int")
    out = joins.enrich(fact, dim, ["id"], {"v": "v", "t": "tt"}, order_by=["t desc", "v asc", "w asc"])
    assert rows(out, "id", "tt", "v") == [(1, 3, "a"), (2, 1, None), (None, None, None)]
    moved = plan(out)
    assert "_o_v" not in moved and "_o_t#" not in moved and "_o_w" in moved
