"""Express pipeline: orders, products, documents, states, messages."""

import json

import pytest
from pyspark.sql import functions as F

from milepost.operators.quality import split_valid
from milepost.plans import express

AS_OF = "2024-01-15 13:20:00"


@pytest.fixture(scope="module")
def lines(spark):
    data = [("r1", f"{i:02d}", f"sku {i} ", "n", float(i), 1.5, f"c{i}") for i in range(1, 8)]
    data += [("r2", "01", " ", "x", 2.0, 10.0, "z"), ("r3", "01", "s", "y", None, 1.0, "w"), ("r3", "02", "t", "y", 1.0, 1.0, "v")]
    cols = "NUM_RESERVA string, KEY string, PRD_LVL_NUMBER string, PRD_NAME_FULL string, CANTIDAD double, PRECIO double, NOMBRE_CLI string"
    return spark.createDataFrame(data, cols).repartition(3)


def orders(lines, **options):
    return express.consolidate_orders(lines, AS_OF, order_by=["KEY"], attributes=["NOMBRE_CLI"], **options)


def test_orders(lines):
    got = {r.NUM_RESERVA: r for r in orders(lines).collect()}
    assert got["r1"].TOTAL == 42.0 and got["r1"].NOMBRE_CLI == "c1" and got["r1"].LINEAS == 7
    ok, bad = split_valid(orders(lines), F.col("RECHAZO").isNull())
    assert (ok.count(), [r.NUM_RESERVA for r in bad.collect()]) == (2, ["r3"])


def test_products_stay_at_line_grain_until_the_document(lines):
    products = express.order_products(lines, order_by=["KEY"])
    assert products.count() == lines.count()
    some = orders(lines).filter("NUM_RESERVA <> 'r3'")
    got = {r.NUM_RESERVA: json.loads(r.PRODUCTOS) for r in express.nest_products(some, products).collect()}
    assert [p["sku"] for p in got["r1"]] == [f"sku {i}" for i in range(1, 8)]
    assert got["r2"] == [{"sku": "", "nombre": "x", "cantidad": 2.0, "precio": 10.0}] and set(got) == {"r1", "r2"}


def order_frame(spark):
    data = [
        ("1", "Ana Paz", "912", "Calle 1", "Lima", "Lima", "Lince > x", 7, "-12.04", "-77.1", 99.9, "201"),
        ("2", "Ana", "913", "Calle 2", "Lima", "Lima", "Surco", 8, "0", "-77.1", 10.0, "500"),
        ("3", None, "914", "Calle 3", "Lima", "Lima", "Lince > x", 9, None, "-77.1", 10.0, None),
        ("4", "", "915", "Calle 4", "Lima", "Lima", "Ate", None, "x", "-77.1", 10.7, None),
    ]
    cols = ("NUM_RESERVA string, NOMBRE_CLI string, FONO_CLI string, DIRECCION_CLI string, REGION_CLI string, "
            "CIUDAD_CLI string, COMUNA_CLI string, CC_DESPACHA int, LATITUD string, LONGITUD string, TOTAL double, STATUS string")
    df = spark.createDataFrame(data, cols)
    product = F.lit('[{"sku":" A 1 ","nombre":" p ","cantidad":2.9,"precio":3.9},{"sku":" ","nombre":"q","cantidad":1,"precio":1}]')
    df = df.withColumns({"PRODUCTOS": product, "FLAG_GEOCODIFICADO": F.lit(None).cast("boolean")})
    sends = df.select("NUM_RESERVA", "STATUS").filter("STATUS is not null")
    return df.drop("STATUS"), sends


def outbox(spark, **options):
    df, sends = order_frame(spark)
    districts = spark.createDataFrame([("Lima", "Lima ", "Surco", 150140)], "region string, city string, district string, UBIGEO int")
    stores = spark.createDataFrame([("8.0", "C8")], "CC string, IDCARGO string")
    geocodes = spark.createDataFrame([("Calle 2, Surco, Lima, PERU", -12.1, -77.0000005)], "DIRECCION_GEO string, lat double, lng double")
    return express.dispatch_outbox(df, sends, districts, stores, geocodes, AS_OF, **options)


def test_outbox(spark):
    got = {r.NUM_RESERVA: r for r in outbox(spark).collect()}
    assert set(got) == {"2", "4"}
    assert got["4"].STATUS == "ERROR_GOOGLE" and got["4"].PAYLOAD is None and not got["4"].FLAG_GEOCODIFICADO
    r = got["2"]
    assert r.FLAG_GEOCODIFICADO and r.lat == -12.099999
    doc = json.loads(r.PAYLOAD)
    assert doc["total_value"] == 10 and doc["order_id"] == 2 and doc["in_store_reference_id"] == "C8"
    pick, drop = doc["action_points"]
    assert pick["products"] == [{"product_id": "A1", "name": "p", "description": "p", "units": 2, "ean": "A1", "unit_price": 3}]
    assert drop == {"products": [], "action_type": "DROP_OFF", "location_type": "CLIENT"}
    client = doc["client_info"]
    assert (client["first_name"], client["last_name"], client["zip_code"], client["email"]) == ("Ana", "Ana", "150140", None)


def test_missing_coordinates_reach_the_geocoder_by_option(spark):
    assert {r.NUM_RESERVA for r in outbox(spark, geocode_nulls=True).collect()} == {"2", "3", "4"}
    df, _ = order_frame(spark)
    assert {r[0] for r in express.geocode_worklist(df).collect()} == {
        "Calle 2, Surco, Lima, PERU", "Calle 3, Lince, Lima, PERU", "Calle 4, Ate, Lima, PERU"
    }


def test_sent_coordinates_go_back(spark, rows):
    df, _ = order_frame(spark)
    out = express.update_sent_coords(df, outbox(spark))
    assert rows(out, "NUM_RESERVA", "LATITUD", "FLAG_GEOCODIFICADO") == [
        ("1", "-12.04", None), ("2", "-12.099999", True), ("3", None, None), ("4", "x", False)
    ]


def test_send_states(spark, rows):
    sends = spark.createDataFrame(
        [("1", "200", '{"total_value": 5}', '{"tracking_url": "u"}'), ("2", "201", '{"total_value": 5}', '{"tracking_url": "", "trackingUrl": "w"}'),
         ("3", "200", "{}", "no json"), ("4", "500", "{}", '{"tracking_url": "u"}'), ("5", "200", None, None), ("6", "200", "[1]", None)],
        "NUM_RESERVA string, STATUS string, PAYLOAD string, RESPONSE string",
    ).withColumn("FECHA_ENVIO", F.lit(None).cast("timestamp_ntz"))
    out = express.classify_sends(sends)
    assert rows(out, "NUM_RESERVA", "ESTADO", "TRACKING_URL", "TOTAL") == [
        ("1", "ENVIADO", "u", 5.0), ("2", "ENVIADO", "w", 5.0), ("3", "SIN_TRACKING", None, None), ("4", "ERROR", "u", None)
    ]
    kept = express.classify_sends(sends, keep_unreadable=True).filter("NUM_RESERVA in ('5', '6')")
    assert rows(kept, "NUM_RESERVA", "ESTADO") == [("5", "ERROR"), ("6", "ERROR")]


def test_digest_has_a_row_for_each_order(spark):
    tracked = spark.range(250).select(F.col("id").alias("NUM_RESERVA"), F.lit("ENVIADO").alias("ESTADO"), F.concat(F.lit("u"), F.col("id")).alias("TRACKING_URL"),
                                      (F.col("id") % 2).alias("tienda"))
    lines = express.digest(tracked, by=["tienda"]).collect()
    assert len(lines) == 250 and sorted(r.linea for r in lines if r.tienda == 1)[0] == "Reserva: 1\nTracking: u1"


def test_extract(spark, rows):
    detail = spark.createDataFrame(
        [(1, 1, 10, "E2", "2024-01-15 00:00:00"), (2, 1, 10, "E3", "2024-01-15 00:00:00"), (3, 1, 97, "E1", "2024-01-15 00:00:00"),
         (4, 1, 10, "E1", "2024-01-14 00:00:00"), (5, 1, 10, "E1", "2024-01-16 23:59:00"), (6, 1, 10, "E1", "2024-01-15 00:00:00")],
        "NUM_RESERVA int, NUM_DETALLE int, CC_ORIGEN int, RANGO_HORARIO string, f string",
    ).select("*", F.lit("p").alias("PRD_LVL_NUMBER"), F.col("f").cast("timestamp_ntz").alias("FECHA_ENTREGA_ORI")).drop("f")
    events = detail.select("NUM_RESERVA", "NUM_DETALLE", F.when(F.col("NUM_RESERVA") == 6, 300).otherwise(110).alias("COD_ESTADO"), F.col("FECHA_ENTREGA_ORI").alias("FECHA_EVENTO"))
    header = spark.createDataFrame([(1, "Ana")], "NUM_RESERVA int, NOMBRE_CLI string")
    out = express.express_lines(detail, header, events, AS_OF)
    assert rows(out, "NUM_RESERVA", "NOMBRE_CLI", "COD_EVENTO_PT", "FECHA_PREPARADO_TIENDA", "KEY") == [
        ("1", "Ana", 110, "15-01-2024 00:00", "1_p"), ("5", "", 110, "16-01-2024 23:59", "5_p")
    ]
