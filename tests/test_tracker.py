"""Location capture."""

import pytest
from pyspark.sql import functions as F

from milepost.plans import tracker
from milepost.sources.schemas import ALERTS, COORDINATES, FEED

AS_OF = "2024-01-15 10:00:00.7"


def sends(spark, data):
    df = spark.createDataFrame(data, "NUM_RESERVA string, FONO_CLI string, NOMBRE string, t string")
    return df.withColumn("FECHA_ENVIO", F.col("t").cast("timestamp_ntz")).drop("t")


@pytest.fixture(scope="module")
def feed(spark):
    points = [("+51 912", "-1", "-2", "10:00"), ("912", "-3", "-4", "09:00"), ("51912", "-5", "-6", "10:00"), ("777", "", "1", "11:00")]
    return tracker.explode_feed(spark.createDataFrame([(points,)], FEED))


def test_newest_point_first_among_equals(feed, rows):
    assert rows(tracker.latest_coord(feed)) == [("51912", "-1", "-2", "10:00")]


def test_text_and_time_order(spark, rows):
    points = spark.createDataFrame([("1", "a", "b", "09-02-2024", 1), ("1", "c", "d", "10-01-2024", 2)], "clientUid string, latitud string, longitud string, fecha string, posicion int")
    assert rows(tracker.latest_coord(points), "fecha") == [("10-01-2024",)]
    assert rows(tracker.latest_coord(points, "dd-MM-yyyy"), "fecha") == [("09-02-2024",)]


def test_capture_counts_attempts(spark, feed, rows):
    today = sends(spark, [("r1", "912", "Ana", "2024-01-15 08:00:00"), ("r1", "913", "Eva", "2024-01-15 09:00:00"), ("r2", "912", "Luz", "2024-01-15 08:00:00"),
                          ("r3", "912", "Sol", "2024-01-14 08:00:00"), ("r4", "912", "Mar", "2024-01-15 08:00:00")])
    state = spark.createDataFrame([("r2", "51912", "Luz", None, None, None, None, "SIN_RESPUESTA", 4), ("r4", "51912", "Mar", "1", "1", "x", None, "ENCONTRADA", 2)], COORDINATES)
    out = tracker.capture(today, state, feed, AS_OF)
    cols = ("NUM_RESERVA", "FONO_CLI", "NOMBRE", "ESTADO", "INTENTOS", "LATITUD")
    assert rows(out, *cols) == [("r1", "51913", "Eva", "SIN_RESPUESTA", 1, None), ("r2", "51912", "Luz", "ENCONTRADA", 5, "-1"), ("r4", "51912", "Mar", "ENCONTRADA", 2, "1")]
    again = tracker.capture(today, out, feed, AS_OF)
    assert rows(again, "NUM_RESERVA", "INTENTOS") == [("r1", 2), ("r2", 5), ("r4", 2)]


def test_queue_and_rejects(spark, rows):
    lines = spark.createDataFrame([(1, "1_a", "912345678", " Ana Paz", "2"), (1, "1_b", "999", "Eva", "1"), (2, "2_a", "912345678", None, "1"), (3, "3_a", "912345678", "Sol", "1")],
                                  "NUM_RESERVA long, KEY string, FONO_CLI string, NOMBRE_CLI string, FECHA_PROCESO string")
    coords = spark.createDataFrame([("9", "51912345678", "Luz", "SIN_RESPUESTA", 2), ("8", "51912345678", "Mar", "ENCONTRADA", 2)], "NUM_RESERVA string, FONO_CLI string, NOMBRE string, ESTADO string, INTENTOS long")
    sent = sends(spark, [("3", "", "", "2024-01-01 00:00:00"), ("9", "", "", "2024-01-15 01:00:00"), ("9", "", "", "2024-01-15 02:00:00"), ("8", "", "", "2024-01-15 02:00:00")])
    ok, bad = tracker.message_queue(lines, coords, sent, AS_OF)
    assert rows(ok) == [("2", "51912345678", "CLIENTE", "CLIENTE-2", None), ("9", "51912345678", "Luz", "Luz-9", 2)]
    assert rows(bad, "NUM_RESERVA") == [("1",)]
    total = tracker.message_candidates(lines, coords, sent, AS_OF).count()
    assert ok.count() + bad.count() == total
    assert tracker.message_queue(lines, coords, sent, AS_OF, fan_out=True)[0].count() == 3


def test_alert_only_once(spark, rows):
    coords = spark.createDataFrame([("1", "f", "n", "a", "b", "c", None, "ENCONTRADA", 1), ("2", "f", "n", None, "b", "c", None, "ENCONTRADA", 1), ("3", "f", "n", "a", "b", "c", None, "ENCONTRADA", 1)], COORDINATES)
    lines = spark.createDataFrame([(1, "R", "C", "D", "X"), (1, "R", "C", "D", "X"), (1, "R", "C", "D", "Y")], "NUM_RESERVA long, REGION_DESP string, CIUDAD_DESP string, COMUNA_DESP string, DIRECCION_DESP string")
    alerts = spark.createDataFrame([], ALERTS)
    out = tracker.new_alerts(coords, lines, alerts, AS_OF)
    assert rows(out, "NUM_RESERVA", "DIRECCION_DESP") == [("1", "X"), ("1", "Y"), ("3", None)]
    assert out.schema.fieldNames() == ALERTS.fieldNames()
    assert tracker.new_alerts(coords, lines, out, AS_OF).count() == 0


def test_lines_without_coords(spark, rows):
    header = spark.createDataFrame([(1, "LIMA", "-1", "-2"), (2, "LURIN", "-1", "-2"), (3, "LURIN", " 0 ", "-2"), (4, "LURIN", "-1", None), (5, "LURIN", "", "")], "NUM_RESERVA int, COMUNA_DESP string, LATITUD string, LONGITUD string")
    detail = header.select("NUM_RESERVA", F.lit("p ").alias("PRD_LVL_NUMBER"), F.lit(97).alias("CC_ORIGEN"), F.expr("timestamp_ntz'2024-01-16 00:00:00'").alias("FECHA_DESPACHO"))
    assert rows(tracker.lines_without_coords(detail, header, AS_OF), "KEY") == [("3_p",), ("4_p",), ("5_p",)]
    assert tracker.lines_without_coords(detail, header, "2024-01-16 01:00:00").count() == 0
    assert tracker.lines_without_coords(detail, header, AS_OF, origins=[91]).count() == 0


def test_padded_keys_of_one_reservation_count_once(spark, rows):
    sends = spark.createDataFrame([("1", "912345678", "a", "2024-01-15 10:00:00"), (" 1 ", "912345678", "b", "2024-01-15 11:00:00")],
                                  "NUM_RESERVA string, FONO_CLI string, NOMBRE string, f string")
    sends = sends.select("NUM_RESERVA", "FONO_CLI", "NOMBRE", F.col("f").cast("timestamp_ntz").alias("FECHA_ENVIO"))
    cols = ("NUM_RESERVA string, FONO_CLI string, NOMBRE string, LATITUD string, LONGITUD string, FECHA_COORDENADA string, "
            "FECHA_PROCESO timestamp_ntz, ESTADO string, INTENTOS bigint")
    state = spark.createDataFrame([("1 ", "912345678", "z", None, None, None, None, "SIN_RESPUESTA", 3)], cols)
    feed = spark.createDataFrame([], "clientUid string, latitud string, longitud string, fecha string, posicion int")
    once = tracker.capture(sends, state, feed, "2024-01-15 18:30:00")
    assert rows(once, "NUM_RESERVA", "NOMBRE", "INTENTOS") == [("1", "b", 4)]
    again = tracker.capture(sends, once, feed, "2024-01-15 18:30:00")
    assert rows(again, "NUM_RESERVA", "INTENTOS") == [("1", 5)]
