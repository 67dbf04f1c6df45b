"""Column expressions on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from milepost.functions import contact, dates, documents, labels, text


def one(spark, values, *columns):
    """Each expression over a one-column frame ``v``, as a list of tuples in input order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    named = [c.alias(f"c{n}") for n, c in enumerate(columns)]
    return [tuple(r)[1:] for r in df.select("i", *named).orderBy("i").collect()]


def test_document_shapes(spark):
    cases = {
        "BOLETA 123456": ("B", "123456", "B-000000123456", "OK"),
        "B000123": ("B", "000123", "B-000000000123", "OK"),
        "B: 000123": (None, "000123", "B: 000123", "OK"),
        "FACTURA 77": ("F", "77", "F-000000000077", "OK"),
        "F001-1234567": ("F", "1234567", "F-000001234567", "OK"),
        '{"BLT":"000946368252"}': ("B", "000946368252", "B-000946368252", "OK"),
        '{"F":"000123456789"}': (None, "000123456789", '{"F":"000123456789"}', "OK"),
        "1234567": (None, "1234567", "1234567", "OK"),
        "BLT 1234567890123": ("B", "1234567890123", "B-1234567890123", "OK"),
        "boleta y factura 9": ("F", "9", "F-000000000009", "OK"),
        "FACTURA": ("F", None, "FACTURA", "SIN_NUMERO_BF"),
        "  ": (None, None, "", "VACIO"),
        None: (None, None, None, "VACIO"),
        "ÑF1": ("F", "1", "F-000000000001", "OK"),
        "xF1 12": (None, "12", "xF1 12", "OK"),
        "F1 linea\n": ("F", None, "F1 linea", "SIN_NUMERO_BF"),
        " 12 345678 y 9999999": (None, "345678", "12 345678 y 9999999", "OK"),
    }
    df = spark.createDataFrame([(i, v) for i, v in enumerate(cases)], "i int, v string")
    out = documents.canonical_document(df, "v").orderBy("i")
    got = [tuple(r) for r in out.select("doc_type", "doc_number", "doc_key", "doc_quality").collect()]
    assert got == list(cases.values())


def test_document_code_is_null_for_blank(spark):
    df = spark.createDataFrame([("  ",), ("B12",)], "v string")
    codes = {r.doc_code for r in documents.canonical_document(df, "v").collect()}
    assert codes == {None, "000000000012"}


def test_phones(spark):
    cases = {
        None: None, "null": None, "N/A": None, " - ": None, "abc": None, "12345678": None, "812345678": None,
        "912345678": "51912345678", "+51 912-345-678": "51912345678", "51912345678": "51912345678",
        "999999999": None, "51888888888": None, "51999999999": None, "519123456789": None,
    }
    assert [r[0] for r in one(spark, cases, contact.clean_phone("v"))] == list(cases.values())


def test_phone_key_is_lenient(spark):
    got = one(spark, ["+51 912 345 678", "912345678", "512", " 7 "], contact.phone_key("v"))
    assert [g[0] for g in got] == ["51912345678", "51912345678", "512", "517"]


def test_names(spark):
    cases = {
        None: ("", ""), "  ": ("", ""), "Ana": ("Ana", "Ana"), "Ana Paz": ("Ana", "Paz"), " Ana  Paz Ruiz ": ("Ana", "Paz Ruiz"),
        "Ana Luz Paz Ruiz": ("Ana Luz", "Paz Ruiz"), "a b c d e f": ("a b", "c d e f"),
    }
    assert one(spark, cases, *contact.split_name("v")) == list(cases.values())


def test_coordinates(spark):
    df = spark.createDataFrame(
        [("-12,04", "-77.1"), ("0", "-77"), ("nan", "1"), ("x", "1"), (None, "1"), ("-12.046412345", "0.00000001"),
         ("inf", "1"), ("1e1", " 2 ")], "a string, b string",
    )
    y, x = contact.clean_coords("a", "b")
    got = [tuple(r) for r in df.select(y.alias("y"), x.alias("x")).collect()]
    assert got == [(-12.04, -77.1)] + [(None, None)] * 6 + [(10.0, 2.0)]


def test_precision_nudges_short_values(spark):
    got = one(spark, ["-12.04", "-12.046", "5", None], contact.dispatch_precision(F.col("v").cast("double")))
    assert [g[0] for g in got] == [-12.039999, -12.046, 5.000001, None]


def test_geocode_text(spark):
    got = one(spark, ["Lince > Lima", "Lince", None], contact.geocode_text(F.lit(" Calle 1 "), "v", F.lit("Lima")))
    assert [g[0] for g in got] == ["Calle 1, Lince, Lima, PERU", "Calle 1, Lince, Lima, PERU", "Calle 1, , Lima, PERU"]


def test_hours(spark):
    got = one(spark, ["06:00", "07:59", "22:10", "23:00", "", None, "x1"], labels.hour_bucket("v"))
    assert [g[0] for g in got] == ["no identificado", "7:00 - 8:00", "22:00 - 23:00", "no identificado", "no identificado",
                                  None, "no identificado"]


def test_channel_changes_in_june_2024(spark):
    day = F.col("v").cast("timestamp_ntz")
    shown = labels.sales_channel(F.lit("2"), F.lit("1"), F.lit("1"), day)
    plan = labels.sales_channel(F.lit("1"), F.lit("7"), F.lit("1"), day, variant="plan")
    display = labels.sales_channel(F.lit("1"), F.lit("7"), F.lit("1"), day)
    got = one(spark, ["2024-05-31 23:59:59", "2024-06-01 00:00:00"], shown, plan, display)
    assert got == [("NO IDENTIFICADO", "NO IDENTIFICADO", "TIENDA"), ("VAD", "NO IDENTIFICADO", "TIENDA")]


def test_topics(spark):
    cases = ["Caja (Positivo), Envío (Muy (mal))", "sin nada", None, " (vacío)"]
    got = one(spark, cases, labels.topic("v", 0), labels.sentiment("v", 0), labels.topic("v", 1), labels.sentiment("v", 1),
              labels.topic("v", 2))
    assert got == [("Caja", "Positivo", "Envío", "Muy (mal)", None), (None,) * 5, (None,) * 5, ("", "vacío", None, None, None)]


def test_nps_class_scales(spark):
    score = F.col("v").cast("int")
    got = one(spark, ["11", "9", "1", "0", None], labels.nps_class(score), labels.nps_class(score, 1))
    assert [g[0] for g in got] == ["Promotor", "Neutro", "Detractor", "Sin Clasificación", "Sin Clasificación"]
    assert [g[1] for g in got][1:4] == ["Promotor", "Detractor", "Detractor"]


@pytest.mark.parametrize("as_of, slot", [("2024-01-01 13:20:00", 2), ("2024-01-01 09:59:00", 0), ("2024-01-01 19:00:00", 5)])
def test_slot_cut_off(as_of, slot):
    assert dates.last_open_slot(as_of) == slot


def test_slots_before_the_first_and_unknown(spark):
    slots = ["E1", "E2", "E3"]
    got = one(spark, ["E1", "E2", "E7", None], dates.slot_open("v", "2024-01-01 13:20:00", slots),
              dates.slot_open("v", "2024-01-01 08:00:00", slots))
    assert got == [(True, False), (True, False), (False, False), (None, False)]


def test_windows_are_open_and_half_open(spark):
    day = F.col("v").cast("timestamp_ntz")
    cases = ["2024-01-14 00:00:00", "2024-01-14 00:00:01", "2024-01-16 00:00:00", "2024-01-17 00:00:00"]
    got = one(spark, cases, dates.in_window(day, dt.datetime(2024, 1, 15, 13), -1, 2, from_open=True),
              dates.in_window(day, "2024-01-15", 1, 2))
    assert got == [(False, False), (True, False), (True, True), (False, False)]


def test_key_text_drops_float_fraction(spark):
    got = one(spark, [" 12.0 ", "12.50", "a.0", "7"], text.key_text("v"))
    assert [g[0] for g in got] == ["12", "12.50", "a.0", "7"]


def test_numbers(spark):
    got = one(spark, [" 7 ", "1.9", "x", "nan", None], dates.parse_number("v"), dates.parse_number("v", "bigint"))
    assert got == [(7.0, 7), (1.9, 1), (None, None), (None, None), (None, None)]


def test_hash_is_null_without_key_only(spark):
    got = one(spark, ["a", None], text.hash_of("v", F.lit("x"), required=1), text.hash_of(F.lit("x"), "v", required=1))
    assert got[1][0] is None and got[1][1] is not None


def test_last_characters_of_short_text(spark):
    assert [g[0] for g in one(spark, ["abc", "0123456789"], text.last_chars("v", 9))] == ["abc", "123456789"]
