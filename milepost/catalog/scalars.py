"""Scalar expressions and labels on the driver tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import contact, labels
from ..functions import fixed_values as fixed
from ..functions.dates import in_window, text_timestamp
from ..functions.text import (
    digits, extract_some, first_chars, first_word, hash_of, last_chars, null_if_blank, one_repeated_char,
    part_at, words,
)
from ..operators.joins import enrich
from ..operators.quality import valid_counts
from ..plans import survey
from ..sources.tables import conform
from .registry import query

MONTHS = "CASE month({0}) " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in fixed.MONTH_LABELS.items()) + " END"
DAYS = "CASE dayofweek({0}) + 1 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in fixed.WEEKDAY_LABELS.items()) + " END"


@query("period_labels", f"""
    SELECT o_orderkey, {MONTHS.format('o_orderdate')} AS mes_nombre_numero,
           {DAYS.format('o_orderdate')} AS dia_semana_ordenado, CAST(day(o_orderdate) AS INTEGER) AS cod_dia_trx,
           strftime(o_orderdate, '%Y-%m-%d') AS "Fecha_actualizacion",
           month(o_orderdate) || '' || year(o_orderdate) AS mesanioconcatenados,
           o_orderstatus || month(o_orderdate) || year(o_orderdate) AS llave_tienda_respuesta,
           o_orderpriority || month(o_orderdate) || year(o_orderdate) AS llave_canal_plan
    FROM orders
""")
def period_labels(t):
    out = survey.add_period_labels(t.orders, "o_orderdate", "o_orderdate")
    out = survey.add_period_keys(out, "o_orderdate", "o_orderstatus", "o_orderpriority")
    return out.select("o_orderkey", "mes_nombre_numero", "dia_semana_ordenado", "cod_dia_trx", "Fecha_actualizacion",
                      "mesanioconcatenados", "llave_tienda_respuesta", "llave_canal_plan")


@query("hour_bucket", """
    WITH e AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'x' || hour(ts) ELSE strftime(ts, '%H:%M')
                      END AS hora FROM events),
    h AS (SELECT *, TRY_CAST(trim(substr(hora, 1, 2)) AS INTEGER) AS n FROM e)
    SELECT event_id, n AS hora_extraida,
           CASE WHEN n BETWEEN 7 AND 22 THEN n || ':00 - ' || (n + 1) || ':00' WHEN hora IS NULL THEN NULL
                ELSE 'no identificado' END AS rango_horario
    FROM h
""")
def hour_bucket(t):
    e = t.events.select(
        "event_id",
        F.when(F.col("event_id") % 5 == 0, F.lit(None))
        .when(F.col("event_id") % 5 == 1, F.concat(F.lit("x"), F.hour("ts").cast("string")))
        .otherwise(F.date_format("ts", "HH:mm"))
        .alias("hora"),
    )
    return e.select("event_id", labels.hour_of_ticket("hora").alias("hora_extraida"),
                    labels.hour_bucket("hora").alias("rango_horario"))


_CHANNEL = """
    CASE WHEN tt = '8' THEN 'VENTA EMPRESA' WHEN tt IN ('2','3','5','11','12','15') OR te IN ('6','9') THEN 'VAD'
         WHEN tt = '1' AND te IN ({0}) THEN 'TIENDA' WHEN te = '5' AND pc = '9' AND tt IN ('1','10') THEN 'DEVOLUCIONES'
         ELSE 'NO IDENTIFICADO' END
"""


def channel_codes(t):
    """Store type, survey type and contact point of each order, answered 26 years after it."""
    k = F.col("o_orderkey")
    types = F.array(*[F.lit(x) for x in ("1", "8", "10", "2", "1", "7", "15", "1")])
    surveys = F.array(*[F.lit(x) for x in ("1", "5", "6", "7", "9")])
    return t.orders.select(
        "o_orderkey",
        F.get(types, k % 8).alias("tt"),
        F.get(surveys, k % 5).alias("te"),
        F.when(k % 3 != 0, "9").otherwise("2").alias("pc"),
        (F.col("o_orderdate") + F.expr("INTERVAL 26 YEARS")).alias("fecha"),
    )


@query("sales_channel", f"""
    WITH c AS (
      SELECT o_orderkey, ['1','8','10','2','1','7','15','1'][o_orderkey % 8 + 1] AS tt,
             ['1','5','6','7','9'][o_orderkey % 5 + 1] AS te, CASE WHEN o_orderkey % 3 <> 0 THEN '9' ELSE '2' END AS pc,
             o_orderdate + INTERVAL 26 YEAR AS fecha
      FROM orders)
    SELECT o_orderkey, fecha,
           CASE WHEN year(fecha) < 2024 OR (year(fecha) = 2024 AND month(fecha) < 6) THEN
                CASE tt WHEN '1' THEN 'TIENDA' WHEN '10' THEN 'DEVOLUCIONES' WHEN '8' THEN 'VENTA EMPRESA'
                        ELSE 'NO IDENTIFICADO' END
                ELSE {_CHANNEL.format("'1','7'")} END AS canal,
           {_CHANNEL.format("'1'")} AS canal_plan
    FROM c
""")
def sales_channel(t):
    codes = ("tt", "te", "pc", "fecha")
    return channel_codes(t).select(
        "o_orderkey", "fecha", labels.sales_channel(*codes).alias("canal"),
        labels.sales_channel(*codes, variant="plan").alias("canal_plan"),
    )


_TILLS = ", ".join(f"'{c}'" for c in fixed.SELF_SERVICE_TILL_CODES)
_TILLS_PADDED = ", ".join(f"'000{c}'" for c in fixed.SELF_SERVICE_TILL_CODES)


@query("till_class", f"""
    WITH o AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 4 = 0 THEN lpad(CAST(o_orderkey % 1000 AS VARCHAR), 6, '0')
                 || '77' ELSE (o_orderkey % 1000) || '123456' END AS doc FROM orders),
    r AS (SELECT l_orderkey, max(CASE WHEN s_suppkey IS NOT NULL THEN 1 ELSE 0 END) AS movil
          FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey AND l_linenumber = s_nationkey GROUP BY 1)
    SELECT o_orderkey, CASE WHEN movil = 1 THEN 'MPOS'
             WHEN left(doc, 3) IN ({_TILLS}) OR left(doc, 6) IN ({_TILLS_PADDED}) THEN 'Caja SCO'
             ELSE 'Caja Asistida' END AS "SCO_Trx"
    FROM o LEFT JOIN r ON o_orderkey = l_orderkey
""")
def till_class(t):
    k = F.col("o_orderkey")
    short = (k % 1000).cast("string")
    surveys = t.orders.select(
        "o_orderkey",
        F.when(k % 4 == 0, F.concat(F.lpad(short, 6, "0"), F.lit("77"))).otherwise(F.concat(short, F.lit("123456"))).alias(
            "doc"
        ),
    )
    report = t.lineitem.select(
        F.col("l_orderkey").alias("num_documento"), F.col("l_suppkey").alias("codigo_cajero"),
        F.col("l_linenumber").alias("sucursal"),
    )
    terminals = t.supplier.select(F.col("s_suppkey").alias("Terminales"), F.col("s_nationkey").alias("Cod"))
    mobile = (
        enrich(report, terminals.withColumn("movil", F.lit(True)), [("codigo_cajero", "Terminales"), ("sucursal", "Cod")],
               ["movil"])
        .groupBy("num_documento")
        .agg(F.max(F.coalesce("movil", F.lit(False))).alias("movil"))
    )
    out = enrich(surveys, mobile, [("o_orderkey", "num_documento")], ["movil"], spread=False)
    return out.select("o_orderkey", labels.till_class("doc", F.coalesce("movil", F.lit(False))).alias("SCO_Trx"))


def topic_text(t):
    """Zero to four ``topic (sentiment)`` items per part."""
    item = [
        F.concat("p_type", F.lit(" ("), "p_brand", F.lit(")")),
        F.concat(part_at("p_name", " ", 0), F.lit(" ("), F.col("p_size").cast("string"), F.lit(")")),
        F.concat(part_at("p_name", " ", 1), F.lit(" (x) (y)")),
        F.lit("sin sentimiento"),
    ]
    n = F.col("p_partkey") % 5
    text = F.array_join(F.slice(F.array(*item), F.lit(1), n.cast("int")), ", ")
    return t.part.select("p_partkey", F.when(n > 0, text).alias("topicos"))


_TOPICS = """
    tx AS (SELECT p_partkey, CASE WHEN p_partkey % 5 > 0 THEN array_to_string(
             [p_type || ' (' || p_brand || ')', split_part(p_name, ' ', 1) || ' (' || p_size || ')',
              split_part(p_name, ' ', 2) || ' (x) (y)', 'sin sentimiento'][1:p_partkey % 5], ', ') END AS topicos
           FROM part)
"""


def _topic_sql(item):
    return (
        f"CASE WHEN regexp_matches({item}, '^(.*?) \\(') THEN regexp_extract({item}, '^(.*?) \\(', 1) END",
        f"CASE WHEN regexp_matches({item}, '\\((.*?)\\)$') THEN regexp_extract({item}, '\\((.*?)\\)$', 1) END",
    )


@query("topic_sentiment", f"WITH {_TOPICS}, s AS (SELECT p_partkey, string_split(topicos, ', ') AS l FROM tx) "
       "SELECT p_partkey, " + ", ".join(
           f"{_topic_sql(f'l[{i}]')[0]} AS topico_{i}, {_topic_sql(f'l[{i}]')[1]} AS sentimento_{i}" for i in (1, 2, 3))
       + " FROM s")
def topic_sentiment(t):
    return survey.topic_sentiment(topic_text(t), "topicos").drop("topicos")


@query("topic_counts", f"WITH {_TOPICS}, s AS (SELECT unnest(string_split(topicos, ', ')) AS i FROM tx), "
       f"c AS (SELECT {_topic_sql('i')[0]} AS topico, {_topic_sql('i')[1]} AS sentimiento FROM s) "
       "SELECT topico, sentimiento, count(*) AS menciones FROM c GROUP BY ALL")
def topic_counts(t):
    return survey.topic_counts(survey.explode_topics(topic_text(t), "topicos", ["p_partkey"]))


@query("translate_status", """
    SELECT event_id, CASE event_type WHEN 'click' THEN 'Creado' WHEN 'purchase' THEN 'Completado'
             WHEN 'error' THEN 'Cancelado' END AS estado,
           CASE event_type WHEN 'click' THEN 'Cargado por el Proveedor' ELSE event_type END AS presupuesto,
           CASE event_type WHEN 'view' THEN 'Pendiente' WHEN 'signup' THEN 'Aprobado' END AS pago
    FROM events
""")
def translate_status(t):
    codes = F.col("event_type")
    state = labels.translate(codes, {"click": "created", "purchase": "done", "error": "cancelled"})
    pay = labels.translate(codes, {"view": "pending", "signup": "approved"})
    budget = labels.translate(codes, {"click": "created"}, keep_unknown=True)
    return t.events.select(
        "event_id",
        labels.translate(state, fixed.BOOKING_STATES).alias("estado"),
        labels.translate(budget, fixed.BUDGET_STATES, keep_unknown=True).alias("presupuesto"),
        labels.translate(pay, fixed.PAYMENT_STATES).alias("pago"),
    )


def _phone_text(key):
    """Phone text of a customer in eleven shapes."""
    eight = F.lpad(((key * 7919 + 13) % 100000000).cast("string"), 8, "0")
    shapes = [
        F.concat(F.lit("9"), eight), F.concat(F.lit("+51 9"), eight), F.concat(F.lit("519"), eight),
        F.concat(F.lit("(9)-"), eight), eight, F.lit("NULL"), F.lit(" - "), F.lit("999999999"), F.lit("51888888888"),
        F.lit(None).cast("string"), F.concat(F.lit("8"), eight),
    ]
    out = None
    for i, c in enumerate(shapes):
        out = F.when(key % 11 == i, c) if out is None else out.when(key % 11 == i, c)
    return out


_PHONES = """
    fono AS (SELECT c_custkey, lpad(CAST((c_custkey * 7919 + 13) % 100000000 AS VARCHAR), 8, '0') AS n8 FROM customer),
    tel AS (SELECT c_custkey, CASE c_custkey % 11 WHEN 0 THEN '9' || n8 WHEN 1 THEN '+51 9' || n8 WHEN 2 THEN '519' || n8
              WHEN 3 THEN '(9)-' || n8 WHEN 4 THEN n8 WHEN 5 THEN 'NULL' WHEN 6 THEN ' - ' WHEN 7 THEN '999999999'
              WHEN 8 THEN '51888888888' WHEN 9 THEN NULL ELSE '8' || n8 END AS fono FROM fono),
    lim AS (SELECT *, regexp_replace(fono, '[^0-9]', '', 'g') AS d FROM tel),
    lleno AS (SELECT *, CASE WHEN length(d) = 9 AND d LIKE '9%' THEN '51' || d ELSE d END AS f FROM lim),
    limpio AS (SELECT c_custkey, fono, CASE WHEN lower(trim(fono)) IN ('', 'null', 'none', 'nan', 'n/a', '-') THEN NULL
                 WHEN NOT regexp_full_match(f, '519\\d{8}') THEN NULL
                 WHEN f IN ('51999999999', '51888888888', '51777777777') THEN NULL
                 WHEN length(replace(substr(f, 3), substr(f, 3, 1), '')) = 0 THEN NULL ELSE f END AS telefono
               FROM lleno)
"""


@query("clean_phones", f"WITH {_PHONES} SELECT c_custkey, fono, telefono FROM limpio")
def clean_phones(t):
    out = t.customer.select("c_custkey", _phone_text(F.col("c_custkey")).alias("fono"))
    return out.withColumn("telefono", contact.clean_phone("fono"))


@query("phone_counts", f"WITH {_PHONES} SELECT telefono IS NOT NULL AS valido, count(*) AS filas FROM limpio GROUP BY 1")
def phone_counts(t):
    fono = t.customer.select(_phone_text(F.col("c_custkey")).alias("fono"))
    return valid_counts(fono, contact.clean_phone("fono").isNotNull())


@query("phone_key", f"""
    WITH {_PHONES}, b AS (SELECT c_custkey, trim(replace(replace(fono, '+', ''), ' ', '')) AS x FROM tel)
    SELECT c_custkey, CASE WHEN x LIKE '51%' THEN x ELSE '51' || x END AS clave FROM b
""")
def phone_key(t):
    return t.customer.select("c_custkey", contact.phone_key(_phone_text(F.col("c_custkey"))).alias("clave"))


@query("clean_coords", """
    WITH c AS (SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN '0' WHEN 1 THEN replace(CAST(-c_acctbal / 1000 AS VARCHAR), '.', ',')
                 WHEN 2 THEN 'sin dato' WHEN 3 THEN ' -12.5 ' WHEN 4 THEN NULL ELSE CAST(c_acctbal / -997 AS VARCHAR) END AS la,
               CASE WHEN c_custkey % 7 = 0 THEN '0.0' WHEN c_custkey % 7 = 1 THEN 'nan' ELSE '-77,0428' END AS lo FROM customer),
    n AS (SELECT c_custkey, la, lo, round(TRY_CAST(trim(replace(la, ',', '.')) AS DOUBLE), 7) AS y,
                 round(TRY_CAST(trim(replace(lo, ',', '.')) AS DOUBLE), 7) AS x FROM c),
    k AS (SELECT c_custkey, la, lo, CASE WHEN y <> 0 AND x <> 0 AND NOT isnan(x) AND NOT isnan(y) THEN y END AS y,
                 CASE WHEN y <> 0 AND x <> 0 AND NOT isnan(x) AND NOT isnan(y) THEN x END AS x FROM n)
    SELECT c_custkey, round(CASE WHEN round(y, 2) = y THEN y + 0.000001 ELSE y END, 6) AS lat,
           round(CASE WHEN round(x, 2) = x THEN x + 0.000001 ELSE x END, 6) AS lng,
           la IS NULL OR lo IS NULL OR trim(la) IN ('', '0', '0.0') OR trim(lo) IN ('', '0', '0.0') AS falta
    FROM k
""")
def clean_coords(t):
    k, bal = F.col("c_custkey"), F.col("c_acctbal")
    la = (
        F.when(k % 6 == 0, "0").when(k % 6 == 1, F.translate((-bal / 1000).cast("string"), ".", ","))
        .when(k % 6 == 2, "sin dato").when(k % 6 == 3, " -12.5 ").when(k % 6 == 4, F.lit(None))
        .otherwise((bal / -997).cast("string"))
    )
    lo = F.when(k % 7 == 0, "0.0").when(k % 7 == 1, "nan").otherwise("-77,0428")
    c = t.customer.select("c_custkey", la.alias("la"), lo.alias("lo"))
    y, x = contact.clean_coords("la", "lo")
    c = c.withColumns({"y": y, "x": x})
    return c.select("c_custkey", contact.dispatch_precision("y").alias("lat"), contact.dispatch_precision("x").alias("lng"),
                    contact.missing_coord("la", "lo").alias("falta"))


def _name_sql(table, key, text, prefix):
    w = "list_filter(regexp_split_to_array({0}, '\\s+'), lambda x: x <> '')".format(text)
    return f"""
      SELECT '{prefix}' || {key} AS id,
             CASE WHEN n = 0 THEN '' WHEN n >= 4 THEN array_to_string(w[1:2], ' ') ELSE w[1] END AS nombre,
             CASE WHEN n = 0 THEN '' WHEN n = 1 THEN w[1] WHEN n >= 4 THEN array_to_string(w[3:], ' ')
                  ELSE array_to_string(w[2:], ' ') END AS apellido, CAST(n AS INTEGER) AS palabras
      FROM (SELECT {key}, w, coalesce(len(w), 0) AS n FROM (SELECT {key}, {w} AS w FROM {table}))
    """


@query("split_names", " UNION ALL ".join([
    _name_sql("part", "p_partkey", "p_name", "p"),
    _name_sql("(SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN '  ' ELSE c_name || "
              "repeat(' x' || c_nationkey, CAST(c_custkey % 4 AS INTEGER)) END AS n FROM customer)", "c_custkey", "n", "c"),
    _name_sql("documents", "doc_id", "text", "d"),
]))
def split_names(t):
    k = F.col("c_custkey")
    tail = F.repeat(F.concat(F.lit(" x"), F.col("c_nationkey").cast("string")), (k % 4).cast("int"))
    customers = F.when(k % 4 == 0, F.lit(None)).when(k % 4 == 1, "  ").otherwise(F.concat("c_name", tail))
    every = (
        t.part.select(F.concat(F.lit("p"), F.col("p_partkey")).alias("id"), F.col("p_name").alias("n"))
        .unionByName(t.customer.select(F.concat(F.lit("c"), k).alias("id"), customers.alias("n")))
        .unionByName(t.documents.select(F.concat(F.lit("d"), F.col("doc_id")).alias("id"), F.col("text").alias("n")))
    )
    first, last = contact.split_name("n")
    return every.select("id", first.alias("nombre"), last.alias("apellido"),
                        F.coalesce(F.size(words("n")), F.lit(0)).alias("palabras"))


@query("conform", """
    SELECT doc_id, coalesce(lang, '') AS lang,
           coalesce(TRY_CAST(CAST(TRY_CAST(regexp_extract(text, '^[^ ]+') AS DOUBLE) AS BIGINT) AS BIGINT), 0) AS primera,
           TRY_CAST(replace(source, 'src', '') AS DOUBLE) AS fuente,
           TRY_CAST('2024-01-' || replace(source, 'src', '') AS TIMESTAMP) AS fecha, '' AS ausente
    FROM documents
""")
def conformed(t):
    number = F.regexp_replace("source", "src", "")
    raw = t.documents.select(
        "doc_id", "lang", F.regexp_extract("text", "^[^ ]+", 0).alias("primera"), number.alias("fuente"),
        F.concat(F.lit("2024-01-"), number).alias("fecha"),
    )
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType()),
        T.StructField("primera", T.LongType()), T.StructField("fuente", T.DoubleType()),
        T.StructField("fecha", T.TimestampNTZType()), T.StructField("ausente", T.StringType()),
    ])
    return conform(raw, schema)


@query("scalar_text", """
    SELECT doc_id, nullif(regexp_extract(text, '([0-9]+)', 1), '') AS primer_numero,
           regexp_matches(text, '\\b[A-Z][a-z]+\\b') AS tiene_palabra, length(regexp_replace(text, '[^0-9]', '', 'g')) AS digitos,
           string_split(text, ', ')[2] AS segunda, right(text, 9) AS cola, left(text, 2) AS cabeza,
           lpad(source, 4, '0') AS corta, upper(lang) AS idioma, lang || '/' || source AS clave,
           nullif(trim(left(text, 1)), '') AS inicial,
           list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')[1] AS palabra,
           length(replace(source, left(source, 1), '')) = 0 AS repetido
    FROM documents
""")
def scalar_text(t):
    return t.documents.select(
        "doc_id",
        extract_some("text", "([0-9]+)").alias("primer_numero"),
        F.col("text").rlike(r"(?<![A-Za-z0-9_])[A-Z][a-z]+(?![A-Za-z0-9_])").alias("tiene_palabra"),
        F.length(digits("text")).cast("bigint").alias("digitos"),
        part_at("text", ", ", 1).alias("segunda"),
        last_chars("text", 9).alias("cola"),
        first_chars("text", 2).alias("cabeza"),
        F.lpad("source", 4, "0").alias("corta"),
        F.upper("lang").alias("idioma"),
        F.concat("lang", F.lit("/"), "source").alias("clave"),
        null_if_blank(first_chars("text", 1)).alias("inicial"),
        first_word("text").alias("palabra"),
        one_repeated_char("source").alias("repetido"),
    )


@query("scalar_case_date", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'fin' WHEN o_totalprice > 250000 THEN 'alto' ELSE 'otro' END AS caso,
           TRY_CAST(left(o_orderpriority, 1) AS BIGINT) AS prioridad, TRY_CAST(o_orderstatus AS BIGINT) AS malo,
           CAST(year(o_orderdate) AS INTEGER) AS anio, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS dia_semana,
           strftime(o_orderdate, '%d-%m-%Y %H:%M') AS texto, floor(o_totalprice / 1000) AS miles,
           CAST(o_orderdate AS DATE) - INTERVAL 4 DAY >= DATE '1998-06-11' AS reciente,
           coalesce(nullif(CASE WHEN o_orderkey % 2 = 0 THEN ' ' ELSE o_orderstatus END, ' '), '-') AS relleno,
           o_orderstatus IN ('F', 'O') AS en_lista
    FROM orders
""")
def scalar_case_date(t):
    status = F.when(F.col("o_orderkey") % 2 == 0, " ").otherwise(F.col("o_orderstatus"))
    return t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "fin").when(F.col("o_totalprice") > 250000, "alto").otherwise("otro").alias(
            "caso"
        ),
        first_chars("o_orderpriority", 1).try_cast("bigint").alias("prioridad"),
        F.col("o_orderstatus").try_cast("bigint").alias("malo"),
        F.year("o_orderdate").alias("anio"),
        F.dayofweek("o_orderdate").alias("dia_semana"),
        text_timestamp("o_orderdate").alias("texto"),
        F.floor(F.col("o_totalprice") / 1000).cast("double").alias("miles"),
        in_window("o_orderdate", "1998-06-15", 0, None).alias("reciente"),
        F.coalesce(null_if_blank(status), F.lit("-")).alias("relleno"),
        F.col("o_orderstatus").isin("F", "O").alias("en_lista"),
    )


@query("scalar_round_json_hash", """
    SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k, '{"v":' || CAST(props ->> '$.k' AS BIGINT) || ',"n":null}' AS doc,
           md5(event_id || event_type || coalesce(CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END || '', '')) AS huella,
           round(value, 1) AS redondo
    FROM events
""")
def scalar_round_json_hash(t):
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return t.events.select(
        "event_id",
        k.alias("k"),
        F.to_json(F.struct(k.alias("v"), F.lit(None).cast("string").alias("n")), {"ignoreNullFields": "false"}).alias("doc"),
        hash_of("event_id", "event_type", F.when(F.col("event_id") % 3 != 0, F.col("user_id")), required=1).alias("huella"),
        F.round("value", 1).alias("redondo"),
    )
