"""Location capture on the driver tables."""

from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..operators.joins import enrich
from ..plans import tracker
from .registry import query
from .services import pick, text

AS_OF = "2024-01-15 18:30:00"
_DISTRICTS = ["VILLA EL SALVADOR", "LURIN", "COMAS", "OTRO", "ANCON"]


def header(t):
    out = enrich(t.orders, t.customer, [("o_custkey", "c_custkey")], ["c_acctbal", "c_nationkey", "c_name"], expect="unique")
    return out.select(
        F.col("o_orderkey").alias("NUM_RESERVA"),
        pick(_DISTRICTS, F.col("c_nationkey") % 5).alias("COMUNA_DESP"),
        F.col("c_name").alias("NOMBRE_CLI"),
        pick(["-12.04", "0", " 0.0 ", None, " "], F.col("o_orderkey") % 5).alias("LATITUD"),
        F.when(F.col("c_acctbal") > 3000, "-77.1").otherwise("0").alias("LONGITUD"),
    )


@query("lines_without_coords", """
    SELECT l_orderkey || '_' || l_partkey AS "KEY", l_orderkey AS "NUM_RESERVA", l_shipdate AS "FECHA_DESPACHO",
           ['VILLA EL SALVADOR', 'LURIN', 'COMAS', 'OTRO', 'ANCON'][c_nationkey % 5 + 1] AS "COMUNA_DESP",
           TIMESTAMP '1998-06-14 09:00:00' AS "FECHA_PROCESO"
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    WHERE l_returnflag IN ('A', 'R') AND c_nationkey % 5 <> 3 AND NOT (o_orderkey % 5 = 0 AND c_acctbal > 3000)
      AND l_shipdate >= TIMESTAMP '1998-06-15' AND l_shipdate < TIMESTAMP '1998-06-16'
""")
def without_coords(t):
    detail = t.lineitem.select(
        F.col("l_orderkey").alias("NUM_RESERVA"), F.col("l_partkey").alias("PRD_LVL_NUMBER"),
        F.when(F.col("l_returnflag") == "N", 10).otherwise(97).alias("CC_ORIGEN"),
        F.col("l_shipdate").alias("FECHA_DESPACHO"),
    )
    out = tracker.lines_without_coords(detail, header(t), "1998-06-14 09:00:00.5")
    return out.select("KEY", "NUM_RESERVA", "FECHA_DESPACHO", "COMUNA_DESP", "FECHA_PROCESO")


def lines(t):
    """Reservation lines with a client phone in several shapes."""
    out = enrich(t.lineitem, t.orders, [("l_orderkey", "o_orderkey")], ["o_custkey", "o_orderpriority"], expect="unique")
    phone = pick(["9", "+51 9", "8", "n/a"], F.col("o_custkey") % 4)
    digits = F.lpad(text("o_custkey"), 8, "4")
    return out.select(
        text("l_orderkey").alias("NUM_RESERVA"),
        F.concat(text("l_orderkey"), F.lit("_"), text("l_partkey"), F.lit("_"), text("l_suppkey"), F.lit("_"),
                 text("l_linenumber")).alias("KEY"),
        F.col("l_shipdate").alias("FECHA_PROCESO"),
        F.when(phone == "n/a", phone).otherwise(F.concat(phone, digits)).alias("FONO_CLI"),
        F.when(F.col("l_linenumber") == 1, F.lit(None)).otherwise(
            F.concat(F.lit(" Ana"), text("l_linenumber"), F.lit(" Paz"))
        ).alias("NOMBRE_CLI"),
        F.concat(F.lit("R"), F.substring("o_orderpriority", 1, 1)).alias("REGION_DESP"),
        text("o_custkey").alias("CIUDAD_DESP"),
        F.col("o_orderpriority").alias("COMUNA_DESP"),
        F.lit("Calle").alias("DIRECCION_DESP"),
    )


def coords(t):
    return t.customer.select(
        F.concat(F.lit("c"), text("c_custkey")).alias("NUM_RESERVA"),
        F.concat(F.lit("519"), F.lpad(text("c_custkey"), 8, "4")).alias("FONO_CLI"),
        F.col("c_mktsegment").alias("NOMBRE"),
        F.when(F.col("c_acctbal") < 5000, fixed.STATE_NO_ANSWER).otherwise(fixed.STATE_FOUND).alias("ESTADO"),
        F.col("c_nationkey").cast("bigint").alias("INTENTOS"),
    )


def sends(t):
    """Messages of the day for some customers, and older ones for finished orders."""
    today = t.events.filter(F.col("event_type") == "error").select(
        F.concat(F.lit("c"), text("user_id")).alias("NUM_RESERVA"), F.col("ts").alias("FECHA_ENVIO")
    )
    older = t.orders.filter(F.col("o_orderstatus") == "F").select(
        text("o_orderkey").alias("NUM_RESERVA"), F.col("o_orderdate").alias("FECHA_ENVIO")
    )
    return today.unionByName(older)


_QUEUE = """
    l AS (
      SELECT CAST(l_orderkey AS VARCHAR) AS r, l_shipdate AS f,
        l_orderkey || '_' || l_partkey || '_' || l_suppkey || '_' || l_linenumber AS k, l_linenumber AS n,
        ['9', '519', '8', NULL][o_custkey % 4 + 1] || lpad(CAST(o_custkey AS VARCHAR), 8, '4') AS d
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'F'),
    p AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY r ORDER BY f, k) = 1),
    c AS (
      SELECT r, CASE WHEN n = 1 THEN 'CLIENTE' ELSE 'Ana' || n END AS nombre, d, CAST(NULL AS BIGINT) AS intentos FROM p
      UNION ALL
      SELECT 'c' || c_custkey, c_mktsegment, '519' || lpad(CAST(c_custkey AS VARCHAR), 8, '4'), c_nationkey FROM customer
      WHERE c_acctbal < 5000 AND EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey AND event_type = 'error'
        AND ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16')),
    q AS (
      SELECT *, CASE WHEN length(d) = 9 AND d LIKE '9%' THEN '51' || d WHEN d LIKE '519%' AND length(d) = 11 THEN d END AS tel
      FROM c)
"""


@query("message_queue", f"""
    WITH {_QUEUE} SELECT r AS "NUM_RESERVA", tel AS "FONO_CLI", nombre AS "NOMBRE", nombre || '-' || r AS "PARAMETROS",
      intentos AS "INTENTOS" FROM q WHERE tel IS NOT NULL
""")
def queue(t):
    return tracker.message_queue(lines(t), coords(t), sends(t), AS_OF)[0]


@query("message_rejects", f'WITH {_QUEUE} SELECT r AS "NUM_RESERVA" FROM q WHERE tel IS NULL')
def rejects(t):
    return tracker.message_queue(lines(t), coords(t), sends(t), AS_OF)[1].select("NUM_RESERVA")


def capture_sends(t):
    """Two sends per order, the second with a padded key, on the day for most orders, an older day for the rest."""
    day = F.when(F.col("o_orderstatus") == "P", F.expr("timestamp_ntz'2024-01-14 12:00:00'")).otherwise(
        F.expr("timestamp_ntz'2024-01-15 00:30:00'")
    )
    one = t.orders.select(
        text("o_orderkey").alias("NUM_RESERVA"),
        F.concat(F.lit("+51 9"), text("o_custkey")).alias("FONO_CLI"),
        F.col("o_orderpriority").alias("NOMBRE"),
        day.alias("FECHA_ENVIO"),
    )
    later = one.withColumns({
        "FECHA_ENVIO": F.col("FECHA_ENVIO") + F.expr("INTERVAL 2 HOURS"),
        "NOMBRE": F.lower("NOMBRE"),
        "NUM_RESERVA": F.concat(F.lit(" "), "NUM_RESERVA", F.lit(" ")),
    })
    return one.unionByName(later)


def capture_state(t):
    o = t.orders.filter(F.col("o_orderpriority") != "5-LOW")
    return o.select(
        text("o_orderkey").alias("NUM_RESERVA"), F.concat(F.lit("519"), text("o_custkey")).alias("FONO_CLI"),
        F.col("o_orderpriority").alias("NOMBRE"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "-1").alias("LATITUD"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "-2").alias("LONGITUD"),
        F.lit(None).cast("string").alias("FECHA_COORDENADA"),
        F.col("o_orderdate").alias("FECHA_PROCESO"),
        F.when(F.col("o_orderpriority") == "1-URGENT", fixed.STATE_FOUND).otherwise(fixed.STATE_NO_ANSWER).alias("ESTADO"),
        F.col("o_orderkey").alias("INTENTOS"),
    )


def feed(t):
    return t.events.select(
        F.concat(F.lit("519"), text("user_id")).alias("clientUid"),
        F.when(F.col("event_type") != "error", F.concat(F.lit("-"), text("value"))).otherwise("").alias("latitud"),
        text("event_id").alias("longitud"),
        F.date_format("ts", "yyyy-MM-dd HH").alias("fecha"),
        F.col("event_id").alias("posicion"),
    )


CAPTURE = """
    pt AS (SELECT '519' || user_id AS tel, '-' || CAST(value AS VARCHAR) AS la, CAST(event_id AS VARCHAR) AS lo,
                  strftime(ts, '%Y-%m-%d %H') AS f
           FROM events WHERE event_type <> 'error'
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY strftime(ts, '%Y-%m-%d %H') DESC, event_id) = 1),
    m AS (
      SELECT CAST(o_orderkey AS VARCHAR) AS r, '519' || o_custkey AS tel, lower(o_orderpriority) AS nombre, la, lo, f,
        CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE o_orderkey END + 1 AS intentos
      FROM orders LEFT JOIN pt ON tel = '519' || o_custkey
      WHERE o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT')
"""


@query("match_coordinates", f"""
    WITH {CAPTURE} SELECT r AS "NUM_RESERVA", tel AS "FONO_CLI", nombre AS "NOMBRE", la AS "LATITUD", lo AS "LONGITUD",
      f AS "FECHA_COORDENADA", TIMESTAMP '2024-01-15 18:30:00' AS "FECHA_PROCESO",
      CASE WHEN la IS NULL THEN 'SIN_RESPUESTA' ELSE 'ENCONTRADA' END AS "ESTADO", intentos AS "INTENTOS" FROM m
""")
def match(t):
    return tracker.match_coordinates(capture_sends(t), capture_state(t), feed(t), AS_OF)


@query("capture", f"""
    WITH {CAPTURE},
    s AS (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW')
    SELECT coalesce(r, CAST(o_orderkey AS VARCHAR)) AS "NUM_RESERVA",
      CASE WHEN r IS NULL THEN '519' || o_custkey ELSE tel END AS "FONO_CLI", coalesce(nombre, o_orderpriority) AS "NOMBRE",
      CASE WHEN r IS NULL THEN CASE WHEN o_orderpriority = '1-URGENT' THEN '-1' END ELSE la END AS "LATITUD",
      CASE WHEN r IS NULL THEN CASE WHEN o_orderpriority = '1-URGENT' THEN '-2' END ELSE lo END AS "LONGITUD",
      CASE WHEN r IS NOT NULL THEN f END AS "FECHA_COORDENADA",
      CASE WHEN r IS NULL THEN o_orderdate ELSE TIMESTAMP '2024-01-15 18:30:00' END AS "FECHA_PROCESO",
      CASE WHEN r IS NULL THEN CASE WHEN o_orderpriority = '1-URGENT' THEN 'ENCONTRADA' ELSE 'SIN_RESPUESTA' END
           WHEN la IS NULL THEN 'SIN_RESPUESTA' ELSE 'ENCONTRADA' END AS "ESTADO",
      coalesce(intentos, o_orderkey) AS "INTENTOS"
    FROM s FULL JOIN m ON r = CAST(o_orderkey AS VARCHAR)
""")
def capture(t):
    return tracker.capture(capture_sends(t), capture_state(t), feed(t), AS_OF)


@query("new_alerts", """
    WITH c AS (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS r, o_orderpriority, o_custkey, o_orderdate FROM orders
               WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'O')
    SELECT r AS "NUM_RESERVA", o_orderpriority AS "NOMBRE", '519' || o_custkey AS "FONO_CLI",
      CASE WHEN e THEN 'R1' END AS "REGION_DESP", CASE WHEN e THEN CAST(o_custkey AS VARCHAR) END AS "CIUDAD_DESP",
      CASE WHEN e THEN '1-URGENT' END AS "COMUNA_DESP", CASE WHEN e THEN 'Calle' END AS "DIRECCION_DESP",
      '-1' AS "LATITUD", '-2' AS "LONGITUD", CAST(NULL AS VARCHAR) AS "FECHA_COORDENADA",
      o_orderdate AS "FECHA_PROCESO", TIMESTAMP '2024-01-15 18:30:00' AS "FECHA_ALERTA"
    FROM (SELECT *, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) AS e FROM c)
""")
def alerts(t):
    known = t.orders.filter(F.col("o_orderstatus") == "O").select(
        F.concat(F.lit(" "), text("o_orderkey"), F.lit(" ")).alias("NUM_RESERVA")
    )
    return tracker.new_alerts(capture_state(t), lines(t), known, AS_OF)
