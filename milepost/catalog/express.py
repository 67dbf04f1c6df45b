"""Express pipeline on the driver tables."""

from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..operators.joins import enrich, not_in_history
from ..plans import express
from ..session import scratch_path
from ..sources.schemas import TRACKING
from .registry import query
from .services import pick, text

AS_OF = "1998-06-15 19:20:00"


def detail(t):
    return t.lineitem.select(
        F.col("l_orderkey").alias("NUM_RESERVA"),
        F.col("l_linenumber").alias("NUM_DETALLE"),
        F.col("l_partkey").alias("PRD_LVL_NUMBER"),
        F.concat(F.lit("P "), text("l_suppkey")).alias("PRD_NAME_FULL"),
        F.col("l_quantity").alias("CANTIDAD"),
        F.col("l_extendedprice").alias("PRECIO"),
        F.when(F.col("l_returnflag") == "R", 97).otherwise(10).alias("CC_ORIGEN"),
        F.col("l_suppkey").alias("CC_DESPACHA"),
        F.concat(F.lit("E"), text("l_linenumber")).alias("RANGO_HORARIO"),
        F.lit("S").alias("EXPRESS"),
        F.col("l_shipdate").alias("FECHA_ENTREGA_ORI"),
    )


def events(t):
    """Prepared, reserved and blocked events of the lines, in one pass over them."""
    codes = F.array(
        F.struct(F.lit(fixed.EVENT_PREPARED).alias("c"), F.when(F.col("l_quantity") > 5, F.col("l_shipdate")).alias("d")),
        F.struct(F.when(F.col("l_tax") > 0.03, fixed.EVENT_RESERVED).alias("c"), F.col("l_shipdate").alias("d")),
        F.struct(F.when(F.col("l_discount") > 0.08, fixed.EVENT_BLOCKED).alias("c"), F.col("l_shipdate").alias("d")),
        F.struct(F.lit(fixed.EVENT_EN_ROUTE).alias("c"), F.when(F.col("l_quantity") > 48, F.col("l_shipdate")).alias("d")),
    )
    out = t.lineitem.select("l_orderkey", "l_linenumber", F.inline(codes))
    return out.filter(F.col("c").isNotNull()).select(
        F.col("l_orderkey").alias("NUM_RESERVA"), F.col("l_linenumber").alias("NUM_DETALLE"),
        F.col("c").alias("COD_ESTADO"), F.col("d").alias("FECHA_EVENTO"),
    )


def header(t):
    out = enrich(t.orders, t.customer, [("o_custkey", "c_custkey")], ["c_name", "c_acctbal", "c_nationkey", "c_mktsegment"], expect="unique")
    return out.select(
        F.col("o_orderkey").alias("NUM_RESERVA"),
        F.col("c_name").alias("NOMBRE_CLI"),
        F.concat(F.lit("9"), text("o_custkey")).alias("FONO_CLI"),
        text("c_nationkey").alias("REGION_CLI"),
        F.col("c_mktsegment").alias("CIUDAD_CLI"),
        F.col("o_orderpriority").alias("COMUNA_CLI"),
        F.concat(F.lit("Calle "), text("o_custkey")).alias("DIRECCION_CLI"),
        text("c_acctbal").alias("LATITUD"),
        F.when(F.col("o_orderstatus") != "P", "-77.1").alias("LONGITUD"),
    )


@query("express_lines", """
    WITH e AS (
      SELECT l_orderkey AS r, l_linenumber AS n, max(CASE WHEN l_quantity > 5 THEN l_shipdate END) AS prep,
             max(CASE WHEN l_tax > 0.03 THEN l_shipdate END) AS res, bool_or(l_discount > 0.08 OR l_quantity > 48) AS malo
      FROM lineitem GROUP BY 1, 2)
    SELECT CAST(l_orderkey AS VARCHAR) AS "NUM_RESERVA", l_orderkey || '_' || l_partkey AS "KEY",
           'E' || l_linenumber AS "RANGO_HORARIO", l_quantity AS "CANTIDAD", l_shipdate AS "FECHA_ENTREGA_ORI",
           CAST(110 AS BIGINT) AS "COD_EVENTO_PT", strftime(prep, '%d-%m-%Y %H:%M') AS "FECHA_PREPARADO_TIENDA",
           CASE WHEN res IS NOT NULL THEN '9' ELSE '' END AS "COD_EVENTO_RB",
           coalesce(strftime(res, '%d-%m-%Y %H:%M'), '') AS "FECHA_RESERVADO_BODEGA", coalesce(c_name, '') AS "NOMBRE_CLI",
           l_suppkey AS "CC_DESPACHA", TIMESTAMP '1998-06-15 19:20:00' AS "FECHA_PROCESO"
    FROM lineitem JOIN e ON r = l_orderkey AND n = l_linenumber LEFT JOIN orders ON o_orderkey = l_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey
    WHERE l_shipdate > TIMESTAMP '1998-06-14' AND l_shipdate < TIMESTAMP '1998-06-17' AND l_returnflag <> 'R'
      AND l_linenumber <= 5 AND prep IS NOT NULL AND NOT malo
""")
def lines(t):
    out = express.express_lines(detail(t), header(t), events(t), AS_OF)
    return out.select(
        "NUM_RESERVA", "KEY", "RANGO_HORARIO", "CANTIDAD", "FECHA_ENTREGA_ORI", "COD_EVENTO_PT", "FECHA_PREPARADO_TIENDA",
        "COD_EVENTO_RB", "FECHA_RESERVADO_BODEGA", "NOMBRE_CLI", "CC_DESPACHA", "FECHA_PROCESO",
    )


_ORDER = ["FECHA_PROCESO", "KEY", "l_linenumber", "CANTIDAD", "PRECIO"]


def order_lines(t):
    return enrich(t.lineitem, t.part, [("l_partkey", "p_partkey")], ["p_name"], expect="unique").select(
        text("l_orderkey").alias("NUM_RESERVA"), F.col("l_shipdate").alias("FECHA_PROCESO"),
        F.concat(text("l_orderkey"), F.lit("_"), text("l_partkey")).alias("KEY"), "l_linenumber",
        F.col("l_quantity").alias("CANTIDAD"), F.col("l_extendedprice").alias("PRECIO"),
        F.col("l_suppkey").alias("CC_DESPACHA"), F.col("p_name").alias("DIRECCION_CLI"),
        F.col("l_partkey").alias("PRD_LVL_NUMBER"), F.col("p_name").alias("PRD_NAME_FULL"),
    )


@query("consolidate_orders", """
    WITH l AS (
      SELECT l_orderkey AS r, l_shipdate AS f, l_orderkey || '_' || l_partkey AS k, l_linenumber AS n, l_quantity AS q,
             l_extendedprice AS p, l_suppkey AS s, trim(p_name) AS nombre, l_partkey
      FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)
    SELECT CAST(r AS VARCHAR) AS "NUM_RESERVA",
           CAST(sum(CAST(q AS DECIMAL(18,4)) * CAST(p AS DECIMAL(18,4))) AS DOUBLE) AS "TOTAL", count(*) AS "LINEAS",
           first(s ORDER BY f, k, n, q, p) AS "CC_DESPACHA", first(nombre ORDER BY f, k, n, q, p) AS "DIRECCION_CLI",
           false AS "ENVIADO"
    FROM l GROUP BY r
""")
def orders(t):
    out = express.consolidate_orders(order_lines(t), AS_OF, order_by=_ORDER, attributes=["CC_DESPACHA", "DIRECCION_CLI"])
    return out.select("NUM_RESERVA", "TOTAL", "LINEAS", "CC_DESPACHA", "DIRECCION_CLI", "ENVIADO")


@query("order_products", """
    SELECT CAST(l_orderkey AS VARCHAR) AS "NUM_RESERVA", l_shipdate AS "ORDEN_1", l_orderkey || '_' || l_partkey AS "ORDEN_2",
           l_linenumber AS "ORDEN_3", CAST(l_partkey AS VARCHAR) AS sku, trim(p_name) AS nombre,
           CAST(l_quantity AS DOUBLE) AS cantidad, CAST(l_extendedprice AS DOUBLE) AS precio
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
""")
def products(t):
    return express.order_products(order_lines(t), order_by=_ORDER[:3])


@query("nest_products", """
    WITH l AS (
      SELECT l_orderkey AS r, l_shipdate AS f, l_orderkey || '_' || l_partkey AS k, l_linenumber AS n, l_quantity AS q,
             l_extendedprice AS p, trim(p_name) AS nombre, l_partkey
      FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)
    SELECT CAST(o_orderkey AS VARCHAR) AS "NUM_RESERVA",
           '[' || string_agg('{"sku":"' || l_partkey || '","nombre":"' || nombre || '","cantidad":' || q || ',"precio":' || p
             || '}', ',' ORDER BY f, k, n, q, p) || ']' AS "PRODUCTOS"
    FROM orders LEFT JOIN l ON r = o_orderkey WHERE o_orderstatus = 'F' GROUP BY 1
""")
def nested(t):
    wanted = t.orders.filter(F.col("o_orderstatus") == "F").select(text("o_orderkey").alias("NUM_RESERVA"))
    return express.nest_products(wanted, express.order_products(order_lines(t), order_by=_ORDER))


def order_table(t):
    """Consolidated orders with client data."""
    k = F.col("o_orderkey")
    out = enrich(t.orders, t.customer, [("o_custkey", "c_custkey")], ["c_name", "c_acctbal", "c_nationkey", "c_mktsegment"], expect="unique")
    return out.select(
        text("o_orderkey").alias("NUM_RESERVA"),
        F.col("c_name").alias("NOMBRE_CLI"),
        F.concat(F.lit("9"), text("o_custkey")).alias("FONO_CLI"),
        F.concat(F.lit(" Calle "), text("o_custkey")).alias("DIRECCION_CLI"),
        F.concat(F.lit(" "), text("c_nationkey")).alias("REGION_CLI"),
        F.col("c_mktsegment").alias("CIUDAD_CLI"),
        F.concat(F.col("o_orderpriority"), F.lit(" > zona")).alias("COMUNA_CLI"),
        (k % 50).alias("CC_DESPACHA"),
        pick(["-12,0464", "0", None, "x", "-12.04641234567"], k % 5).alias("LATITUD"),
        F.when(k % 7 != 0, "-77.1").otherwise("-76.99995").alias("LONGITUD"),
        F.col("o_totalprice").alias("TOTAL"),
        F.lit(False).alias("ENVIADO"),
        F.lit(False).alias("FLAG_GEOCODIFICADO"),
    )


def product_table(t):
    """Two products of each order, the second with a blank sku."""
    rows = enrich(t.orders, t.customer, [("o_custkey", "c_custkey")], ["c_acctbal"], expect="unique").select(
        text("o_orderkey").alias("NUM_RESERVA"), F.concat(F.lit(" A "), text("o_custkey"), F.lit(" ")).alias("sku"), "c_acctbal"
    )
    one = rows.select("NUM_RESERVA", F.lit(2).alias("linea"), "sku", F.lit("x ").alias("nombre"), F.lit(2.0).alias("q"), "c_acctbal")
    two = rows.select("NUM_RESERVA", F.lit(1).alias("linea"), F.lit("  ").alias("sku"), F.lit("y"), F.lit(1.0), F.lit(1.0))
    return express.order_products(one.union(two), "NUM_RESERVA", ["linea"], "sku", "nombre", "q", "c_acctbal")


def sends_table(t):
    return t.orders.filter(F.col("o_orderstatus") == "F").select(
        text("o_orderkey").alias("NUM_RESERVA"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "201").when(F.col("o_orderpriority") == "2-HIGH", "200")
        .otherwise("500").alias("STATUS"),
    )


_OUTBOX = """
    o AS (
      SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS "NUM_RESERVA", o_custkey, o_totalprice, c_name, c_acctbal,
        c_nationkey, c_mktsegment, o_orderpriority, 'Calle ' || o_custkey || ', ' || o_orderpriority || ', ' || c_mktsegment
          || ', PERU' AS geo,
        CAST(CASE o_orderkey % 5 WHEN 0 THEN -12.0464 WHEN 4 THEN -12.0464123 END AS DOUBLE) AS la,
        CAST(CASE WHEN o_orderkey % 7 <> 0 THEN -77.1 ELSE -76.99995 END AS DOUBLE) AS lo
      FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE o_orderkey % 5 <> 2
        AND NOT (o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH'))),
    g AS (
      SELECT *, CASE WHEN la IS NULL AND o_custkey % 3 <> 0 THEN -11.5 ELSE la END AS y,
        CASE WHEN la IS NOT NULL THEN lo WHEN o_custkey % 3 <> 0 THEN -76.123456 END AS x,
        la IS NULL AND o_custkey % 3 <> 0 AS geocodificado FROM o),
    f AS (
      SELECT *, round(CASE WHEN round(y, 2) = y THEN y + 0.000001 ELSE y END, 6) AS lat,
        round(CASE WHEN round(x, 2) = x THEN x + 0.000001 ELSE x END, 6) AS lng FROM g)
"""


def outbox(t):
    orders = order_table(t)
    zones = orders.select(
        F.trim("REGION_CLI").alias("region"), F.col("CIUDAD_CLI").alias("city"),
        F.concat("COMUNA_CLI", F.lit(" ")).alias("district"),
    ).distinct()
    nations = t.nation.filter(F.col("n_nationkey") < 20).withColumn("_region", text("n_nationkey"))
    districts = enrich(zones, nations, [("region", "_region")], {"n_name": "UBIGEO"})
    stores = t.supplier.filter(F.col("s_suppkey") < 40).select(
        F.concat(text("s_suppkey"), F.lit(".0")).alias("CC"), F.col("s_name").alias("IDCARGO")
    )
    custkey = F.regexp_extract("DIRECCION_GEO", "([0-9]+)", 1).cast("bigint")
    found = express.geocode_worklist(express.with_coords(orders)).filter(custkey % 3 != 0)
    geocodes = found.select("DIRECCION_GEO", F.lit(-11.5).alias("lat"), F.lit(-76.123456).alias("lng"))
    return express.dispatch_outbox(orders, sends_table(t), districts, stores, geocodes, AS_OF, products=product_table(t))


@query("dispatch_outbox", f"""
    WITH {_OUTBOX}
    SELECT "NUM_RESERVA", geo AS "DIRECCION_GEO", lat, lng, geocodificado AS "FLAG_GEOCODIFICADO",
      CASE WHEN c_nationkey < 20 THEN 'NATION_' || c_nationkey END AS "UBIGEO",
      s_name AS "IDCARGO",
      CASE WHEN y IS NULL THEN 'ERROR_GOOGLE' END AS "STATUS", TIMESTAMP '1998-06-15 19:20:00' AS "FECHA_ENVIO",
      CASE WHEN y IS NOT NULL THEN '{{"total_value":' || CAST(trunc(o_totalprice) AS BIGINT)
        || ',"user_tip":0,"vehicle_type":"{fixed.DISPATCH_VEHICLE}","payment_method":"{fixed.DISPATCH_PAYMENT}","order_id":' || k
        || ',"in_store_reference_id":' || coalesce('"' || s_name || '"', 'null') || ',"action_points":[{{"picking_point_id":'
        || coalesce('"' || s_name || '"', 'null') || ',"instructions":"","products":[{{"product_id":"A' || o_custkey
        || '","name":"x","description":"x","units":2,"ean":"A' || o_custkey || '","unit_price":' || CAST(trunc(c_acctbal) AS BIGINT)
        || '}}],"action_type":"PICK_UP","location_type":"STORE"}},{{"products":[],"action_type":"DROP_OFF","location_type":"CLIENT"}}],'
        || '"client_info":{{"email":null,"phone":"9' || o_custkey || '","first_name":"' || c_name || '","last_name":"' || c_name
        || '","address":" Calle ' || o_custkey || '","lat":' || lat || ',"lng":' || lng || ',"complement":"","city":"' || c_mktsegment
        || '","comments":"","zip_code":' || CASE WHEN c_nationkey < 20 THEN '"NATION_' || c_nationkey || '"' ELSE 'null' END || '}}}}'
      END AS "PAYLOAD"
    FROM f LEFT JOIN supplier ON s_suppkey = k % 50 AND s_suppkey < 40
""")
def dispatch(t):
    return outbox(t).select(
        "NUM_RESERVA", "DIRECCION_GEO", "lat", "lng", "FLAG_GEOCODIFICADO", "UBIGEO", "IDCARGO", "STATUS", "FECHA_ENVIO", "PAYLOAD"
    )


@query("geocode_worklist", f"WITH {_OUTBOX} SELECT DISTINCT geo AS \"DIRECCION_GEO\" FROM f WHERE la IS NULL")
def worklist(t):
    ready = not_in_history(express.with_coords(order_table(t)), sends_table(t), "NUM_RESERVA",
                           F.col("STATUS").isin(*fixed.ACCEPTED_STATUS))
    return express.geocode_worklist(ready)


@query("update_sent_coords", f"""
    WITH {_OUTBOX}
    SELECT CAST(o_orderkey AS VARCHAR) AS "NUM_RESERVA",
      CASE WHEN f.y IS NOT NULL THEN CAST(f.lat AS VARCHAR)
           ELSE ['-12,0464', '0', NULL, 'x', '-12.04641234567'][o_orderkey % 5 + 1] END AS "LATITUD",
      coalesce(f.geocodificado, false) AS "FLAG_GEOCODIFICADO"
    FROM orders LEFT JOIN f ON f.k = o_orderkey
""")
def update_coords(t):
    out = express.update_sent_coords(order_table(t), outbox(t))
    return out.select("NUM_RESERVA", "LATITUD", "FLAG_GEOCODIFICADO")


def answered(t):
    """Sends with document and response texts in several shapes."""
    k = F.col("event_id")
    url = F.concat(F.lit("https://t/"), text("event_id"))
    response = (
        F.when(k % 6 == 0, F.concat(F.lit('{"tracking_url":"'), url, F.lit('"}')))
        .when(k % 6 == 1, F.concat(F.lit('{"tracking_url":"","trackingUrl":"'), url, F.lit('"}')))
        .when(k % 6 == 2, '{"message":"ok"}')
        .when(k % 6 == 3, "gateway timeout")
        .when(k % 6 == 4, F.lit(None))
        .otherwise("[1, 2]")
    )
    document = F.when(F.col("event_type") == "signup", F.lit(None)).when(F.col("event_type") == "view", "no json").otherwise(
        F.concat(F.lit('{"total_value":'), F.get_json_object("props", "$.k"), F.lit("}"))
    )
    return t.events.select(
        text("event_id").alias("NUM_RESERVA"), F.col("ts").alias("FECHA_ENVIO"),
        pick(["200", "201", "500", "ERROR"], k % 4).alias("STATUS"), document.alias("PAYLOAD"), response.alias("RESPONSE"),
    )


_SENDS = """
    c AS (
      SELECT event_id, CAST(event_id AS VARCHAR) AS "NUM_RESERVA", ts AS "FECHA_ENVIO", user_id,
        ['200', '201', '500', 'ERROR'][event_id % 4 + 1] AS "STATUS_API",
        CASE WHEN event_id % 6 IN (0, 1) THEN 'https://t/' || event_id END AS url,
        CAST(CAST(props ->> '$.k' AS BIGINT) AS DOUBLE) AS "TOTAL"
      FROM events WHERE event_type NOT IN ('signup', 'view')),
    s AS (
      SELECT "NUM_RESERVA", "FECHA_ENVIO", "STATUS_API", CASE WHEN "STATUS_API" NOT IN ('200', '201') THEN 'ERROR'
          WHEN url IS NULL THEN 'SIN_TRACKING' ELSE 'ENVIADO' END AS "ESTADO", url AS "TRACKING_URL", "TOTAL", event_id
      FROM c)
"""


@query("classify_sends", f"WITH {_SENDS} SELECT * EXCLUDE (event_id) FROM s")
def classify(t):
    return express.classify_sends(answered(t))


@query("new_tracking", f"""
    WITH {_SENDS} SELECT * EXCLUDE (event_id) FROM s
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = event_id AND o_orderstatus = 'F')
""")
def tracking(t):
    known = t.orders.filter(F.col("o_orderstatus") == "F").select(text("o_orderkey").alias("NUM_RESERVA"))
    return express.new_tracking(express.classify_sends(answered(t)), known)


@query("digest", f"""
    WITH {_SENDS} SELECT CAST("FECHA_ENVIO" AS DATE) AS dia, 'Reserva: ' || "NUM_RESERVA" || chr(10) || 'Tracking: ' || "TRACKING_URL" AS linea
    FROM s WHERE "ESTADO" = 'ENVIADO'
""")
def digest(t):
    """Lines of the daily messages."""
    sends = express.classify_sends(answered(t)).withColumn("dia", F.col("FECHA_ENVIO").cast("date"))
    return express.digest(sends, by=["dia"])


@query("express_chain", """
    WITH e AS (
      SELECT l_orderkey AS r, l_linenumber AS n, max(CASE WHEN l_quantity > 5 THEN l_shipdate END) AS prep,
             bool_or(l_discount > 0.08 OR l_quantity > 48) AS malo FROM lineitem GROUP BY 1, 2)
    SELECT CAST(l_orderkey AS VARCHAR) AS "NUM_RESERVA", TIMESTAMP '1998-06-15 19:20:00' AS "FECHA_ENVIO",
           CASE WHEN l_orderkey % 3 = 0 THEN '500' ELSE '200' END AS "STATUS_API",
           CASE WHEN l_orderkey % 3 = 0 THEN 'ERROR' ELSE 'ENVIADO' END AS "ESTADO", 'https://t/' || l_orderkey AS "TRACKING_URL",
           CAST(trunc(sum(CAST(l_quantity AS DECIMAL(18,4)) * CAST(l_extendedprice AS DECIMAL(18,4)))) AS DOUBLE) AS "TOTAL"
    FROM lineitem JOIN e ON r = l_orderkey AND n = l_linenumber
    WHERE l_shipdate > TIMESTAMP '1998-06-14' AND l_shipdate < TIMESTAMP '1998-06-17' AND l_returnflag <> 'R'
      AND l_linenumber <= 5 AND prep IS NOT NULL AND NOT malo
    GROUP BY l_orderkey
""")
def chain(t):
    """Extract, orders, dispatch and tracking over stored tables, run twice: the second run adds nothing."""
    paths = [scratch_path(t.spark, f"chain-{x}") for x in ("orders", "products", "sends", "tracking")]
    orders, products = express.orders_table(paths[0], 16), express.products_table(paths[1], 16)
    sends, found = paths[2:]
    zones = t.customer.select(text("c_nationkey").alias("region"), F.col("c_mktsegment").alias("city")).distinct()
    districts = zones.select("region", "city", F.lit("x").alias("district"), F.lit("1").alias("UBIGEO"))
    stores = t.supplier.select(text("s_suppkey").alias("CC"), F.col("s_name").alias("IDCARGO"))

    def send(outbox):
        key = F.col("NUM_RESERVA").cast("bigint")
        return outbox.withColumns({
            "STATUS": F.when(key % 3 == 0, "500").otherwise("200"),
            "RESPONSE": F.concat(F.lit('{"tracking_url":"https://t/'), "NUM_RESERVA", F.lit('"}')),
        })

    lines = express.express_lines(detail(t), header(t), events(t), AS_OF)
    for _ in range(2):
        express.run_orders(t.spark, lines, orders, products, AS_OF)
        places = express.geocode_worklist(orders.read(t.spark))
        geocodes = places.select("DIRECCION_GEO", F.lit(-11.5).alias("lat"), F.lit(-76.123456).alias("lng"))
        express.run_dispatch(t.spark, orders, products, sends, districts, stores, geocodes, AS_OF, send)
        express.run_tracking(t.spark, sends, found)
    return t.spark.read.schema(TRACKING).parquet(found)
