"""Join operators on the driver tables."""

from pyspark.sql import functions as F

from ..functions import labels
from ..functions.dates import in_window, in_years, slot_open
from ..functions.documents import canonical_document
from ..functions.text import extract_some, is_blank
from ..operators.joins import enrich, not_in_history, role_join, star_join, with_events
from ..operators.quality import rejects_sample, split_valid, union_by_name
from ..plans import express, services, tracker
from ..plans.delivery import survey_deliveries
from .registry import query


@query("event_rules", """
    WITH e AS (SELECT user_id, CASE WHEN event_type = 'error' AND value > 100 THEN 'fatal' ELSE event_type END AS code,
                      CASE WHEN value >= 1 THEN ts END AS fecha FROM events),
    f AS (SELECT user_id, max(CASE WHEN code = 'purchase' THEN fecha END) AS compra,
                 max(CASE WHEN code = 'click' THEN fecha END) AS clic,
                 max(CASE WHEN code = 'fatal' THEN fecha END) AS fatal
          FROM e WHERE fecha IS NOT NULL GROUP BY user_id)
    SELECT c_custkey AS user_id, c_name, compra, clic FROM customer JOIN f ON c_custkey = f.user_id
    WHERE compra IS NOT NULL AND fatal IS NULL
""")
def event_rules(t):
    events = t.events.select(
        "user_id",
        F.when((F.col("event_type") == "error") & (F.col("value") > 100), "fatal")
        .otherwise(F.col("event_type"))
        .alias("code"),
        F.when(F.col("value") >= 1, F.col("ts")).alias("fecha"),
    )
    lines = t.customer.select(F.col("c_custkey").alias("user_id"), "c_name")
    return with_events(lines, events, ["user_id"], "code", "fecha", {"purchase": "compra"}, {"click": "clic"}, ["fatal"])


@query("not_in_history", """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
""")
def history(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    return not_in_history(orders, t.lineitem, "o_orderkey", F.col("l_returnflag") == "R", "l_orderkey")


@query("resend_candidates", """
    SELECT CAST(c_custkey AS VARCHAR) AS "NUM_RESERVA", '9' || c_custkey AS "FONO_CLI", c_name AS "NOMBRE_CLI",
           'SIN_RESPUESTA' AS "ESTADO", CAST(c_nationkey AS BIGINT) AS "INTENTOS"
    FROM customer
    WHERE c_acctbal < 5000 AND EXISTS (
      SELECT 1 FROM events WHERE user_id = c_custkey AND event_type = 'error'
        AND ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16')
""")
def resend(t):
    coords = t.customer.select(
        F.col("c_custkey").cast("string").alias("NUM_RESERVA"),
        F.concat(F.lit("9"), F.col("c_custkey").cast("string")).alias("FONO_CLI"),
        F.col("c_name").alias("NOMBRE"),
        F.when(F.col("c_acctbal") < 5000, "SIN_RESPUESTA").otherwise("ENCONTRADA").alias("ESTADO"),
        F.col("c_nationkey").cast("bigint").alias("INTENTOS"),
    )
    sends = t.events.filter(F.col("event_type") == "error").select(
        F.col("user_id").cast("string").alias("NUM_RESERVA"), F.col("ts").alias("FECHA_ENVIO")
    )
    return tracker.resend_candidates(coords, sends, "2024-01-15 10:00:00")


@query("union_queue", """
    SELECT o_orderkey, o_custkey, o_orderpriority, CAST(NULL AS DOUBLE) AS o_totalprice FROM orders
    WHERE o_orderstatus = 'O'
    UNION ALL BY NAME
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus <> 'O'
""")
def union_queue(t):
    fresh = t.orders.filter(F.col("o_orderstatus") == "O").select("o_orderkey", "o_custkey", "o_orderpriority")
    again = t.orders.filter(F.col("o_orderstatus") != "O").select("o_orderkey", "o_custkey", "o_totalprice")
    return union_by_name(fresh, again)


@query("star_enrich", """
    SELECT l_orderkey, l_partkey, l_linenumber, c_mktsegment, cn.n_name AS cliente_n_name, sn.n_name AS proveedor_n_name,
           r_name AS cliente_r_name
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
    LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey LEFT JOIN region ON cn.n_regionkey = r_regionkey
""")
def star(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey")
    out = star_join(lines, [
        (t.orders, [("l_orderkey", "o_orderkey")], ["o_custkey"]),
        (t.customer, [("o_custkey", "c_custkey")], ["c_mktsegment", "c_nationkey"]),
        (t.supplier, [("l_suppkey", "s_suppkey")], ["s_nationkey"]),
    ])
    roles = {"cliente": "c_nationkey", "proveedor": "s_nationkey"}
    out = role_join(out, t.nation, "n_nationkey", roles, ["n_name", "n_regionkey"])
    out = enrich(out, t.region, [("cliente_n_regionkey", "r_regionkey")], {"r_name": "cliente_r_name"}, expect="unique")
    return out.select("l_orderkey", "l_partkey", "l_linenumber", "c_mktsegment", "cliente_n_name", "proveedor_n_name",
                      "cliente_r_name")


@query("composite_key_plan", """
    WITH o AS (SELECT o_orderkey, o_orderstatus, o_totalprice,
                      c_mktsegment || month(o_orderdate) || year(o_orderdate) AS llave
               FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
    p AS (SELECT llave AS k, max(o_totalprice) AS meta FROM o WHERE o_orderstatus = 'F' GROUP BY llave)
    SELECT o_orderkey, llave, meta / 10 AS plan FROM o LEFT JOIN p ON llave = k
""")
def composite_key_plan(t):
    o = enrich(t.orders, t.customer, [("o_custkey", "c_custkey")], ["c_mktsegment"], expect="unique").select(
        "o_orderkey", "o_orderstatus", "o_totalprice",
        labels.plan_key("c_mktsegment", F.month("o_orderdate"), F.year("o_orderdate")).alias("llave"),
    )
    plan = o.filter(F.col("o_orderstatus") == "F").groupBy("llave").agg((F.max("o_totalprice") / 10).alias("plan"))
    return enrich(o.select("o_orderkey", "llave"), plan, ["llave"], ["plan"])


@query("three_key_lookup", """
    WITH p AS (SELECT p_partkey, p_type AS a, p_brand AS b, p_name AS c,
                      CASE WHEN p_partkey % 10 = 0 THEN 'x' ELSE p_size || '.0' END AS cc FROM part),
    d AS (SELECT p_type, p_brand, p_name, min(p_partkey) AS u FROM part WHERE p_size > 10 GROUP BY ALL),
    s AS (SELECT CAST(p_size AS DOUBLE) AS cc, count(*) AS n FROM part WHERE p_size < 45 GROUP BY 1)
    SELECT p_partkey, u AS "UBIGEO", n AS "IDCARGO" FROM p LEFT JOIN d ON a = p_type AND b = p_brand AND c = p_name
    LEFT JOIN s ON TRY_CAST(p.cc AS DOUBLE) = s.cc
""")
def three_key_lookup(t):
    pad = F.concat(F.lit("  "), F.col("p_type"), F.lit(" "))
    orders = t.part.select(
        "p_partkey",
        pad.alias("REGION_CLI"),
        F.col("p_brand").alias("CIUDAD_CLI"),
        F.concat(F.col("p_name"), F.lit("\t")).alias("COMUNA_CLI"),
        F.when(F.col("p_partkey") % 10 == 0, "x").otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".0"))).alias(
            "CC_DESPACHA"
        ),
    )
    districts = (
        t.part.filter(F.col("p_size") > 10)
        .groupBy(F.col("p_type").alias("region"), F.col("p_brand").alias("city"), F.col("p_name").alias("district"))
        .agg(F.min("p_partkey").alias("UBIGEO"))
    )
    stores = (
        t.part.filter(F.col("p_size") < 45).groupBy(F.col("p_size").cast("string").alias("CC")).agg(
            F.count(F.lit(1)).alias("IDCARGO")
        )
    )
    return express.enrich_orders(orders, districts, stores).select("p_partkey", "UBIGEO", "IDCARGO")


@query("extracted_key_join", """
    SELECT c_custkey, s_suppkey, n_name
    FROM customer LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 1000) s
      ON regexp_extract(c_name, '([0-9]+)$', 1) = regexp_extract(s_name, '([0-9]+)$', 1)
    LEFT JOIN nation ON n_nationkey = s_nationkey AND n_regionkey = c_nationkey % 5
""")
def extracted_key_join(t):
    def number(c):
        return extract_some(c, r"([0-9]+)\z")

    out = enrich(
        t.customer, t.supplier, [(number("c_name"), number("s_name"))], ["s_suppkey", "s_nationkey"],
        where=F.col("s_acctbal") > 1000,
    )
    out = out.withColumn("_region", F.col("c_nationkey") % 5)
    out = enrich(out, t.nation, [("s_nationkey", "n_nationkey"), ("_region", "n_regionkey")], ["n_name"])
    return out.select("c_custkey", "s_suppkey", "n_name")


@query("enrich_latest", """
    WITH u AS (SELECT l_orderkey, l_partkey, l_shipdate FROM lineitem
               QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_partkey DESC) = 1),
    k AS (SELECT lower(p_type) AS tipo, count(*) AS piezas FROM part WHERE p_size < 40 GROUP BY 1)
    SELECT o_orderkey, l_partkey, l_shipdate, p_type, piezas
    FROM orders LEFT JOIN u ON o_orderkey = l_orderkey LEFT JOIN part ON l_partkey = p_partkey
    LEFT JOIN k ON upper(p_type) = upper(tipo)
""")
def enrich_latest(t):
    out = enrich(
        t.orders.select("o_orderkey"), t.lineitem, [("o_orderkey", "l_orderkey")], ["l_partkey", "l_shipdate"],
        order_by=["l_shipdate desc", "l_partkey desc"], spread=False,
    )
    out = enrich(out, t.part, [("l_partkey", "p_partkey")], ["p_type"], expect="unique")
    kinds = t.part.filter(F.col("p_size") < 40).groupBy(F.lower("p_type").alias("tipo")).agg(
        F.count(F.lit(1)).alias("piezas")
    )
    return enrich(out, kinds, [("p_type", "tipo")], ["piezas"], normalise=F.upper)


@query("split_dims", """
    WITH c AS (
      SELECT c_custkey, CASE WHEN n_nationkey % 7 = 0 THEN n_name ELSE n_nationkey || ' - ' || n_name END AS canal,
             CASE WHEN c_custkey % 3 = 0 THEN r_name || ' - ' || c_mktsegment WHEN c_custkey % 3 = 1
                  THEN r_name || ' X - ' || c_mktsegment ELSE r_name END AS categoria,
             CASE WHEN r_regionkey = 1 THEN ' ' WHEN r_regionkey <> 2 THEN r_name END AS pn, n_name AS nn, c_name AS cn
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
    SELECT c_custkey, TRY_CAST(trim(split_part(canal, '-', 1)) AS BIGINT) AS codigo_tienda,
           CASE WHEN contains(canal, '-') THEN trim(split_part(canal, '-', 2)) END AS nombre_tienda,
           CASE WHEN regexp_matches(categoria, '^[^ -]+\\s*-') THEN regexp_extract(categoria, '^([^ -]+)\\s*-', 1)
                ELSE categoria END AS categoria_macroservicio,
           coalesce(nullif(trim(pn || ' ' || CASE WHEN trim(pn) = '' THEN '' ELSE nn END), ''),
                    nullif(trim(cn || ' ' || nn), '')) AS nombre_contratista
    FROM c
""")
def split_dims(t):
    c = enrich(t.customer, t.nation, [("c_nationkey", "n_nationkey")], ["n_name", "n_regionkey"], expect="unique")
    c = enrich(c, t.region, [("n_regionkey", "r_regionkey")], ["r_name"], expect="unique")
    code = F.concat(F.col("c_nationkey").cast("string"), F.lit(" - "), F.col("n_name"))
    third = F.col("c_custkey") % 3
    c = c.withColumns({
        "canal": F.when(F.col("c_nationkey") % 7 == 0, F.col("n_name")).otherwise(code),
        "categoria": F.when(third == 0, F.concat("r_name", F.lit(" - "), "c_mktsegment"))
        .when(third == 1, F.concat("r_name", F.lit(" X - "), "c_mktsegment"))
        .otherwise(F.col("r_name")),
        "pn": F.when(F.col("n_regionkey") == 1, " ").when(F.col("n_regionkey") != 2, F.col("r_name")),
    })
    c = c.withColumn("pl", F.when(is_blank("pn"), "").otherwise(F.col("n_name")))
    return c.select(
        "c_custkey",
        labels.store_code("canal").alias("codigo_tienda"),
        labels.store_name("canal").alias("nombre_tienda"),
        labels.macro_category("categoria").alias("categoria_macroservicio"),
        labels.contractor_name("pn", "pl", "c_name", "n_name").alias("nombre_contratista"),
    )


@query("window_filters", """
    SELECT o_orderkey, o_orderdate,
      o_orderdate > TIMESTAMP '1998-06-14' AND o_orderdate < TIMESTAMP '1998-06-17' AS abierta,
      o_orderdate >= TIMESTAMP '1998-06-16' AND o_orderdate < TIMESTAMP '1998-06-17' AS manana,
      o_orderdate >= TIMESTAMP '1998-06-15' AND o_orderdate < TIMESTAMP '1998-06-16' AS hoy,
      o_orderdate >= TIMESTAMP '1998-06-11' AS reciente,
      year(o_orderdate) IN (1996, 1998, 1999) AS en_anios
    FROM orders
""")
def window_filters(t):
    as_of, d = "1998-06-15 13:20:00", "o_orderdate"
    return t.orders.select(
        "o_orderkey",
        d,
        in_window(d, as_of, -1, 2, from_open=True).alias("abierta"),
        in_window(d, as_of, 1, 2).alias("manana"),
        in_window(d, as_of, 0, 1).alias("hoy"),
        in_window(d, as_of, -4, None).alias("reciente"),
        in_years(d, [1996, 1998, 1999]).alias("en_anios"),
    )


@query("slot_open", """
    SELECT event_id, 'E' || (hour(ts) // 3 + 1) AS franja FROM events
    WHERE hour(ts) // 3 + 1 <= 4 AND hour(ts) // 3 + 1 <= 6
""")
def open_slots(t):
    slot = F.concat(F.lit("E"), (F.floor(F.hour("ts") / 3) + 1).cast("string"))
    out = t.events.select("event_id", slot.alias("franja"))
    # 17:10 less one hour of lead is the fourth slot.
    return out.filter(slot_open("franja", "2024-01-15 17:10:00", ["E1", "E2", "E3", "E4", "E5", "E6"]))


@query("survey_filters", """
    SELECT o_orderkey AS encuesta, c_mktsegment AS segmento, o_orderdate AS fecha, o_totalprice AS importe
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderstatus = 'F' AND c_mktsegment = 'BUILDING' AND year(o_orderdate) IN (1997, 1998, 2000)
      AND o_totalprice IS NOT NULL
""")
def survey_filters(t):
    done = t.orders.filter((F.col("o_orderstatus") == "F") & in_years("o_orderdate", [1997, 1998, 2000]))
    out = enrich(done, t.customer, [("o_custkey", "c_custkey")], ["c_mktsegment"], expect="unique")
    out = out.filter(F.col("c_mktsegment") == "BUILDING").na.drop("any", subset=["o_totalprice"])
    return out.select(
        F.col("o_orderkey").alias("encuesta"),
        F.col("c_mktsegment").alias("segmento"),
        F.col("o_orderdate").alias("fecha"),
        F.col("o_totalprice").alias("importe"),
    )


@query("state_filters", """
    WITH o AS (
      SELECT o_custkey, CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN 'SIN_RESPUESTA'
                        ELSE 'ENCONTRADA' END AS estado,
             CASE o_orderstatus WHEN 'F' THEN '-12.5' WHEN 'O' THEN ' ' END AS lat FROM orders)
    SELECT DISTINCT o_custkey, coalesce(estado, '') IN ('', 'SIN_RESPUESTA') AS pendiente,
           coalesce(estado = 'ENCONTRADA' AND lat IS NOT NULL, false) AS localizada,
           lat IS NULL OR trim(lat) = '' AS en_blanco
    FROM o
""")
def state_filters(t):
    rows = t.orders.select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderpriority") == "2-HIGH", "SIN_RESPUESTA")
        .when(F.col("o_orderpriority") != "1-URGENT", "ENCONTRADA")
        .alias("ESTADO"),
        F.when(F.col("o_orderstatus") == "F", "-12.5").when(F.col("o_orderstatus") == "O", " ").alias("LATITUD"),
    ).withColumn("LONGITUD", F.col("LATITUD"))
    pending = tracker.pending_rows(rows).withColumns({"pendiente": F.lit(True), "localizada": F.lit(False)})
    found = tracker.located(rows).withColumns({"pendiente": F.lit(False), "localizada": F.lit(True)})
    lost = rows.filter((F.col("ESTADO") == "ENCONTRADA") & F.col("LATITUD").isNull()).withColumns(
        {"pendiente": F.lit(False), "localizada": F.lit(False)}
    )
    every = pending.unionByName(found).unionByName(lost)
    return every.select("o_custkey", "pendiente", "localizada", is_blank("LATITUD").alias("en_blanco")).distinct()


@query("rejects_sample", """
    SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE NOT (l_quantity < 45)
      AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')
    ORDER BY l_orderkey, l_partkey, l_quantity LIMIT 20
""")
def rejected(t):
    _, bad = split_valid(t.lineitem.select("l_orderkey", "l_partkey", "l_quantity"), F.col("l_quantity") < 45)
    bad = not_in_history(bad, t.orders, "l_orderkey", F.col("o_orderstatus") == "F", "o_orderkey")
    return rejects_sample(bad, ["l_orderkey", "l_partkey", "l_quantity"])


_REFERENCES = """
    refs AS (
      SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
        CASE o_orderkey % 12
          WHEN 0 THEN 'BOLETA ' || (o_orderkey + 100000) WHEN 1 THEN ' b' || (o_orderkey + 7) || ' '
          WHEN 2 THEN 'B: 000' || o_orderkey WHEN 3 THEN 'Factura ' || o_orderkey
          WHEN 4 THEN 'F001-' || (o_orderkey + 1000000) WHEN 5 THEN '{"BLT":"000' || (o_orderkey + 100000000) || '"}'
          WHEN 6 THEN '{"F" : "' || o_orderkey || '"}' WHEN 7 THEN CAST(o_orderkey + 5000000 AS VARCHAR)
          WHEN 8 THEN 'BLT ' || (12345600000000 + o_custkey) WHEN 9 THEN '  ' WHEN 10 THEN NULL
          ELSE 'FACTURA Y BOLETA ' || translate(CAST(o_custkey AS VARCHAR), '0123456789', 'ABCDEGHIJK') END AS referencia
      FROM orders),
    typed AS (
      SELECT *, trim(referencia) AS txt,
        CASE WHEN regexp_matches(upper(trim(referencia)), '\\bFACTURA\\b|\\bF\\d') THEN 'F'
             WHEN regexp_matches(upper(trim(referencia)), '\\bBOLETA\\b|\\bBLT\\b|\\bB\\d') THEN 'B' END AS tipo,
        coalesce(nullif(regexp_extract(trim(referencia), '"[A-Za-z]*"\\s*:\\s*"(\\d+)"', 1), ''),
                 nullif(regexp_extract(trim(referencia), '(\\d{6,})', 1), ''),
                 nullif(regexp_extract(trim(referencia), '(\\d+)$', 1), '')) AS num
      FROM refs),
    docs AS (
      SELECT *, CASE WHEN length(num) >= 12 THEN num ELSE lpad(num, 12, '0') END AS num12,
        tipo IS NOT NULL AND num IS NOT NULL AS ok FROM typed),
    keyed AS (
      SELECT *, CASE WHEN ok THEN num12 ELSE nullif(txt, '') END AS codigo,
        CASE WHEN ok THEN tipo || '-' || num12 ELSE txt END AS clave,
        CASE WHEN tipo IS NOT NULL AND num IS NULL THEN 'SIN_NUMERO_BF'
             WHEN tipo IS NULL AND coalesce(txt, '') = '' THEN 'VACIO' ELSE 'OK' END AS calidad
      FROM docs)
"""


def references(t):
    """Order references in twelve shapes."""
    k = F.col("o_orderkey")

    def text(c):
        return c.cast("string")

    shapes = [
        F.concat(F.lit("BOLETA "), text(k + 100000)),
        F.concat(F.lit(" b"), text(k + 7), F.lit(" ")),
        F.concat(F.lit("B: 000"), text(k)),
        F.concat(F.lit("Factura "), text(k)),
        F.concat(F.lit("F001-"), text(k + 1000000)),
        F.concat(F.lit('{"BLT":"000'), text(k + 100000000), F.lit('"}')),
        F.concat(F.lit('{"F" : "'), text(k), F.lit('"}')),
        text(k + 5000000),
        F.concat(F.lit("BLT "), text(F.col("o_custkey") + F.lit(12345600000000))),
        F.lit("  "),
        F.lit(None).cast("string"),
        F.concat(F.lit("FACTURA Y BOLETA "), F.translate(text(F.col("o_custkey")), "0123456789", "ABCDEGHIJK")),
    ]
    shape = None
    for i, c in enumerate(shapes):
        shape = F.when(k % 12 == i, c) if shape is None else shape.when(k % 12 == i, c)
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", shape.alias("referencia"))


@query("canonical_document", f"""
    WITH {_REFERENCES}
    SELECT o_orderkey, tipo AS doc_type, num AS doc_number, codigo AS doc_code, clave AS doc_key, calidad AS doc_quality
    FROM keyed
""")
def canonical(t):
    return canonical_document(references(t), "referencia").select(
        "o_orderkey", "doc_type", "doc_number", "doc_code", "doc_key", "doc_quality"
    )


@query("document_match", f"""
    WITH {_REFERENCES},
    enc AS (SELECT o_orderkey AS a_surveyid, o_orderdate AS e_responsedate, clave AS k FROM keyed
            WHERE o_orderstatus = 'F' AND coalesce(trim(clave), '') <> ''
            QUALIFY row_number() OVER (PARTITION BY clave ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
    SELECT o_orderkey, clave AS doc_key, a_surveyid, e_responsedate FROM keyed LEFT JOIN enc ON clave = k
""")
def document_match(t):
    return _document_match(t, "latest")


def _document_match(t, match):
    docs = canonical_document(references(t), "referencia")
    surveys = docs.filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("a_surveyid"), F.col("o_orderdate").alias("e_responsedate"),
        F.col("doc_key").alias("survey_key"),
    )
    return services.match_documents(
        docs.select("o_orderkey", "doc_key"), surveys, "doc_key", "survey_key", ["a_surveyid", "e_responsedate"],
        match=match,
    )


@query("document_match_all", f"""
    WITH {_REFERENCES},
    enc AS (SELECT o_orderkey AS a_surveyid, o_orderdate AS e_responsedate, clave AS k FROM keyed
            WHERE o_orderstatus = 'F' AND coalesce(trim(clave), '') <> '')
    SELECT o_orderkey, clave AS doc_key, a_surveyid, e_responsedate FROM keyed LEFT JOIN enc ON clave = k
""")
def document_match_all(t):
    return _document_match(t, "all")


@query("survey_delivery_match", """
    WITH l AS (SELECT l_orderkey, l_partkey, l_suppkey, date_diff('day', o_orderdate, l_shipdate) AS atraso
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    w AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY l_orderkey
            ORDER BY atraso DESC, l_partkey, l_suppkey) = 1)
    SELECT o_orderkey, CAST(atraso AS INTEGER) AS dias_atraso, l_partkey FROM orders
    LEFT JOIN w ON l_orderkey = o_orderkey AND o_orderkey > 0
""")
def survey_delivery_match(t):
    surveys = t.orders.select("o_orderkey", F.concat(F.lit("B-000"), F.col("o_orderkey").cast("string")).alias("doc"))
    lines = enrich(t.lineitem, t.orders, [("l_orderkey", "o_orderkey")], ["o_orderdate"], expect="unique").select(
        "l_partkey", "l_suppkey", "l_shipdate", "o_orderdate",
        F.concat(F.lit("Boleta N. "), F.col("l_orderkey").cast("string")).alias("line_doc"),
    )
    out = survey_deliveries(surveys, lines, "doc", "line_doc", "o_orderdate", "l_shipdate",
                            ["l_partkey asc", "l_suppkey asc"], ["l_partkey"])
    return out.select("o_orderkey", "dias_atraso", "l_partkey")
