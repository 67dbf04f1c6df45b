"""Survey mart, recommendation scores and delivery effects on the driver tables."""

from pyspark.sql import functions as F

from ..operators.joins import enrich
from ..plans import delivery, survey
from .registry import query
from .scalars import _CHANNEL, _TILLS, _TILLS_PADDED, DAYS, MONTHS
from .services import pick, text


def tables(t):
    """The eleven inputs of the mart, derived from the driver tables."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    answered = F.col("o_orderdate") + F.expr("INTERVAL 26 YEARS")
    surveys = t.orders.select(
        text("o_orderkey").alias("a_surveyid"),
        answered.alias("e_responsedate"),
        F.date_sub(answered.cast("date"), 1).alias("e_sdm_transaction_date_date"),
        F.when(F.col("o_orderstatus") == "P", "2").otherwise("4").alias("e_sdm_country_alt"),
        F.when(F.col("o_orderpriority") == "5-LOW", "EXPIRED").otherwise("COMPLETED").alias("e_status"),
        F.concat((k % 1000).cast("string"), F.lit("-"), text("o_custkey")).alias("e_sdm_transaction_number_text"),
        pick(["1", "8", "10", "2", "1", "7", "15", "1"], k % 8).alias("e_sdm_store_type_radio"),
        pick(["1", "5", "6", "7", "9"], k % 5).alias("e_sdm_survey_type_alt"),
        F.when(k % 3 != 0, "9").otherwise("2").alias("e_sdm_punto_contacto"),
        F.when(c % 50 != 7, F.concat(F.lit("PE-T-"), (c % 30).cast("string"))).otherwise("PE").alias("e_unitid"),
        F.concat(F.lit("NATION_"), (c % 30).cast("string")).alias("e_sdm_store_name_text"),
        F.when(k % 6 != 0, F.concat(F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":30"))).alias(
            "e_sdm_hora_tirilla_ticket"
        ),
        F.when(k % 3 != 0, F.concat(F.lit("Caja (Positivo), "), F.col("o_orderpriority"), F.lit(" (Negativo)"))).alias(
            "a_topics_sentiments_tagged_original"
        ),
        F.when(k % 13 != 0, (k % 12).cast("string")).alias("q_sdm_ltr11"),
        (k % 3).cast("string").alias("q_sdm_home_product_use_alt"),
        (k % 4).cast("string").alias("q_sdm_ropo_enum"),
        (k % 5).cast("string").alias("q_sdm_home_competitive_prices_alt"),
    )
    month = F.month("o_orderdate")
    periods = t.orders.groupBy(month.alias("m"), (F.year("o_orderdate") + 26).alias("y"))
    company = periods.agg(F.max(F.floor("o_totalprice")).alias("NPS_CIA"))
    plans = t.orders.groupBy(month.alias("m"), (F.year("o_orderdate") + 26).alias("y"), (c % 30).alias("s"))
    channel = F.concat(pick(["TIENDA", "VAD", "VENTA EMPRESA"], F.col("y") % 3), text("m"), text("y"))
    number = F.col("n_nationkey")
    return {
        "surveys": surveys,
        "ces": t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(
            text("o_orderkey").alias("a_surveyid"), F.col("o_totalprice").alias("sales_margin_dt"),
            F.col("o_orderdate").alias("customer_ces_dt"), (k % 6).alias("ces_level_val"),
        ),
        "money": t.orders.filter(F.col("o_orderstatus") == "F").select(
            text("o_orderkey").alias("id"), F.col("o_orderdate").alias("fecha_transaccion"),
            F.col("o_totalprice").alias("VENTA"), (F.col("o_totalprice") / 2).alias("COSTO"), (k % 10).alias("UNIDADES"),
            c.alias("main_customer_id"), (k % 2).alias("cliente_volvio"), (k % 30).alias("dias_para_volver"),
            (k % 4).alias("veces_que_volvio"), (k % 3).alias("cliente_habia_ido"), (k % 90).alias("dias_desde_ultima_visita"),
            (k % 5).alias("veces_que_habia_ido"),
        ),
        "stores": t.nation.select(
            number.alias("CODIGO"), F.col("n_name").alias("TIENDA"), text("n_regionkey").alias("REGION"),
            *[(number % i).cast("string").alias(c) for i, c in enumerate(survey.STORE_COLUMNS[2:], start=2)],
        ),
        "store_plan": plans.agg((F.count(F.lit(1)) * 7).alias("NPS")).select(
            F.concat(text("y"), F.lpad(text("m"), 2, "0"), text("s")).alias("LLAVE_TIENDA"), F.col("NPS").cast("double").alias("NPS")
        ),
        "store_aux": t.nation.select(F.col("n_name").alias("Nombre_Tienda"), (number + 100).alias("Cod")),
        "company_plan": company.select(
            F.concat(F.lit("CIA"), text("m"), text("y")).alias("LLAVE_CIA"), F.col("NPS_CIA").cast("double").alias("NPS_CIA")
        ),
        "channel_plan": company.select(channel.alias("LLAVE"), F.col("NPS_CIA").cast("double").alias("NPS")),
        "till_report": t.orders.select(
            F.concat((k % 1000).cast("string"), F.lit("-"), text("o_custkey")).alias("num_documento"),
            (k % 100).alias("codigo_cajero"), (c % 25).cast("int").alias("sucursal"),
        ),
        "mobile_terminals": t.supplier.select(F.col("s_suppkey").alias("Terminales"), F.col("s_nationkey").alias("Cod")),
        "sales": plans.agg(
            F.count(F.lit(1)).alias("transactions3"), F.sum(k % 10).alias("unidades"),
            F.max("o_totalprice").alias("venta"),
        ).select(F.col("s").alias("location_id"), F.col("m").alias("month"), F.col("y").alias("year"), "transactions3",
                 "unidades", "venta"),
    }


_STORE_SQL = ", ".join(
    f"CAST(st.n_nationkey % {i} AS VARCHAR) AS \"{c}\"" for i, c in enumerate(survey.STORE_COLUMNS[2:], start=2)
)


@query("survey_mart", f"""
    WITH s AS (
      SELECT CAST(o_orderkey AS VARCHAR) AS a_surveyid, o_orderkey AS k, o_custkey AS c, o_orderstatus, o_orderpriority,
        o_totalprice, o_orderdate, o_orderdate + INTERVAL 26 YEAR AS fecha,
        CAST(CAST(o_orderdate + INTERVAL 26 YEAR AS DATE) - INTERVAL 1 DAY AS DATE) AS compra,
        (o_orderkey % 1000) || '-' || o_custkey AS doc, ['1','8','10','2','1','7','15','1'][o_orderkey % 8 + 1] AS tt,
        ['1','5','6','7','9'][o_orderkey % 5 + 1] AS te, CASE WHEN o_orderkey % 3 <> 0 THEN '9' ELSE '2' END AS pc,
        CASE WHEN o_custkey % 50 <> 7 THEN 'PE-T-' || (o_custkey % 30) ELSE 'PE' END AS unidad,
        'NATION_' || (o_custkey % 30) AS tienda,
        CASE WHEN o_orderkey % 6 <> 0 THEN lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':30' END AS hora
      FROM orders),
    b AS (
      SELECT *, month(fecha) || '' || year(fecha) AS periodo,
        CASE WHEN year(fecha) < 2024 OR (year(fecha) = 2024 AND month(fecha) < 6) THEN
             CASE tt WHEN '1' THEN 'TIENDA' WHEN '10' THEN 'DEVOLUCIONES' WHEN '8' THEN 'VENTA EMPRESA'
                     ELSE 'NO IDENTIFICADO' END
             ELSE {_CHANNEL.format("'1','7'")} END AS canal,
        {_CHANNEL.format("'1'")} AS canal_plan, CASE WHEN c % 50 <> 7 THEN CAST(c % 30 AS VARCHAR) END AS unit_number,
        CAST(substr(hora, 1, 2) AS INTEGER) AS h
      FROM s WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' AND year(fecha) IN (2024, 2025, 2026)),
    mov AS (
      SELECT (o_orderkey % 1000) || '-' || o_custkey AS doc, bool_or(s_suppkey IS NOT NULL) AS movil
      FROM orders LEFT JOIN supplier ON s_suppkey = o_orderkey % 100 AND s_nationkey = o_custkey % 25 GROUP BY 1),
    cia AS (SELECT month(o_orderdate) AS m, year(o_orderdate) + 26 AS y, max(floor(o_totalprice)) AS v FROM orders GROUP BY 1, 2),
    pla AS (SELECT month(o_orderdate) AS m, year(o_orderdate) + 26 AS y, o_custkey % 30 AS s, count(*) AS n,
                   sum(o_orderkey % 10) AS u, max(o_totalprice) AS v FROM orders GROUP BY 1, 2, 3)
    SELECT b.a_surveyid, fecha AS e_responsedate, compra AS e_sdm_transaction_date_date, '4' AS e_sdm_country_alt,
      'COMPLETED' AS e_status, b.doc AS e_sdm_transaction_number_text, tt AS e_sdm_store_type_radio,
      te AS e_sdm_survey_type_alt, pc AS e_sdm_punto_contacto, unidad AS e_unitid, tienda AS e_sdm_store_name_text,
      hora AS e_sdm_hora_tirilla_ticket,
      CASE WHEN k % 3 <> 0 THEN 'Caja (Positivo), ' || o_orderpriority || ' (Negativo)' END
        AS a_topics_sentiments_tagged_original,
      CASE WHEN k % 13 <> 0 THEN CAST(k % 12 AS VARCHAR) END AS q_sdm_ltr11,
      CAST(k % 3 AS VARCHAR) AS q_sdm_home_product_use_alt, CAST(k % 4 AS VARCHAR) AS q_sdm_ropo_enum,
      CAST(k % 5 AS VARCHAR) AS q_sdm_home_competitive_prices_alt,
      CASE WHEN o_orderpriority = '1-URGENT' THEN b.a_surveyid END AS surveyid_ces,
      CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END AS sales_margin_dt,
      CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate END AS customer_ces_dt,
      CASE WHEN o_orderpriority = '1-URGENT' THEN k % 6 END AS ces_level_val,
      CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS fecha_transaccion,
      CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS "VENTA",
      CASE WHEN o_orderstatus = 'F' THEN o_totalprice / 2 END AS "COSTO",
      CASE WHEN o_orderstatus = 'F' THEN k % 10 END AS "UNIDADES", CASE WHEN o_orderstatus = 'F' THEN c END AS main_customer_id,
      CASE WHEN o_orderstatus = 'F' THEN k % 2 END AS cliente_volvio,
      CASE WHEN o_orderstatus = 'F' THEN k % 30 END AS dias_para_volver,
      CASE WHEN o_orderstatus = 'F' THEN k % 4 END AS veces_que_volvio,
      CASE WHEN o_orderstatus = 'F' THEN k % 3 END AS cliente_habia_ido,
      CASE WHEN o_orderstatus = 'F' THEN k % 90 END AS dias_desde_ultima_visita,
      CASE WHEN o_orderstatus = 'F' THEN k % 5 END AS veces_que_habia_ido,
      CASE WHEN movil THEN 'MPOS' WHEN left(b.doc, 3) IN ({_TILLS}) OR left(b.doc, 6) IN ({_TILLS_PADDED}) THEN 'Caja SCO'
           ELSE 'Caja Asistida' END AS "SCO_Trx",
      CAST(month(fecha) AS INTEGER) AS mes, CAST(year(fecha) AS INTEGER) AS anio, {MONTHS.format('fecha')} AS mes_nombre_numero,
      CAST(month(compra) AS INTEGER) AS mes_transaccion, {MONTHS.format('compra')} AS mes_transaccion_nombre_numero,
      CAST(day(compra) AS INTEGER) AS cod_dia_trx, {DAYS.format('compra')} AS dia_semana_ordenado,
      strftime(fecha, '%Y-%m-%d') AS "Fecha_actualizacion", canal AS canal_venta_general, unit_number, h AS hora_extraida,
      CASE WHEN h BETWEEN 7 AND 22 THEN h || ':00 - ' || (h + 1) || ':00' WHEN hora IS NULL THEN NULL
           ELSE 'no identificado' END AS rango_horario,
      right(b.doc, 9) AS "Cod_trx", periodo AS mesanioconcatenados, tienda || periodo AS llave_tienda_respuesta,
      canal || periodo AS llave_canal_plan, CASE WHEN k % 3 <> 0 THEN 'Caja' END AS topico_1,
      CASE WHEN k % 3 <> 0 THEN 'Positivo' END AS sentimento_1, CASE WHEN k % 3 <> 0 THEN o_orderpriority END AS topico_2,
      CASE WHEN k % 3 <> 0 THEN 'Negativo' END AS sentimento_2, CAST(NULL AS VARCHAR) AS topico_3,
      CAST(NULL AS VARCHAR) AS sentimento_3,
      CASE WHEN k % 13 = 0 THEN 'Sin Clasificación' WHEN k % 12 >= 10 THEN 'Promotor' WHEN k % 12 >= 8 THEN 'Neutro'
           WHEN k % 12 >= 1 THEN 'Detractor' ELSE 'Sin Clasificación' END AS categoria_nps,
      CASE k % 3 WHEN 1 THEN 'Uso personal' WHEN 2 THEN 'Uso laboral' END AS uso_producto,
      CASE k % 4 WHEN 1 THEN 'Si' WHEN 2 THEN 'No' END AS "Ropo",
      CASE k % 5 WHEN 1 THEN 'De precio bajo' WHEN 2 THEN 'Del mismo precio' WHEN 3 THEN 'De alto precio'
                 WHEN 4 THEN 'De muy alto precio' END AS precios_competitivos,
      st.n_name AS "TIENDA", CAST(st.n_regionkey AS VARCHAR) AS "REGION", {_STORE_SQL},
      CASE WHEN st.n_nationkey IS NOT NULL THEN p.n * 7 / 10 END AS "NPS_PLAN_TIENDA",
      CASE WHEN st.n_nationkey IS NOT NULL THEN strftime(fecha, '%Y%m') || st.n_nationkey END AS "LLAVE_TIENDA",
      aux.n_nationkey + 100 AS "Cod", cia.v / 10.0 AS "NPS_CIA", can.v AS plan_canal_nps,
      CASE WHEN st.n_nationkey IS NOT NULL THEN p.n END AS "Transacciones",
      CASE WHEN st.n_nationkey IS NOT NULL THEN CAST(p.u AS BIGINT) END AS "Unidades_vendidas",
      CASE WHEN st.n_nationkey IS NOT NULL THEN p.v END AS "Ventas"
    FROM b LEFT JOIN mov ON mov.doc = b.doc LEFT JOIN nation st ON unit_number = CAST(st.n_nationkey AS VARCHAR)
    LEFT JOIN pla p ON p.m = month(fecha) AND p.y = year(fecha) AND p.s = st.n_nationkey
    LEFT JOIN nation aux ON aux.n_name = tienda LEFT JOIN cia ON cia.m = month(fecha) AND cia.y = year(fecha)
    LEFT JOIN cia can ON can.m = month(fecha) AND can.y = year(fecha)
      AND canal_plan = ['TIENDA', 'VAD', 'VENTA EMPRESA'][can.y % 3 + 1]
""")
def mart(t):
    return survey.survey_mart(tables(t))


_NPS = """
    count(*) FILTER ({s} BETWEEN 1 AND 11) AS respuestas, count(*) FILTER ({s} IN (10, 11)) AS promotores,
    count(*) FILTER ({s} IN (8, 9)) AS neutros, count(*) FILTER ({s} BETWEEN 1 AND 7) AS detractores,
    CASE WHEN count(*) FILTER ({s} BETWEEN 1 AND 11) > 0 THEN CAST(100 AS DOUBLE) * CAST(count(*) FILTER ({s} IN (10, 11))
      - count(*) FILTER ({s} BETWEEN 1 AND 7) AS DOUBLE) / count(*) FILTER ({s} BETWEEN 1 AND 11) END AS nps
"""


@query("nps_by_segment", f"""
    WITH r AS (SELECT c_mktsegment, CAST(month(o_orderdate) AS INTEGER) AS mes, {_NPS.format(s='(o_orderkey % 12)')},
                      CAST(max(c_nationkey) AS DOUBLE) AS plan
               FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
    SELECT *, nps - plan AS brecha_plan FROM r
""")
def nps_by_segment(t):
    answers = enrich(t.orders, t.customer, [("o_custkey", "c_custkey")], ["c_mktsegment", "c_nationkey"], expect="unique").withColumns(
        {"mes": F.month("o_orderdate"), "meta": F.col("c_nationkey").cast("double")}
    )
    return survey.nps_by(answers, ["c_mktsegment", "mes"], F.col("o_orderkey") % 12, plan="meta")


@query("nps_by_delay", f"""
    WITH l AS (SELECT l_orderkey, max(date_diff('day', o_orderdate, l_shipdate)) AS atraso
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
    m AS (SELECT o_orderkey % 11 AS s, atraso FROM orders LEFT JOIN l ON l_orderkey = o_orderkey AND o_orderkey > 0),
    r AS (SELECT CAST(CASE WHEN atraso <= 0 THEN 0 WHEN atraso > 7 THEN 8 ELSE atraso END AS INTEGER) AS tramo_atraso,
                 {_NPS.format(s='(s + 1)')} FROM m GROUP BY 1)
    SELECT *, (SELECT nps FROM r WHERE tramo_atraso = 0) - nps AS puntos_perdidos FROM r
""")
def nps_by_delay(t):
    surveys = t.orders.select("o_orderkey", text("o_orderkey").alias("doc"), (F.col("o_orderkey") % 11).alias("nota"))
    lines = enrich(t.lineitem, t.orders, [("l_orderkey", "o_orderkey")], ["o_orderdate"], expect="unique").withColumn(
        "line_doc", text("l_orderkey")
    )
    matched = delivery.survey_deliveries(surveys, lines, "doc", "line_doc", "o_orderdate", "l_shipdate",
                                         ["l_partkey asc", "l_suppkey asc"])
    return delivery.nps_by_delay(matched, "nota", shift=1)


@query("nps_by_origin", f"""
    WITH w AS (SELECT l_orderkey, l_suppkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
               QUALIFY row_number() OVER (PARTITION BY l_orderkey
                 ORDER BY date_diff('day', o_orderdate, l_shipdate) DESC, l_partkey, l_suppkey) = 1)
    SELECT n_name AS nodo, c_nationkey AS region, {_NPS.format(s='(o_orderkey % 11 + 1)')}
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN w ON l_orderkey = o_orderkey AND o_orderkey > 0
    LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2
""")
def nps_by_origin(t):
    surveys = enrich(t.orders, t.customer, [("o_custkey", "c_custkey")], {"c_nationkey": "region"}, expect="unique").select(
        "o_orderkey", text("o_orderkey").alias("doc"), (F.col("o_orderkey") % 11).alias("nota"), "region"
    )
    lines = enrich(t.lineitem, t.orders, [("l_orderkey", "o_orderkey")], ["o_orderdate"], expect="unique").withColumn(
        "line_doc", text("l_orderkey")
    )
    matched = delivery.survey_deliveries(surveys, lines, "doc", "line_doc", "o_orderdate", "l_shipdate",
                                         ["l_partkey asc", "l_suppkey asc"], ["l_suppkey"])
    matched = enrich(matched, t.supplier, [("l_suppkey", "s_suppkey")], ["s_nationkey"], expect="unique")
    matched = enrich(matched, t.nation, [("s_nationkey", "n_nationkey")], {"n_name": "nodo"}, expect="unique")
    return survey.nps_by(matched, ["nodo", "region"], "nota", shift=1)


@query("fragmentation_effect", """
    WITH f AS (SELECT l_orderkey, count(DISTINCT l_shipdate) > 1 AS fragmentado, max(l_orderkey % 5 + 1) AS nota
               FROM lineitem GROUP BY 1)
    SELECT fragmentado, count(*) AS ordenes, avg(nota) AS csat FROM f GROUP BY 1
""")
def fragmentation(t):
    lines = t.lineitem.withColumn("nota", F.col("l_orderkey") % 5 + 1)
    return delivery.fragmentation_effect(lines, "l_orderkey", "l_shipdate", "nota")
