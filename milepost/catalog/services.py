"""Services mart and its indicators on the driver tables."""

from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..operators.joins import enrich
from ..plans import services
from .joins import _REFERENCES, references
from .registry import query

_STATES = ["created", "Done ", "cancelled", "on_my_way", "accepted", "unknown", " CREATED"]


def pick(values, index):
    """Value of a short list by number, from 0."""
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def text(c):
    return F.col(c).cast("string")


def tables(t):
    """The eighteen inputs of the mart, derived from the driver tables."""
    o, k = t.orders, F.col("o_orderkey")
    refs = references(t)
    booking = o.select(
        text("o_orderkey").alias("id"),
        (F.col("o_custkey") % 100).cast("string").alias("professional_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", text("o_orderkey")).alias("shopping_cart_id"),
        (F.col("o_orderdate") + F.expr("INTERVAL 10 DAYS")).alias("done_date"),
        F.col("o_orderdate").alias("date"),
        F.when(F.col("o_orderstatus") == "F", "approved").when(F.col("o_orderstatus") == "O", "pending")
        .otherwise("x").alias("payment_status"),
        F.col("o_orderpriority").alias("service_name"),
        text("o_totalprice").alias("final_cost"),
        F.when(k % 9 == 0, "s/p").otherwise(text("o_totalprice")).alias("final_price"),
        (k % 150).cast("string").alias("service_variant_area_id"),
        (k % 30).cast("string").alias("category_id"),
        (k % 27).cast("string").alias("sale_channel_id"),
    )
    log = t.lineitem.select(
        (F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("id"),
        F.col("l_orderkey").alias("booking_id"),
        pick(_STATES, F.col("l_linenumber") - 1).alias("new_status"),
        F.col("l_shipdate").alias("updated_date"),
        F.col("l_suppkey").alias("user_id"),
    )
    email = F.concat(F.lit("u"), text("c_custkey"), F.lit("@x"))
    return {
        "booking": booking,
        "booking_log": log,
        "professional": t.supplier.select(
            F.col("s_suppkey").alias("id"), F.col("s_suppkey").alias("user_id"),
            F.when(F.col("s_suppkey") % 2 == 0, F.col("s_nationkey")).alias("parent_id"),
        ),
        "users": t.customer.select(
            F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 5 == 0, " ").otherwise(F.col("c_name")).alias("name"),
            F.when(F.col("c_custkey") % 5 == 0, "").otherwise(F.col("c_mktsegment")).alias("lastname"), email.alias("email"),
        ),
        "shopping_cart": o.select(
            k.alias("id"), F.col("o_custkey").alias("user_id"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("project_id"),
        ),
        "creator_team": t.customer.filter(F.col("c_acctbal") > 2000).select(
            email.alias("Correo_creador"), F.col("c_mktsegment").alias("gestion")
        ),
        "incident": t.lineitem.filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 30)).select(
            (F.col("l_partkey") * 1000000 + F.col("l_suppkey") * 100 + F.col("l_linenumber")).alias("id"),
            text("l_orderkey").alias("entity_id"), F.col("l_linenumber").alias("booking_incident_reason_id"),
        ),
        "incident_reason": t.nation.select(
            F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"),
            F.concat(F.lit("d "), F.col("n_name")).alias("description"),
            F.col("n_regionkey").alias("booking_incident_category_id"),
        ),
        "incident_category": t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")),
        "variant_operation": t.part.select(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("service_variant_id")
        ),
        "service_variant": t.part.select("p_size").distinct().select(
            F.col("p_size").alias("id"), (F.col("p_size") % 25).alias("service_id"),
            (F.col("p_size") % 3 == 0).alias("is_budget"),
        ),
        "service": t.nation.select(
            F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("service_type_id")
        ),
        "service_type": t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")),
        "category": t.nation.select(
            F.col("n_nationkey").alias("id"),
            F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("PISO - "), F.col("n_name"))).otherwise(F.col("n_name")).alias(
                "name"
            ),
        ),
        "sale_channel": t.nation.select(
            F.col("n_nationkey").alias("id"), F.concat(text("n_nationkey"), F.lit(" - "), F.col("n_name")).alias("name")
        ),
        "external_transaction": refs.select(
            k.alias("id"), (k - k % 2).alias("shopping_cart_id"), F.col("referencia").alias("reference")
        ),
        "budget_execution": t.lineitem.filter(F.col("l_returnflag") == "A").select(
            F.col("l_orderkey").alias("budget_booking_id"), F.col("l_shipdate").alias("created_date"),
            F.col("l_partkey").alias("id"), F.col("l_linestatus").alias("name"),
            F.when(F.col("l_linestatus") == "O", "created").otherwise("other").alias("status"),
            text("l_extendedprice").alias("total_quote"),
        ),
        "surveys": refs.select(
            text("o_orderkey").alias("a_surveyid"),
            (F.col("o_orderdate") + F.expr("INTERVAL 26 YEARS")).alias("e_creationdate"),
            (F.col("o_orderdate") + F.expr("INTERVAL 26 YEARS")).alias("e_responsedate"),
            F.col("referencia").alias("e_sdm_transaction_number_text"),
            (k % 11 + 1).cast("string").alias("q_sdm_instalaciones_ltr"),
            F.when(F.col("o_orderstatus") != "F", text("o_custkey")).alias("e_sdm_instalaciones_proveedor_servicio"),
            F.when(F.col("o_custkey") % 10 == 0, "2").otherwise("4").alias("e_sdm_country_alt"),
            *[(k % n).cast("string").alias(f"q_sdm_instalaciones_{c}_sat5")
              for n, c in ((2, "amabilidad"), (3, "calidad"), (4, "fechas"), (5, "orden_limpieza"))],
            F.lit("bien").alias("q_sdm_instalaciones_comment"), F.lit(None).cast("string").alias("q_sdm_instalaciones_comment_2"),
            F.lit("Tienda (Positivo)").alias("a_topics_sentiments_tagged_original"),
        ),
    }


def _case(column, mapping):
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


_MART = f"""
    WITH {_REFERENCES},
    log AS (SELECT l_partkey * 1000 + l_suppkey AS id, l_orderkey AS b, {_STATES}[l_linenumber] AS st, l_shipdate AS d,
                   l_suppkey AS u FROM lineitem),
    ult AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY b ORDER BY d DESC, id DESC, st DESC, u DESC) = 1),
    pri AS (SELECT * FROM log WHERE lower(st) = 'created'
            QUALIFY row_number() OVER (PARTITION BY b ORDER BY d, id, st, u) = 1),
    users AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN ' ' ELSE c_name END AS n,
                     CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END AS l, 'u' || c_custkey || '@x' AS email,
                     c_acctbal, c_mktsegment FROM customer),
    prof AS (SELECT s_suppkey AS id, s_suppkey AS uid, CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey END AS pid FROM supplier),
    inc AS (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 30
            QUALIFY row_number() OVER (PARTITION BY l_orderkey
              ORDER BY l_partkey * 1000000 + l_suppkey * 100 + l_linenumber DESC) = 1),
    pre AS (SELECT l_orderkey, l_linestatus,
                   sum(CAST(l_extendedprice AS DECIMAL(38,9))) OVER (PARTITION BY l_orderkey) AS total
            FROM lineitem WHERE l_returnflag = 'A'
            QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_partkey DESC, l_linestatus DESC) = 1),
    doc AS (SELECT o_orderkey - o_orderkey % 2 AS cart, clave, calidad FROM keyed
            QUALIFY row_number() OVER (PARTITION BY o_orderkey - o_orderkey % 2 ORDER BY o_orderkey DESC) = 1),
    enc AS (SELECT CAST(o_orderkey AS VARCHAR) AS sid, o_orderdate + INTERVAL 26 YEAR AS r, clave, o_orderkey AS k FROM keyed
            WHERE o_orderstatus <> 'F' AND o_custkey % 10 <> 0 AND year(o_orderdate + INTERVAL 26 YEAR) >= 2025
              AND coalesce(clave, '') <> '' {{newest}}),
    base AS (
      SELECT o.o_orderkey AS k, CAST(o.o_orderkey AS VARCHAR) AS booking_id, pri.d AS fecha_creacion,
        o.o_orderdate + INTERVAL 10 DAY AS fecha_finalizacion, o.o_orderdate AS fecha_programacion,
        CASE o.o_orderstatus WHEN 'F' THEN 'Aprobado' WHEN 'O' THEN 'Pendiente' END AS estado_de_pago,
        {_case('lower(trim(ult.st))', fixed.BOOKING_STATES)} AS estado_del_servicio,
        CASE WHEN cat.n_nationkey % 2 = 0 THEN 'PISO - ' || cat.n_name ELSE cat.n_name END AS categoria_servicio,
        CASE WHEN cat.n_nationkey % 2 = 0 THEN 'PISO' ELSE cat.n_name END AS categoria_macroservicio,
        ty.r_name AS bucket_servicio, p_name AS servicio_solicitado, se.n_name AS tipo_servicio,
        o.o_orderpriority AS nombre_servicio, sc.n_nationkey || ' - ' || sc.n_name AS canal_de_venta,
        CAST(sc.n_nationkey AS BIGINT) AS codigo_tienda, sc.n_name AS nombre_tienda, ic.r_name AS categoria_incidente,
        ir.n_name AS razon_incidente, 'd ' || ir.n_name AS descripcion_incidente, cl.email AS cliente_email,
        pu.email AS profesional_email, cr.email AS creador_email,
        coalesce(nullif(trim(fu.n || ' ' || fu.l), ''), nullif(trim(pu.n || ' ' || pu.l), '')) AS nombre_contratista,
        CASE WHEN cr.c_acctbal > 2000 THEN cr.c_mktsegment END AS gestion, doc.clave AS clave_canonica_reference,
        doc.calidad AS calidad_reference, enc.sid AS a_surveyid, enc.r AS e_creationdate, enc.r AS e_responsedate,
        coalesce(CAST(enc.r AS DATE), CAST(o.o_orderdate AS DATE)) AS fecha_respuesta, enc.k % 11 AS nps,
        CAST(enc.k % 2 AS VARCHAR) AS csat_instalaciones_amabilidad, CAST(enc.k % 3 AS VARCHAR) AS csat_instalaciones_calidad,
        CAST(enc.k % 4 AS VARCHAR) AS csat_instalaciones_fechas, CAST(enc.k % 5 AS VARCHAR) AS csat_instalaciones_orden_limpieza,
        CASE WHEN enc.k IS NOT NULL THEN 'bien' END AS comentario_principal, CAST(NULL AS VARCHAR) AS comentario_secundario,
        CASE WHEN enc.k IS NOT NULL THEN 'Tienda (Positivo)' END AS topicos_encuesta,
        ca.o_custkey AS cliente_user_id, pr.uid AS profesional_user_id, pri.u AS creador_user_id,
        ult.u AS ultimo_actor_user_id, o.o_totalprice AS costo,
        CASE WHEN o.o_orderkey % 9 <> 0 THEN o.o_totalprice END AS importe,
        CASE WHEN ca.o_orderstatus <> 'P' THEN ca.o_custkey END AS "Proyecto_id",
        CASE WHEN p_size % 3 = 0 THEN 'Presupuestado' ELSE 'No Presupuestado' END AS "Presupuesto_flag",
        CAST(pre.total AS DOUBLE) AS costo_presupuesto,
        CASE pre.l_linestatus WHEN 'O' THEN 'Cargado por el Proveedor' WHEN 'F' THEN 'other' END AS "Estado_presupuesto"
      FROM orders o
      LEFT JOIN ult ON o.o_orderkey = ult.b LEFT JOIN pri ON o.o_orderkey = pri.b
      LEFT JOIN pre ON o.o_orderkey = pre.l_orderkey LEFT JOIN inc ON o.o_orderkey = inc.l_orderkey
      LEFT JOIN orders ca ON o.o_orderpriority <> '5-LOW' AND ca.o_orderkey = o.o_orderkey
      LEFT JOIN doc ON o.o_orderpriority <> '5-LOW' AND doc.cart = o.o_orderkey
      LEFT JOIN prof pr ON pr.id = o.o_custkey % 100 LEFT JOIN prof fa ON fa.id = pr.pid
      LEFT JOIN users cl ON cl.id = ca.o_custkey LEFT JOIN users pu ON pu.id = pr.uid
      LEFT JOIN users cr ON cr.id = ult.u LEFT JOIN users fu ON fu.id = fa.uid
      LEFT JOIN nation ir ON ir.n_nationkey = inc.l_linenumber LEFT JOIN region ic ON ic.r_regionkey = ir.n_regionkey
      LEFT JOIN part ON p_partkey = o.o_orderkey % 150 LEFT JOIN nation se ON se.n_nationkey = p_size % 25
      LEFT JOIN region ty ON ty.r_regionkey = se.n_regionkey LEFT JOIN nation cat ON cat.n_nationkey = o.o_orderkey % 30
      LEFT JOIN nation sc ON sc.n_nationkey = o.o_orderkey % 27 LEFT JOIN enc ON enc.clave = doc.clave),
    proj AS (
      SELECT *, coalesce('p:' || "Proyecto_id", 'b:' || booking_id) AS pk FROM base),
    f AS (
      SELECT *, max(CASE WHEN "Presupuesto_flag" = 'Presupuestado' THEN 1 ELSE 0 END) OVER (PARTITION BY pk)
               AS proyecto_tiene_presupuesto,
             max(CASE WHEN "Presupuesto_flag" <> 'Presupuestado' AND estado_del_servicio = 'Completado' THEN 1 ELSE 0 END)
               OVER (PARTITION BY pk) AS proyecto_tiene_ejecucion FROM proj)
    SELECT * EXCLUDE (k, pk),
      CASE WHEN a_surveyid IS NULL THEN NULL
           WHEN row_number() OVER (PARTITION BY a_surveyid ORDER BY booking_id) = 1 THEN 'PRINCIPAL' ELSE 'SECUNDARIO' END
        AS estado_encuesta,
      CASE WHEN "Presupuesto_flag" = 'Presupuestado' THEN 'PRESUPUESTO' WHEN estado_del_servicio = 'Completado'
           THEN 'EJECUCION' ELSE 'OTRO' END AS rol_booking_en_proyecto,
      CASE WHEN proyecto_tiene_presupuesto = 1 AND proyecto_tiene_ejecucion = 1 THEN 'EJECUTADO'
           WHEN proyecto_tiene_presupuesto = 1 THEN 'PENDIENTE DE EJECUTAR' ELSE 'SIN PRESUPUESTO' END AS estado_proyecto
    FROM f
"""


_NEWEST = "QUALIFY row_number() OVER (PARTITION BY clave ORDER BY r DESC, CAST(o_orderkey AS VARCHAR) DESC) = 1"


def _mart(t, match):
    out = services.services_mart(tables(t), match)
    return out.withColumn("costo_presupuesto", F.col("costo_presupuesto").cast("double")).drop(
        "professional_id", "shopping_cart_id"
    )


@query("services_mart", _MART.replace("{newest}", ""))
def mart(t):
    return _mart(t, "all")


@query("services_mart_latest", _MART.replace("{newest}", _NEWEST))
def mart_latest(t):
    return _mart(t, "latest")


def served_lines(t):
    """Order lines as services: requested, scheduled, finished and promised."""
    lines = enrich(t.lineitem, t.orders, [("l_orderkey", "o_orderkey")], ["o_orderdate", "o_custkey", "o_orderpriority"], expect="unique")
    lines = enrich(lines, t.customer, [("o_custkey", "c_custkey")], ["c_mktsegment"], expect="unique")
    day = F.col("o_orderdate")
    return lines.select(
        "l_suppkey", "c_mktsegment", "o_orderpriority",
        F.when(F.col("l_linestatus") == "F", "Completado").when(F.col("l_returnflag") == "R", "Cancelado")
        .otherwise("En camino").alias("estado"),
        day.alias("pedido"),
        F.date_add(day.cast("date"), F.col("l_linenumber")).alias("agenda"),
        F.date_add(day.cast("date"), (F.col("l_quantity") / 4).cast("int")).alias("fin"),
        F.date_add(day.cast("date"), F.lit(7)).alias("promesa"),
        F.when(F.col("l_discount") > 0.07, pick(["dano", "retraso", "ausencia"], (F.col("l_linenumber") % 3).cast("int")))
        .alias("incidente"),
    )


_SERVED = """
    s AS (SELECT l_suppkey, c_mktsegment, o_orderpriority, CAST(o_orderdate AS DATE) AS d,
            CASE WHEN l_linestatus = 'F' THEN 'Completado' WHEN l_returnflag = 'R' THEN 'Cancelado' ELSE 'En camino' END AS e,
            l_linenumber AS ag, CAST(floor(l_quantity / 4) AS INTEGER) AS fi,
            CASE WHEN l_discount > 0.07 THEN ['dano', 'retraso', 'ausencia'][l_linenumber % 3 + 1] END AS inc
          FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey)
"""
_KPIS = """
    count(*) AS servicios, count(*) FILTER (e = 'Completado') AS ejecutados,
    avg(CASE WHEN e = 'Completado' THEN 1.0 ELSE 0.0 END) AS tasa_ejecucion,
    avg(CASE WHEN e = 'Cancelado' THEN 1.0 ELSE 0.0 END) AS tasa_cancelacion,
    count(inc) AS incidentes, avg(CASE WHEN inc IS NOT NULL THEN 1.0 ELSE 0.0 END) AS tasa_incidentes,
    avg(CASE WHEN ag <= 3 THEN 1.0 ELSE 0.0 END) AS tasa_sla,
    avg(CASE WHEN fi <= 7 THEN 1.0 ELSE 0.0 END) AS tasa_promesa,
    avg(ag) AS dias_agendamiento, avg(fi - ag) AS dias_ejecucion
"""


def _kpis(t, dims):
    return services.service_kpis(served_lines(t), dims, "estado", "pedido", "agenda", "fin", "promesa", "incidente")


@query("services_kpis", f"WITH {_SERVED} SELECT c_mktsegment, o_orderpriority, {_KPIS} FROM s GROUP BY ALL")
def kpis(t):
    return _kpis(t, ["c_mktsegment", "o_orderpriority"])


@query("provider_ranking", f"""
    WITH {_SERVED} SELECT l_suppkey, {_KPIS} FROM s GROUP BY l_suppkey ORDER BY tasa_promesa DESC, l_suppkey LIMIT 10
""")
def provider_ranking(t):
    return services.ranking(_kpis(t, ["l_suppkey"]), "tasa_promesa", ["l_suppkey"], 10)


@query("incident_ranking", f"""
    WITH {_SERVED} SELECT c_mktsegment, inc AS incidente, count(*) AS incidentes FROM s WHERE inc IS NOT NULL GROUP BY ALL
""")
def incidents(t):
    return services.incident_ranking(served_lines(t), ["c_mktsegment"], "incidente")
