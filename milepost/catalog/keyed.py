"""Keyed operators on the driver tables."""

from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..operators.keyed import add_any, add_total, dedupe, earliest_per_key, latest_per_key, primary_flag
from ..plans import services
from .registry import query

EVENT_COLUMNS = ["user_id", "event_id", "event_type", "ts", "value"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus"]


@query("latest_status", """
    SELECT user_id, event_id, event_type, ts, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def latest_status(t):
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    return latest_per_key(t.events, ["user_id"], order).select(*EVENT_COLUMNS)


@query("first_created", """
    SELECT user_id, event_id, event_type, ts, value FROM events WHERE event_type = 'signup'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1
""")
def first_created(t):
    signup = F.col("event_type") == "signup"
    return earliest_per_key(t.events, ["user_id"], ["ts", "event_id"], signup).select(*EVENT_COLUMNS)


@query("booking_lifecycle", """
    WITH log AS (
      SELECT event_id AS id, user_id AS booking_id, ts AS updated_date, event_id % 97 AS user_id,
             CASE event_id % 3 WHEN 0 THEN '  ' || upper(event_type) WHEN 1 THEN upper(event_type)
                  ELSE event_type END AS new_status
      FROM events),
    ult AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY booking_id ORDER BY updated_date DESC, id DESC) = 1),
    pri AS (SELECT * FROM log WHERE lower(new_status) = 'signup'
            QUALIFY row_number() OVER (PARTITION BY booking_id ORDER BY updated_date, id) = 1)
    SELECT u.booking_id, lower(trim(u.new_status)) AS ultimo_estado, u.updated_date AS fecha_ultimo_estado,
           u.user_id AS actor_ultimo_estado, p.updated_date AS fecha_creacion, p.user_id AS actor_creacion
    FROM ult u LEFT JOIN pri p ON u.booking_id = p.booking_id
""")
def booking_lifecycle(t):
    log = t.events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("booking_id"),
        F.col("ts").alias("updated_date"),
        (F.col("event_id") % 97).alias("user_id"),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("  "), F.upper("event_type")))
        .when(F.col("event_id") % 3 == 1, F.upper("event_type"))
        .otherwise(F.col("event_type"))
        .alias("new_status"),
    )
    return services.booking_lifecycle(log, first_status="signup")


@query("dedupe_keep_last", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
      l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
      l_linestatus DESC) = 1
""")
def dedupe_keep_last(t):
    return dedupe(t.lineitem, ["l_orderkey", "l_linenumber"], LINE_ORDER, keep="last").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )


@query("primary_flag", """
    WITH s AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS encuesta FROM orders)
    SELECT o_orderkey, encuesta,
           CASE WHEN encuesta IS NULL THEN NULL
                WHEN row_number() OVER (PARTITION BY encuesta ORDER BY o_orderkey) = 1 THEN 'PRINCIPAL'
                ELSE 'SECUNDARIO' END AS estado_encuesta
    FROM s
""")
def primary(t):
    surveyed = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("encuesta"))
    return primary_flag(surveyed, "encuesta", ["o_orderkey"], "estado_encuesta", (fixed.PRIMARY, fixed.SECONDARY))


@query("budget_rollup", """
    WITH b AS (
      SELECT l_orderkey AS budget_booking_id, l_shipdate AS created_date, l_partkey AS id, l_returnflag AS name,
             CASE WHEN l_linestatus = 'O' THEN 'in_progress' ELSE 'archived' END AS status,
             CASE WHEN l_returnflag <> 'N' THEN CAST(l_extendedprice AS VARCHAR) END AS total_quote
      FROM lineitem),
    s AS (SELECT *, sum(coalesce(CAST(total_quote AS DECIMAL(38,9)), 0)) OVER (PARTITION BY budget_booking_id) AS costo
          FROM b)
    SELECT budget_booking_id, created_date, id, name,
           CASE status WHEN 'in_progress' THEN 'En proceso de creación' ELSE status END AS "Estado_presupuesto",
           CAST(costo AS DOUBLE) AS costo_total
    FROM s
    QUALIFY row_number() OVER (PARTITION BY budget_booking_id
      ORDER BY created_date DESC, id DESC, name DESC, status DESC) = 1
""")
def budget_rollup(t):
    budgets = t.lineitem.select(
        F.col("l_orderkey").alias("budget_booking_id"),
        F.col("l_shipdate").alias("created_date"),
        F.col("l_partkey").alias("id"),
        F.col("l_returnflag").alias("name"),
        F.when(F.col("l_linestatus") == "O", "in_progress").otherwise("archived").alias("status"),
        F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice").cast("string")).alias("total_quote"),
    )
    return services.latest_budget(budgets).withColumn("costo_total", F.col("costo_total").cast("double"))


@query("project_state", """
    WITH b AS (
      SELECT o_orderkey AS booking_id, CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS "Proyecto_id",
             CASE WHEN o_orderpriority = '1-URGENT' THEN 'Presupuestado' ELSE 'No Presupuestado' END AS flag,
             CASE o_orderstatus WHEN 'F' THEN 'Completado' WHEN 'P' THEN 'En camino' ELSE 'Cancelado' END AS estado
      FROM orders),
    f AS (
      SELECT *, coalesce('p:' || "Proyecto_id", 'b:' || booking_id) AS k FROM b),
    w AS (
      SELECT *, max(CASE WHEN flag = 'Presupuestado' THEN 1 ELSE 0 END) OVER (PARTITION BY k) AS pre,
             max(CASE WHEN flag <> 'Presupuestado' AND estado = 'Completado' THEN 1 ELSE 0 END)
               OVER (PARTITION BY k) AS eje
      FROM f)
    SELECT booking_id, "Proyecto_id", flag AS "Presupuesto_flag", estado AS estado_del_servicio,
           pre AS proyecto_tiene_presupuesto, eje AS proyecto_tiene_ejecucion,
           CASE WHEN flag = 'Presupuestado' THEN 'PRESUPUESTO' WHEN estado = 'Completado' THEN 'EJECUCION'
                ELSE 'OTRO' END AS rol_booking_en_proyecto,
           CASE WHEN pre = 1 AND eje = 1 THEN 'EJECUTADO' WHEN pre = 1 THEN 'PENDIENTE DE EJECUTAR'
                ELSE 'SIN PRESUPUESTO' END AS estado_proyecto
    FROM w
""")
def project_state(t):
    bookings = t.orders.select(
        F.col("o_orderkey").alias("booking_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("Proyecto_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", fixed.BUDGETED).otherwise(fixed.NOT_BUDGETED).alias(
            "Presupuesto_flag"
        ),
        F.when(F.col("o_orderstatus") == "F", "Completado")
        .when(F.col("o_orderstatus") == "P", "En camino")
        .otherwise("Cancelado")
        .alias("estado_del_servicio"),
    )
    return services.project_state(bookings)


@query("window_totals", """
    SELECT o_orderkey, o_custkey,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey) AS DOUBLE) AS total_cliente,
           max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey) AS alguna_finalizada
    FROM orders
""")
def window_totals(t):
    out = add_total(t.orders, "o_custkey", F.col("o_totalprice").cast("decimal(18,2)"), "total_cliente")
    out = add_any(out, "o_custkey", {"alguna_finalizada": F.col("o_orderstatus") == "F"})
    return out.select("o_orderkey", "o_custkey", F.col("total_cliente").cast("double"), "alguna_finalizada")
