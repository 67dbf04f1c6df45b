"""Customer-survey mart and its indicators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import labels
from ..functions.dates import in_years, month_year
from ..functions.text import extract_some, last_chars
from ..operators.joins import enrich

STORE_COLUMNS = (
    "TIENDA", "REGION", "SUBREGION", "TIPO_TIENDA", "GERENTE_REGIONAL", "CATEGORIA", "TIENDA_SCO",
    "TRANSFORMACION", "S1", "S2", "S3", "S4", "S5",
)
MONEY_COLUMNS = (
    "fecha_transaccion", "VENTA", "COSTO", "UNIDADES", "main_customer_id", "cliente_volvio", "dias_para_volver",
    "veces_que_volvio", "cliente_habia_ido", "dias_desde_ultima_visita", "veces_que_habia_ido",
)


def survey_base(
    surveys: DataFrame,
    country: str = fixed.SURVEY_COUNTRY,
    status: str = fixed.SURVEY_STATUS,
    years: Sequence[int] = fixed.SURVEY_YEARS,
) -> DataFrame:
    """Answered surveys of a country and a list of response years (F2); all three tests reach the scan."""
    return surveys.filter(
        (F.col("e_sdm_country_alt") == country)
        & (F.col("e_status") == status)
        & in_years("e_responsedate", years)
    )


def add_period_labels(df: DataFrame, responded: str, bought: str) -> DataFrame:
    """Month and weekday labels of response and purchase (B2)."""
    return df.withColumns(
        {
            "mes": F.month(responded),
            "anio": F.year(responded),
            "mes_nombre_numero": labels.month_label(responded),
            "mes_transaccion": F.month(bought),
            "mes_transaccion_nombre_numero": labels.month_label(bought),
            "cod_dia_trx": F.dayofmonth(bought),
            "dia_semana_ordenado": labels.weekday_label(bought),
            "Fecha_actualizacion": F.date_format(responded, "yyyy-MM-dd"),
        }
    )


def add_period_keys(df: DataFrame, responded: str, store: str, channel: str) -> DataFrame:
    """Month, store-month and channel-month keys."""
    period = month_year(responded)
    return df.withColumns(
        {
            "mesanioconcatenados": period,
            "llave_tienda_respuesta": F.concat(F.col(store), period),
            "llave_canal_plan": F.concat(F.col(channel), period),
        }
    )


def survey_labels(df: DataFrame) -> DataFrame:
    """Recommendation class and answer labels."""

    def number(c):
        return F.col(c).try_cast("bigint")

    return df.withColumns(
        {
            "categoria_nps": labels.nps_class(number("q_sdm_ltr11")),
            "uso_producto": labels.translate(number("q_sdm_home_product_use_alt"), fixed.PRODUCT_USE),
            "Ropo": labels.translate(number("q_sdm_ropo_enum"), fixed.ROPO),
            "precios_competitivos": labels.translate("q_sdm_home_competitive_prices_alt", fixed.PRICE_PERCEPTION),
        }
    )


def topic_sentiment(df: DataFrame, source: str, n: int = 3) -> DataFrame:
    """Topic and sentiment columns 1..n out of ``topic (sentiment), ...`` text."""
    out = {}
    for i in range(n):
        out[f"topico_{i + 1}"] = labels.topic(source, i)
        out[f"sentimento_{i + 1}"] = labels.sentiment(source, i)
    return df.withColumns(out)


def explode_topics(df: DataFrame, source: str, keep: Sequence[str]) -> DataFrame:
    """One row per topic, however many there are."""
    out = df.select(*keep, F.posexplode(F.split(F.col(source), ", ")).alias("posicion", "_item"))
    return out.select(
        *keep,
        "posicion",
        labels.topic("_item", 0).alias("topico"),
        labels.sentiment("_item", 0).alias("sentimiento"),
    )


def topic_counts(topics: DataFrame, dims: Sequence[str] = ()) -> DataFrame:
    return topics.groupBy(*dims, "topico", "sentimiento").agg(F.count(F.lit(1)).alias("menciones"))


def till_of_survey(surveys: DataFrame, report: DataFrame, terminals: DataFrame, document: str) -> DataFrame:
    """Till class, from the till report of the document and the list of mobile terminals.

    A document with several tills in the report counts as mobile when any of them is.
    """
    mobile = (
        enrich(
            report,
            terminals.withColumn("_mobile", F.lit(True)),
            [("codigo_cajero", "Terminales"), ("sucursal", "Cod")],
            ["_mobile"],
            what="terminals",
        )
        .groupBy("num_documento")
        .agg(F.max(F.coalesce("_mobile", F.lit(False))).alias("_mobile"))
    )
    out = enrich(surveys, mobile, [(document, "num_documento")], ["_mobile"], expect="unique", spread=True)
    return out.withColumn("SCO_Trx", labels.till_class(document, F.coalesce("_mobile", F.lit(False)))).drop("_mobile")


def survey_mart(tables: Mapping[str, DataFrame], **base) -> DataFrame:
    """Survey experience mart (B1): one row per survey, stores, plans, till class and sales attached.

    tables: surveys, ces, money, stores, store_plan, store_aux, company_plan,
    channel_plan, till_report, mobile_terminals, sales. Surveys are made unique
    before the joins and every lookup is unique on its key, so no distinct over
    the wide result is needed. The large sides (ces, money, till report) are joined
    first, while rows are narrowest after the scan's own columns.
    """
    t = tables
    # Hashed by survey: distinct and the two joins below need no further shuffle.
    out = survey_base(t["surveys"], **base).repartition("a_surveyid").distinct()
    out = enrich(out, t["ces"].withColumn("surveyid_ces", F.col("a_surveyid")), [("a_surveyid", "a_surveyid")],
                 ["surveyid_ces", "sales_margin_dt", "customer_ces_dt", "ces_level_val"], spread=False, what="ces")
    out = enrich(out, t["money"], [("a_surveyid", "id")], MONEY_COLUMNS, spread=False, what="money")
    out = till_of_survey(out, t["till_report"], t["mobile_terminals"], "e_sdm_transaction_number_text")

    responded, bought = "e_responsedate", "e_sdm_transaction_date_date"
    codes = ("e_sdm_store_type_radio", "e_sdm_survey_type_alt", "e_sdm_punto_contacto", responded)
    out = add_period_labels(out, responded, bought)
    out = out.withColumns(
        {
            "canal_venta_general": labels.sales_channel(*codes),
            "_plan_channel": F.concat(labels.sales_channel(*codes, variant="plan"), month_year(responded)),
            "unit_number": extract_some("e_unitid", r"-([0-9]+)\z"),
            "hora_extraida": labels.hour_of_ticket("e_sdm_hora_tirilla_ticket"),
            "rango_horario": labels.hour_bucket("e_sdm_hora_tirilla_ticket"),
            "Cod_trx": last_chars("e_sdm_transaction_number_text", 9),
        }
    )
    out = add_period_keys(out, responded, "e_sdm_store_name_text", "canal_venta_general")
    out = survey_labels(topic_sentiment(out, "a_topics_sentiments_tagged_original"))

    stores = t["stores"].withColumn("_code", F.col("CODIGO").cast("string"))
    out = enrich(out, stores, [("unit_number", "_code")], [*STORE_COLUMNS, "_code"], what="stores")
    out = enrich(
        out,
        t["store_plan"].withColumn("NPS_PLAN_TIENDA", F.col("NPS") / 10),
        [(labels.store_plan_key(responded, "_code"), "LLAVE_TIENDA")],
        ["NPS_PLAN_TIENDA", "LLAVE_TIENDA"],
        what="store plan",
    )
    out = enrich(out, t["store_aux"], [("e_sdm_store_name_text", "Nombre_Tienda")], ["Cod"], what="store names")
    out = enrich(
        out,
        t["company_plan"].select("LLAVE_CIA", (F.col("NPS_CIA") / 10.0).alias("NPS_CIA")),
        [(labels.company_plan_key(responded), "LLAVE_CIA")],
        ["NPS_CIA"],
        what="company plan",
    )
    out = enrich(out, t["channel_plan"], [("_plan_channel", "LLAVE")], {"NPS": "plan_canal_nps"}, what="channel plan")
    return enrich(
        out,
        t["sales"],
        [(labels.sales_key("_code", "mes", "anio"), labels.sales_key("location_id", "month", "year"))],
        {"transactions3": "Transacciones", "unidades": "Unidades_vendidas", "venta": "Ventas"},
        what="sales",
    ).drop("_plan_channel", "_code")


def share(test: Column) -> Column:
    """Share of rows meeting a test, NULL tests counting as no."""
    return F.avg(F.when(test, 1.0).otherwise(0.0))


def nps_columns(score: Column, shift: int = 0) -> list[Column]:
    """Answers, class counts and NPS = % promoters - % detractors over the classified answers."""
    kind = labels.nps_class(score, shift)

    def count(label):
        return F.count_if(kind == label)

    promoters, neutrals, detractors = (
        count(fixed.NPS_PROMOTER), count(fixed.NPS_NEUTRAL), count(fixed.NPS_DETRACTOR)
    )
    answers = promoters + neutrals + detractors
    return [
        answers.alias("respuestas"),
        promoters.alias("promotores"),
        neutrals.alias("neutros"),
        detractors.alias("detractores"),
        F.when(answers > 0, 100.0 * (promoters - detractors) / answers).alias("nps"),
    ]


def nps_by(
    mart: DataFrame, dims: Sequence[str], score: Column | str, shift: int = 0, plan: str | None = None
) -> DataFrame:
    """NPS by dimensions, with the distance to plan when a plan column is named."""
    score = F.col(score) if isinstance(score, str) else score
    cols = nps_columns(score, shift)
    if plan:
        cols.append(F.max(plan).alias("plan"))
    out = mart.groupBy(*dims).agg(*cols)
    return out.withColumn("brecha_plan", F.col("nps") - F.col("plan")) if plan else out
