"""Survey against delivery performance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import digits
from ..operators.joins import match_one
from .survey import nps_columns


def delivery_key(c: Column | str) -> Column:
    """Document reduced to its digits without leading zeros; NULL when it has none."""
    return F.nullif(F.ltrim(digits(c), F.lit("0")), F.lit(""))


def survey_deliveries(
    surveys: DataFrame,
    lines: DataFrame,
    document: str,
    line_document: str,
    promised: str,
    delivered: str,
    tie: Sequence[str],
    cols: Sequence[str] = (),
) -> DataFrame:
    """Each survey with the worst line of its document, by days late; the survey count never changes."""
    surveys = surveys.withColumn("_doc", delivery_key(document))
    lines = lines.withColumns(
        {"_line_doc": delivery_key(line_document), "dias_atraso": F.datediff(F.col(delivered), F.col(promised))}
    )
    worst = ["dias_atraso desc", *tie]
    return match_one(surveys, lines, "_doc", "_line_doc", worst, ["dias_atraso", *cols]).drop("_doc")


def delay_bucket(days: Column | str) -> Column:
    """0 on time, 1..7 days late, 8 for more than a week, NULL when nothing was delivered."""
    days = F.col(days) if isinstance(days, str) else days
    return F.when(days <= 0, 0).when(days > 7, 8).otherwise(days)


def nps_by_delay(matched: DataFrame, score: Column | str, delay: str = "dias_atraso", shift: int = 0) -> DataFrame:
    """NPS per day late, and the points lost against on-time deliveries (A10). At most ten rows."""
    score = F.col(score) if isinstance(score, str) else score
    out = matched.groupBy(delay_bucket(delay).alias("tramo_atraso")).agg(*nps_columns(score, shift))
    # One window over the ten rows of the result, so that the match runs once.
    every = Window.partitionBy(F.lit(0))
    on_time = F.max(F.when(F.col("tramo_atraso") == 0, F.col("nps"))).over(every)
    return out.withColumn("puntos_perdidos", on_time - F.col("nps"))


def fragmentation_effect(lines: DataFrame, key: str, delivered: str, score: str) -> DataFrame:
    """Mean score of orders delivered on one date against orders delivered in pieces (A10).

    Several dates means that the earliest and the latest differ, which needs no distinct.
    """
    orders = lines.groupBy(key).agg(
        (F.min(delivered) < F.max(delivered)).alias("fragmentado"), F.max(score).alias("_score")
    )
    return orders.groupBy(F.coalesce("fragmentado", F.lit(False)).alias("fragmentado")).agg(
        F.count(F.lit(1)).alias("ordenes"), F.avg("_score").alias("csat")
    )
