"""Location capture: lines without coordinates, messages, answers, alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import contact
from ..functions import fixed_values as fixed
from ..functions.dates import AsOf, in_window, literal, moment, on_day, parse_timestamp
from ..functions.text import is_blank, key_text, line_key
from ..operators.joins import enrich, enrich_distinct, in_history, not_in_history, with_state
from ..operators.keyed import dedupe, earliest_per_key, latest_per_key
from ..operators.merge import merge_upsert
from ..operators.quality import split_valid, union_by_name

ALERT_COLUMNS = (
    "NUM_RESERVA", "NOMBRE", "FONO_CLI", "REGION_DESP", "CIUDAD_DESP", "COMUNA_DESP", "DIRECCION_DESP",
    "LATITUD", "LONGITUD", "FECHA_COORDENADA", "FECHA_PROCESO",
)
ADDRESS_COLUMNS = ("REGION_DESP", "CIUDAD_DESP", "COMUNA_DESP", "DIRECCION_DESP")


def now_column(as_of: AsOf) -> Column:
    return literal(moment(as_of).replace(microsecond=0))


def lines_without_coords(
    detail: DataFrame,
    header: DataFrame,
    as_of: AsOf,
    origins: Sequence[int] = fixed.TRACKER_ORIGINS,
    districts: Sequence[str] = fixed.TRACKER_DISTRICTS,
    dispatch_date: str = "FECHA_DESPACHO",
) -> DataFrame:
    """Lines leaving tomorrow to the listed districts without coordinates.

    The district test is on the header, so a line needs one: an inner join, with
    both sides filtered at their scan.
    """
    due = in_window(dispatch_date, as_of, 1, 2)
    lines = detail.filter(F.col("CC_ORIGEN").isin(*origins))
    heads = header.filter(F.col("COMUNA_DESP").isin(*districts) & contact.missing_coord("LATITUD", "LONGITUD"))
    if dispatch_date in lines.columns:
        lines = lines.filter(due)
    else:
        heads = heads.filter(due)
    return lines.join(heads, "NUM_RESERVA", "inner").withColumns(
        {"KEY": line_key("NUM_RESERVA", "PRD_LVL_NUMBER"), "FECHA_PROCESO": now_column(as_of)}
    )


def resend_candidates(coords: DataFrame, sends: DataFrame, as_of: AsOf, fan_out: bool = False) -> DataFrame:
    """Unanswered reservations that were messaged today.

    One row per reservation; ``fan_out`` repeats it for every send of the day (G9).
    """
    waiting = coords.filter(F.col("ESTADO") == fixed.STATE_NO_ANSWER).select(
        "NUM_RESERVA", "FONO_CLI", F.col("NOMBRE").alias("NOMBRE_CLI"), "ESTADO", "INTENTOS"
    )
    today = sends.filter(on_day("FECHA_ENVIO", as_of))
    if fan_out:
        return waiting.join(today.select("NUM_RESERVA"), "NUM_RESERVA", "inner")
    return in_history(waiting, today, "NUM_RESERVA")


def clean_phones(df: DataFrame, phone: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a usable phone, the phone replaced by its clean form, and the rejected rows."""
    marked = df.withColumn("_phone", contact.clean_phone(phone))
    ok, rejected = split_valid(marked, F.col("_phone").isNotNull())
    return ok.withColumn(phone, F.col("_phone")).drop("_phone"), rejected.drop("_phone")


def message_candidates(
    lines: DataFrame, coords: DataFrame, sends: DataFrame, as_of: AsOf, fan_out: bool = False,
    tie: Sequence[str] = ("KEY",),
) -> DataFrame:
    """First line of each reservation never messaged, and the resends.

    Messaged reservations leave before the first line is picked: the pick then
    sorts only what is new.
    """
    lines = lines.withColumn("NUM_RESERVA", key_text("NUM_RESERVA"))
    fresh = earliest_per_key(not_in_history(lines, sends, "NUM_RESERVA"), ["NUM_RESERVA"], ["FECHA_PROCESO", *tie])
    return union_by_name(fresh, resend_candidates(coords, sends, as_of, fan_out))


def message_queue(
    lines: DataFrame, coords: DataFrame, sends: DataFrame, as_of: AsOf, fan_out: bool = False,
    tie: Sequence[str] = ("KEY",),
) -> tuple[DataFrame, DataFrame]:
    """Messages to send now and the rows rejected for their phone."""
    ok, rejected = clean_phones(message_candidates(lines, coords, sends, as_of, fan_out, tie), "FONO_CLI")
    name = contact.greeting_name("NOMBRE_CLI")
    queue = ok.select(
        "NUM_RESERVA",
        "FONO_CLI",
        name.alias("NOMBRE"),
        contact.message_parameters(name, "NUM_RESERVA").alias("PARAMETROS"),
        "INTENTOS",
    )
    return queue, rejected


def explode_feed(documents: DataFrame) -> DataFrame:
    """Points of chat-feed documents with their position (FEED schema)."""
    return documents.select(F.posexplode("extraInfo").alias("posicion", "p")).select("posicion", "p.*")


def latest_coord(feed: DataFrame, time_format: str | None = None, position: str = "posicion") -> DataFrame:
    """Newest point of each phone, the first in the feed among equals.

    Times are compared as text, or as timestamps when their format is given (G14).
    """
    when = parse_timestamp("fecha", time_format) if time_format else F.col("fecha")
    points = feed.filter(~is_blank("latitud") & ~is_blank("longitud")).select(
        contact.phone_key("clientUid").alias("telefono"), "latitud", "longitud", "fecha", position, when.alias("_when")
    )
    return latest_per_key(points, ["telefono"], [F.col("_when").desc_nulls_last(), F.col(position).asc()]).select(
        "telefono", "latitud", "longitud", "fecha"
    )


def pending_rows(df: DataFrame) -> DataFrame:
    """Rows without a state or without an answer."""
    return df.filter(F.col("ESTADO").isNull() | (F.col("ESTADO") == fixed.STATE_NO_ANSWER))


def located(coords: DataFrame) -> DataFrame:
    """Found, with both coordinates."""
    return coords.filter(
        (F.col("ESTADO") == fixed.STATE_FOUND) & F.col("LATITUD").isNotNull() & F.col("LONGITUD").isNotNull()
    )


def match_coordinates(
    sends: DataFrame,
    state: DataFrame,
    feed: DataFrame,
    as_of: AsOf,
    time_format: str | None = None,
    tie: Sequence[str] = ("FONO_CLI", "NOMBRE"),
) -> DataFrame:
    """Answer of today's pending reservations, attempts counted.

    Today's last send per reservation, its saved state, the newest point of its
    phone: found or still without answer, one attempt more either way. Keys are made
    canonical first, so that padded forms of one reservation count as one.
    """
    sends, state = (df.withColumn("NUM_RESERVA", key_text("NUM_RESERVA")) for df in (sends, state))
    today = dedupe(sends.filter(on_day("FECHA_ENVIO", as_of)), ["NUM_RESERVA"], ["FECHA_ENVIO", *tie], keep="last")
    saved = state.select("NUM_RESERVA", "ESTADO", "INTENTOS")
    pending = pending_rows(with_state(today.drop("ESTADO", "INTENTOS"), saved, "NUM_RESERVA", {"INTENTOS": 0}))
    pending = pending.withColumn("FONO_CLI", contact.phone_key("FONO_CLI"))
    out = enrich(
        pending, latest_coord(feed, time_format), [("FONO_CLI", "telefono")],
        {"latitud": "LATITUD", "longitud": "LONGITUD", "fecha": "FECHA_COORDENADA"}, what="feed",
    )
    return out.select(
        "NUM_RESERVA",
        "FONO_CLI",
        "NOMBRE",
        "LATITUD",
        "LONGITUD",
        "FECHA_COORDENADA",
        now_column(as_of).alias("FECHA_PROCESO"),
        F.when(F.col("LATITUD").isNotNull(), fixed.STATE_FOUND).otherwise(fixed.STATE_NO_ANSWER).alias("ESTADO"),
        (F.col("INTENTOS") + 1).cast("bigint").alias("INTENTOS"),
    )


def capture(sends: DataFrame, state: DataFrame, feed: DataFrame | None, as_of: AsOf, **options) -> DataFrame:
    """New content of the coordinates table after one capture run (B26 + M3).

    Without a feed (the service did not answer) the run is skipped and no attempt is
    counted; an answer without points counts one for everybody who is waiting.
    """
    if feed is None:
        return state
    state = state.withColumn("NUM_RESERVA", key_text("NUM_RESERVA"))
    answered = match_coordinates(sends, state, feed, as_of, **options)
    return merge_upsert(state, answered, ["NUM_RESERVA"], on_dup="unique")


def new_alerts(coords: DataFrame, lines: DataFrame, alerts: DataFrame, as_of: AsOf) -> DataFrame:
    """Located reservations not alerted before, with their address.

    Alerted ones leave first, so that addresses are joined to new rows only.
    """
    fresh = not_in_history(located(coords), alerts, "NUM_RESERVA")
    fresh = fresh.withColumn("NUM_RESERVA", key_text("NUM_RESERVA"))
    out = enrich_distinct(fresh, lines, "NUM_RESERVA", ADDRESS_COLUMNS)
    return out.select(*ALERT_COLUMNS, now_column(as_of).alias("FECHA_ALERTA"))
