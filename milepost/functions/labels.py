"""Code -> label expressions: literal maps and ``when`` rules, no join needed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .dates import literal, month_year
from .text import col, extract, first_chars, part_at, strip


def translate(c: Column | str, labels: Mapping, keep_unknown: bool = False) -> Column:
    """Label of a code; an unknown code gives NULL, or itself with ``keep_unknown``."""
    c = col(c)
    out = None
    for code, label in labels.items():
        out = F.when(c == code, label) if out is None else out.when(c == code, label)
    return out.otherwise(c) if keep_unknown else out


def month_label(c: Column | str) -> Column:
    return translate(F.month(col(c)), fixed.MONTH_LABELS)


def weekday_label(c: Column | str) -> Column:
    return translate(F.dayofweek(col(c)), fixed.WEEKDAY_LABELS)


def hour_of_ticket(c: Column | str) -> Column:
    """Hour from the first two characters of a ticket time, NULL when they are no number."""
    return strip(first_chars(c, 2)).try_cast("int")


def hour_bucket(c: Column | str) -> Column:
    """``h:00 - h+1:00`` in opening hours, NULL for NULL, a fixed word otherwise."""
    hour = hour_of_ticket(c)
    return (
        F.when(
            hour.between(fixed.HOUR_OPEN, fixed.HOUR_CLOSE),
            F.concat(hour.cast("string"), F.lit(":00 - "), (hour + 1).cast("string"), F.lit(":00")),
        )
        .when(col(c).isNull(), F.lit(None))
        .otherwise(fixed.HOUR_UNKNOWN)
    )


def till_class(document: Column | str, is_mobile: Column, codes=fixed.SELF_SERVICE_TILL_CODES) -> Column:
    """Mobile terminal, self-service till or assisted till."""
    padded = ["000" + code for code in codes]
    self_service = first_chars(document, 3).isin(*codes) | first_chars(document, 6).isin(padded)
    return (
        F.when(is_mobile, fixed.TILL_MOBILE)
        .when(self_service, fixed.TILL_SELF_SERVICE)
        .otherwise(fixed.TILL_ASSISTED)
    )


def _current_channel(store_type: Column, survey_type: Column, contact: Column, store_surveys) -> Column:
    return (
        F.when(store_type == "8", fixed.CHANNEL_BUSINESS)
        .when(
            store_type.isin(*fixed.REMOTE_STORE_TYPES) | survey_type.isin(*fixed.REMOTE_SURVEY_TYPES),
            fixed.CHANNEL_REMOTE,
        )
        .when((store_type == "1") & survey_type.isin(*store_surveys), fixed.CHANNEL_STORE)
        .when(
            (survey_type == "5") & (contact == "9") & store_type.isin("1", "10"),
            fixed.CHANNEL_RETURNS,
        )
        .otherwise(fixed.CHANNEL_UNKNOWN)
    )


def sales_channel(
    store_type: Column | str,
    survey_type: Column | str,
    contact: Column | str,
    responded: Column | str,
    variant: str = "shown",
) -> Column:
    """Sales channel from three survey codes.

    ``shown`` changes rule at a fixed month and is what the mart displays;
    ``plan`` has one rule for all dates and is what the channel plan is keyed on.
    """
    store_type, survey_type, contact = col(store_type), col(survey_type), col(contact)
    if variant == "plan":
        return _current_channel(store_type, survey_type, contact, ["1"])
    if variant != "shown":
        raise ValueError(f"unknown channel variant: {variant}")
    before = translate(
        store_type,
        {"1": fixed.CHANNEL_STORE, "10": fixed.CHANNEL_RETURNS, "8": fixed.CHANNEL_BUSINESS},
    )
    return F.when(
        col(responded) < literal(fixed.CHANNEL_RULE_START),
        F.coalesce(before, F.lit(fixed.CHANNEL_UNKNOWN)),
    ).otherwise(_current_channel(store_type, survey_type, contact, ["1", "7"]))


def nps_class(score: Column | str, shift: int = 0) -> Column:
    """Promoter / neutral / detractor on the 1..11 scale; ``shift`` moves a 0..10 score onto it."""
    score = col(score) + shift
    return (
        F.when(score.isin(10, 11), fixed.NPS_PROMOTER)
        .when(score.isin(8, 9), fixed.NPS_NEUTRAL)
        .when(score.between(1, 7), fixed.NPS_DETRACTOR)
        .otherwise(fixed.NPS_UNCLASSIFIED)
    )


def topic(c: Column | str, index: int) -> Column:
    """Topic number ``index`` (from 0) of ``topic (sentiment), topic (sentiment)`` text."""
    return extract(part_at(c, ", ", index), r"^(.*?) \(")


def sentiment(c: Column | str, index: int) -> Column:
    return extract(part_at(c, ", ", index), r"\((.*?)\)\z")


def macro_category(c: Column | str) -> Column:
    """Text before the first dash when it is one word, else the whole name."""
    return F.coalesce(extract(c, r"^([^ -]+)\s*-"), col(c))


def store_code(sale_channel: Column | str) -> Column:
    return strip(part_at(sale_channel, "-", 0)).try_cast("bigint")


def store_name(sale_channel: Column | str) -> Column:
    return strip(part_at(sale_channel, "-", 1))


def plan_key(*parts: Column | str) -> Column:
    """Composite text key, NULL when any part is NULL."""
    return F.concat(*[col(p).cast("string") for p in parts])


def store_plan_key(responded: Column | str, store: Column | str) -> Column:
    return F.concat(F.date_format(col(responded), "yyyyMM"), col(store).cast("string"))


def company_plan_key(responded: Column | str) -> Column:
    return F.concat(F.lit("CIA"), month_year(responded))


def sales_key(store: Column | str, month: Column | str, year: Column | str) -> Column:
    return F.concat(
        F.lpad(col(store).cast("string"), 3, "0"),
        F.lpad(col(month).cast("string"), 2, "0"),
        col(year).cast("string"),
    )


def contractor_name(parent_first, parent_last, own_first, own_last) -> Column:
    """Full name of the parent provider, else the provider's own."""

    def full(first, last):
        return F.nullif(strip(F.concat(col(first), F.lit(" "), col(last))), F.lit(""))

    return F.coalesce(full(parent_first, parent_last), full(own_first, own_last))
