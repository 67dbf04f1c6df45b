"""Phones, coordinates, person names and addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .dates import parse_number
from .text import col, digits, one_repeated_char, part_at, strip, words


def clean_phone(c: Column | str, blacklist=fixed.PHONE_BLACKLIST) -> Column:
    """Mobile number ready to receive a message (``519`` and eight digits), else NULL."""
    c = col(c).cast("string")
    only = digits(c)
    full = F.when((F.length(only) == 9) & only.startswith("9"), F.concat(F.lit(fixed.PHONE_COUNTRY), only)).otherwise(
        only
    )
    usable = (
        ~F.lower(strip(c)).isin(*fixed.PHONE_NULL_WORDS)
        & full.rlike(r"^519[0-9]{8}\z")
        & ~full.isin(*blacklist)
        & ~one_repeated_char(F.substring(full, 3, 9))
    )
    return F.when(usable, full)


def phone_key(c: Column | str) -> Column:
    """Lenient phone key, used only to match two sources."""
    bare = strip(F.translate(col(c).cast("string"), "+ ", ""))
    return F.when(bare.startswith(fixed.PHONE_COUNTRY), bare).otherwise(F.concat(F.lit(fixed.PHONE_COUNTRY), bare))


def missing_coord(lat: Column | str, lng: Column | str) -> Column:
    """Either axis null, blank or a written zero."""

    def missing(c):
        return col(c).isNull() | strip(col(c).cast("string")).isin(*fixed.MISSING_COORD_TEXTS)

    return missing(lat) | missing(lng)


def round_at(c: Column | str, decimals: int) -> Column:
    """Round the binary value, as a scaled integer: the written digits may show a tie that it is not."""
    scale = float(10**decimals)
    return F.round(col(c) * scale, 0) / scale


def coord(c: Column | str) -> Column:
    """One axis as a number with seven decimals; NULL for text that is no number."""
    return round_at(parse_number(F.translate(col(c).cast("string"), ",", ".")), 7)


def clean_coords(lat: Column | str, lng: Column | str) -> tuple[Column, Column]:
    """Both axes, or both NULL when either is unreadable or zero."""
    y, x = coord(lat), coord(lng)
    usable = (y != 0) & (x != 0)
    return F.when(usable, y), F.when(usable, x)


def dispatch_precision(c: Column | str) -> Column:
    """Six decimals; a value with two decimals or fewer is nudged so that it carries more."""
    c = col(c)
    return round_at(F.when(round_at(c, 2) == c, c + F.lit(0.000001)).otherwise(c), 6)


def geocode_text(address: Column | str, district: Column | str, city: Column | str) -> Column:
    """``address, district, city, country``; the district ends before `` >``."""

    def text(c):
        return F.coalesce(strip(c), F.lit(""))

    return F.concat_ws(
        ", ", text(address), text(part_at(district, " >", 0)), text(city), F.lit(fixed.GEOCODE_COUNTRY)
    )


def split_name(c: Column | str) -> tuple[Column, Column]:
    """First and last names out of a full name.

    One word serves as both; two or three words give one first name; from four
    words on there are two first names.
    """
    w = words(c)
    n = F.size(w)
    firsts = F.when(n >= 4, 2).otherwise(1)
    first = F.array_join(F.slice(w, 1, firsts), " ")
    last = F.when(n == 1, F.get(w, F.lit(0))).otherwise(F.array_join(F.slice(w, firsts + 1, F.greatest(n, F.lit(1))), " "))
    empty = col(c).isNull() | (n < 1)
    return F.when(empty, "").otherwise(first), F.when(empty, "").otherwise(last)


def greeting_name(c: Column | str) -> Column:
    """First word of the client name, or a fixed word when there is none."""
    return F.coalesce(F.get(words(c), F.lit(0)), F.lit(fixed.DEFAULT_CLIENT_NAME))


def message_parameters(name: Column | str, reservation: Column | str) -> Column:
    return F.concat(col(name), F.lit("-"), col(reservation).cast("string"))
