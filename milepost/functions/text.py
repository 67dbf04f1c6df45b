"""Text expressions. Each takes Columns (or column names) and returns a Column."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\x0b\x0c"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every leading and trailing white-space character, not only blanks."""
    return F.btrim(col(c), F.lit(WHITESPACE))


def null_if_blank(c: Column | str) -> Column:
    return F.nullif(strip(c), F.lit(""))


def is_blank(c: Column | str) -> Column:
    """Null, or empty once trimmed."""
    c = col(c)
    return c.isNull() | (strip(c) == "")


def extract(c: Column | str, pattern: str, group: int = 1) -> Column:
    """Regex group, NULL when the pattern does not match (an empty match stays empty)."""
    c = col(c)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def extract_some(c: Column | str, pattern: str, group: int = 1) -> Column:
    """Like :func:`extract` for a group that cannot match empty text: one regex pass."""
    return F.nullif(F.regexp_extract(col(c), pattern, group), F.lit(""))


def digits(c: Column | str) -> Column:
    return F.regexp_replace(col(c), "[^0-9]+", "")


def part_at(c: Column | str, delimiter: str, index: int) -> Column:
    """Zero-based piece of a split, NULL when there are fewer pieces."""
    return F.get(F.split(col(c), re.escape(delimiter)), F.lit(index))


def last_chars(c: Column | str, n: int) -> Column:
    return F.right(col(c), F.lit(n))


def first_chars(c: Column | str, n: int) -> Column:
    return F.substring(col(c), 1, n)


def words(c: Column | str) -> Column:
    """White-space separated words; an empty array for blank text, NULL for NULL."""
    return F.filter(F.split(col(c), r"\s+"), lambda w: w != "")


def first_word(c: Column | str) -> Column:
    return F.get(words(c), F.lit(0))


def one_repeated_char(c: Column | str) -> Column:
    return col(c).rlike(r"^(.)\1*\z")


def key_text(c: Column | str) -> Column:
    """Key as trimmed text; an integral double or decimal loses its fraction (``12.0`` -> ``12``)."""
    raw = col(c).cast("string")
    # Few keys carry a fraction: only those pay for the regex.
    return F.when(raw.contains(".0"), F.regexp_replace(strip(raw), r"^(-?[0-9]+)\.0+\z", "$1")).otherwise(strip(raw))


def line_key(reservation: Column | str, item: Column | str, trim: bool = True) -> Column:
    """``reservation_item`` key of a reservation line."""
    if trim:
        return F.concat(key_text(reservation), F.lit("_"), key_text(item))
    return F.concat(col(reservation).cast("string"), F.lit("_"), col(item).cast("string"))


def hash_of(*cols: Column | str, required: int = 0) -> Column:
    """md5 of the concatenated texts, in lower-case hex.

    The first ``required`` columns make the hash NULL when they are NULL; the
    others count as empty text.
    """
    parts = [col(c).cast("string") for c in cols]
    parts = parts[:required] + [F.coalesce(p, F.lit("")) for p in parts[required:]]
    return F.md5(F.concat(*parts))
