"""Date and time expressions around an explicit ``as_of``.

Bounds are computed on the driver and enter the plan as literals of the column's
own type, so a window reaches the parquet scan as a pushed filter.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, null_if_blank, strip

AsOf = str | dt.date | dt.datetime


def moment(as_of: AsOf) -> dt.datetime:
    if isinstance(as_of, dt.datetime):
        return as_of
    if isinstance(as_of, dt.date):
        return dt.datetime(as_of.year, as_of.month, as_of.day)
    return dt.datetime.fromisoformat(as_of)


def literal(value: AsOf, kind: str = "timestamp_ntz") -> Column:
    """Literal of the given Spark type; no zone conversion for ``timestamp_ntz``."""
    value = moment(value)
    text = value.date().isoformat() if kind == "date" else value.isoformat(sep=" ")
    return F.lit(text).cast(kind)


def in_window(
    c: Column | str,
    as_of: AsOf,
    from_day: int | None,
    to_day: int | None,
    from_open: bool = False,
    kind: str = "timestamp_ntz",
) -> Column:
    """``day(as_of)+from_day <= c < day(as_of)+to_day``.

    ``from_open`` makes the lower bound strict. A bound of ``None`` is left out.
    """
    c, day = col(c), moment(as_of).date()
    tests = []
    if from_day is not None:
        low = literal(day + dt.timedelta(days=from_day), kind)
        tests.append(c > low if from_open else c >= low)
    if to_day is not None:
        tests.append(c < literal(day + dt.timedelta(days=to_day), kind))
    out = tests[0]
    for test in tests[1:]:
        out = out & test
    return out


def on_day(c: Column | str, as_of: AsOf, kind: str = "timestamp_ntz") -> Column:
    return in_window(c, as_of, 0, 1, kind=kind)


def in_years(c: Column | str, years, kind: str = "timestamp_ntz") -> Column:
    """Year in a list, written as ranges so that it is pushed to the scan."""
    c, out, years = col(c), None, sorted(set(years))
    while years:
        first = last = years.pop(0)
        while years and years[0] == last + 1:
            last = years.pop(0)
        test = (c >= literal(dt.date(first, 1, 1), kind)) & (c < literal(dt.date(last + 1, 1, 1), kind))
        out = test if out is None else out | test
    return out


def last_open_slot(as_of: AsOf) -> int:
    """Number of the last delivery slot still open: two-hour slots from 09:00, one hour of lead."""
    hour = (moment(as_of) - dt.timedelta(hours=1)).hour
    return (hour - 9) // 2 + 1


def slot_open(c: Column | str, as_of: AsOf, slots) -> Column:
    """Slot code in the list and not past the cut-off of ``as_of``."""
    last = last_open_slot(as_of)
    still_open = [s for s in slots if int(s[1:]) <= last]
    return col(c).isin(still_open) if still_open else F.lit(False)


def text_timestamp(c: Column | str, pattern: str = "dd-MM-yyyy HH:mm") -> Column:
    return F.date_format(col(c), pattern)


def parse_timestamp(c: Column | str, pattern: str | None = None) -> Column:
    """Timestamp without zone, NULL on text that does not parse."""
    c = null_if_blank(c)
    if pattern is None:
        return c.try_cast("timestamp_ntz")
    return F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")


def parse_number(c: Column | str, kind: str = "double") -> Column:
    """Number from text; NULL on bad text and on NaN or infinity."""
    n = strip(col(c).cast("string")).try_cast("double")
    n = F.when(~F.isnan(n) & (F.abs(n) != float("inf")), n)
    return n if kind == "double" else n.try_cast(kind)


def month_year(c: Column | str) -> Column:
    """``month || year`` without padding, e.g. ``62024``."""
    c = col(c)
    return F.concat(F.month(c).cast("string"), F.year(c).cast("string"))
