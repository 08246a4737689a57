"""Calendar expressions: date keys, quarters, month names, month keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(year: str | Column, month: str | Column) -> Column:
    """``YYYYMM`` as an integer."""
    return (_c(year) * 100 + _c(month)).cast("int")


def quarter_of(month: str | Column) -> Column:
    """Quarter by range test; anything outside 1..9 (13, 0, NULL) falls to 4.

    ``quarter()`` is not used because it needs a valid date.
    """
    m = _c(month)
    return (
        F.when(m.between(1, 3), 1).when(m.between(4, 6), 2).when(m.between(7, 9), 3).otherwise(4).cast("int")
    )


def month_name(month: str | Column) -> Column:
    """Full English month name, unpadded; NULL for a month outside 1..12."""
    m = _c(month)
    return F.when(m.between(1, 12), F.date_format(F.make_date(F.lit(2000), m, F.lit(1)), "MMMM"))


def year_month(year: str | Column, month: str | Column) -> Column:
    """``YYYY-MM`` text; NULL if either part is NULL."""
    return F.concat(_c(year).cast("string"), F.lit("-"), F.lpad(_c(month).cast("string"), 2, "0"))


def month_start(year: str | Column, month: str | Column) -> Column:
    """First day of the month as a DATE."""
    return F.make_date(_c(year), _c(month), F.lit(1))


def month_key_of(ts: str | Column) -> Column:
    """``yyyy-MM-01`` text key of the month containing a timestamp."""
    return F.date_format(F.trunc(_c(ts), "MM"), "yyyy-MM-dd")


def utc_stamp(when: dt.datetime) -> Column:
    """A timestamp literal; a datetime without a zone is UTC, not the driver's zone."""
    aware = when if when.tzinfo else when.replace(tzinfo=dt.timezone.utc)
    return F.timestamp_micros(F.lit((aware - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)))


def age_tenths_half_up(now: str | Column, ts: str | Column) -> Column:
    """Age in tenths of an hour, rounded half up in integer arithmetic."""
    micros = F.unix_micros(_c(now)) - F.unix_micros(_c(ts))
    return F.call_function("div", micros * 10 + F.lit(1_800_000_000), F.lit(3_600_000_000))


# ---- driver-side helpers for month keys (tiny inputs: one key or a range) ----


def month_key(when: dt.datetime | dt.date) -> str:
    """Key of the month containing ``when`` (``YYYY-MM-01``)."""
    return f"{when.year:04d}-{when.month:02d}-01"


def parse_month_key(key: str) -> dt.date:
    """Validate a month key: it must be a first-of-month ISO date."""
    day = dt.date.fromisoformat(key)
    if day.day != 1:
        raise ValueError(f"month key must be the first day of a month, got {key!r}")
    return day


def month_keys(start: str, end: str) -> list[str]:
    """Inclusive month range [start, end], one key per month."""
    first, last = parse_month_key(start), parse_month_key(end)
    if last < first:
        raise ValueError(f"empty month range {start!r}..{end!r}")
    keys, y, m = [], first.year, first.month
    while (y, m) <= (last.year, last.month):
        keys.append(f"{y:04d}-{m:02d}-01")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return keys
