"""Code normalisation and md5 surrogate keys (built-in expressions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm_code(c: str | Column) -> Column:
    """Upper-case code with surrounding spaces removed."""
    return F.upper(F.trim(F.col(c) if isinstance(c, str) else c))


def clean_name(c: str | Column) -> Column:
    return F.trim(F.col(c) if isinstance(c, str) else c)


def delay_record_id(year: str | Column, month: str | Column, carrier: Column, airport: Column) -> Column:
    """md5 of ``YEAR-MONTH-CARRIER-AIRPORT``; any NULL part gives a NULL id.

    ``concat`` propagates NULL like SQL ``||`` (``concat_ws`` would skip it).
    """
    y = F.col(year) if isinstance(year, str) else year
    m = F.col(month) if isinstance(month, str) else month
    return F.md5(
        F.concat(y.cast("string"), F.lit("-"), m.cast("string"), F.lit("-"), carrier, F.lit("-"), airport)
    )


def code_key(c: str | Column) -> Column:
    """Dimension key: md5 of the (already normalised) code."""
    return F.md5(F.col(c) if isinstance(c, str) else c)
