"""Dimension models (MOD-02..04).

Each dimension is a DISTINCT over staging, i.e. a hash aggregate with a
map-side partial step, so the shuffle carries at most one row per distinct
value per task whatever the size of staging.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.dates import date_key, month_name, quarter_of, year_month
from tarmac.functions.keys import code_key
from tarmac.operators.dedupe import collapse_latest


def _code_dim(staging: DataFrame, code: str, name: str, on_name_conflict: str) -> DataFrame:
    key = f"{code}_key"
    pairs = staging.select(code, name)
    if on_name_conflict == "distinct":
        # One row per (code, name): a code seen with two names yields two rows.
        pairs = pairs.distinct()
    elif on_name_conflict == "latest":
        # One row per code: the name of the most recently ingested record.
        pairs = collapse_latest(staging.select(code, name, "_ingested_at"), [code], "_ingested_at").drop(
            "_ingested_at"
        )
    else:
        raise ValueError(f"on_name_conflict must be 'distinct' or 'latest', got {on_name_conflict!r}")
    return pairs.select(code_key(code).alias(key), code, name)


def dim_carrier(staging: DataFrame, on_name_conflict: str = "distinct") -> DataFrame:
    return _code_dim(staging, "carrier", "carrier_name", on_name_conflict)


def dim_airport(staging: DataFrame, on_name_conflict: str = "distinct") -> DataFrame:
    return _code_dim(staging, "airport", "airport_name", on_name_conflict)


def dim_date(staging: DataFrame) -> DataFrame:
    periods = staging.select("year", "month").distinct()
    return periods.select(
        date_key("year", "month").alias("date_key"),
        "year",
        "month",
        quarter_of("month").alias("quarter"),
        month_name("month").alias("month_name"),
        year_month("year", "month").alias("year_month"),
    )
