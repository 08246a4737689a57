"""Analytics marts over the fact table (MOD-06, MOD-07, AGG-20).

Both marts are one hash aggregation each (partial sums per task, one
shuffle of at most groups x tasks rows). Money is summed as decimal, so
totals are exact; ratios are ratios of sums (not averages of ratios),
rounded half away from zero.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.numeric import exact_ratio


def _total(c: str, alias: str):
    return F.round(F.sum(c), 2).alias(alias)


# mart column -> summed fact column
CARRIER_SUMS = {
    "total_flights": "arr_flights",
    "total_delayed": "arr_del15",
    "total_cancelled": "arr_cancelled",
    "total_delay_minutes": "arr_delay",
    "total_carrier_delay_minutes": "carrier_delay",
    "total_weather_delay_minutes": "weather_delay",
    "total_nas_delay_minutes": "nas_delay",
    "total_security_delay_minutes": "security_delay",
    "total_late_aircraft_delay_minutes": "late_aircraft_delay",
}


def _carrier_mart(rows: DataFrame, sources: Mapping[str, str]) -> DataFrame:
    minutes = [c for c in CARRIER_SUMS if c.endswith("_minutes")]
    sums = rows.groupBy("carrier_key", "carrier", "carrier_name").agg(
        *[_total(src, c) if c in minutes else F.sum(src).alias(c) for c, src in sources.items()])
    return sums.select(
        "carrier_key",
        "carrier",
        "carrier_name",
        "total_flights",
        "total_delayed",
        "total_cancelled",
        exact_ratio("total_delayed", "total_flights", factor=100).alias("delay_rate_pct"),
        *minutes,
        exact_ratio("total_delay_minutes", "total_delayed", num_scale=2).alias(
            "avg_delay_minutes_per_delayed_flight"
        ),
    )


def carrier_delay_performance(fact: DataFrame) -> DataFrame:
    return _carrier_mart(fact, CARRIER_SUMS)


def carrier_mart_of(sums: DataFrame) -> DataFrame:
    """The carrier mart from per-year sums (``CARRIER_SUMS`` by year and carrier)."""
    return _carrier_mart(sums, {c: c for c in CARRIER_SUMS})


def monthly_delay_trends(fact: DataFrame, ordered: bool = True) -> DataFrame:
    sums = fact.groupBy("date_key", "year", "month").agg(
        F.sum("arr_flights").alias("total_flights"),
        F.sum("arr_del15").alias("total_delayed"),
        F.sum("arr_cancelled").alias("total_cancelled"),
        F.sum("arr_diverted").alias("total_diverted"),
        _total("arr_delay", "total_delay_minutes"),
        _total("carrier_delay", "total_carrier_delay_minutes"),
        _total("weather_delay", "total_weather_delay_minutes"),
        _total("nas_delay", "total_nas_delay_minutes"),
        _total("late_aircraft_delay", "total_late_aircraft_delay_minutes"),
    )
    out = sums.select(
        "date_key",
        "year",
        "month",
        "total_flights",
        "total_delayed",
        "total_cancelled",
        "total_diverted",
        exact_ratio("total_delayed", "total_flights", factor=100).alias("delay_rate_pct"),
        "total_delay_minutes",
        exact_ratio("total_delay_minutes", "total_flights", num_scale=2).alias("avg_delay_minutes_per_flight"),
        "total_carrier_delay_minutes",
        "total_weather_delay_minutes",
        "total_nas_delay_minutes",
        "total_late_aircraft_delay_minutes",
    )
    return out.orderBy("year", "month") if ordered else out


def row_distribution(fact: DataFrame) -> DataFrame:
    """Rows per (year, month) of the fact table."""
    return fact.groupBy("year", "month").agg(F.count(F.lit(1)).alias("row_count")).orderBy("year", "month")
