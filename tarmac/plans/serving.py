"""Dashboard queries on the stored states (MOD-10, MOD-11, SRT-04).

The state tables are small (keys x slices); the queries merge them with
one aggregation. Top-k uses ``orderBy(...).limit(k)``, which Spark plans as
TakeOrderedAndProject: every task keeps its own k best rows and only those
reach the final merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.dates import month_start
from tarmac.functions.numeric import exact_ratio
from tarmac.operators.partial_state import merge_states

_RATE_STATES = {"total_flights": "total_flights_state", "total_delayed": "total_delayed_state"}


def top_carriers(state: DataFrame, n: int = 10) -> DataFrame:
    """Carriers with flights, ranked by delay rate, then delayed count, then code."""
    merged = merge_states(state, ["carrier"], _RATE_STATES)
    return (
        merged.where(F.col("total_flights") > 0)
        .select(
            "carrier",
            "total_flights",
            "total_delayed",
            exact_ratio("total_delayed", "total_flights", factor=100).alias("delay_rate_pct"),
        )
        .orderBy(F.col("delay_rate_pct").desc_nulls_last(), F.col("total_delayed").desc_nulls_last(), "carrier")
        .limit(n)
    )


def monthly_trend(state: DataFrame) -> DataFrame:
    """Flights, delayed flights and delay rate per calendar month."""
    keyed = state.withColumn("month_start", month_start("year", "month"))
    merged = merge_states(keyed, ["month_start"], _RATE_STATES)
    return merged.select(
        "month_start",
        "total_flights",
        "total_delayed",
        exact_ratio("total_delayed", "total_flights", factor=100).alias("delay_rate_pct"),
    ).orderBy("month_start")


def headline(top: DataFrame, trend: DataFrame) -> DataFrame:
    """Two headline rows: the worst carrier and the latest month.

    Each is a ``min_by``/``max_by`` aggregate (one partial row per task),
    not a sort; the worst carrier uses the same order as ``top_carriers``.
    """
    worst = top.agg(
        F.min_by(
            F.struct("carrier", "delay_rate_pct"),
            F.struct(-F.col("delay_rate_pct"), -F.col("total_delayed"), F.col("carrier")),
        ).alias("w")
    ).select(
        F.lit("worst_carrier").alias("metric"),
        F.col("w.carrier").alias("label"),
        F.col("w.delay_rate_pct").alias("delay_rate_pct"),
    )
    latest = trend.agg(F.max_by(F.struct("month_start", "delay_rate_pct"), F.col("month_start")).alias("l")).select(
        F.lit("latest_month").alias("metric"),
        F.col("l.month_start").cast("string").alias("label"),
        F.col("l.delay_rate_pct").alias("delay_rate_pct"),
    )
    return worst.unionByName(latest)
