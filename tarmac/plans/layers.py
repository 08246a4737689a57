"""Model chain staging -> dims -> fact with one lineage cut.

Staging feeds four consumers (three dimensions and the fact). Each
consumer prunes different columns, so Spark cannot reuse one exchange
for all of them and would recompute bronze and the dedupe four times.
``materialise`` cuts the lineage once by writing a parquet table into the
cluster's shared checkpoint folder and reading it back: it survives
executor loss (unlike a local checkpoint or an in-memory cache), it is
computed once (an eager ``checkpoint()`` of an unpersisted frame runs the
plan a second time to write it), and the re-read carries file statistics
for the planner.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.operators.broadcast import DIM_BROADCAST_ROWS, bounded_broadcast
from tarmac.plans.dims import dim_airport, dim_carrier, dim_date
from tarmac.plans.fact import fact_flight_delays
from tarmac.plans.staging import stage
from tarmac.session import materialise


@dataclass
class Layers:
    staging: DataFrame
    dim_carrier: DataFrame
    dim_airport: DataFrame
    dim_date: DataFrame
    fact: DataFrame


def _dim_for_join(dim: DataFrame, staging_rows: int | None) -> DataFrame:
    """Broadcast a dimension only behind an exact bound.

    A dimension (distinct codes of staging) never has more rows than
    staging, whose exact row count the staging write observed; at or under
    the bound that is proof enough. Above it, a bounded count of the
    dimension itself decides (one small job); without a count the planner
    decides (AQE broadcasts only after measuring).
    """
    if staging_rows is None:
        return dim
    if staging_rows <= DIM_BROADCAST_ROWS:
        return F.broadcast(dim)
    return bounded_broadcast(dim, DIM_BROADCAST_ROWS)


def build_layers(bronze: DataFrame, target: DataFrame | None = None, normalise_first: bool = True,
                 on_name_conflict: str = "distinct", cut: bool = True) -> Layers:
    staging = stage(bronze, target, normalise_first=normalise_first)
    sizes: dict = {}
    if cut:
        staging, sizes = materialise(staging, "staging", {"rows": F.count(F.lit(1))})
    carriers = dim_carrier(staging, on_name_conflict)
    airports = dim_airport(staging, on_name_conflict)
    dates = dim_date(staging)
    # Dimensions are distinct codes / months, bounded by the staging row
    # count the write observed, so the fact join broadcasts them without
    # another job and staging streams through the joins without a shuffle.
    rows = sizes.get("rows")
    fact = fact_flight_delays(
        staging,
        _dim_for_join(carriers, rows),
        _dim_for_join(airports, rows),
        _dim_for_join(dates, rows),
    )
    return Layers(staging, carriers, airports, dates, fact)
