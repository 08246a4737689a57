"""Mergeable partial aggregates (sum states) and their merge.

A state table holds grouped partial sums keyed by the dimension keys plus
a *slice* key (the load unit, here ``year``). A slice is rebuilt from the
same frame as the fact slice and replaced together with it, so reloading a
slice cannot count it twice. Reading merges the states with a second sum;
sums of sums are exact for integers and decimals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def partial_state(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str], slice_key: str = "year") -> DataFrame:
    """``GROUP BY slice, keys`` with ``sum(source) AS state`` for each entry of ``sums``."""
    group = [slice_key] + [k for k in keys if k != slice_key]
    return df.groupBy(*group).agg(*[F.sum(src).alias(state) for state, src in sums.items()])


def merge_states(state: DataFrame, keys: Sequence[str], states: Mapping[str, str]) -> DataFrame:
    """Re-sum stored states per ``keys``: ``{output: state_column}``."""
    return state.groupBy(*keys).agg(*[F.sum(col).alias(out) for out, col in states.items()])
