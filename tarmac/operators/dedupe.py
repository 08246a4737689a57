"""Latest-wins deduplication.

``latest_per_key`` keeps one row per key: the first under a total order.
It is ``row_number() OVER (PARTITION BY keys ORDER BY order) = 1``; Spark
plans the ``= 1`` filter as a WindowGroupLimit that runs once before the
shuffle (each task keeps only its best row per key) and once after, so a
key holding a third of all rows is cut down inside every map task instead
of being sorted by one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def latest_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """One row per ``keys``: the first row by ``order`` (ties: give a total order)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def collapse_latest(df: DataFrame, keys: Sequence[str], version: str = "_updated_at") -> DataFrame:
    """Version-collapsing read: the highest ``version`` per key wins.

    Ties on the version are broken by the remaining columns, so the result
    is deterministic; NULL versions lose to any stamped version.
    """
    rest = [c for c in df.columns if c not in keys and c != version]
    order = [F.col(version).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in rest]
    return latest_per_key(df, keys, order)
