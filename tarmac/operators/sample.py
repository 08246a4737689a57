"""Seeded row sample (SNK-17).

``sample_rows`` returns ``n`` rows in a pseudo-random order given by the
md5 of a unique key and a seed. Unlike ``orderBy(rand(seed))``, whose
values depend on how rows are split into partitions, the choice depends
only on the data and the seed, so it is the same on every run and at any
parallelism. It is a top-k (TakeOrderedAndProject): each task keeps its
best ``n`` rows and only those reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows of ``df`` chosen by the seeded hash of the unique column ``key``."""
    if n <= 0:
        raise ValueError("n must be greater than 0")
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))
    return df.orderBy(order, F.col(key)).limit(n)
