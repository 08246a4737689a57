"""Conformed fact table (MOD-05): staging joined to the three dimensions.

The joins are inner equi-joins on the natural codes, so a staging row with
a NULL code drops out and a code present in a dimension under two names
fans out (one fact row per name). Dimensions are small by nature (codes,
months); callers pass them through ``operators.broadcast.bounded_broadcast``
(a row count decides) or mark them after a write whose observed row
count is known; unmarked, the join is a sort-merge join that AQE may
still turn into a broadcast once it has measured the dimension, and
whose skewed partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tarmac.schemas import FACT_COLUMNS


def fact_flight_delays(staging: DataFrame, carriers: DataFrame, airports: DataFrame, dates: DataFrame) -> DataFrame:
    s = staging.alias("s")
    dc = carriers.select("carrier", "carrier_key").alias("dc")
    da = airports.select("airport", "airport_key").alias("da")
    dd = dates.select("year", "month", "date_key").alias("dd")
    joined = (
        s.join(dc, s["carrier"] == dc["carrier"])
        .join(da, s["airport"] == da["airport"])
        .join(dd, (s["year"] == dd["year"]) & (s["month"] == dd["month"]))
    )
    cols = []
    for c in FACT_COLUMNS:
        if c == "carrier_key":
            cols.append(dc["carrier_key"])
        elif c == "airport_key":
            cols.append(da["airport_key"])
        elif c == "date_key":
            cols.append(dd["date_key"])
        else:
            cols.append(s[c])
    return joined.select(*cols)
