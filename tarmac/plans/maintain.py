"""Marts kept up to date by year slices.

A delivery changes some years of staging. ``maintain_marts`` rebuilds what
depends on them and nothing else: per-year lists of codes and names give the
dimensions, per-year sums give the carrier mart, and the fact and the monthly
mart are replaced by year. All of it becomes visible with one commit, which
also notes the staging partitions it was built from; the next call compares
those with the current ones to see which years changed.

A code that gains or loses a name changes the fact rows of that code in every
year, so the years in which it occurs are rebuilt as well. The tables are
therefore always equal to a full rebuild.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.operators.broadcast import DIM_BROADCAST_ROWS
from tarmac.operators.partial_state import partial_state
from tarmac.plans.dims import dim_airport, dim_carrier, dim_date
from tarmac.plans.fact import fact_flight_delays
from tarmac.plans.marts import CARRIER_SUMS, carrier_mart_of, monthly_delay_trends
from tarmac.session import in_parallel
from tarmac.sinks import tables as sink
from tarmac.sinks.commits import NULL_VALUE, Record, Staged, in_values

#: property of the commit record: staging partition -> folder the marts were built from
BUILT_FROM = "marts_built_from"
FACT_SORT = ("carrier_key", "airport_key", "date_key")
FACT_BLOOMS = ("carrier", "airport")


@dataclass(frozen=True)
class Maintained:
    """What a run rebuilt: changed years of staging, and the years of the fact."""

    changed: list
    rebuilt: list


def _year(name: str) -> int | None:
    return None if name == NULL_VALUE else int(name)


def changed_years(record: Record) -> list[int | None]:
    """Years of staging whose folder is not the one the marts were built from."""
    now = {v: e["location"] for v, e in record.parts("staging").items()}
    built = record.properties.get(BUILT_FROM, {})
    return sorted((_year(v) for v in now.keys() | built.keys() if now.get(v) != built.get(v)), key=lambda y: (y is not None, y or 0))


def _years_of_changed_codes(old: DataFrame, new: DataFrame, slices: DataFrame, code: str) -> list[int]:
    """Years holding a code whose set of names differs between two states of a dimension."""
    both = old.withColumn("__side", F.lit(1)).unionByName(new.withColumn("__side", F.lit(-1)))
    changed = both.groupBy(*old.columns).agg(F.sum("__side").alias("__d")).where("__d <> 0").select(code).distinct()
    return [r[0] for r in slices.join(changed, code, "left_semi").select("year").distinct().collect()]


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a dimension whose written row count is known to be small."""
    return F.broadcast(df) if rows <= DIM_BROADCAST_ROWS else df


def maintain_marts(store: sink.Store, chunk_size: int | None = None, full: bool = False) -> Maintained:
    """Bring dimensions, fact and marts up to date with staging, in one commit.

    ``full`` rebuilds every year. Nothing is written if staging has not
    changed since the last commit of the marts.
    """
    log = store.log
    sink.govern(store, "staging", "year")
    base = log.head()
    first = full or "fact_flight_delays" not in base.tables
    changed = [_year(v) for v in base.parts("staging")] if first else changed_years(base)
    if not changed and not first:
        return Maintained([], [])
    staging = log.read("staging", base)
    touched = staging.where(in_values("year", changed))
    replaces = None if first else changed

    def slices(table: str, *columns: str):
        return log.stage(touched.select("year", *columns).distinct(), table, "year", replaces)[0]  # a few rows a year

    staged = in_parallel(lambda: slices("carriers_by_year", "carrier", "carrier_name"),
                         lambda: slices("airports_by_year", "airport", "airport_name"),
                         lambda: slices("months_by_year", "month"))
    seen = log.merged(base, staged)
    carriers, airports, months = (log.read(s.table, seen) for s in staged)
    dims = in_parallel(lambda: log.stage(dim_carrier(carriers), "dim_carrier")[0],
                       lambda: log.stage(dim_airport(airports), "dim_airport")[0],
                       lambda: log.stage(dim_date(months), "dim_date")[0])
    seen = log.merged(seen, dims)
    new = {s.table: log.read(s.table, seen) for s in dims}
    rebuilt = set(changed)
    if not first:
        rebuilt.update(*in_parallel(*[
            lambda table=table, code=code, by_year=by_year: _years_of_changed_codes(log.read(table, base), new[table], by_year, code)
            for table, code, by_year in (("dim_carrier", "carrier", carriers), ("dim_airport", "airport", airports))]))
    rebuilt = sorted(rebuilt, key=lambda y: (y is not None, y or 0))

    rows = {s.table: s.rows for s in dims}
    fact = fact_flight_delays(staging.where(in_values("year", rebuilt)),
                              *(_small(new[t], rows[t]) for t in ("dim_carrier", "dim_airport", "dim_date")))
    facts = [sink.stage_slices(fact, store, "fact_flight_delays", None if first else rebuilt, "year", chunk_size,
                               sort_cols=FACT_SORT, bloom_cols=FACT_BLOOMS)]
    seen = log.merged(seen, facts)
    fact = log.read("fact_flight_delays", seen, rebuilt)
    years = None if first else rebuilt

    def carriers_mart() -> list[Staged]:
        sums = partial_state(fact, ["carrier_key", "carrier", "carrier_name"], CARRIER_SUMS)
        state = sink.stage_slices(sums, store, "carrier_sums_by_year", years, "year", as_is=True)
        merged = log.read("carrier_sums_by_year", log.merged(seen, [state]))
        return [state, log.stage(carrier_mart_of(merged), "carrier_delay_performance")[0]]

    marts = in_parallel(carriers_mart, lambda: [sink.stage_slices(
        monthly_delay_trends(fact, ordered=False), store, "monthly_delay_trends", years, "year", chunk_size, as_is=True)])
    built = {v: e["location"] for v, e in base.parts("staging").items()}
    log.commit([*staged, *dims, *facts, *marts[0], *marts[1]], base, {BUILT_FROM: built})
    return Maintained(changed, rebuilt)
