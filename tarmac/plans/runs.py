"""End-to-end runs: daily month load and fact backfill (MOD-12..15).

``run_daily`` executes bronze -> silver -> marts -> gold -> checks for the
month key of the run as one driver program. Tables live in a ``Store``;
each layer is read back from its table by the next one, which is also
what cuts the lineage between stages.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.dates import month_keys, parse_month_key, utc_stamp
from tarmac.plans import checks
from tarmac.plans.maintain import Maintained, maintain_marts
from tarmac.plans.rollup import carrier_state, monthly_state
from tarmac.plans.staging import check_schema, check_target, rows_after, stage
from tarmac.schemas import BRONZE, CSV_COLUMNS, FACT_COLUMNS
from tarmac.session import in_parallel
from tarmac.sinks import tables as sink
from tarmac.sinks.commits import Record
from tarmac.sources.csv_source import read_raw_csv

#: property of the commit record: newest ``_ingested_at`` in staging, microseconds since 1970 UTC
STAGING_MARK = "staging_mark"
GOLD_DIMS = ("gold_dim_carrier", "gold_dim_airport", "gold_dim_date")
GOLD_TRIO = ("gold_fact_flight_delays", "gold_carrier_state", "gold_monthly_state")


def stamp_batch(df: DataFrame, ingested_at: dt.datetime | Column | None = None) -> DataFrame:
    """Add ``_ingested_at``: one timestamp for the whole batch, taken once (naive ones are UTC)."""
    if ingested_at is None:
        ingested_at = dt.datetime.now(dt.timezone.utc)
    ts = ingested_at if isinstance(ingested_at, Column) else utc_stamp(ingested_at)
    return df.select(*CSV_COLUMNS).withColumn("_ingested_at", ts)


def load_bronze(batch: DataFrame | str, store: sink.Store, ingested_at=None) -> int:
    """Stamp and append a raw batch (a frame, or a CSV path / directory /
    glob read with the explicit schema) to bronze; returns rows appended."""
    if isinstance(batch, str):
        batch = read_raw_csv(store.spark, batch)
    stamped = stamp_batch(batch, ingested_at)
    rows = stamped.select([F.col(f.name).cast(f.dataType) for f in BRONZE.fields])
    if store.exists("bronze") and not store.governed("bronze"):
        return sink.append(rows, store, "bronze")
    return sink.append_batch(rows, store, "bronze")


def load_silver(store: sink.Store, normalise_first: bool = True) -> int:
    """Incremental staging: new bronze rows, deduped and cleaned, upserted by id.

    The high-water mark is a property of the commit record, set by the same
    commit as the upsert it belongs to. With the newest stamp of every bronze
    batch in the record as well, neither staging nor an older batch is opened.
    """
    base = store.log.head()
    target = store.read("staging") if store.exists("staging") else None
    properties = {}
    if "bronze" in base.tables and (target is None or STAGING_MARK in base.properties):
        mark = base.properties.get(STAGING_MARK) if target is not None else None
        fresh = sink.new_batches(base, "bronze", mark)
        if not fresh:
            return 0
        newest = [n for b in fresh if (n := base.parts("bronze")[b]["newest"]) is not None]
        properties = {STAGING_MARK: max([*newest, *([mark] if mark is not None else [])], default=None)}
        batch = stage(rows_after(store.log.read("bronze", base, fresh), mark), None, normalise_first=normalise_first)
    else:  # tables written without commit records: the mark comes from a scan of staging
        batch = stage(store.read("bronze"), target, normalise_first=normalise_first)
    check_schema(batch)
    if target is not None:
        check_target(target, batch)
    with sink.scratch_table(batch, store, "staging_batch") as written:  # read three times by the upsert
        return sink.upsert(written, store, "staging", properties=properties)


def build_marts(store: sink.Store, chunk_size: int | None = None) -> Maintained:
    """Dimensions, fact and the two marts from the years of staging that changed."""
    return maintain_marts(store, chunk_size)


def publish_dims(store: sink.Store, chunk_size: int | None = None) -> None:
    """Gold dims: full reload from the marts, stamped with ``_updated_at``; the three change with one commit."""
    now = F.current_timestamp()
    base = store.log.head()
    options = {"maxRecordsPerFile": chunk_size} if chunk_size else {}
    staged = in_parallel(*[lambda name=name: store.log.stage(store.read(name.removeprefix("gold_")).withColumn("_updated_at", now), name,
                                                             options=options)[0] for name in GOLD_DIMS])
    store.log.commit(staged, base)


def publish_fact_years(store: sink.Store, years: list[int], chunk_size: int | None = None) -> int:
    """Replace the gold fact slices and the matching state slices for ``years``, as one unit.

    The three are staged from the same source rows and named by one commit
    record: a reader, or a rerun after a failure anywhere before it, sees the
    old trio or the new one, never a mixture.
    """
    years = sorted(set(years))
    for table in GOLD_TRIO:
        sink.govern(store, table, "year")
    base = store.log.head()
    source = store.read("fact_flight_delays").where(F.col("year").isin(years)).select(*FACT_COLUMNS)
    fact, states, months = GOLD_TRIO
    staged = in_parallel(
        lambda: sink.stage_slices(source, store, fact, years, chunk_size=chunk_size),
        lambda: sink.stage_slices(carrier_state(source), store, states, years, chunk_size=chunk_size, as_is=True),
        lambda: sink.stage_slices(monthly_state(source), store, months, years, chunk_size=chunk_size, as_is=True),
    )
    store.log.commit(staged, base)
    return staged[0].rows


@dataclass
class RunResult:
    bronze_rows: int
    silver_rows: int
    gold_fact_rows: int
    make_checks: Callable[[], DataFrame]

    @cached_property
    def checks(self) -> DataFrame:
        """Every check of the tables as this run left them; made when first asked for."""
        return self.make_checks()


def all_checks(store: sink.Store, now: Column, head: Record | None = None) -> DataFrame:
    """Every check of the tables as of ``head`` (the last commit by default); at most two scans of any
    table (see ``checks.suite``)."""
    head = head or store.log.head()
    read = lambda name: store.log.read(name, head) if name in head.tables else store.read(name)
    models = {"stg_airline_delay_data": read("staging")} | {name: read(name) for name in (
        "dim_carrier", "dim_airport", "dim_date", "fact_flight_delays", "carrier_delay_performance", "monthly_delay_trends")}
    sizes = {name: rows for name in (*models, *GOLD_DIMS) if (rows := head.rows(name)) is not None}
    return checks.suite(read("bronze"), models, read("gold_fact_flight_delays"), {name: read(name) for name in GOLD_DIMS}, now, sizes)


def run_daily(batch: DataFrame | str, store: sink.Store, month_key: str, ingested_at=None, now=None,
              chunk_size: int | None = None) -> RunResult:
    """One scheduled run for ``month_key``: append, stage, marts, gold, checks.

    The gold fact is refreshed for the whole year of the month key. Folders
    that only old commit records name are deleted at the end.
    """
    year = parse_month_key(month_key).year
    bronze_rows = load_bronze(batch, store, ingested_at)
    silver_rows = load_silver(store)
    build_marts(store, chunk_size)
    publish_dims(store, chunk_size)
    fact_rows = publish_fact_years(store, [year], chunk_size)
    store.log.vacuum()
    now_col = utc_stamp(now) if now is not None else F.current_timestamp()
    head = store.log.head()
    return RunResult(bronze_rows, silver_rows, fact_rows, lambda: all_checks(store, now_col, head))


def backfill(store: sink.Store, start_key: str, end_key: str, chunk_size: int | None = None) -> int:
    """Refresh gold fact slices for every year touched by [start, end] months.

    The month range becomes its set of years, loaded in one job, instead
    of reloading a whole year once per month key.
    """
    years = sorted({parse_month_key(k).year for k in month_keys(start_key, end_key)})
    return publish_fact_years(store, years, chunk_size)
