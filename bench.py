"""Benchmark the headline work.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]:
one warm-up, then $BENCH_RUNS timed runs (default 3), median seconds.

Whole queries (from the parquet scans, consumed by the ``noop`` sink, no
driver collect): the dedupe of lineitem, staging, the served top 10, and the
daily run with its backfill. Single steps on a store built once: all marts,
the marts of one delivered year, the gold slice with its states, the upsert of a
year, the backfill, the check suite. Prints one JSON line. Arguments name queries to time instead.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tarmac.catalog import queries as Qs  # noqa: E402
from tarmac.functions.dates import utc_stamp  # noqa: E402
from tarmac.plans import runs  # noqa: E402
from tarmac.plans.maintain import maintain_marts  # noqa: E402
from tarmac.session import clear_work, local_session  # noqa: E402
from tarmac.sinks import tables as sink  # noqa: E402
from tarmac.sources.star_adapter import bronze_batch  # noqa: E402

WHOLE = [
    "win_01",  # latest-wins dedupe over the whole lineitem table
    "mod_01",  # staging: adapter over the star schema + dedupe + cleaning
    "mod_10",  # top-10 carriers from partial states, end to end
    "mod_15",  # daily run + backfill over a month range, end to end
]


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def steps(spark, sf_dir: str) -> dict:
    """Name -> action, on a store that one daily run has filled."""
    store = sink.Store(spark)
    runs.run_daily(bronze_batch(spark, sf_dir).select(*Qs.CSV_COLUMNS), store, Qs.RUN_MONTH, ingested_at=Qs.RUN_STAMP, now=Qs.NOW)
    store.read("staging").where(F.col("year") == 1998).write.saveAsTable(store.name("delivery"))
    return {
        "step_upsert_year": lambda: sink.upsert(store.read("delivery"), store, "staging"),
        "step_marts": lambda: maintain_marts(store, full=True),
        "step_marts_one_year": lambda: (sink.upsert(store.read("delivery"), store, "staging"), runs.build_marts(store)),
        "step_gold_year_and_states": lambda: runs.publish_fact_years(store, [1998]),
        "step_backfill": lambda: runs.backfill(store, *Qs.BACKFILL_RANGE),
        "step_check_suite": lambda: consume(runs.all_checks(store, utc_stamp(Qs.NOW))),
    }


def timed(action, runs_: int) -> float:
    action()  # warm-up
    seconds = []
    for _ in range(runs_):
        t0 = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - t0)
    return round(statistics.median(seconds), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    count = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or WHOLE
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16, app="tarmac-bench")
    timings = {n: timed(lambda n=n: consume(Qs.QUERIES[n](spark, sf_dir)), count) for n in names}
    if not sys.argv[1:]:
        timings |= {n: timed(action, count) for n, action in steps(spark, sf_dir).items()}
    clear_work(spark)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "headline_total_median",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
