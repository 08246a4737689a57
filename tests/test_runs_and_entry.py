import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from engine_helpers import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="driver data missing")

STAMP = dt.datetime(2024, 1, 31, 3, 0)
NOW = dt.datetime(2024, 1, 31, 12, 0)


def snapshot(store, table, cols=None):
    df = store.read(table)
    if cols:
        df = df.select(*cols)
    return sorted(tuple(r) for r in df.collect())


def test_daily_run_rerun_is_idempotent_for_silver_gold_and_state(spark, store):
    from tarmac.plans.runs import backfill, run_daily
    from tarmac.schemas import CSV_COLUMNS, FACT_COLUMNS
    from tarmac.sources.star_adapter import bronze_batch

    batch = bronze_batch(spark, SF_SMALL).select(*CSV_COLUMNS)
    first = run_daily(batch, store, "1998-06-01", ingested_at=STAMP, now=NOW)
    assert first.gold_fact_rows > 0
    checks = {(r.check, r.layer): r for r in first.checks.collect()}
    assert all(r.passed for r in checks.values()), [r for r in checks.values() if not r.passed]
    assert checks[("data_freshness", "bronze")].description == "Bronze data is fresh."
    silver = snapshot(store, "staging")
    gold = snapshot(store, "gold_fact_flight_delays", FACT_COLUMNS)
    state = snapshot(store, "gold_carrier_state")
    assert {r[FACT_COLUMNS.index("year")] for r in gold} == {1998}

    run_daily(batch, store, "1998-06-01", ingested_at=STAMP, now=NOW)
    assert store.read("bronze").count() == 2 * batch.count()  # raw layer appends
    assert snapshot(store, "staging") == silver
    assert snapshot(store, "gold_fact_flight_delays", FACT_COLUMNS) == gold
    assert snapshot(store, "gold_carrier_state") == state  # no double counting

    backfill(store, "1996-11-01", "1997-02-01")
    years = {r.year for r in store.read("gold_fact_flight_delays").select("year").distinct().collect()}
    assert years == {1996, 1997, 1998}
    once = snapshot(store, "gold_monthly_state")
    backfill(store, "1996-11-01", "1997-02-01")
    assert snapshot(store, "gold_monthly_state") == once
    merged = store.read("gold_carrier_state").groupBy().agg(F.sum("total_flights_state")).first()[0]
    direct = store.read("gold_fact_flight_delays").groupBy().agg(F.sum("arr_flights")).first()[0]
    assert merged == direct
    leftovers = [t.name for t in spark.catalog.listTables(store.database) if "__" in t.name]
    assert leftovers == []  # scratch batches and upsert stages are dropped


def test_entry_and_registry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10 and df.columns == ["carrier", "total_flights", "total_delayed", "delay_rate_pct"]
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    # every key of the engine has oracle SQL; training-data operators have it where SQL can express them
    assert {k for k in qs if k != "pipeline" and not (k.startswith("op") and k[2].isdigit())} <= set(sqls)


ORACLE_SAMPLE = ["mod_01", "mod_06", "mod_07", "mod_10", "mod_11", "win_01", "dq_01", "dq_06", "agg_18", "joi_06",
                 "agg_11", "snk_11", "snk_17", "cnd_03", "flt_02", "dq_24", "snk_14", "snk_19", "mod_16"]


@pytest.mark.parametrize("key", ORACLE_SAMPLE)
def test_oracle_agreement_small(spark, key):
    import duckdb

    import __spark_entry__ as E
    from tools.compare import TABLES, digest

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_daily_run_from_csv_path(spark, store, tmp_path):
    from tarmac.plans.runs import run_daily
    from tarmac.schemas import CSV_COLUMNS
    from tarmac.sources.csv_source import write_csv
    from tarmac.sources.star_adapter import bronze_batch

    batch = bronze_batch(spark, SF_SMALL).select(*CSV_COLUMNS)
    path = str(tmp_path / "delays_csv")
    write_csv(batch, path)
    result = run_daily(path, store, "1998-06-01", ingested_at=STAMP, now=NOW)
    assert result.bronze_rows == batch.count()
    assert store.read("staging").count() == result.silver_rows
    assert result.checks.where("NOT passed").count() == 0
