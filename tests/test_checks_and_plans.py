import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from engine_helpers import SF_SMALL, plan_text
from tarmac.plans import checks


def test_gold_checks_fail_paths(spark):
    fact = spark.createDataFrame([("c1", "a1", 202401), ("c9", "a1", 202402), (None, "a1", 202401)],
                                 "carrier_key string, airport_key string, date_key int")
    carriers = spark.createDataFrame([("c1", "AA", ""), ("", "BB", "B")], "carrier_key string, carrier string, "
                                     "carrier_name string")
    airports = spark.createDataFrame([("a1", "JFK", "JFK Intl")], "airport_key string, airport string, "
                                     "airport_name string")
    dates = spark.createDataFrame([(202401,)], "date_key int")
    got = {r.check: r for r in checks.gold_checks(fact, carriers, airports, dates).collect()}
    assert got["fact_row_count"].passed and got["fact_row_count"].description == "fact_flight_delays has 3 rows."
    assert got["no_null_carrier_columns"].violations == 2
    assert got["no_null_carrier_columns"].description == "2 rows have empty carrier_key, carrier, or carrier_name."
    assert got["no_null_airport_columns"].passed
    assert got["no_orphaned_carrier_keys"].violations == 2  # c9 and the NULL key
    assert got["no_orphaned_carrier_keys"].description == "2 fact rows have orphaned carrier_key values."
    assert got["no_orphaned_date_keys"].violations == 1
    empty = checks.gold_checks(fact.limit(0), carriers, airports, dates).where("check = 'fact_row_count'").first()
    assert not empty.passed and empty.description == "fact_flight_delays is empty."


def test_declarative_tests_fail_paths(spark):
    models = {
        "m": spark.createDataFrame([("k1",), ("k1",), ("k2",), (None,), (None,)], "k string"),
        "p": spark.createDataFrame([("k1",)], "k string"),
    }
    u = checks.unique_tests(models, {"m": ["k"]}).first()
    assert (u.check, u.violations, u.description) == ("unique_m_k", 1, "1 failing row(s).")  # NULLs ignored
    n = checks.not_null_tests(models, {"m": ["k"]}).first()
    assert n.violations == 2
    r = checks.relationship_tests(models, [("m", "k", "p")]).first()
    assert r.violations == 1  # k2; NULL keys are not checked


def test_silver_checks_fail_paths(spark):
    from tarmac.plans.staging import stage
    from test_staging import bronze_rows

    b = bronze_rows(spark, [
        dict(year=2024, month=13, carrier="AA", airport="JFK", arr_delay=-1, _ingested_at=dt.datetime(2024, 1, 1)),
        dict(year=2024, month=1, carrier="aa", airport="JFK", _ingested_at=dt.datetime(2024, 1, 1)),
        dict(year=2024, month=1, carrier="AA ", airport="JFK", _ingested_at=dt.datetime(2024, 1, 2)),
    ])
    got = {r.check: r for r in checks.silver_checks(stage(b, normalise_first=False)).collect()}
    assert got["unique_surrogate_key"].violations == 1
    assert got["month_range"].description == "Column 'month' has 1 value(s) above maximum 12."
    assert got["non_negative_delays"].severity == "WARN" and got["non_negative_delays"].violations == 1
    assert got["no_null_key_columns"].passed


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="driver data missing")
def test_fact_joins_become_broadcast_after_measuring(spark):
    from tarmac.catalog.queries import mod_05

    df = mod_05(spark, SF_SMALL)
    df.collect()
    final = plan_text(df, "simple").split("== Initial Plan ==")[0]
    assert final.count("BroadcastHashJoin") >= 3 and "SortMergeJoin" not in final


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="driver data missing")
def test_gold_publish_reads_only_the_year_partition(spark, store):
    from tarmac.catalog.queries import layers
    from tarmac.sinks import tables as sink

    sink.write_layout(layers(spark, SF_SMALL).fact, store, "fact_flight_delays")
    read = store.read("fact_flight_delays").where(F.col("year").isin([1998]))
    plan = plan_text(read)
    pf = [line for line in plan.splitlines() if line.startswith("PartitionFilters:")][0]
    assert "year#" in pf and "1998" in pf
    assert "/year=1998]" in plan  # only that directory is listed


def test_broadcast_is_bounded_by_rows_and_by_bytes(spark):
    from tarmac.operators.broadcast import bounded_broadcast, fits

    df = spark.range(50).select(F.col("id"), F.repeat(F.lit("é"), 100).alias("name"), F.lit(None).cast("string").alias("none"))
    assert fits(df, 50, 50 * 208) and not fits(df, 49) and not fits(df, 50, 50 * 208 - 1)
    assert fits(df.limit(0), 0, 0)
    hinted = lambda *bounds: "ResolvedHint" in bounded_broadcast(df, *bounds)._jdf.queryExecution().analyzed().toString()
    assert hinted(50) and not hinted(49) and not hinted(50, 1000)
