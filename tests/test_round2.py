"""Sinks, clocks, contracts and foreign keys beyond the shared fixture."""

from __future__ import annotations

import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from engine_helpers import plan_text
from tarmac.operators import quality as Q
from tarmac.plans.runs import load_silver, stamp_batch
from tarmac.plans.staging import stage
from tarmac.schemas import BRONZE, BRONZE_TEXT_LIMITS, CSV_COLUMNS
from tarmac.sinks import tables as sink

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
UTC = dt.timezone.utc


def bronze(spark, *rows):
    full = [{**dict.fromkeys(f.name for f in BRONZE.fields), **r} for r in rows]
    return spark.createDataFrame([tuple(r[f.name] for f in BRONZE.fields) for r in full], BRONZE)


def test_upsert_keeps_rows_without_a_year(spark, store):
    cols = "airline_delay_id string, n int, year int"
    sink.upsert(spark.createDataFrame([(None, 2, None), ("a", 1, 2020), ("b", 1, 2021)], cols), store, "t")
    sink.upsert(spark.createDataFrame([(None, 20, None), ("a", 9, 2020)], cols), store, "t")
    got = sorted(store.read("t").collect(), key=lambda r: (r.year or 0, r.n))
    assert [(r.airline_delay_id, r.n, r.year) for r in got] == [(None, 2, None), (None, 20, None), ("a", 9, 2020), ("b", 1, 2021)]


def test_upsert_drops_its_stage_when_it_fails(spark, store):
    cols = "airline_delay_id string, n int, year int"
    sink.upsert(spark.createDataFrame([("a", 1, 2020)], cols), store, "t")
    with pytest.raises(Exception):
        sink.upsert(spark.createDataFrame([("a", 1, 2020)], cols).withColumn("n", F.raise_error(F.lit("boom")).cast("int")), store, "t")
    assert not [t.name for t in spark.catalog.listTables(store.database) if "__stage_" in t.name]


def test_upsert_by_version_keeps_the_newer_row(spark, store):
    cols = "airline_delay_id string, v int, year int"
    sink.upsert(spark.createDataFrame([("a", 5, 2020), ("b", None, 2020), ("c", 5, 2020)], cols), store, "t")
    sink.upsert(spark.createDataFrame([("a", 4, 2020), ("b", 9, 2020), ("c", 6, 2020), ("d", 1, 2020)], cols), store, "t", version_col="v")
    assert {r.airline_delay_id: r.v for r in store.read("t").collect()} == {"a": 5, "b": None, "c": 6, "d": 1}


def test_one_file_per_small_year(spark, store):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 4 + 2020).cast("int").alias("year")).repartition(16)
    sink.replace_slices(df, store, "f", range(2020, 2024))
    named = store.read("f").select("year", F.input_file_name().alias("file")).distinct()
    files = {r[0]: r[1] for r in named.groupBy("year").count().collect()}
    assert set(files) == {2020, 2021, 2022, 2023} and max(files.values()) <= 2
    sink.full_reload(df, store, "bounded", chunk_size=1000)
    per_file = store.read("bounded").select(F.input_file_name().alias("file")).groupBy("file").count().agg(F.max("count")).first()[0]
    assert per_file <= 1000


def test_stamps_do_not_depend_on_the_drivers_zone():
    code = (
        "import datetime as dt\n"
        "from tarmac.session import local_session\n"
        "from tarmac.functions.dates import utc_stamp\n"
        "s = local_session(1, 1)\n"
        "from pyspark.sql import functions as F\n"
        "r = s.range(1).select(F.unix_micros(utc_stamp(dt.datetime(2024, 1, 31, 3))), F.unix_micros(utc_stamp(dt.datetime.now(dt.timezone.utc)))"
        " - F.unix_micros(F.current_timestamp())).first()\n"
        "print('GOT', r[0], abs(r[1]) < 300_000_000)\n")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, env=os.environ | {"TZ": "America/New_York"}, capture_output=True, text=True, timeout=300)
    assert f"GOT {int(dt.datetime(2024, 1, 31, 3, tzinfo=UTC).timestamp()) * 1_000_000} True" in out.stdout, out.stderr[-2000:]


def test_batch_stamp_is_utc(spark):
    row = stamp_batch(bronze(spark, dict(year=2024, month=1)).select(*CSV_COLUMNS), dt.datetime(2024, 1, 31, 3)).select(
        F.unix_seconds("_ingested_at")).first()
    assert row[0] == int(dt.datetime(2024, 1, 31, 3, tzinfo=UTC).timestamp())


def test_drift_of_the_stored_table_is_refused_before_any_write(spark, store):
    row = dict(year=2024, month=1, carrier="AA", airport="JFK", _ingested_at=dt.datetime(2024, 1, 1))
    sink.append(bronze(spark, row), store, "bronze")
    stage(store.read("bronze")).withColumn("arr_flights", F.col("arr_flights").cast("string")).where("false").write.partitionBy(
        "year").saveAsTable(store.name("staging"))
    with pytest.raises(ValueError, match="arr_flights"):
        load_silver(store)
    assert store.read("staging").count() == 0


def test_source_values_are_rounded_once(spark):
    from decimal import Decimal

    got = stage(bronze(spark, dict(year=2024, month=1, carrier="AA", airport="JFK", carrier_ct=Decimal("0.0049999996")))).first()
    assert got.carrier_ct == Decimal("0.00")


def test_text_lengths(spark):
    df = bronze(spark, dict(carrier="x" * 16), dict(carrier="AA", airport_name="é" * 200), dict(airport="y" * 11))
    r = Q.evaluate(df, [Q.text_length(BRONZE_TEXT_LIMITS, "text_lengths", "bronze")]).first()
    assert r.violations == 2 and "'carrier' has 1" in r.description and "'airport' has 1" in r.description


def test_orphans_are_counted_before_the_shuffle(spark, store):
    spark.range(2000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k")).write.saveAsTable(store.name("child"))
    spark.createDataFrame([("0",), ("3",)], "k string").write.saveAsTable(store.name("parent"))
    orphans = Q.orphans_frame(store.read("child"), store.read("parent"), "k")
    assert orphans.agg(F.sum("__n")).first()[0] == 1998
    plan = plan_text(orphans, "simple")
    above_scan = plan[:plan.index(".child")]
    assert "Exchange" not in above_scan[above_scan.rindex("partial_count"):]


def test_reader_sees_a_changed_schema(spark, tmp_path):
    from tarmac.sources.tables import read_table

    spark.range(1).write.parquet(f"{tmp_path}/t.parquet")
    assert read_table(spark, str(tmp_path), "t").columns == ["id"]
    spark.range(1).withColumn("x", F.lit(1)).write.mode("overwrite").parquet(f"{tmp_path}/t.parquet")
    assert read_table(spark, str(tmp_path), "t").columns == ["id", "x"]


def test_stores_and_work_folders_can_be_dropped(spark, store):
    import pathlib

    from tarmac.plans.layers import materialise
    from tarmac.session import checkpoint_root, clear_work

    other = sink.Store(spark)
    sink.append(spark.range(3), other, "t")
    other.drop()
    assert not spark.catalog.databaseExists(other.database)
    assert materialise(spark.range(3)).count() == 3
    clear_work(spark)
    assert not (pathlib.Path(checkpoint_root(spark).removeprefix("file:")) / "tarmac-work").exists()
