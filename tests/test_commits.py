"""Commit records: one unit of several tables, single writes, stored marks, delta maintenance."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from engine_helpers import SF_SMALL, plan_text
from tarmac.plans import maintain, runs, staging
from tarmac.schemas import CSV_COLUMNS, FACT_COLUMNS
from tarmac.sinks import tables as sink
from tarmac.sinks.commits import CommitConflict, Record

STAMP = dt.datetime(2024, 1, 31, 3, 0)
NOW = dt.datetime(2024, 1, 31, 12, 0)
needs_data = pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="driver data missing")


def frame(spark, rows):
    return spark.createDataFrame(rows, "airline_delay_id string, v int, year int")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def first_batch(spark):
    from tarmac.sources.star_adapter import bronze_batch

    return bronze_batch(spark, SF_SMALL).select(*CSV_COLUMNS)


def redelivery(batch, year=1998, **changes):
    out = batch.where(F.col("year") == year).withColumn("arr_flights", (F.col("arr_flights") + 1).cast("decimal(32,16)"))
    return out.withColumns(changes)


# ------------------------------------------------------------- the record


def test_tables_of_a_commit_appear_together(spark, store):
    log = store.log
    a, _ = log.stage(frame(spark, [("a", 1, 2020)]), "a", "year")
    b, _ = log.stage(frame(spark, [("b", 1, 2020), ("c", 1, None)]), "b", "year")
    assert not store.exists("a") and log.head() == Record()
    made = log.commit([a, b], log.head(), {"note": 7})
    assert made.version == 1 and log.head() == made and log.tables() == ["a", "b"] and made.properties == {"note": 7}
    assert rows_of(store.read("b")) == [("b", 1, 2020), ("c", 1, None)]
    assert rows_of(log.read("b", values=[None])) == [("c", 1, None)]


def test_a_frame_keeps_its_version(spark, store):
    sink.upsert(frame(spark, [("a", 1, 2020), ("b", 1, 2021)]), store, "t")
    old = store.read("t")
    sink.upsert(frame(spark, [("a", 2, 2020)]), store, "t")
    assert rows_of(old) == [("a", 1, 2020), ("b", 1, 2021)]
    assert rows_of(store.read("t")) == [("a", 2, 2020), ("b", 1, 2021)]
    other = sink.Store(spark, store.root, f"{store.database}_again")  # another session finds the records
    assert rows_of(other.read("t")) == rows_of(store.read("t"))
    spark.sql(f"DROP DATABASE {other.database}_shown CASCADE")


def test_writers_of_other_partitions_both_land_and_of_the_same_one_do_not(spark, store):
    sink.upsert(frame(spark, [("a", 1, 2020), ("b", 1, 2021)]), store, "t")
    log, base = store.log, store.log.head()
    mine, _ = log.stage(frame(spark, [("a", 2, 2020)]), "t", "year", replaces=[2020])
    theirs, _ = log.stage(frame(spark, [("b", 2, 2021)]), "t", "year", replaces=[2021])
    late, _ = log.stage(frame(spark, [("a", 3, 2020)]), "t", "year", replaces=[2020])
    log.commit([theirs], base, {"x": 1})
    assert log.commit([mine], base, {"y": 2}).version == base.version + 2
    assert rows_of(store.read("t")) == [("a", 2, 2020), ("b", 2, 2021)]
    assert {k: log.head().properties[k] for k in "xy"} == {"x": 1, "y": 2}
    with pytest.raises(CommitConflict, match="2020"):
        log.commit([late], base)
    assert rows_of(store.read("t")) == [("a", 2, 2020), ("b", 2, 2021)]


def test_only_one_file_per_version(spark, store):
    name = store.log._file(1)
    assert store.log.files.create(name, "{}") and not store.log.files.create(name, "[]")
    assert store.log.files.read(name) == "{}" and store.log.files.names(f"{store.root}/_commits") == [name.rsplit("/", 1)[1]]


def test_vacuum_deletes_what_no_kept_record_names(spark, store):
    for v in range(4):
        sink.upsert(frame(spark, [("a", v, 2020)]), store, "t")
    store.log.stage(frame(spark, [("z", 9, 2020)]), "t", "year")  # never committed
    folders = lambda: store.log.files.names(f"{store.root}/_data/t")
    assert len(folders()) == 5 and store.log.vacuum() == 0  # young folders may be a write in progress
    assert store.log.vacuum(keep=2, min_age=0) == 3 and len(folders()) == 2 and store.log.versions() == [3, 4]
    assert rows_of(store.read("t")) == [("a", 3, 2020)] and rows_of(store.log.read("t", store.log.at(3))) == [("a", 2, 2020)]
    assert len(spark.catalog.listTables(store.log.database)) == 2


def test_text_partitions_and_tables_without_one(spark, store):
    log = store.log
    df = spark.createDataFrame([(1, "o'hare x"), (2, "b/c"), (3, "d=e%")], "v int, p string")
    first, _ = log.stage(df, "text", "p")
    plain, _ = log.stage(spark.range(3), "plain")
    log.commit([first, plain], log.head())
    assert rows_of(store.read("text").where("p = 'b/c'")) == [(2, "b/c")] and rows_of(store.read("text")) == rows_of(df)
    assert store.read("plain").count() == 3
    sink.full_reload(spark.range(5), store, "plain")
    assert store.read("plain").count() == 5


# ------------------------------------------------------------ single writes


def test_upsert_writes_touched_partitions_once(spark, store):
    sink.upsert(frame(spark, [(f"{y}-{i}", i, y) for y in (2020, 2021, 2022) for i in range(2000)]), store, "t")
    before = store.log.head()
    size = lambda record, y: store.log.files.size(record.location("t", y))
    sink.upsert(frame(spark, [("2021-7", -1, 2021)]), store, "t")
    after = store.log.head()
    assert [y for y in ("2020", "2021", "2022") if after.location("t", y) != before.location("t", y)] == ["2021"]
    written = [f for f in store.log.files.names(f"{store.root}/_data/t") if f not in before.location("t", 2020)]
    assert len(written) == 1
    folder = f"{store.root}/_data/t/{written[0]}"
    assert [n for n in store.log.files.names(folder) if n[0] not in "._"] == ["year=2021"]
    assert 0 < store.log.files.size(folder) < 1.2 * size(before, 2021) + 2_000  # the partition, once
    assert store.read("t").count() == 6000 and store.read("t").where("v = -1").count() == 1


def test_a_failure_between_stage_and_commit_loses_nothing(spark, store, monkeypatch):
    sink.upsert(frame(spark, [("a", 1, 2020)]), store, "t")
    monkeypatch.setattr(store.log, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        sink.upsert(frame(spark, [("a", 2, 2020), ("b", 1, 2020)]), store, "t")
    monkeypatch.undo()
    assert rows_of(store.read("t")) == [("a", 1, 2020)]
    sink.upsert(frame(spark, [("a", 2, 2020), ("b", 1, 2020)]), store, "t")
    assert rows_of(store.read("t")) == [("a", 2, 2020), ("b", 1, 2020)]


def test_a_plain_table_comes_under_the_records_with_its_first_upsert(spark, store):
    frame(spark, [("a", 1, 2020), ("b", 1, 2021)]).write.partitionBy("year").saveAsTable(store.name("t"))
    sink.upsert(frame(spark, [("a", 2, 2020)]), store, "t")
    assert store.governed("t") and rows_of(store.read("t")) == [("a", 2, 2020), ("b", 1, 2021)]


# ------------------------------------------------------ publication as a unit


@needs_data
@pytest.mark.parametrize("failing", ["carrier_state", "monthly_state"])
def test_a_failed_publication_leaves_the_old_trio(spark, store, monkeypatch, failing):
    batch = first_batch(spark)
    runs.run_daily(batch, store, "1998-06-01", ingested_at=STAMP, now=NOW)
    trio = lambda: [rows_of(store.read(t)) for t in runs.GOLD_TRIO]
    old = trio()
    runs.load_bronze(redelivery(batch), store, STAMP + dt.timedelta(days=1))
    runs.load_silver(store)
    runs.build_marts(store)
    whole = getattr(runs, failing)
    monkeypatch.setattr(runs, failing, lambda fact: whole(fact).withColumn("total_flights_state", F.raise_error(F.lit("boom")).cast("long")))
    with pytest.raises(Exception, match="boom"):
        runs.publish_fact_years(store, [1998])
    assert trio() == old
    monkeypatch.undo()
    runs.publish_fact_years(store, [1998])
    new = trio()
    assert all(a != b for a, b in zip(old, new, strict=True))
    flights = [store.read(t).agg(F.sum(c)).first()[0] for t, c in zip(
        runs.GOLD_TRIO, ("arr_flights", "total_flights_state", "total_flights_state"), strict=True)]
    assert len(set(flights)) == 1
    assert rows_of(store.read(runs.GOLD_TRIO[0]).select(*FACT_COLUMNS)) == rows_of(
        store.read("fact_flight_delays").where("year = 1998").select(*FACT_COLUMNS))


# ------------------------------------------------------- stored mark, batches


@needs_data
def test_incremental_staging_opens_new_batches_only(spark, store, monkeypatch):
    batch = first_batch(spark)
    runs.load_bronze(batch, store, STAMP)
    runs.load_silver(store)
    assert runs.load_silver(store) == 0  # nothing new: no job reads bronze or staging
    later = STAMP + dt.timedelta(days=1)
    runs.load_bronze(redelivery(batch), store, later)
    head = store.log.head()
    mark = head.properties[runs.STAGING_MARK]
    fresh = sink.new_batches(head, "bronze", mark)
    assert len(fresh) == 1 and len(head.parts("bronze")) == 2
    source = store.log.read("bronze", head, fresh)
    assert "PartitionFilters: [" in plan_text(source) and "_batch" in plan_text(source)
    opened = {f for f in source.inputFiles()}
    assert opened and all(head.parts("bronze")[fresh[0]]["location"].removeprefix("file:") in f for f in opened)
    monkeypatch.setattr(staging, "high_water_mark", lambda *_: (_ for _ in ()).throw(AssertionError("staging was scanned")))
    runs.load_silver(store)
    assert store.log.head().properties[runs.STAGING_MARK] == int(later.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)
    assert store.read("staging").where("_ingested_at > '2024-01-31 12:00:00'").select("year").distinct().collect()[0][0] == 1998
    assert sink.append_batch(store.read("bronze").limit(0), store, "bronze") == 0 and len(store.log.head().parts("bronze")) == 2


def test_unstamped_rows_and_mixed_batches(spark, store):
    rows = [("AA", 1, "2024-01-02 00:00:00"), ("BB", 2, None), ("CC", 3, "2024-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "c string, n int, t string").withColumn("_ingested_at", F.col("t").cast("timestamp")).drop("t")
    sink.append_batch(df.where("c = 'BB'"), store, "bronze")
    sink.append_batch(df.where("c <> 'BB'"), store, "bronze")
    head = store.log.head()
    assert len(sink.new_batches(head, "bronze", None)) == 2
    mark = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1e6)
    fresh = sink.new_batches(head, "bronze", mark)
    assert [r.c for r in staging.rows_after(store.log.read("bronze", head, fresh), mark).collect()] == ["AA"]
    assert store.read("bronze").columns == ["c", "n", "_ingested_at"]


# ---------------------------------------------------------- delta maintenance


def tables(store):
    return {t: rows_of(store.read(t)) for t in (
        "dim_carrier", "dim_airport", "dim_date", "fact_flight_delays", "carrier_delay_performance", "monthly_delay_trends")}


@needs_data
def test_one_year_rewrites_one_year_and_equals_a_full_rebuild(spark, store):
    batch = first_batch(spark)
    runs.load_bronze(batch, store, STAMP)
    runs.load_silver(store)
    first = maintain.maintain_marts(store)
    assert 1998 in first.rebuilt and len(first.rebuilt) > 3
    assert maintain.maintain_marts(store) == maintain.Maintained([], [])  # nothing changed
    before = store.log.head()
    runs.load_bronze(redelivery(batch, 1996), store, STAMP + dt.timedelta(days=1))
    runs.load_silver(store)
    assert maintain.maintain_marts(store) == maintain.Maintained([1996], [1996])
    after = store.log.head()
    for t in ("fact_flight_delays", "monthly_delay_trends", "carrier_sums_by_year", "carriers_by_year"):
        assert [y for y in after.parts(t) if after.location(t, y) != before.location(t, y)] == ["1996"], t
    kept = tables(store)
    maintain.maintain_marts(store, full=True)
    assert tables(store) == kept


@needs_data
def test_a_renamed_code_rebuilds_its_other_years(spark, store):
    batch = first_batch(spark)
    runs.load_bronze(batch, store, STAMP)
    runs.load_silver(store)
    maintain.maintain_marts(store)
    carrier = batch.select(F.upper(F.trim("carrier"))).orderBy("carrier").first()[0]
    mine = F.upper(F.trim(F.col("carrier"))) == carrier
    renamed = F.when(mine, F.lit("New Name")).otherwise(F.col("carrier_name"))
    runs.load_bronze(redelivery(batch, 1998, carrier_name=renamed), store, STAMP + dt.timedelta(days=1))
    runs.load_silver(store)
    got = maintain.maintain_marts(store)
    years = {r[0] for r in batch.where(mine).select("year").distinct().collect()}
    assert got.changed == [1998] and set(got.rebuilt) == years | {1998}
    kept = tables(store)
    assert len([r for r in kept["dim_carrier"] if r[1] == carrier]) == 2
    maintain.maintain_marts(store, full=True)
    assert tables(store) == kept


@needs_data
def test_a_vanished_year_leaves_the_marts(spark, store):
    batch = first_batch(spark)
    runs.load_bronze(batch, store, STAMP)
    runs.load_silver(store)
    maintain.maintain_marts(store)
    sink.replace_slices(store.read("staging").where("false"), store, "staging", [1995])
    assert maintain.maintain_marts(store).changed == [1995]
    kept = tables(store)
    assert not [r for r in kept["monthly_delay_trends"] if 1995 in r] and "1995" not in store.log.head().parts("fact_flight_delays")
    maintain.maintain_marts(store, full=True)
    assert tables(store) == kept
