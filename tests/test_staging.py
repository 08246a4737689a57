import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tarmac.plans.staging import check_schema, stage
from tarmac.schemas import BRONZE, STAGING, STAGING_COLUMNS

T1 = dt.datetime(2024, 1, 1, 3, 0)
T2 = dt.datetime(2024, 2, 1, 3, 0)


def bronze_rows(spark, rows):
    """rows: dicts with some bronze columns; the rest default to 0 / names."""
    full = []
    for r in rows:
        d = {f.name: None for f in BRONZE.fields}
        d.update({"carrier_name": "Air", "airport_name": "Port"})
        for c in ("arr_flights", "arr_del15", "arr_cancelled", "arr_diverted", "arr_delay"):
            d[c] = Decimal("0")
        d.update(r)
        full.append(tuple(Decimal(str(v)) if isinstance(v, (int, float)) and f.name not in ("year", "month")
                          else v for f, v in zip(BRONZE.fields, [d[f.name] for f in BRONZE.fields])))
    return spark.createDataFrame(full, BRONZE)


def test_contract_and_cleaning(spark):
    b = bronze_rows(spark, [dict(year=2024, month=1, carrier=" aa ", airport="jfk ", carrier_name=" American ",
                                 airport_name=" JFK Intl", arr_flights=120.5, arr_del15=20.4, arr_delay=55.555,
                                 _ingested_at=T1)])
    out = stage(b)
    check_schema(out)
    assert out.columns == STAGING_COLUMNS
    r = out.first()
    assert (r.carrier, r.airport, r.carrier_name, r.airport_name) == ("AA", "JFK", "American", "JFK Intl")
    assert r.arr_flights == 121 and r.arr_del15 == 20  # round half away from zero, then int
    assert r.arr_delay == Decimal("55.56")
    import hashlib

    assert r.airline_delay_id == hashlib.md5(b"2024-1-AA-JFK").hexdigest()


def test_latest_wins_and_null_stamp_counts_as_newest(spark):
    b = bronze_rows(spark, [
        dict(year=2024, month=1, carrier="AA", airport="JFK", arr_flights=1, _ingested_at=T1),
        dict(year=2024, month=1, carrier="AA", airport="JFK", arr_flights=2, _ingested_at=T2),
        dict(year=2024, month=2, carrier="AA", airport="JFK", arr_flights=3, _ingested_at=T2),
        dict(year=2024, month=2, carrier="AA", airport="JFK", arr_flights=4, _ingested_at=None),
    ])
    got = {(r.month, r.arr_flights) for r in stage(b).collect()}
    assert got == {(1, 2), (2, 4)}


def test_in_batch_ties_resolve_deterministically(spark):
    rows = [dict(year=2024, month=1, carrier="AA", airport="JFK", arr_flights=n, _ingested_at=T1) for n in (5, 7, 6)]
    for perm in ([0, 1, 2], [2, 1, 0], [1, 0, 2]):
        b = bronze_rows(spark, [rows[i] for i in perm]).repartition(3)
        assert stage(b).first().arr_flights == 7


def test_normalise_first_merges_code_variants(spark):
    b = bronze_rows(spark, [
        dict(year=2024, month=1, carrier="aa", airport="JFK", arr_flights=1, _ingested_at=T1),
        dict(year=2024, month=1, carrier=" AA", airport="JFK", arr_flights=2, _ingested_at=T2),
    ])
    assert stage(b).count() == 1
    raw = stage(b, normalise_first=False)
    assert raw.count() == 2 and raw.select("airline_delay_id").distinct().count() == 1


def test_high_water_mark(spark):
    b = bronze_rows(spark, [
        dict(year=2024, month=1, carrier="AA", airport="JFK", _ingested_at=T1),
        dict(year=2024, month=2, carrier="AA", airport="JFK", _ingested_at=T2),
    ])
    target = stage(b.where(F.col("_ingested_at") == T1))
    assert [r.month for r in stage(b, target).collect()] == [2]
    empty_target = target.limit(0)
    assert stage(b, empty_target).count() == 2  # no mark -> full load


def test_null_key_part_gives_null_id(spark):
    b = bronze_rows(spark, [dict(year=2024, month=1, carrier=None, airport="JFK", _ingested_at=T1)])
    assert stage(b).first().airline_delay_id is None


def test_schema_drift_guard(spark):
    b = bronze_rows(spark, [dict(year=2024, month=1, carrier="AA", airport="JFK", _ingested_at=T1)])
    with pytest.raises(ValueError):
        check_schema(stage(b).withColumn("arr_flights", F.col("arr_flights").cast("long")))
    check_schema(stage(b), STAGING)


def test_overflowing_decimal_raises_under_ansi(spark):
    b = bronze_rows(spark, [dict(year=2024, month=1, carrier="AA", airport="JFK", arr_delay=123456789.5,
                                 _ingested_at=T1)])
    with pytest.raises(Exception):
        stage(b).collect()


def test_high_water_mark_reaches_the_parquet_scan(spark, store):
    from engine_helpers import plan_text
    from tarmac.plans.staging import new_rows
    from tarmac.sinks import tables as sink

    b = bronze_rows(spark, [dict(year=2024, month=1, carrier="AA", airport="JFK", _ingested_at=T1)])
    sink.append(b, store, "bronze")
    sink.append(b.withColumn("_ingested_at", F.lit(T2).cast("timestamp")), store, "bronze")
    target = stage(store.read("bronze").where(F.col("_ingested_at") == T1))
    fresh = new_rows(store.read("bronze"), target)
    assert "PushedFilters: [IsNotNull(_ingested_at), GreaterThan(_ingested_at," in plan_text(fresh)
    assert fresh.count() == 1
