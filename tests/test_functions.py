import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tarmac.functions import dates, keys, numeric


def test_month_key_first_of_month_and_year_boundary():
    assert dates.month_key(dt.datetime(2025, 11, 15, 3, 0)) == "2025-11-01"
    assert dates.month_key(dt.datetime(2026, 1, 2)) == "2026-01-01"


def test_month_keys_inclusive_range_and_validation():
    assert dates.month_keys("2024-11-01", "2025-02-01") == ["2024-11-01", "2024-12-01", "2025-01-01", "2025-02-01"]
    assert dates.month_keys("2025-12-01", "2025-12-01") == ["2025-12-01"]
    with pytest.raises(ValueError):
        dates.parse_month_key("2025-12-02")
    with pytest.raises(ValueError):
        dates.month_keys("2025-02-01", "2025-01-01")


def test_calendar_columns(spark):
    df = spark.createDataFrame([(2024, 1), (2024, 9), (2024, 10), (2024, 12), (2024, 13)], "year int, month int")
    rows = df.select(
        dates.date_key("year", "month").alias("k"),
        dates.quarter_of("month").alias("q"),
        dates.month_name("month").alias("n"),
        dates.year_month("year", "month").alias("ym"),
    ).collect()
    assert [r.k for r in rows] == [202401, 202409, 202410, 202412, 202413]
    assert [r.q for r in rows] == [1, 3, 4, 4, 4]  # 13 falls to the ELSE branch
    assert [r.n for r in rows] == ["January", "September", "October", "December", None]
    assert rows[0].ym == "2024-01"


def test_month_start_and_month_key_of(spark):
    df = spark.createDataFrame([(2024, 2, dt.datetime(2024, 2, 29, 23, 59))], "year int, month int, ts timestamp")
    r = df.select(dates.month_start("year", "month").alias("d"), dates.month_key_of("ts").alias("k")).first()
    assert r.d == dt.date(2024, 2, 1) and r.k == "2024-02-01"


def test_record_id_is_md5_of_normalised_parts_and_null_propagates(spark):
    df = spark.createDataFrame([(2024, 1, " aa ", "jfk"), (2024, 1, None, "JFK")], "y int, m int, c string, a string")
    rows = df.select(keys.delay_record_id("y", "m", keys.norm_code("c"), keys.norm_code("a")).alias("id")).collect()
    import hashlib

    assert rows[0].id == hashlib.md5(b"2024-1-AA-JFK").hexdigest()
    assert rows[1].id is None


def test_trim_only_removes_spaces(spark):
    df = spark.createDataFrame([("\tAa ",)], "c string")
    assert df.select(keys.norm_code("c").alias("x")).first().x == "\tAA"


def test_exact_ratio_half_up_and_null_denominator(spark):
    df = spark.createDataFrame(
        [(1, 8), (1, 3), (2, 3), (0, 0), (5, None), (-1, 8)], "num long, den long"
    )
    got = [r.x for r in df.select(numeric.exact_ratio("num", "den", factor=100).alias("x")).collect()]
    assert got == [12.5, 33.33, 66.67, None, None, -12.5]
    # 0.125 -> 0.13 (half away from zero), decimal numerator with scale 2
    d = spark.createDataFrame([(Decimal("0.25"), 2), (Decimal("0.05"), 2)], "num decimal(10,2), den long")
    got = [r.x for r in d.select(numeric.exact_ratio("num", "den", num_scale=2).alias("x")).collect()]
    assert got == [0.13, 0.03]


def test_decimal_round_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(Decimal("0.25"),), (Decimal("-0.25"),), (Decimal("0.35"),)], "x decimal(10,2)")
    assert [r.r for r in df.select(F.round("x", 1).alias("r")).collect()] == [
        Decimal("0.3"), Decimal("-0.3"), Decimal("0.4")]
