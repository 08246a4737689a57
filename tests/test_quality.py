import datetime as dt

from pyspark.sql import functions as F

from engine_helpers import plan_text
from tarmac.operators import quality as Q

NOW = dt.datetime(2024, 6, 1, 12, 0, 0)


def _row(df, rule):
    return Q.evaluate(df, [rule]).first()


def test_no_nulls_pass_and_per_column_messages(spark):
    clean = spark.createDataFrame([(2024, 1, "AA", "JFK")], "year int, month int, carrier string, airport string")
    r = _row(clean, Q.no_nulls(["year", "month", "carrier", "airport"], "no_null_key_columns", "bronze"))
    assert r.passed and r.violations == 0 and r.description == "All key columns are non-null."
    dirty = spark.createDataFrame([(None, 1, "AA", None), (None, 2, "AA", "X")],
                                  "year int, month int, carrier string, airport string")
    r = _row(dirty, Q.no_nulls(["year", "month", "carrier", "airport"], "no_null_key_columns", "bronze"))
    assert not r.passed and r.violations == 3
    assert r.description == ("Column 'year' contains 2 null value(s).; "
                             "Column 'airport' contains 1 null value(s).")


def test_min_row_count(spark):
    ten = spark.range(10)
    assert _row(ten, Q.min_row_count(1, "c", "bronze")).description == "Row count is 10."
    r = _row(ten.limit(0), Q.min_row_count(1, "c", "bronze"))
    assert not r.passed and r.description == "Expected at least 1 row(s), but found 0."
    assert _row(ten, Q.min_row_count(10, "c", "bronze")).passed  # inclusive


def test_duplicates_counts_excess_rows(spark):
    abc = spark.createDataFrame([("a",), ("b",), ("c",)], "airline_delay_id string")
    rule = Q.duplicates_rule(["airline_delay_id"], "unique_surrogate_key", "silver")
    assert _row(Q.duplicates_frame(abc, ["airline_delay_id"]), rule).passed
    dup = spark.createDataFrame([("dup",), ("dup",), (None,), (None,)], "airline_delay_id string")
    r = _row(Q.duplicates_frame(dup, ["airline_delay_id"]), rule)
    # NULL keys count as equal (like a distinct over the key columns)
    assert r.violations == 2
    assert r.description == "Found 2 duplicate row(s) on key column(s): [airline_delay_id]."


def test_range_inclusive_nulls_ignored(spark):
    df = spark.createDataFrame([(1,), (12,), (13,), (None,), (0,)], "month int")
    r = _row(df, Q.value_range("month", 1, 12, "month_range", "silver"))
    assert r.violations == 2
    assert r.description == ("Column 'month' has 1 value(s) below minimum 1.; "
                             "Column 'month' has 1 value(s) above maximum 12.")


def test_non_negative_delays(spark):
    df = spark.createDataFrame([(10.0, -1.0), (0.0, 0.0)], "arr_delay double, carrier_delay double")
    rule = Q.combine([Q.value_range(c, 0, None, "n", "silver") for c in ["arr_delay", "carrier_delay"]],
                     "non_negative_delays", "silver", "WARN", "All delay columns are non-negative.")
    r = _row(df, rule)
    assert r.severity == "WARN" and r.violations == 1
    assert r.description == "Column 'carrier_delay' has 1 value(s) below minimum 0."


def test_consistency_tolerance_strict_and_nulls_as_zero(spark):
    df = spark.createDataFrame([(3.0, 2.0, None), (4.0, 2.0, 1.0), (5.0, 2.0, 1.9)], "total double, a double, b double")
    r = _row(df, Q.consistency(["a", "b"], "total", 1.0, "cons", "silver"))
    # row1: |2-3| = 1.0 not > 1.0 ; row2: |3-4| = 1 ; row3: |3.9-5| = 1.1 > 1
    assert r.violations == 1
    assert r.description == "1 row(s) where [a + b] differs from 'total' by more than 1.0."


def test_freshness_windows(spark):
    now = F.lit(NOW).cast("timestamp")

    def check(ts):
        df = spark.createDataFrame([(ts,)], "_ingested_at timestamp")
        return _row(df, Q.freshness("_ingested_at", now, 25, "data_freshness", "bronze"))

    assert check(NOW - dt.timedelta(hours=1)).passed
    assert check(NOW - dt.timedelta(hours=25)).passed  # exactly the limit passes
    r = check(NOW - dt.timedelta(hours=30))
    assert not r.passed and r.description == (
        "Latest ingestion is 30.0 hour(s) old, exceeding the 25-hour freshness threshold.")
    r = check(None)
    assert not r.passed and r.description == "No ingestion timestamps found — table may be empty."


def test_orphans_anti_join_and_null_handling(spark):
    fact = spark.createDataFrame([("k1",), ("k2",), (None,)], "carrier_key string")
    dim = spark.createDataFrame([("k1",)], "carrier_key string")
    assert Q.orphans_frame(fact, dim, "carrier_key").agg(F.sum("__n")).first()[0] == 2  # k2 and NULL
    assert Q.orphans_frame(fact, dim, "carrier_key", skip_null=True).agg(F.sum("__n")).first()[0] == 1


def test_one_aggregation_per_frame(spark):
    df = spark.createDataFrame([(1, None)], "month int, x int")
    out = Q.evaluate(df, [Q.no_nulls(["x"], "a", "l"), Q.value_range("month", 1, 12, "b", "l")])
    plan = plan_text(out, "simple")
    assert plan.count("HashAggregate(") <= 2  # partial + final, shared by both rules
    assert out.count() == 2


def scans(df, column: str) -> int:
    """Parquet scans of the executed plan that read ``column``."""
    import re

    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return len([1 for line in re.findall(r"Scan parquet .*|FileScan parquet .*", text) if column in line])


def test_suite_reads_the_fact_once_for_rules_and_links(spark, store):
    from tarmac.plans import checks

    fact = spark.createDataFrame([(f"id{i}", 202401 + i % 3, f"c{i % 4}" if i % 9 else None, f"a{i % 5}") for i in range(90)],
                                 "airline_delay_id string, date_key int, carrier_key string, airport_key string")
    fact.write.saveAsTable(store.name("fact"))
    parents = {"carrier_key": ["c0", "c1", "c2"], "airport_key": [f"a{i}" for i in range(5)] + ["a0"], "date_key": [202401, 202402]}
    frames = {k: spark.createDataFrame([(v,) for v in vs], f"{k} {'int' if k == 'date_key' else 'string'}") for k, vs in parents.items()}
    models = {"fact_flight_delays": store.read("fact"), "dim_carrier": frames["carrier_key"], "dim_airport": frames["airport_key"],
              "dim_date": frames["date_key"]}
    got = checks.relationship_tests(models)
    assert scans(got, "carrier_key") == 1
    want = {}
    rows = fact.collect()
    for key, vs in parents.items():
        want[f"relationships_fact_flight_delays_{key}"] = sum(r[key] is not None and r[key] not in vs for r in rows)
    assert {r.check: r.violations for r in got.collect()} == want
    flagged, rules, apart = Q.with_links(models["fact_flight_delays"], [checks.link_of("fact_flight_delays", k, f) for k, f in frames.items()], max_rows=2)
    assert len(rules) == 1 and len(apart) == 2  # parents above the bound are joined by counted keys
    both = Q.union_all([Q.evaluate(flagged, rules), *apart])
    assert {r.check: r.violations for r in both.collect()} == want


def test_repeated_keys_are_counted_exactly_and_not_read_again_without_any(spark, store):
    rows = [("a", 1), ("a", 1), ("a", 2), ("b", 1), (None, 1), (None, None), (None, None), ("c", 3)]
    df = spark.createDataFrame(rows * 1, "k string, n int")
    assert {(r.k, r.n): r["__n"] for r in Q.repeated_keys(df, ["k", "n"]).collect()} == {("a", 1): 2, (None, None): 2}
    assert {r.k: r["__n"] for r in Q.repeated_keys(df, ["k"], max_rows=0).collect()} == {"a": 3, None: 3}
    spark.range(1000).withColumn("k", F.md5(F.col("id").cast("string"))).write.saveAsTable(store.name("keys"))
    unique = Q.repeated_keys(store.read("keys"), ["k"])
    assert unique.count() == 0 and "FileScan" not in plan_text(unique, "simple")


def test_suite_equals_the_single_checks(spark):
    import os

    import pytest
    from engine_helpers import SF_SMALL

    if not os.path.exists(SF_SMALL):
        pytest.skip("driver data missing")
    from tarmac.catalog.queries import NOW, _models, bronze_from_star, dirty_staging, layers
    from tarmac.functions.dates import utc_stamp
    from tarmac.plans import checks
    from tarmac.session import materialise

    lay = layers(spark, SF_SMALL)
    models = {k: materialise(v) for k, v in (_models(lay) | {"stg_airline_delay_data": dirty_staging(lay.staging)}).items()}
    models["dim_date"] = models["dim_date"].where("month <> 3")
    bronze, now = bronze_from_star(spark, SF_SMALL), utc_stamp(NOW)
    gold = [models["fact_flight_delays"], lay.dim_carrier.where("carrier_key < '8'"), lay.dim_airport, models["dim_date"]]
    whole = checks.suite(bronze, models, gold[0], dict(zip(("gold_dim_carrier", "gold_dim_airport", "gold_dim_date"), gold[1:], strict=True)), now,
                         {"dim_carrier": 25, "gold_dim_airport": 25})
    apart = [checks.bronze_checks(bronze, now), checks.silver_checks(models["stg_airline_delay_data"]), checks.gold_checks(*gold),
             checks.unique_tests(models), checks.not_null_tests(models), checks.relationship_tests(models)]
    rows = lambda df: sorted(map(tuple, df.collect()))
    got = rows(whole)
    assert got == rows(Q.union_all(apart)) and sum(not r[4] for r in got) >= 6


def test_drift_counts_what_the_contract_cannot_take(spark):
    from pyspark.sql import types as T

    want = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DateType()), T.StructField("c", T.StringType()),
                         T.StructField("gone", T.DoubleType())])
    df = spark.createDataFrame([("1", "2024-01-02", "x", 1), ("1.5x", "soon", None, 2), (None, None, "y", 3), ("99999999999", "2024-02-30", "z", 4)],
                               "a string, b string, c string, extra int")
    assert [tuple(r) for r in Q.drift(df, want).collect()] == [
        ("a", "int", "string", 2), ("b", "date", "string", 2), ("gone", "double", None, 0), ("extra", None, "int", 0)]
    assert Q.drift(df, df.schema).collect() == []
