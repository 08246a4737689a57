import os
from decimal import Decimal

import pytest

from engine_helpers import SF_SMALL, plan_text
from tarmac.schemas import BRONZE_CSV, CSV_COLUMNS


def test_csv_explicit_schema_and_count_as_float_text(spark, tmp_path):
    from tarmac.sources.csv_source import read_raw_csv

    p = tmp_path / "delays.csv"
    values = ["2024", "1", "AA", "American", "JFK", "JFK Intl", "120.0"] + ["1.5"] * 14
    p.write_text(",".join(CSV_COLUMNS) + "\n" + ",".join(values) + "\n")
    df = read_raw_csv(spark, str(p))
    assert df.schema == BRONZE_CSV
    r = df.first()
    assert r.year == 2024 and r.arr_flights == Decimal(120)  # the contract keeps 18 places


def test_csv_failfast_on_bad_value(spark, tmp_path):
    from tarmac.sources.csv_source import read_raw_csv

    p = tmp_path / "bad.csv"
    values = ["2024", "January", "AA", "American", "JFK", "JFK Intl"] + ["1"] * 15
    p.write_text(",".join(CSV_COLUMNS) + "\n" + ",".join(values) + "\n")
    with pytest.raises(Exception):
        read_raw_csv(spark, str(p)).collect()


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="driver data missing")
def test_adapter_scans_are_pruned_and_nothing_runs_in_python(spark):
    from tarmac.catalog.queries import layers
    from tarmac.plans.rollup import carrier_state
    from tarmac.plans.serving import top_carriers

    top = top_carriers(carrier_state(layers(spark, SF_SMALL).fact))
    plan = plan_text(top)
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    from tarmac.sources.star_adapter import line_grain

    grain_plan = plan_text(line_grain(spark, SF_SMALL))
    assert ("ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_linenumber:int,l_quantity:double,"
            "l_discount:double,l_returnflag:string,l_linestatus:string,l_shipdate:timestamp_ntz>") in grain_plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in grain_plan


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="driver data missing")
def test_dedupe_limits_rows_before_the_shuffle(spark):
    from tarmac.catalog.queries import win_01

    plan = plan_text(win_01(spark, SF_SMALL), "simple")
    first_limit = plan.find("WindowGroupLimit")
    exchange = plan.find("Exchange hashpartitioning(l_orderkey")
    assert first_limit != -1 and exchange != -1
    assert plan.count("WindowGroupLimit") == 2  # partial (map side) + final


def test_bounded_broadcast_checks_size(spark):
    from tarmac.operators.broadcast import bounded_broadcast

    small = spark.range(5).withColumnRenamed("id", "k")
    big = spark.range(1000).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in plan_text(big.join(bounded_broadcast(small, 10), "k"))
    assert "BroadcastHashJoin" not in plan_text(small.join(bounded_broadcast(big, 10), "k"))


def test_dimension_broadcast_needs_an_exact_bound(spark):
    from tarmac.operators.broadcast import DIM_BROADCAST_ROWS
    from tarmac.plans.layers import _dim_for_join

    fact = spark.range(1000).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(DIM_BROADCAST_ROWS + 1).withColumnRenamed("id", "k")

    def broadcast_join(dim, staging_rows):
        return "BroadcastHashJoin" in plan_text(fact.join(_dim_for_join(dim, staging_rows), "k"), "simple")

    assert broadcast_join(small, 1000)  # the staging row count bounds the dimension
    assert broadcast_join(small, 10**9)  # staging too large: a bounded count of the dimension decides
    assert not broadcast_join(big, 10**9)  # over the bound: shuffle join
    assert not broadcast_join(small, None)  # no count: left to the planner
