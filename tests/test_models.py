import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from tarmac.plans.dims import dim_airport, dim_carrier, dim_date
from tarmac.plans.fact import fact_flight_delays
from tarmac.plans.marts import carrier_delay_performance, monthly_delay_trends
from tarmac.plans.rollup import carrier_state, monthly_state
from tarmac.plans.serving import headline, monthly_trend, top_carriers
from tarmac.plans.staging import stage
from tarmac.schemas import FACT_COLUMNS

from test_staging import bronze_rows

T1 = dt.datetime(2024, 1, 1)


def staging(spark, rows):
    return stage(bronze_rows(spark, rows))


def test_dim_date_and_fact_join(spark):
    st = staging(spark, [
        dict(year=2024, month=1, carrier="AA", airport="JFK", arr_flights=10, arr_del15=2, arr_delay=30, _ingested_at=T1),
        dict(year=2024, month=11, carrier="DL", airport="JFK", arr_flights=5, arr_del15=1, arr_delay=12.5, _ingested_at=T1),
        dict(year=2024, month=11, carrier=None, airport="JFK", arr_flights=5, _ingested_at=T1),
    ])
    d = {r.date_key: r for r in dim_date(st).collect()}
    assert d[202411].quarter == 4 and d[202411].month_name == "November" and d[202411].year_month == "2024-11"
    fact = fact_flight_delays(st, dim_carrier(st), dim_airport(st), dim_date(st))
    assert fact.columns == FACT_COLUMNS
    assert fact.count() == 2  # NULL carrier drops out of the inner join


def test_two_names_fan_out_and_latest_option(spark):
    st = staging(spark, [
        dict(year=2024, month=1, carrier="AA", carrier_name="American", airport="JFK", arr_flights=10, _ingested_at=T1),
        dict(year=2024, month=2, carrier="AA", carrier_name="American Airlines", airport="JFK", arr_flights=10,
             _ingested_at=dt.datetime(2024, 2, 1)),
    ])
    dc = dim_carrier(st)
    assert dc.count() == 2
    fact = fact_flight_delays(st, dc, dim_airport(st), dim_date(st))
    assert fact.count() == 4  # each staging row joins both names
    latest = dim_carrier(st, on_name_conflict="latest").collect()
    assert [(r.carrier, r.carrier_name) for r in latest] == [("AA", "American Airlines")]


def test_marts_ratios_and_null_sums(spark):
    st = staging(spark, [
        dict(year=2024, month=1, carrier="AA", airport="JFK", arr_flights=3, arr_del15=1, arr_delay=10.005,
             _ingested_at=T1),
        dict(year=2024, month=1, carrier="AA", airport="LAX", arr_flights=5, arr_del15=0, arr_delay=0, _ingested_at=T1),
        dict(year=2024, month=2, carrier="DL", airport="LAX", arr_flights=0, arr_del15=0, arr_delay=0, _ingested_at=T1),
    ])
    fact = fact_flight_delays(st, dim_carrier(st), dim_airport(st), dim_date(st))
    c = {r.carrier: r for r in carrier_delay_performance(fact).collect()}
    assert c["AA"].total_flights == 8 and c["AA"].delay_rate_pct == 12.5
    assert c["AA"].total_delay_minutes == Decimal("10.01")
    assert c["AA"].avg_delay_minutes_per_delayed_flight == 10.01
    assert c["AA"].total_security_delay_minutes is None  # all-NULL sum stays NULL
    assert c["DL"].delay_rate_pct is None  # zero denominator
    m = monthly_delay_trends(fact).collect()
    assert [r.month for r in m] == [1, 2] and m[0].avg_delay_minutes_per_flight == 1.25


def test_partial_state_merge_equals_direct_aggregate(spark):
    rows = [dict(year=y, month=m, carrier=c, airport=a, arr_flights=f, arr_del15=f // 3, arr_delay=f * 1.5,
                 _ingested_at=T1)
            for y in (2023, 2024) for m in (1, 6) for c in ("AA", "DL", "UA") for a, f in (("JFK", 7), ("LAX", 9))]
    st = staging(spark, rows)
    fact = fact_flight_delays(st, dim_carrier(st), dim_airport(st), dim_date(st))
    top = {r.carrier: r for r in top_carriers(carrier_state(fact)).collect()}
    direct = {r.carrier: r for r in carrier_delay_performance(fact).collect()}
    for c in top:
        assert top[c].total_flights == direct[c].total_flights
        assert top[c].delay_rate_pct == direct[c].delay_rate_pct
    trend = monthly_trend(monthly_state(fact)).collect()
    assert [r.month_start for r in trend] == [dt.date(2023, 1, 1), dt.date(2023, 6, 1), dt.date(2024, 1, 1),
                                              dt.date(2024, 6, 1)]


def test_top_k_tie_break_having_and_headline(spark):
    state = spark.createDataFrame(
        [(2024, "k1", "BB", 10, 5), (2024, "k2", "AA", 10, 5), (2024, "k3", "CC", 0, 0), (2023, "k2", "AA", 10, 1)],
        "year int, carrier_key string, carrier string, total_flights_state long, total_delayed_state long")
    top = top_carriers(state, 2).collect()
    assert [r.carrier for r in top] == ["BB", "AA"]  # 50% beats 30%; CC has no flights
    ms = spark.createDataFrame([(2024, 202401, 1, 10, 1), (2024, 202402, 2, 10, 3)],
                               "year int, date_key int, month int, total_flights_state long, total_delayed_state long")
    h = {r.metric: r for r in headline(top_carriers(state, 10), monthly_trend(ms)).collect()}
    assert h["worst_carrier"].label == "BB" and h["latest_month"].label == "2024-02-01"
    assert h["latest_month"].delay_rate_pct == 30.0


def test_lateral_aliases_merge_the_states_of_the_whole_chain(spark):
    """cnd_03 sums the carriers' states built from staging and fact, not one raw table."""
    import __spark_entry__ as E

    sf_dir = "/root/testdata/sf0.001"
    got = {r.carrier: r for r in E.queries()["cnd_03"](spark, sf_dir).collect()}
    want = {r.carrier: r for r in E.queries()["agg_15"](spark, sf_dir).collect() if r.total_flights}
    assert got and set(got) == set(want)
    for carrier, row in got.items():
        assert (row.total_flights, row.total_delayed) == (want[carrier].total_flights, want[carrier].total_delayed)
        exact = Decimal(100 * row.total_delayed) / Decimal(row.total_flights)
        assert row.delay_rate_pct == float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))
