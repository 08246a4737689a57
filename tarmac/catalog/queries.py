"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
inventory item. Every query starts from the driver's parquet tables.

Output columns of type decimal are presented as double (the exact decimal
value converted once at the end), so that results compare across engines
whose decimal result types differ; internal tables keep decimals.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.dates import month_key_of, month_name, month_start, quarter_of, utc_stamp
from tarmac.functions.keys import code_key
from tarmac.functions.numeric import exact_ratio, sql_exact_ratio
from tarmac.operators import quality as Q
from tarmac.operators.dedupe import collapse_latest, latest_per_key
from tarmac.operators.partial_state import merge_states
from tarmac.operators.sample import sample_rows
from tarmac.plans import checks
from tarmac.plans.dims import dim_date
from tarmac.plans.layers import Layers, build_layers, materialise
from tarmac.plans.marts import carrier_delay_performance, monthly_delay_trends, row_distribution
from tarmac.plans.rollup import carrier_state, monthly_state
from tarmac.plans.runs import GOLD_TRIO, STAGING_MARK, backfill, build_marts, load_bronze, load_silver, publish_fact_years, run_daily
from tarmac.plans.serving import headline, monthly_trend, top_carriers
from tarmac.plans.staging import rows_after, stage
from tarmac.schemas import (
    BRONZE_TEXT_LIMITS,
    CSV_COLUMNS,
    DELAY_COLUMNS,
    FACT_COLUMNS,
    KEY_COLUMNS,
    MEASURE_COLUMNS,
    STAGING,
    STAGING_COLUMNS,
)
from tarmac.sinks import layout, versions
from tarmac.sinks import tables as sink
from tarmac.sources.star_adapter import bronze_batch, bronze_from_star, reload_batch, with_redelivery
from tarmac.sources.tables import read_table

# Fixed parameters of the registered scenarios.
NOW = dt.datetime(2024, 1, 31, 12, 0, 0, tzinfo=dt.timezone.utc)  # "current time" of checks
RUN_STAMP = dt.datetime(2024, 1, 31, 3, 0, 0, tzinfo=dt.timezone.utc)  # ingest stamp of the daily run
RUN_MONTH = "1998-06-01"
BACKFILL_RANGE = ("1996-11-01", "1997-02-01")
DIM_DATE_PUBLISHED_BEFORE = "2000-01-01"


def present(df: DataFrame) -> DataFrame:
    """Decimal columns as double; everything else unchanged."""
    return df.select(
        [F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
         for f in df.schema.fields]
    )


def layers(spark: SparkSession, sf_dir: str, **kw) -> Layers:
    return build_layers(bronze_from_star(spark, sf_dir), **kw)


def store_for(spark: SparkSession) -> sink.Store:
    return sink.Store(spark)


# ---------------------------------------------------------------- models


def mod_01(spark, sf_dir):
    return present(layers(spark, sf_dir).staging)


def mod_02(spark, sf_dir):
    return layers(spark, sf_dir).dim_carrier


def mod_03(spark, sf_dir):
    return layers(spark, sf_dir).dim_airport


def mod_04(spark, sf_dir):
    return layers(spark, sf_dir).dim_date


def mod_05(spark, sf_dir):
    return present(layers(spark, sf_dir).fact)


def mod_06(spark, sf_dir):
    return present(carrier_delay_performance(layers(spark, sf_dir).fact))


def mod_07(spark, sf_dir):
    return present(monthly_delay_trends(layers(spark, sf_dir).fact))


def mod_08(spark, sf_dir):
    return present(carrier_state(layers(spark, sf_dir).fact))


def mod_09(spark, sf_dir):
    return present(monthly_state(layers(spark, sf_dir).fact))


def mod_10(spark, sf_dir):
    return top_carriers(carrier_state(layers(spark, sf_dir).fact), 10)


def mod_11(spark, sf_dir):
    return monthly_trend(monthly_state(layers(spark, sf_dir).fact))


# ------------------------------------------------------- window / filters


LINE_ORDER = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus"]


def win_01(spark, sf_dir):
    """Latest line version per (order, line number) over the whole lineitem."""
    li = read_table(spark, sf_dir, "lineitem")
    return latest_per_key(li, ["l_orderkey", "l_linenumber"], [F.col(c).desc_nulls_first() for c in LINE_ORDER])


def flt_02(spark, sf_dir):
    """Bronze rows newer than the committed high-water mark: the second batch, and no file of the first."""
    store = store_for(spark)
    first = materialise(bronze_batch(spark, sf_dir), "bronze")  # the adapter runs once
    sink.append_batch(first, store, "bronze")
    load_silver(store)
    sink.append_batch(reload_batch(first), store, "bronze")
    head = store.log.head()
    mark = head.properties[STAGING_MARK]
    return present(rows_after(store.log.read("bronze", head, sink.new_batches(head, "bronze", mark)), mark))


def flt_04(spark, sf_dir):
    bronze = bronze_from_star(spark, sf_dir)
    any_null = lambda cols: F.count_if(
        F.expr(" OR ".join(f"{c} IS NULL" for c in cols))
    )
    return bronze.agg(
        any_null(KEY_COLUMNS).alias("null_key_rows"),
        any_null(DELAY_COLUMNS[1:]).alias("null_cause_rows"),
    )


def flt_05(spark, sf_dir):
    lay = layers(spark, sf_dir)
    blank = lambda dim, code: dim.withColumn(
        f"{code}_name", F.when(F.col(f"{code}_key") >= "8", F.col(f"{code}_name")).otherwise(F.lit("")))
    return checks.gold_checks(lay.fact, blank(lay.dim_carrier, "carrier"), blank(lay.dim_airport, "airport"), lay.dim_date,
                              only={"no_null_carrier_columns", "no_null_airport_columns"})


def flt_07(spark, sf_dir):
    state = carrier_state(layers(spark, sf_dir).fact)
    merged = merge_states(state, ["carrier"], {"total_flights": "total_flights_state",
                                               "total_delayed": "total_delayed_state"})
    return merged.where(F.col("total_flights") > 0)


# ------------------------------------------------------------------ joins


def joi_01(spark, sf_dir):
    """The carrier join of the fact model (its broadcast plan included)."""
    return layers(spark, sf_dir).fact.select("airline_delay_id", "carrier", "carrier_key")


def joi_02(spark, sf_dir):
    return layers(spark, sf_dir).fact.select("airline_delay_id", "airport", "airport_key")


def joi_03(spark, sf_dir):
    return layers(spark, sf_dir).fact.select("airline_delay_id", "year", "month", "date_key")


def _orphan_checks(spark, sf_dir, name: str) -> DataFrame:
    """Orphans of a written fact against dimensions of which part is missing:
    codes whose key sorts from '8' on, and periods loaded after the publication."""
    lay = layers(spark, sf_dir)
    # Date dimension as published before the later periods were loaded.
    published = lay.staging.where(F.col("_ingested_at") < F.lit(DIM_DATE_PUBLISHED_BEFORE).cast("timestamp"))
    return checks.gold_checks(materialise(lay.fact, "fact"), lay.dim_carrier.where("carrier_key < '8'"),
                              lay.dim_airport.where("airport_key < '8'"), dim_date(published), only={name})


def joi_04(spark, sf_dir):
    return _orphan_checks(spark, sf_dir, "no_orphaned_carrier_keys")


def joi_05(spark, sf_dir):
    return _orphan_checks(spark, sf_dir, "no_orphaned_airport_keys")


def joi_06(spark, sf_dir):
    return _orphan_checks(spark, sf_dir, "no_orphaned_date_keys")


def dirty_staging(staging: DataFrame) -> DataFrame:
    """Staging with faults for the checks to find: every row of January twice, months
    beyond 12, missing carriers and negative delays, each where a count says so."""
    flights = F.col("arr_flights")
    doubled = staging.unionByName(staging.where("month = 1"))
    return (doubled.withColumn("month", F.when(flights % 7 == 0, F.col("month") + 12).otherwise(F.col("month")))
            .withColumn("carrier", F.when(flights % 5 != 0, F.col("carrier")))
            .withColumn("weather_delay", F.when(flights % 3 == 0, -F.col("weather_delay")).otherwise(F.col("weather_delay"))))


def _models(lay: Layers) -> dict[str, DataFrame]:
    """The seven tested models. The fact (a scan of the written staging table
    through three broadcast joins, no shuffle) is cheaper to recompute in
    each of its three consumers than to write and read back."""
    fact = lay.fact
    return {
        "stg_airline_delay_data": lay.staging,
        "dim_carrier": lay.dim_carrier,
        "dim_airport": lay.dim_airport,
        "dim_date": lay.dim_date,
        "fact_flight_delays": fact,
        "carrier_delay_performance": carrier_delay_performance(fact),
        "monthly_delay_trends": monthly_delay_trends(fact, ordered=False),
    }


def joi_07(spark, sf_dir):
    """Relationships of a written fact with parents of which part is missing."""
    lay = layers(spark, sf_dir)
    return checks.relationship_tests({
        "fact_flight_delays": materialise(lay.fact, "fact"), "dim_date": lay.dim_date.where("month <> 3"),
        "dim_carrier": lay.dim_carrier.where("carrier_key < '8'"), "dim_airport": lay.dim_airport.where("airport_key < '8'")})


def joi_08(spark, sf_dir):
    """Fan-out: carriers renamed in the re-delivered year get two dimension
    rows, and every fact row of such a carrier joins both."""
    first = bronze_batch(spark, sf_dir)
    renamed = reload_batch(first).withColumn("carrier_name", F.lower("carrier_name"))
    lay = build_layers(first.unionByName(renamed))
    fact_rows = lay.fact.groupBy("carrier").agg(F.count(F.lit(1)).alias("fact_rows"))
    staging_rows = lay.staging.groupBy("carrier").agg(F.count(F.lit(1)).alias("staging_rows"))
    names = lay.dim_carrier.groupBy("carrier").agg(F.count(F.lit(1)).alias("dim_rows"))
    return staging_rows.join(names, "carrier").join(fact_rows, "carrier")


# ------------------------------------------------------------ aggregations


def _by_airport(spark, sf_dir) -> DataFrame:
    fact = layers(spark, sf_dir).fact
    return fact.groupBy("airport").agg(
        F.sum("arr_flights").alias("total_flights"),
        F.sum("arr_del15").alias("total_delayed"),
        F.sum("arr_delay").alias("total_delay_minutes"),
    )


def agg_05(spark, sf_dir):
    return _by_airport(spark, sf_dir).select(
        "airport", exact_ratio("total_delayed", "total_flights", factor=100).alias("delay_rate_pct"))


def agg_06(spark, sf_dir):
    return _by_airport(spark, sf_dir).select(
        "airport",
        exact_ratio("total_delay_minutes", "total_delayed", num_scale=2).alias("avg_delay_minutes_per_delayed_flight"))


def agg_07(spark, sf_dir):
    return _by_airport(spark, sf_dir).select(
        "airport", exact_ratio("total_delay_minutes", "total_flights", num_scale=2).alias("avg_delay_minutes_per_flight"))


def agg_08(spark, sf_dir):
    return layers(spark, sf_dir).staging.select("carrier", "carrier_name").distinct()


def agg_10(spark, sf_dir):
    return layers(spark, sf_dir).staging.select("year", "month").distinct()


def agg_11(spark, sf_dir):
    bronze = materialise(bronze_from_star(spark, sf_dir), "bronze")  # the adapter runs once
    lay = build_layers(bronze)
    parts = [
        bronze.agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit("bronze")),
        lay.staging.agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit("staging")),
        lay.fact.agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit("fact")),
    ]
    return Q.union_all(parts).select("table_name", "row_count")


def agg_12(spark, sf_dir):
    return bronze_from_star(spark, sf_dir).agg(F.max("_ingested_at").alias("latest_ingested_at"))


def agg_15(spark, sf_dir):
    state = carrier_state(layers(spark, sf_dir).fact)
    return present(merge_states(state, ["carrier"], {
        "total_flights": "total_flights_state",
        "total_delayed": "total_delayed_state",
        "total_delay_minutes": "total_delay_minutes_state",
    }))


def agg_16(spark, sf_dir):
    state = monthly_state(layers(spark, sf_dir).fact).withColumn("month_start", month_start("year", "month"))
    return present(merge_states(state, ["month_start"], {
        "total_flights": "total_flights_state",
        "total_delayed": "total_delayed_state",
        "total_delay_minutes": "total_delay_minutes_state",
    }))


def agg_18(spark, sf_dir):
    """Total vs distinct (order, line number) pairs of lineitem; NULL keys group together."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"])
    groups = Q.duplicates_frame(li, ["l_orderkey", "l_linenumber"])
    return groups.agg(
        F.sum("__n").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.sum(F.col("__n") - 1).alias("excess_rows"),
    )


def agg_20(spark, sf_dir):
    return row_distribution(layers(spark, sf_dir).fact)


# ----------------------------------------------------------------- sorting


def srt_01(spark, sf_dir):
    """Months of the monthly mart with their place in its order."""
    months = monthly_delay_trends(layers(spark, sf_dir).fact, ordered=False)
    place = F.row_number().over(Window.orderBy("year", "month"))  # one row per month
    return months.select("year", "month", "total_flights", place.alias("place"))


def srt_03(spark, sf_dir):
    """Months of the served trend with their place in its order."""
    trend = monthly_trend(monthly_state(layers(spark, sf_dir).fact))
    return trend.select("month_start", "total_flights", F.row_number().over(Window.orderBy("month_start")).alias("place"))


def srt_02(spark, sf_dir):
    mart = carrier_delay_performance(layers(spark, sf_dir).fact)
    return present(
        mart.orderBy(F.col("delay_rate_pct").desc_nulls_last(), F.col("total_delayed").desc_nulls_last(), "carrier")
        .limit(10)
        .select("carrier", "total_flights", "total_delayed", "delay_rate_pct")
    )


def srt_04(spark, sf_dir):
    fact = layers(spark, sf_dir).fact
    return headline(top_carriers(carrier_state(fact), 10), monthly_trend(monthly_state(fact)))


# ------------------------------------------------------------------- sinks


def set_01(spark, sf_dir):
    """Two appends to bronze (first load, then the re-delivered year)."""
    store = store_for(spark)
    first = bronze_batch(spark, sf_dir)
    sink.append(first, store, "bronze")
    sink.append(reload_batch(store.read("bronze")), store, "bronze")
    return present(store.read("bronze"))


def snk_05(spark, sf_dir):
    """Full reload twice: the table holds the dimension once."""
    store = store_for(spark)
    lay = layers(spark, sf_dir)
    sink.full_reload(lay.dim_carrier, store, "dim_carrier")
    sink.full_reload(lay.dim_carrier, store, "dim_carrier")
    return store.read("dim_carrier")


def snk_07(spark, sf_dir):
    """Slice replace of one year, run twice, plus an emptied year."""
    store = store_for(spark)
    fact = layers(spark, sf_dir).fact
    sink.replace_slices(fact, store, "fact", [1997, 1998])
    sink.replace_slice(fact, store, "fact", 1998)
    sink.replace_slice(fact, store, "fact", 1998)
    sink.replace_slice(fact.where(F.lit(False)), store, "fact", 1997)
    return present(store.read("fact").select(*FACT_COLUMNS))


def snk_09(spark, sf_dir):
    """Upsert: first load, then the re-delivered year replaces its keys."""
    store = store_for(spark)
    first = materialise(bronze_batch(spark, sf_dir), "bronze")  # the adapter runs once
    # records without a year have no id: the second load adds its own and keeps the first one's
    undated = lambda df: df.unionByName(df.where("month = 2").withColumn("year", F.lit(None).cast("int")))
    sink.upsert(undated(materialise(stage(first))).withColumn(
        "airline_delay_id", F.when(F.col("year").isNotNull(), F.col("airline_delay_id"))), store, "staging")
    both = with_redelivery(first)
    second = materialise(stage(both, store.read("staging").where("year IS NOT NULL")))
    sink.upsert(undated(second).withColumn("airline_delay_id", F.when(F.col("year").isNotNull(), F.col("airline_delay_id"))), store, "staging")
    return present(store.read("staging").select(*STAGING_COLUMNS))


def snk_15(spark, sf_dir):
    """Latest version per carrier from two stamped publications of the dimension."""
    lay = layers(spark, sf_dir)
    v1 = lay.dim_carrier.withColumn("_updated_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    v2 = (lay.dim_carrier.withColumn("carrier_name", F.lower("carrier_name"))
          .withColumn("_updated_at", F.lit("2024-02-01 00:00:00").cast("timestamp")))
    return collapse_latest(v1.unionByName(v2), ["carrier_key"], "_updated_at")


# --------------------------------------------------------------- functions


def str_04(spark, sf_dir):
    st = layers(spark, sf_dir).staging
    return st.select("airline_delay_id", code_key("carrier").alias("carrier_key"),
                     code_key("airport").alias("airport_key"))


def dat_01(spark, sf_dir):
    return layers(spark, sf_dir).staging.select("month").distinct().select("month", month_name("month").alias("month_name"))


def dat_02(spark, sf_dir):
    return layers(spark, sf_dir).staging.select("month").distinct().select("month", quarter_of("month").alias("quarter"))


def dat_05(spark, sf_dir):
    return layers(spark, sf_dir).dim_date.select("year", "month", month_start("year", "month").alias("month_start"))


def dat_07(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["ts"])
    return ev.groupBy(month_key_of("ts").alias("month_key")).agg(F.count(F.lit(1)).alias("events"))


def dat_08(spark, sf_dir):
    """Every month between the first and last staged month, inclusive."""
    st = layers(spark, sf_dir).staging
    bounds = st.agg(F.min(month_start("year", "month")).alias("lo"), F.max(month_start("year", "month")).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("month_start")).select(
        F.date_format("month_start", "yyyy-MM-dd").alias("month_key"))


def cnd_01(spark, sf_dir):
    st = layers(spark, sf_dir).staging
    return st.groupBy(quarter_of("month").alias("quarter")).agg(F.count(F.lit(1)).alias("row_count"))


def cnd_02(spark, sf_dir):
    st = layers(spark, sf_dir).staging
    return present(st.select("airline_delay_id", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in DELAY_COLUMNS]))


def cnd_03(spark, sf_dir):
    """Lateral alias reuse with GROUP BY and HAVING, in Spark SQL, over the carriers' partial states."""
    state = carrier_state(layers(spark, sf_dir).fact)
    ratio = sql_exact_ratio("total_delayed", "total_flights", factor=100)
    # the frame is passed as a query argument: no session-wide temp view
    return spark.sql(
        """
        SELECT carrier,
               sum(total_flights_state) AS total_flights,
               sum(total_delayed_state) AS total_delayed,
               """ + ratio + """ AS delay_rate_pct
        FROM {state}
        GROUP BY carrier
        HAVING total_flights > 0
        """,
        state=state,
    )


def mth_01(spark, sf_dir):
    st = layers(spark, sf_dir).staging
    return present(st.select("airline_delay_id", F.round("carrier_ct", 1).alias("carrier_ct_1"),
                             F.round("weather_ct", 0).alias("weather_ct_0"),
                             F.round("arr_delay", -1).alias("arr_delay_tens")))


def mth_03(spark, sf_dir):
    st = layers(spark, sf_dir).staging
    return st.select("airline_delay_id",
                     exact_ratio("security_delay", "arr_del15", num_scale=2).alias("security_minutes_per_delayed"))


# ------------------------------------------------------------ data quality


def dq_01(spark, sf_dir):
    bronze = bronze_from_star(spark, sf_dir)
    rules = [Q.no_nulls([c], f"no_nulls_{c}", "bronze", success=f"Column '{c}' has no nulls.")
             for c in KEY_COLUMNS + MEASURE_COLUMNS]
    return Q.evaluate(bronze, rules)


def dq_02(spark, sf_dir):
    bronze = materialise(bronze_from_star(spark, sf_dir), "bronze")  # the adapter runs once
    lay = build_layers(bronze)
    return Q.union_all([
        Q.evaluate(bronze, [Q.min_row_count(1, "minimum_row_count", "bronze")]),
        Q.evaluate(lay.fact, [Q.min_row_count(1, "fact_row_count", "gold", success="fact_flight_delays has {n} rows.",
                                              failure="fact_flight_delays is empty.")]),
        Q.evaluate(lay.staging.where(F.col("year") > 2100), [Q.min_row_count(1, "future_rows", "silver")]),
    ])


def dq_03(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"])
    keys = ["l_orderkey", "l_linenumber"]
    return Q.evaluate(Q.duplicates_frame(li, keys), [Q.duplicates_rule(keys, "unique_line_key", "source",
                                                                       success="Line key is unique.")])


def dq_04(spark, sf_dir):
    st = dirty_staging(layers(spark, sf_dir).staging)
    return Q.evaluate(st, [
        Q.value_range("month", 1, 12, "month_range", "silver", success="All month values are in range [1, 12]."),
        Q.value_range("arr_flights", 1, 500, "flights_range", "silver", success="Flights in range."),
        Q.value_range("carrier_ct", 0, 1, "carrier_ct_range", "silver", "WARN", success="carrier_ct in range."),
    ])


def dq_05(spark, sf_dir):
    st = layers(spark, sf_dir).staging
    return Q.evaluate(st, [
        Q.consistency(DELAY_COLUMNS[1:], "arr_delay", 1.0, "delay_minutes_consistency", "silver"),
        Q.consistency(["carrier_ct", "weather_ct", "nas_ct", "security_ct", "late_aircraft_ct"], "arr_del15", 1.0,
                      "delay_cause_consistency", "silver"),
    ])


def dq_06(spark, sf_dir):
    now = utc_stamp(NOW)
    ev = read_table(spark, sf_dir, "events", ["ts"]).select(F.col("ts").cast("timestamp").alias("_ingested_at"))
    return Q.union_all([
        Q.evaluate(bronze_from_star(spark, sf_dir), [Q.freshness("_ingested_at", now, 25, "data_freshness", "bronze")]),
        Q.evaluate(ev, [Q.freshness("_ingested_at", now, 25, "data_freshness", "events")]),
    ])


def dq_10(spark, sf_dir):
    return checks.silver_checks(dirty_staging(layers(spark, sf_dir).staging), only={"unique_surrogate_key"})


def dq_13(spark, sf_dir):
    return checks.silver_checks(dirty_staging(layers(spark, sf_dir).staging), only={"non_negative_delays"})


def dq_20(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return checks.unique_tests(_models(lay) | {"stg_airline_delay_data": dirty_staging(lay.staging)})


def dq_21(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return checks.not_null_tests(_models(lay) | {"stg_airline_delay_data": dirty_staging(lay.staging)})


def dq_22(spark, sf_dir):
    """Relationships of the written fact with its own dimensions: all hold."""
    lay = layers(spark, sf_dir)
    return checks.relationship_tests(_models(lay) | {"fact_flight_delays": materialise(lay.fact, "fact")})


def dq_23(spark, sf_dir):
    """Declared text lengths of bronze."""
    return Q.evaluate(bronze_from_star(spark, sf_dir), [Q.text_length(BRONZE_TEXT_LIMITS, "text_lengths", "bronze")])


def dq_24(spark, sf_dir):
    """Staging as a changed feed would deliver it, against its contract: a count as text with words
    in it, a column gone and a new one."""
    st = layers(spark, sf_dir).staging
    flights = F.when(F.col("arr_flights") % 7 == 0, F.lit("n/a")).otherwise(F.col("arr_flights").cast("string"))
    return Q.drift(st.withColumn("arr_flights", flights).drop("weather_delay").withColumn("note", F.lit("x")), STAGING)


# ------------------------------------------------------------- end to end


def _daily(spark, sf_dir) -> sink.Store:
    store = store_for(spark)
    run_daily(bronze_batch(spark, sf_dir).select(*CSV_COLUMNS), store, RUN_MONTH, ingested_at=RUN_STAMP, now=NOW)
    return store


def mod_12(spark, sf_dir):
    store = _daily(spark, sf_dir)
    c = store.read("gold_dim_carrier").select(F.lit("carrier").alias("dim"), F.col("carrier_key").alias("key"),
                                               F.col("carrier").alias("code"), F.col("carrier_name").alias("name"))
    a = store.read("gold_dim_airport").select(F.lit("airport").alias("dim"), F.col("airport_key").alias("key"),
                                               F.col("airport").alias("code"), F.col("airport_name").alias("name"))
    d = store.read("gold_dim_date").select(F.lit("date").alias("dim"), F.col("date_key").cast("string").alias("key"),
                                            F.col("year_month").alias("code"), F.col("month_name").alias("name"))
    return Q.union_all([c, a, d])


def mod_13(spark, sf_dir):
    store = _daily(spark, sf_dir)
    return present(store.read("gold_fact_flight_delays").select(*FACT_COLUMNS))


def mod_14(spark, sf_dir):
    store = store_for(spark)
    result = run_daily(bronze_batch(spark, sf_dir).select(*CSV_COLUMNS), store, RUN_MONTH,
                       ingested_at=RUN_STAMP, now=NOW)
    return result.checks


def mod_15(spark, sf_dir):
    store = _daily(spark, sf_dir)
    backfill(store, *BACKFILL_RANGE)
    return present(store.read("gold_fact_flight_delays").select(*FACT_COLUMNS))


LATER_STAMP = RUN_STAMP + dt.timedelta(days=1)


def _redelivered(spark, sf_dir) -> sink.Store:
    """The daily run, then a second delivery of one year, staged."""
    first = materialise(bronze_batch(spark, sf_dir), "bronze")  # the adapter runs once
    store = store_for(spark)
    run_daily(first.select(*CSV_COLUMNS), store, RUN_MONTH, ingested_at=RUN_STAMP, now=NOW)
    load_bronze(reload_batch(first).select(*CSV_COLUMNS), store, ingested_at=LATER_STAMP)
    load_silver(store)
    return store


def _trio_totals(store: sink.Store, phase: str) -> DataFrame:
    """Flights per year in the three tables that are published together."""
    flights = ("arr_flights", "total_flights_state", "total_flights_state")
    return Q.union_all([
        store.read(table).groupBy("year").agg(F.sum(c).alias("flights")).select(
            F.lit(phase).alias("phase"), F.lit(table).alias("table_name"), "year", "flights")
        for table, c in zip(GOLD_TRIO, flights, strict=True)])


def mod_16(spark, sf_dir):
    """A publication that fails after two of its three writes, then its rerun: readers see the old
    trio until the commit, and the new one as a whole."""
    store = _redelivered(spark, sf_dir)
    build_marts(store)
    year = [int(RUN_MONTH[:4])]
    phases = [materialise(_trio_totals(store, "published"))]
    base = store.log.head()
    source = store.read("fact_flight_delays").where(F.col("year").isin(year))
    for table, rows in zip(GOLD_TRIO[:2], (source.select(*FACT_COLUMNS), carrier_state(source)), strict=True):
        sink.stage_slices(rows, store, table, year)  # written; the third write never comes, so nothing is committed
    assert store.log.head().version == base.version
    phases.append(materialise(_trio_totals(store, "interrupted")))
    publish_fact_years(store, year)
    phases.append(_trio_totals(store, "rerun"))
    return Q.union_all(phases)


def mod_17(spark, sf_dir):
    """The carrier mart kept up by year slices after the second delivery."""
    store = _redelivered(spark, sf_dir)
    build_marts(store)
    return present(store.read("carrier_delay_performance"))


def mod_18(spark, sf_dir):
    """Which years of the fact and of the monthly mart the second delivery rewrote, with their rows."""
    store = _redelivered(spark, sf_dir)
    before = store.log.head()
    build_marts(store)
    after = store.log.head()
    parts = []
    for table in ("fact_flight_delays", "monthly_delay_trends"):
        rewritten = [int(y) for y in after.parts(table) if after.location(table, y) != before.location(table, y)]
        parts.append(store.read(table).groupBy("year").agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(table).alias("table_name"), "year", "row_count", F.col("year").isin(rewritten).alias("rewritten")))
    return Q.union_all(parts)


def mod_19(spark, sf_dir):
    """The monthly mart kept up by year slices after the second delivery."""
    store = _redelivered(spark, sf_dir)
    build_marts(store)
    return present(store.read("monthly_delay_trends"))


# ------------------------------------------- file layouts, seeded sample


def src_01(spark, sf_dir):
    """CSV round trip: write the first load as CSV, read it back with the
    explicit 21-column schema (FAILFAST)."""
    from tarmac.sources.csv_source import read_raw_csv, write_csv
    from tarmac.session import work_dir

    path = work_dir(spark, "csv")
    write_csv(bronze_batch(spark, sf_dir).select(*CSV_COLUMNS), path)
    return present(read_raw_csv(spark, path))


def snk_06(spark, sf_dir):
    store = store_for(spark)
    fact = layers(spark, sf_dir).fact
    sink.full_reload(fact, store, "fact_chunked", chunk_size=1000)
    return present(store.read("fact_chunked"))


def snk_11(spark, sf_dir):
    store = store_for(spark)
    sink.write_layout(layers(spark, sf_dir).fact, store, "fact_layout")
    return present(store.read("fact_layout").select(*FACT_COLUMNS))


def snk_12(spark, sf_dir):
    store = store_for(spark)
    sink.write_layout(layers(spark, sf_dir).fact, store, "fact_bloom", bloom_cols=("carrier", "airport"))
    return present(store.read("fact_bloom").select(*FACT_COLUMNS))


def snk_18(spark, sf_dir):
    """Bloom filters of the code columns: in how many row groups' footers they stand, and what lookups read."""
    store = store_for(spark)
    sink.write_layout(layers(spark, sf_dir).fact, store, "fact_bloom", chunk_size=1000)
    fact = store.read("fact_bloom")
    told = materialise(layout.footers(fact, ["carrier", "airport"]))
    parts = []
    for column in ("carrier", "airport"):
        least = fact.agg(F.min(column)).first()[0]  # the codes of the fact sort after it and before its repetition
        absent = layout.rows_read(fact.where(F.col(column) == F.lit(f"{least}!")))
        parts.append(told.where(F.col("column") == column).agg(F.min("has_bloom").alias("in_every_row_group")).select(
            F.lit(column).alias("column_name"), "in_every_row_group", F.lit(absent).cast("long").alias("rows_read_for_absent_code"),
            F.lit(fact.where(F.col(column) == least).count()).cast("long").alias("rows_of_first_code")))
    return Q.union_all(parts)


#: with about 50 row groups a year, three columns have fewer than four ranges each
SKIPPED_AT_LEAST = 0.4


def snk_13(spark, sf_dir):
    """Share of row groups that a lookup by carrier, airport or month skips in the interleaved layout, against a bound."""
    store = store_for(spark)
    fact = materialise(layers(spark, sf_dir).fact, "fact")
    columns = ["month", "carrier_key", "airport_key"]
    sink.write_layout(fact, store, "fact_z", sort_cols=columns, chunk_size=100, interleave=True)
    read = store.read("fact_z")
    told = layout.footers(read, columns)
    values = Q.union_all([fact.select(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")).distinct() for c in columns])
    share = layout.skipped_share(told, values)
    rows = read.agg(F.count(F.lit(1)).alias("row_count"))
    return share.crossJoin(F.broadcast(rows)).select(
        F.col("column").alias("column_name"), (F.col("skipped") >= SKIPPED_AT_LEAST).alias("skipped_enough"), "row_count")


def snk_14(spark, sf_dir):
    """Order and overlap of the files of the serving layout, by year."""
    store = store_for(spark)
    sink.write_layout(layers(spark, sf_dir).fact, store, "fact_sorted", chunk_size=500)
    return layout.clustering(store.read("fact_sorted"), ["carrier_key", "airport_key", "date_key"]).select(
        "year", "row_count", "out_of_order", "overlap_depth")


def snk_19(spark, sf_dir):
    """Two deliveries as versions, read before, during and after their compaction: by year, rows and flights."""
    store = store_for(spark)
    first = materialise(bronze_batch(spark, sf_dir), "bronze")  # the adapter runs once
    key = ["airline_delay_id"]
    versions.append_versions(stage(first), store, "staging", key)
    versions.append_versions(stage(reload_batch(first)), store, "staging", key)
    by_year = lambda df, phase: df.groupBy("year").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("arr_flights").alias("flights")).withColumn("phase", F.lit(phase))
    before = materialise(by_year(store.read("staging"), "before"))
    reader = by_year(store.read("staging"), "during")  # planned before, run after the compaction's commit
    versions.compact(store, "staging")
    return Q.union_all([before, reader, by_year(store.read("staging"), "after")]).select("phase", "year", "row_count", "flights")


def snk_17(spark, sf_dir):
    st = layers(spark, sf_dir).staging
    return present(sample_rows(st, 5, "airline_delay_id", seed=42))


def stream_01(spark, sf_dir):
    from tarmac.streaming.staging_stream import stream_stage

    return present(stream_stage(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn
    for name, fn in dict(globals()).items()
    if callable(fn) and name[:4] in {
        "mod_", "win_", "flt_", "joi_", "agg_", "srt_", "set_", "snk_", "str_", "dat_", "cnd_", "mth_", "dq_0",
        "dq_1", "dq_2", "src_", "stre",
    } and name[-2:].isdigit()
}
