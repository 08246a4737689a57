"""Oracle SQL (DuckDB dialect) for the registered queries.

Written independently of the Spark code from the model definitions, over
the driver's pre-registered views. Column names and presented types match
the Spark output: decimals as DOUBLE, counts as BIGINT, ratios through the
same integer half-up rule.
"""

from __future__ import annotations

# The data contract, written out here so that nothing is shared with the engine.
DELAY_COLUMNS = ["arr_delay", "carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay"]
DECIMAL_COLUMNS = ["carrier_ct", "weather_ct", "nas_ct", "security_ct", "late_aircraft_ct", *DELAY_COLUMNS]
MEASURE_COLUMNS = ["arr_flights", "arr_del15", "carrier_ct", "weather_ct", "nas_ct", "security_ct", "late_aircraft_ct",
                   "arr_cancelled", "arr_diverted", *DELAY_COLUMNS]
CSV_COLUMNS = ["year", "month", "carrier", "carrier_name", "airport", "airport_name", *MEASURE_COLUMNS]
FACT_COLUMNS = ["airline_delay_id", "date_key", "carrier_key", "airport_key", "year", "month", "carrier", "carrier_name",
                "airport", "airport_name", "arr_flights", "arr_del15", "arr_cancelled", "arr_diverted", *DECIMAL_COLUMNS,
                "_ingested_at"]
UNIQUE = {"stg_airline_delay_data": ["airline_delay_id"], "dim_carrier": ["carrier_key"], "dim_airport": ["airport_key"],
          "dim_date": ["date_key"], "fact_flight_delays": ["airline_delay_id"],
          "carrier_delay_performance": ["carrier_key"], "monthly_delay_trends": ["date_key"]}
NOT_NULL = {"stg_airline_delay_data": ["airline_delay_id", "year", "month", "carrier", "airport"],
            "dim_carrier": ["carrier_key", "carrier", "carrier_name"],
            "dim_airport": ["airport_key", "airport", "airport_name"], "dim_date": ["date_key", "year", "month"],
            "fact_flight_delays": ["airline_delay_id", "date_key", "carrier_key", "airport_key"],
            "carrier_delay_performance": ["carrier_key"], "monthly_delay_trends": ["date_key"]}
RELATIONSHIPS = [("date_key", "dim_date"), ("carrier_key", "dim_carrier"), ("airport_key", "dim_airport")]
TEXT_LIMITS = {"carrier": 10, "carrier_name": 100, "airport": 10, "airport_name": 200}


def ratio(num: str, den: str, num_scale: int = 0, factor: int = 1, digits: int = 2) -> str:
    """num / den times factor, rounded half away from zero at ``digits``: exact decimal
    long division in DuckDB's 128-bit integers."""
    top = f"(CAST(({num}) * {10 ** num_scale} AS HUGEINT) * {factor * 10 ** digits})"
    bottom = f"(CAST(NULLIF({den}, 0) AS HUGEINT) * {10 ** num_scale})"
    return (f"CAST(sign({top}) * ((abs({top}) * 2 + {bottom}) // ({bottom} * 2)) AS DOUBLE) / {float(10 ** digits)}")

CAUSES = {"carrier": (1, 2), "weather": (3,), "nas": (4, 5), "security": (6,), "late_aircraft": (7,)}


def _cause_sums() -> str:
    parts = []
    for cause, lines in CAUSES.items():
        cond = f"l_returnflag = 'R' AND l_linenumber IN ({', '.join(map(str, lines))})"
        parts.append(f"sum(CASE WHEN {cond} THEN CAST(l_discount AS DECIMAL(10,2)) END) AS {cause}_ct")
        parts.append(f"sum(CASE WHEN {cond} THEN CAST(l_quantity AS DECIMAL(10,2)) END) AS {cause}_delay")
    return ",\n         ".join(parts)


def _bronze_select(prefix: str = "g.") -> str:
    text = {
        "carrier": "' ' || lower(sn.n_name) || ' '",
        "carrier_name": "sn.n_name || ' '",
        "airport": "cn.n_name",
        "airport_name": "' ' || cn.n_name",
    }
    cols = []
    for c in CSV_COLUMNS:
        if c in text:
            cols.append(f"{text[c]} AS {c}")
        elif c in ("year", "month"):
            cols.append(f"{prefix}{c}")
        else:
            cols.append(f"CAST({prefix}{c} AS DECIMAL(18,6)) AS {c}")
    cols.append(f"CAST({prefix}_ingested_at AS TIMESTAMP) AS _ingested_at")
    return ", ".join(cols)


def _reload_select() -> str:
    cols = []
    for c in CSV_COLUMNS:
        if c == "carrier":
            cols.append("upper(trim(carrier)) AS carrier")
        elif c == "arr_flights":
            cols.append("CAST(arr_flights + 1 AS DECIMAL(18,6)) AS arr_flights")
        else:
            cols.append(c)
    cols.append("_ingested_at + INTERVAL 4000 DAY AS _ingested_at")
    return ", ".join(cols)


BRONZE = f"""
__lines AS (
  SELECT CAST(year(l.l_shipdate) AS INTEGER) AS year, CAST(month(l.l_shipdate) AS INTEGER) AS month,
         s.s_nationkey AS supp_nation, c.c_nationkey AS cust_nation,
         l.l_linenumber, l.l_quantity, l.l_discount, l.l_returnflag, l.l_linestatus, l.l_shipdate
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
__grain AS (
  SELECT year, month, supp_nation, cust_nation,
         count(*) AS arr_flights,
         count(*) FILTER (WHERE l_returnflag = 'R') AS arr_del15,
         count(*) FILTER (WHERE l_returnflag = 'A' AND l_linestatus = 'F') AS arr_cancelled,
         count(*) FILTER (WHERE l_returnflag = 'A' AND l_linestatus = 'O') AS arr_diverted,
         sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(10,2)) END) AS arr_delay,
         {_cause_sums()},
         max(l_shipdate) AS _ingested_at
  FROM __lines
  GROUP BY year, month, supp_nation, cust_nation
),
batch1 AS (
  SELECT {_bronze_select()}
  FROM __grain g
  JOIN nation sn ON sn.n_nationkey = g.supp_nation
  JOIN nation cn ON cn.n_nationkey = g.cust_nation
),
reload AS (SELECT {_reload_select()} FROM batch1 WHERE year = 1998),
bronze AS (SELECT * FROM batch1 UNION ALL SELECT * FROM reload)"""


def _staging(src: str, name: str = "staging") -> str:
    order = ", ".join(f"{c} DESC NULLS FIRST" for c in
                      ["_ingested_at"] + MEASURE_COLUMNS + ["carrier_name", "airport_name", "carrier", "airport"])
    cols = [
        "md5(CAST(year AS VARCHAR) || '-' || CAST(month AS VARCHAR) || '-' || upper(trim(carrier)) || '-' "
        "|| upper(trim(airport))) AS airline_delay_id",
        "year", "month", "upper(trim(carrier)) AS carrier", "upper(trim(airport)) AS airport",
        "trim(carrier_name) AS carrier_name", "trim(airport_name) AS airport_name",
    ]
    cols += [f"CAST(round({c}) AS INTEGER) AS {c}" for c in ["arr_flights", "arr_del15", "arr_cancelled", "arr_diverted"]]
    cols += [f"CAST({c} AS DECIMAL(10,2)) AS {c}" for c in DECIMAL_COLUMNS]
    cols += ["_ingested_at"]
    return f"""
{name}__ranked AS (
  SELECT *, row_number() OVER (PARTITION BY year, month, upper(trim(carrier)), upper(trim(airport))
                               ORDER BY {order}) AS __rn
  FROM {src}
),
{name} AS (SELECT {', '.join(cols)} FROM {name}__ranked WHERE __rn = 1)"""


def _dims(staging: str = "staging", suffix: str = "") -> str:
    return f"""
dim_carrier{suffix} AS (SELECT md5(carrier) AS carrier_key, carrier, carrier_name
                FROM (SELECT DISTINCT carrier, carrier_name FROM {staging})),
dim_airport{suffix} AS (SELECT md5(airport) AS airport_key, airport, airport_name
                FROM (SELECT DISTINCT airport, airport_name FROM {staging})),
dim_date{suffix} AS (
  SELECT CAST(year * 100 + month AS INTEGER) AS date_key, year, month,
         CAST(CASE WHEN month BETWEEN 1 AND 3 THEN 1 WHEN month BETWEEN 4 AND 6 THEN 2
              WHEN month BETWEEN 7 AND 9 THEN 3 ELSE 4 END AS INTEGER) AS quarter,
         CASE WHEN month BETWEEN 1 AND 12 THEN strftime(make_date(2000, month, 1), '%B') END AS month_name,
         CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS year_month
  FROM (SELECT DISTINCT year, month FROM {staging}))"""


def _fact(staging: str = "staging", suffix: str = "", name: str = "fact") -> str:
    cols = []
    for c in FACT_COLUMNS:
        src = {"date_key": "d", "carrier_key": "dc", "airport_key": "da"}.get(c, "s")
        cols.append(f"{src}.{c}")
    return f"""
{name} AS (
  SELECT {', '.join(cols)}
  FROM {staging} s
  JOIN dim_carrier{suffix} dc ON s.carrier = dc.carrier
  JOIN dim_airport{suffix} da ON s.airport = da.airport
  JOIN dim_date{suffix} d ON s.year = d.year AND s.month = d.month)"""


CORE = ",".join([BRONZE, _staging("bronze"), _dims(), _fact()])


def W(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def present(cols: list[str], decimals: set[str] = set(DECIMAL_COLUMNS), prefix: str = "") -> str:
    return ", ".join(f"CAST({prefix}{c} AS DOUBLE) AS {c}" if c in decimals else f"{prefix}{c}" for c in cols)


STAGING_COLS = ["airline_delay_id", "year", "month", "carrier", "airport", "carrier_name", "airport_name",
                "arr_flights", "arr_del15", "arr_cancelled", "arr_diverted"] + DECIMAL_COLUMNS + ["_ingested_at"]
BRONZE_DECIMALS = set(MEASURE_COLUMNS)


def check_row(check: str, layer: str, severity: str, n: str, success: str, failure: str) -> str:
    """One CHECK_RESULT row; ``n`` is the violations expression."""
    return (f"SELECT '{check}' AS \"check\", '{layer}' AS layer, '{severity}' AS severity, "
            f"CAST({n} AS BIGINT) AS violations, ({n}) = 0 AS passed, "
            f"CASE WHEN ({n}) = 0 THEN {success} ELSE {failure} END AS description")


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _mart_carrier(fact: str = "fact") -> str:
    return f"""
cdp AS (
  SELECT carrier_key, carrier, carrier_name,
         CAST(sum(arr_flights) AS BIGINT) AS total_flights,
         CAST(sum(arr_del15) AS BIGINT) AS total_delayed,
         CAST(sum(arr_cancelled) AS BIGINT) AS total_cancelled,
         round(sum(arr_delay), 2) AS total_delay_minutes,
         round(sum(carrier_delay), 2) AS total_carrier_delay_minutes,
         round(sum(weather_delay), 2) AS total_weather_delay_minutes,
         round(sum(nas_delay), 2) AS total_nas_delay_minutes,
         round(sum(security_delay), 2) AS total_security_delay_minutes,
         round(sum(late_aircraft_delay), 2) AS total_late_aircraft_delay_minutes
  FROM {fact} GROUP BY carrier_key, carrier, carrier_name),
carrier_delay_performance AS (
  SELECT carrier_key, carrier, carrier_name, total_flights, total_delayed, total_cancelled,
         {ratio('total_delayed', 'total_flights', factor=100)} AS delay_rate_pct,
         CAST(total_delay_minutes AS DOUBLE) AS total_delay_minutes,
         CAST(total_carrier_delay_minutes AS DOUBLE) AS total_carrier_delay_minutes,
         CAST(total_weather_delay_minutes AS DOUBLE) AS total_weather_delay_minutes,
         CAST(total_nas_delay_minutes AS DOUBLE) AS total_nas_delay_minutes,
         CAST(total_security_delay_minutes AS DOUBLE) AS total_security_delay_minutes,
         CAST(total_late_aircraft_delay_minutes AS DOUBLE) AS total_late_aircraft_delay_minutes,
         {ratio('total_delay_minutes', 'total_delayed', num_scale=2)} AS avg_delay_minutes_per_delayed_flight
  FROM cdp)"""


def _mart_monthly(fact: str = "fact") -> str:
    return f"""
mdt AS (
  SELECT date_key, year, month,
         CAST(sum(arr_flights) AS BIGINT) AS total_flights,
         CAST(sum(arr_del15) AS BIGINT) AS total_delayed,
         CAST(sum(arr_cancelled) AS BIGINT) AS total_cancelled,
         CAST(sum(arr_diverted) AS BIGINT) AS total_diverted,
         round(sum(arr_delay), 2) AS total_delay_minutes,
         round(sum(carrier_delay), 2) AS total_carrier_delay_minutes,
         round(sum(weather_delay), 2) AS total_weather_delay_minutes,
         round(sum(nas_delay), 2) AS total_nas_delay_minutes,
         round(sum(late_aircraft_delay), 2) AS total_late_aircraft_delay_minutes
  FROM {fact} GROUP BY date_key, year, month),
monthly_delay_trends AS (
  SELECT date_key, year, month, total_flights, total_delayed, total_cancelled, total_diverted,
         {ratio('total_delayed', 'total_flights', factor=100)} AS delay_rate_pct,
         CAST(total_delay_minutes AS DOUBLE) AS total_delay_minutes,
         {ratio('total_delay_minutes', 'total_flights', num_scale=2)} AS avg_delay_minutes_per_flight,
         CAST(total_carrier_delay_minutes AS DOUBLE) AS total_carrier_delay_minutes,
         CAST(total_weather_delay_minutes AS DOUBLE) AS total_weather_delay_minutes,
         CAST(total_nas_delay_minutes AS DOUBLE) AS total_nas_delay_minutes,
         CAST(total_late_aircraft_delay_minutes AS DOUBLE) AS total_late_aircraft_delay_minutes
  FROM mdt)"""


CARRIER_STATE = """
carrier_state AS (
  SELECT year, carrier_key, carrier,
         CAST(sum(arr_flights) AS BIGINT) AS total_flights_state,
         CAST(sum(arr_del15) AS BIGINT) AS total_delayed_state,
         sum(arr_delay) AS total_delay_minutes_state,
         sum(carrier_delay) AS total_carrier_delay_state,
         sum(weather_delay) AS total_weather_delay_state,
         sum(nas_delay) AS total_nas_delay_state,
         sum(security_delay) AS total_security_delay_state,
         sum(late_aircraft_delay) AS total_late_aircraft_delay_state
  FROM fact GROUP BY year, carrier_key, carrier)"""

MONTHLY_STATE = """
monthly_state AS (
  SELECT year, date_key, month,
         CAST(sum(arr_flights) AS BIGINT) AS total_flights_state,
         CAST(sum(arr_del15) AS BIGINT) AS total_delayed_state,
         sum(arr_delay) AS total_delay_minutes_state
  FROM fact GROUP BY year, date_key, month)"""

STATE_DECIMALS = {"total_delay_minutes_state", "total_carrier_delay_state", "total_weather_delay_state",
                  "total_nas_delay_state", "total_security_delay_state", "total_late_aircraft_delay_state"}

TOP_CARRIERS = f"""
merged AS (SELECT carrier, CAST(sum(total_flights_state) AS BIGINT) AS total_flights,
                  CAST(sum(total_delayed_state) AS BIGINT) AS total_delayed
           FROM carrier_state GROUP BY carrier),
top_carriers AS (
  SELECT carrier, total_flights, total_delayed, {ratio('total_delayed', 'total_flights', factor=100)} AS delay_rate_pct
  FROM merged WHERE total_flights > 0
  ORDER BY delay_rate_pct DESC NULLS LAST, total_delayed DESC NULLS LAST, carrier
  LIMIT 10)"""

MONTHLY_TREND = f"""
mt AS (SELECT make_date(year, month, 1) AS month_start,
              CAST(sum(total_flights_state) AS BIGINT) AS total_flights,
              CAST(sum(total_delayed_state) AS BIGINT) AS total_delayed
       FROM monthly_state GROUP BY make_date(year, month, 1)),
monthly_trend AS (
  SELECT month_start, total_flights, total_delayed,
         {ratio('total_delayed', 'total_flights', factor=100)} AS delay_rate_pct
  FROM mt)"""


def _orphan_check(code: str, dim: str = None) -> str:
    key = f"{code}_key"
    dim = dim or f"dim_{code}"
    n = f"(SELECT count(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = f.{key}))"
    return check_row(f"no_orphaned_{code}_keys", "gold", "ERROR", n,
                     q(f"All {key} values resolve to dim_{code}."),
                     f"CAST({n} AS VARCHAR) || {q(f' fact rows have orphaned {key} values.')}")


def _empty_text_check(code: str) -> str:
    cols = [f"{code}_key", code, f"{code}_name"]
    cond = " OR ".join(f"{c} IS NULL OR {c} = ''" for c in cols)
    n = f"(SELECT count(*) FROM dim_{code} WHERE {cond})"
    return check_row(f"no_null_{code}_columns", "gold", "ERROR", n, q(f"All {code} columns are populated."),
                     f"CAST({n} AS VARCHAR) || {q(f' rows have empty {cols[0]}, {cols[1]}, or {cols[2]}.')}")


MODELS = {
    "stg_airline_delay_data": "staging",
    "dim_carrier": "dim_carrier",
    "dim_airport": "dim_airport",
    "dim_date": "dim_date",
    "fact_flight_delays": "fact",
    "carrier_delay_performance": "carrier_delay_performance",
    "monthly_delay_trends": "monthly_delay_trends",
}


def _declarative(kind: str) -> str:
    rows = []
    if kind == "unique":
        for model, cols in UNIQUE.items():
            for c in cols:
                n = (f"(SELECT count(*) FROM (SELECT {c} FROM {MODELS[model]} WHERE {c} IS NOT NULL "
                     f"GROUP BY {c} HAVING count(*) > 1))")
                rows.append(check_row(f"unique_{model}_{c}", model, "ERROR", n, "'Passed.'",
                                      f"CAST({n} AS VARCHAR) || ' failing row(s).'"))
    elif kind == "not_null":
        for model, cols in NOT_NULL.items():
            for c in cols:
                n = f"(SELECT count(*) FROM {MODELS[model]} WHERE {c} IS NULL)"
                rows.append(check_row(f"not_null_{model}_{c}", model, "ERROR", n, "'Passed.'",
                                      f"CAST({n} AS VARCHAR) || ' failing row(s).'"))
    else:
        child = "fact_flight_delays"
        for key, parent in RELATIONSHIPS:
            n = (f"(SELECT count(*) FROM {MODELS[child]} c WHERE c.{key} IS NOT NULL AND NOT EXISTS "
                 f"(SELECT 1 FROM {MODELS[parent]} p WHERE p.{key} = c.{key}))")
            rows.append(check_row(f"relationships_{child}_{key}", child, "ERROR", n, "'Passed.'",
                                  f"CAST({n} AS VARCHAR) || ' failing row(s).'"))
    return "\nUNION ALL\n".join(rows)


# every row of January twice, months beyond 12, missing carriers, negative delays
DIRTY = """
dirty AS (
  SELECT * REPLACE (CASE WHEN arr_flights % 7 = 0 THEN month + 12 ELSE month END AS month,
                    CASE WHEN arr_flights % 5 <> 0 THEN carrier END AS carrier,
                    CASE WHEN arr_flights % 3 = 0 THEN -weather_delay ELSE weather_delay END AS weather_delay)
  FROM (SELECT * FROM staging UNION ALL SELECT * FROM staging WHERE month = 1))"""

MARTS = ",".join([_mart_carrier(), _mart_monthly()])
NOW = "TIMESTAMP '2024-01-31 12:00:00'"
RUN_STAMP = "TIMESTAMP '2024-01-31 03:00:00'"


def _freshness(src: str, layer: str) -> str:
    latest = f"(SELECT max(_ingested_at) FROM {src})"
    micros = f"(epoch_us({NOW}) - epoch_us({latest}))"
    stale = f"(CASE WHEN {latest} IS NULL OR {micros} > 90000000000 THEN 1 ELSE 0 END)"
    tenths = f"(({micros} * 10 + 1800000000) // 3600000000)"
    msg = (f"CASE WHEN {latest} IS NULL THEN {q('No ingestion timestamps found — table may be empty.')} "
           f"ELSE 'Latest ingestion is ' || CAST({tenths} // 10 AS VARCHAR) || '.' || CAST({tenths} % 10 AS VARCHAR) "
           f"|| ' hour(s) old, exceeding the 25-hour freshness threshold.' END")
    return check_row("data_freshness", layer, "WARN", stale, "'Bronze data is fresh.'", msg)


def _range_msgs(col: str, lo, hi, src: str) -> tuple[str, str]:
    parts_n, parts_msg = [], []
    if lo is not None:
        n = f"(SELECT count(*) FROM {src} WHERE {col} < {lo})"
        parts_n.append(n)
        parts_msg.append(f"CASE WHEN {n} > 0 THEN 'Column ''{col}'' has ' || CAST({n} AS VARCHAR) || "
                         f"' value(s) below minimum {lo}.' END")
    if hi is not None:
        n = f"(SELECT count(*) FROM {src} WHERE {col} > {hi})"
        parts_n.append(n)
        parts_msg.append(f"CASE WHEN {n} > 0 THEN 'Column ''{col}'' has ' || CAST({n} AS VARCHAR) || "
                         f"' value(s) above maximum {hi}.' END")
    return " + ".join(parts_n), ", ".join(parts_msg)


def _range_check(check, layer, severity, col, lo, hi, src, success) -> str:
    n, msgs = _range_msgs(col, lo, hi, src)
    return check_row(check, layer, severity, f"({n})", q(success), f"concat_ws('; ', {msgs})")


def _silver_unique() -> str:
    n = "(SELECT COALESCE(sum(c - 1), 0) FROM (SELECT count(*) AS c FROM staging GROUP BY airline_delay_id))"
    return check_row("unique_surrogate_key", "silver", "ERROR", n, "'Surrogate key is unique.'",
                     f"'Found ' || CAST({n} AS VARCHAR) || ' duplicate row(s) on key column(s): [airline_delay_id].'")


def _non_negative() -> str:
    ns, msgs = [], []
    for c in DELAY_COLUMNS:
        n, m = _range_msgs(c, 0, None, "staging")
        ns.append(n)
        msgs.append(m)
    return check_row("non_negative_delays", "silver", "WARN", "(" + " + ".join(ns) + ")",
                     "'All delay columns are non-negative.'", f"concat_ws('; ', {', '.join(msgs)})")


def _min_rows(check, layer, src, success_tmpl, failure_sql=None) -> str:
    n = f"(SELECT count(*) FROM {src})"
    short = f"greatest(1 - {n}, 0)"
    head, tail = success_tmpl.split("{n}")
    success = f"{q(head)} || CAST({n} AS VARCHAR) || {q(tail)}"
    failure = failure_sql or f"'Expected at least 1 row(s), but found ' || CAST({n} AS VARCHAR) || '.'"
    return check_row(check, layer, "ERROR", short, success, failure)


def _null_check(col: str, src: str) -> str:
    n = f"(SELECT count(*) FROM {src} WHERE {col} IS NULL)"
    return check_row(f"no_nulls_{col}", "bronze", "ERROR", n, q(f"Column '{col}' has no nulls."),
                     f"'Column ''{col}'' contains ' || CAST({n} AS VARCHAR) || ' null value(s).'")


def _consistency(check: str, comps: list[str], total: str) -> str:
    s = " + ".join(f"COALESCE({c}, 0)" for c in comps)
    n = f"(SELECT count(*) FROM staging WHERE abs(({s}) - COALESCE({total}, 0)) > 1.0)"
    msg = (f"CAST({n} AS VARCHAR) || ' row(s) where [{' + '.join(comps)}] differs from ''{total}'' "
           f"by more than 1.0.'")
    return check_row(check, "silver", "WARN", n, "'Components reconcile with the total.'", msg)


def _null_keys_check(layer: str, src: str, cols: list[str]) -> str:
    ns = [f"(SELECT count(*) FROM {src} WHERE {c} IS NULL)" for c in cols]
    msgs = ", ".join(f"CASE WHEN {n} > 0 THEN 'Column ''{c}'' contains ' || CAST({n} AS VARCHAR) || "
                     f"' null value(s).' END" for c, n in zip(cols, ns))
    return check_row("no_null_key_columns", layer, "ERROR", "(" + " + ".join(ns) + ")",
                     "'All key columns are non-null.'", f"concat_ws('; ', {msgs})")


def _run_core() -> str:
    """The daily run: first load stamped once, staged, dims, fact; gold = year 1998."""
    stamped_cols = ", ".join(CSV_COLUMNS) + f", {RUN_STAMP} AS _ingested_at"
    return ",".join([BRONZE, f"\nrun_bronze AS (SELECT {stamped_cols} FROM batch1)", _staging("run_bronze"),
                     _dims(), _fact()])


def _gold_dims_union() -> str:
    return """
SELECT 'carrier' AS dim, carrier_key AS key, carrier AS code, carrier_name AS name FROM dim_carrier
UNION ALL SELECT 'airport', airport_key, airport, airport_name FROM dim_airport
UNION ALL SELECT 'date', CAST(date_key AS VARCHAR), year_month, month_name FROM dim_date"""


def _all_checks_run() -> str:
    """Checks of the daily run (bronze, silver, gold, declarative)."""
    bronze = "run_bronze"
    rows = [
        _null_keys_check("bronze", bronze, ["year", "month", "carrier", "airport"]),
        _min_rows("minimum_row_count", "bronze", bronze, "Row count is {n}."),
        _freshness(bronze, "bronze"),
        _silver_unique(),
        _null_keys_check("silver", "staging", ["year", "month", "carrier", "airport", "airline_delay_id"]),
        _range_check("month_range", "silver", "ERROR", "month", 1, 12, "staging", "All month values are in range [1, 12]."),
        _non_negative(),
        _min_rows("fact_row_count", "gold", "gold_fact", "fact_flight_delays has {n} rows.",
                  "'fact_flight_delays is empty.'"),
        _empty_text_check("carrier"),
        _empty_text_check("airport"),
        _orphan_check("carrier").replace("FROM fact f", "FROM gold_fact f"),
        _orphan_check("airport").replace("FROM fact f", "FROM gold_fact f"),
        _orphan_check("date").replace("FROM fact f", "FROM gold_fact f"),
        _declarative("unique"),
        _declarative("not_null"),
        _declarative("relationships"),
    ]
    return "\nUNION ALL\n".join(rows)


def oracle_sql() -> dict[str, str]:
    fact_cols = present(FACT_COLUMNS)
    staging_cols = present(STAGING_COLS)
    bronze_cols = present(CSV_COLUMNS + ["_ingested_at"], BRONZE_DECIMALS)
    core = W(CORE)
    core_marts = W(CORE, MARTS)
    sql: dict[str, str] = {
        "mod_01": core + f"SELECT {staging_cols} FROM staging",
        "mod_02": core + "SELECT * FROM dim_carrier",
        "mod_03": core + "SELECT * FROM dim_airport",
        "mod_04": core + "SELECT * FROM dim_date",
        "mod_05": core + f"SELECT {fact_cols} FROM fact",
        "mod_06": core_marts + "SELECT * FROM carrier_delay_performance",
        "mod_07": core_marts + "SELECT * FROM monthly_delay_trends",
        "mod_08": W(CORE, CARRIER_STATE) + "SELECT " + present(
            ["year", "carrier_key", "carrier", "total_flights_state", "total_delayed_state",
             "total_delay_minutes_state", "total_carrier_delay_state", "total_weather_delay_state",
             "total_nas_delay_state", "total_security_delay_state", "total_late_aircraft_delay_state"],
            STATE_DECIMALS) + " FROM carrier_state",
        "mod_09": W(CORE, MONTHLY_STATE) + "SELECT " + present(
            ["year", "date_key", "month", "total_flights_state", "total_delayed_state", "total_delay_minutes_state"],
            STATE_DECIMALS) + " FROM monthly_state",
        "mod_10": W(CORE, CARRIER_STATE, TOP_CARRIERS) + "SELECT * FROM top_carriers",
        "mod_11": W(CORE, MONTHLY_STATE, MONTHLY_TREND) + "SELECT * FROM monthly_trend ORDER BY month_start",
        "win_01": """
SELECT * EXCLUDE (__rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY """
        + ", ".join(f"{c} DESC NULLS FIRST" for c in
                    ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax",
                     "l_returnflag", "l_linestatus"])
        + """) AS __rn
  FROM lineitem) WHERE __rn = 1""",
        "flt_02": W(BRONZE, _staging("batch1", "first_staging"))
        + f"SELECT {bronze_cols} FROM bronze WHERE _ingested_at > (SELECT max(_ingested_at) FROM first_staging)",
        "flt_04": W(BRONZE) + "SELECT count(*) FILTER (WHERE year IS NULL OR month IS NULL OR carrier IS NULL OR "
        "airport IS NULL) AS null_key_rows, count(*) FILTER (WHERE "
        + " OR ".join(f"{c} IS NULL" for c in DELAY_COLUMNS[1:]) + ") AS null_cause_rows FROM bronze",
        "flt_05": core + "\nUNION ALL\n".join(_empty_text_check(c).replace(
            f"FROM dim_{c} ", f"FROM (SELECT * REPLACE (CASE WHEN {c}_key >= '8' THEN {c}_name ELSE '' END AS {c}_name) FROM dim_{c}) ")
            for c in ("carrier", "airport")),
        "flt_07": W(CORE, CARRIER_STATE) + "SELECT carrier, CAST(sum(total_flights_state) AS BIGINT) AS total_flights, "
        "CAST(sum(total_delayed_state) AS BIGINT) AS total_delayed FROM carrier_state GROUP BY carrier "
        "HAVING sum(total_flights_state) > 0",
        "joi_01": core + "SELECT s.airline_delay_id, s.carrier, d.carrier_key FROM staging s "
        "JOIN dim_carrier d ON s.carrier = d.carrier",
        "joi_02": core + "SELECT s.airline_delay_id, s.airport, d.airport_key FROM staging s "
        "JOIN dim_airport d ON s.airport = d.airport",
        "joi_03": core + "SELECT s.airline_delay_id, s.year, s.month, d.date_key FROM staging s "
        "JOIN dim_date d ON s.year = d.year AND s.month = d.month",
        "joi_04": core + _orphan_check("carrier", "(SELECT * FROM dim_carrier WHERE carrier_key < '8')"),
        "joi_05": core + _orphan_check("airport", "(SELECT * FROM dim_airport WHERE airport_key < '8')"),
        "joi_06": W(CORE, "\npublished AS (SELECT * FROM staging WHERE _ingested_at < TIMESTAMP '2000-01-01 00:00:00')",
                    _dims("published", "_pub")) + _orphan_check("date", "dim_date_pub"),
        "joi_07": W(CORE, MARTS) + _declarative("relationships").replace(
            "FROM dim_date p WHERE", "FROM dim_date p WHERE p.month <> 3 AND").replace(
            "FROM dim_carrier p WHERE", "FROM dim_carrier p WHERE p.carrier_key < '8' AND").replace(
            "FROM dim_airport p WHERE", "FROM dim_airport p WHERE p.airport_key < '8' AND"),
        "joi_08": W(BRONZE, "\nrenamed AS (SELECT * REPLACE (lower(carrier_name) AS carrier_name) FROM reload)",
                    "\nbronze_r AS (SELECT * FROM batch1 UNION ALL SELECT * FROM renamed)",
                    _staging("bronze_r"), _dims(), _fact())
        + """SELECT s.carrier, s.staging_rows, d.dim_rows, f.fact_rows
FROM (SELECT carrier, count(*) AS staging_rows FROM staging GROUP BY carrier) s
JOIN (SELECT carrier, count(*) AS dim_rows FROM dim_carrier GROUP BY carrier) d ON s.carrier = d.carrier
JOIN (SELECT carrier, count(*) AS fact_rows FROM fact GROUP BY carrier) f ON s.carrier = f.carrier""",
    }

    by_airport = W(CORE, """
ap AS (SELECT airport, CAST(sum(arr_flights) AS BIGINT) AS total_flights, CAST(sum(arr_del15) AS BIGINT) AS total_delayed,
              sum(arr_delay) AS total_delay_minutes FROM fact GROUP BY airport)""")
    sql["agg_05"] = by_airport + f"SELECT airport, {ratio('total_delayed', 'total_flights', factor=100)} AS delay_rate_pct FROM ap"
    sql["agg_06"] = by_airport + (f"SELECT airport, {ratio('total_delay_minutes', 'total_delayed', num_scale=2)} "
                                  "AS avg_delay_minutes_per_delayed_flight FROM ap")
    sql["agg_07"] = by_airport + (f"SELECT airport, {ratio('total_delay_minutes', 'total_flights', num_scale=2)} "
                                  "AS avg_delay_minutes_per_flight FROM ap")
    sql["agg_08"] = core + "SELECT DISTINCT carrier, carrier_name FROM staging"
    sql["agg_10"] = core + "SELECT DISTINCT year, month FROM staging"
    sql["agg_11"] = core + ("SELECT 'bronze' AS table_name, count(*) AS row_count FROM bronze UNION ALL "
                            "SELECT 'staging', count(*) FROM staging UNION ALL SELECT 'fact', count(*) FROM fact")
    sql["agg_12"] = W(BRONZE) + "SELECT max(_ingested_at) AS latest_ingested_at FROM bronze"
    sql["agg_15"] = W(CORE, CARRIER_STATE) + ("SELECT carrier, CAST(sum(total_flights_state) AS BIGINT) AS total_flights, "
                                              "CAST(sum(total_delayed_state) AS BIGINT) AS total_delayed, "
                                              "CAST(sum(total_delay_minutes_state) AS DOUBLE) AS total_delay_minutes "
                                              "FROM carrier_state GROUP BY carrier")
    sql["agg_16"] = W(CORE, MONTHLY_STATE) + ("SELECT make_date(year, month, 1) AS month_start, "
                                              "CAST(sum(total_flights_state) AS BIGINT) AS total_flights, "
                                              "CAST(sum(total_delayed_state) AS BIGINT) AS total_delayed, "
                                              "CAST(sum(total_delay_minutes_state) AS DOUBLE) AS total_delay_minutes "
                                              "FROM monthly_state GROUP BY make_date(year, month, 1)")
    sql["agg_18"] = ("SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys, "
                     "CAST(sum(n - 1) AS BIGINT) AS excess_rows FROM (SELECT count(*) AS n FROM lineitem "
                     "GROUP BY l_orderkey, l_linenumber)")
    sql["agg_20"] = core + "SELECT year, month, count(*) AS row_count FROM fact GROUP BY year, month ORDER BY year, month"
    sql["srt_01"] = core_marts + ("SELECT year, month, total_flights, CAST(row_number() OVER (ORDER BY year, month) AS INTEGER) AS place "
                                  "FROM monthly_delay_trends")
    sql["srt_03"] = W(CORE, MONTHLY_STATE, MONTHLY_TREND) + (
        "SELECT month_start, total_flights, CAST(row_number() OVER (ORDER BY month_start) AS INTEGER) AS place FROM monthly_trend")
    sql["srt_02"] = core_marts + ("SELECT carrier, total_flights, total_delayed, delay_rate_pct FROM "
                                  "carrier_delay_performance ORDER BY delay_rate_pct DESC NULLS LAST, "
                                  "total_delayed DESC NULLS LAST, carrier LIMIT 10")
    sql["srt_04"] = W(CORE, CARRIER_STATE, MONTHLY_STATE, TOP_CARRIERS, MONTHLY_TREND) + """
SELECT * FROM (SELECT 'worst_carrier' AS metric, carrier AS label, delay_rate_pct FROM top_carriers
               ORDER BY delay_rate_pct DESC, total_delayed DESC, carrier LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'latest_month', CAST(month_start AS VARCHAR), delay_rate_pct FROM monthly_trend
               ORDER BY month_start DESC LIMIT 1)"""
    sql["set_01"] = W(BRONZE) + f"SELECT {bronze_cols} FROM bronze"
    sql["snk_05"] = core + "SELECT * FROM dim_carrier"
    sql["snk_17"] = core + (f"SELECT {staging_cols} FROM staging "
                            "ORDER BY md5(airline_delay_id || '42'), airline_delay_id LIMIT 5")
    # chunked, sorted and bloom-indexed writes must read back the fact unchanged
    for key in ("snk_06", "snk_11", "snk_12"):
        sql[key] = core + f"SELECT {fact_cols} FROM fact"
    sql["snk_19"] = core + "\nUNION ALL\n".join(
        f"SELECT '{phase}' AS phase, year, count(*) AS row_count, CAST(sum(arr_flights) AS BIGINT) AS flights FROM staging GROUP BY year"
        for phase in ("before", "during", "after"))
    sql["snk_18"] = core + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, true AS in_every_row_group, CAST(0 AS BIGINT) AS rows_read_for_absent_code, "
        f"count(*) AS rows_of_first_code FROM fact WHERE {c} = (SELECT min({c}) FROM fact)" for c in ("carrier", "airport"))
    sql["snk_13"] = core + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, true AS skipped_enough, count(*) AS row_count FROM fact"
        for c in ("month", "carrier_key", "airport_key"))
    sql["snk_14"] = core + ("SELECT year, count(*) AS row_count, CAST(0 AS BIGINT) AS out_of_order, CAST(1 AS BIGINT) AS overlap_depth "
                            "FROM fact GROUP BY year")
    sql["snk_07"] = core + f"SELECT {fact_cols} FROM fact WHERE year = 1998"
    undated = present(STAGING_COLS).replace("airline_delay_id", "CAST(NULL AS VARCHAR) AS airline_delay_id", 1).replace(
        "year", "CAST(NULL AS INTEGER) AS year", 1)
    sql["snk_09"] = W(CORE, _staging("batch1", "first_staging"), "\nsecond_staging AS (SELECT * FROM staging WHERE _ingested_at > "
                      "(SELECT max(_ingested_at) FROM first_staging))") + (
        f"SELECT {staging_cols} FROM staging UNION ALL SELECT {undated} FROM first_staging WHERE month = 2 "
        f"UNION ALL SELECT {undated} FROM second_staging WHERE month = 2")
    sql["snk_15"] = core + ("SELECT carrier_key, carrier, lower(carrier_name) AS carrier_name, "
                            "TIMESTAMP '2024-02-01 00:00:00' AS _updated_at FROM dim_carrier")
    sql["str_04"] = core + "SELECT airline_delay_id, md5(carrier) AS carrier_key, md5(airport) AS airport_key FROM staging"
    sql["dat_01"] = core + ("SELECT month, CASE WHEN month BETWEEN 1 AND 12 THEN strftime(make_date(2000, month, 1), '%B') "
                            "END AS month_name FROM (SELECT DISTINCT month FROM staging)")
    sql["dat_02"] = core + ("SELECT month, CAST(CASE WHEN month BETWEEN 1 AND 3 THEN 1 WHEN month BETWEEN 4 AND 6 THEN 2 "
                            "WHEN month BETWEEN 7 AND 9 THEN 3 ELSE 4 END AS INTEGER) AS quarter "
                            "FROM (SELECT DISTINCT month FROM staging)")
    sql["dat_05"] = core + "SELECT year, month, make_date(year, month, 1) AS month_start FROM dim_date"
    sql["dat_07"] = ("SELECT strftime(date_trunc('month', ts), '%Y-%m-%d') AS month_key, count(*) AS events "
                     "FROM events GROUP BY 1")
    sql["dat_08"] = core + ("SELECT strftime(m, '%Y-%m-%d') AS month_key FROM (SELECT unnest(generate_series("
                            "min(make_date(year, month, 1)), max(make_date(year, month, 1)), INTERVAL 1 MONTH)) AS m "
                            "FROM staging)")
    sql["cnd_01"] = core + ("SELECT CAST(CASE WHEN month BETWEEN 1 AND 3 THEN 1 WHEN month BETWEEN 4 AND 6 THEN 2 "
                            "WHEN month BETWEEN 7 AND 9 THEN 3 ELSE 4 END AS INTEGER) AS quarter, count(*) AS row_count "
                            "FROM staging GROUP BY 1")
    sql["cnd_02"] = core + ("SELECT airline_delay_id, "
                            + ", ".join(f"CAST(COALESCE({c}, 0) AS DOUBLE) AS {c}" for c in DELAY_COLUMNS)
                            + " FROM staging")
    sql["cnd_03"] = W(CORE, CARRIER_STATE) + (
        "SELECT carrier, CAST(sum(total_flights_state) AS BIGINT) AS total_flights, "
        "CAST(sum(total_delayed_state) AS BIGINT) AS total_delayed, "
        f"{ratio('total_delayed', 'total_flights', factor=100)} AS delay_rate_pct "
        "FROM carrier_state GROUP BY carrier HAVING total_flights > 0")
    sql["mth_01"] = core + ("SELECT airline_delay_id, CAST(round(carrier_ct, 1) AS DOUBLE) AS carrier_ct_1, "
                            "CAST(round(weather_ct, 0) AS DOUBLE) AS weather_ct_0, "
                            "CAST(round(arr_delay, -1) AS DOUBLE) AS arr_delay_tens FROM staging")
    sql["mth_03"] = core + (f"SELECT airline_delay_id, {ratio('security_delay', 'arr_del15', num_scale=2)} "
                            "AS security_minutes_per_delayed FROM staging")
    sql["dq_01"] = W(BRONZE) + "\nUNION ALL\n".join(
        _null_check(c, "bronze") for c in ["year", "month", "carrier", "airport"] + MEASURE_COLUMNS)
    sql["dq_02"] = core + "\nUNION ALL\n".join([
        _min_rows("minimum_row_count", "bronze", "bronze", "Row count is {n}."),
        _min_rows("fact_row_count", "gold", "fact", "fact_flight_delays has {n} rows.", "'fact_flight_delays is empty.'"),
        _min_rows("future_rows", "silver", "(SELECT * FROM staging WHERE year > 2100)", "Row count is {n}."),
    ])
    n_dup = ("(SELECT COALESCE(sum(c - 1), 0) FROM (SELECT count(*) AS c FROM lineitem "
             "GROUP BY l_orderkey, l_linenumber))")
    sql["dq_03"] = check_row("unique_line_key", "source", "ERROR", n_dup, "'Line key is unique.'",
                             f"'Found ' || CAST({n_dup} AS VARCHAR) || "
                             "' duplicate row(s) on key column(s): [l_orderkey, l_linenumber].'")
    sql["dq_04"] = W(CORE, DIRTY) + "\nUNION ALL\n".join([
        _range_check("month_range", "silver", "ERROR", "month", 1, 12, "dirty", "All month values are in range [1, 12]."),
        _range_check("flights_range", "silver", "ERROR", "arr_flights", 1, 500, "dirty", "Flights in range."),
        _range_check("carrier_ct_range", "silver", "WARN", "carrier_ct", 0, 1, "dirty", "carrier_ct in range."),
    ])
    sql["dq_05"] = core + "\nUNION ALL\n".join([
        _consistency("delay_minutes_consistency", DELAY_COLUMNS[1:], "arr_delay"),
        _consistency("delay_cause_consistency", ["carrier_ct", "weather_ct", "nas_ct", "security_ct", "late_aircraft_ct"],
                     "arr_del15"),
    ])
    sql["dq_06"] = W(BRONZE, "\nev AS (SELECT CAST(ts AS TIMESTAMP) AS _ingested_at FROM events)") + \
        _freshness("bronze", "bronze") + "\nUNION ALL\n" + _freshness("ev", "events")
    dirty = W(CORE, DIRTY)
    of_dirty = lambda text: text.replace("FROM staging", "FROM dirty")
    sql["dq_10"] = dirty + of_dirty(_silver_unique())
    sql["dq_13"] = dirty + of_dirty(_non_negative())
    sql["dq_20"] = W(CORE, DIRTY, MARTS) + of_dirty(_declarative("unique"))
    sql["dq_21"] = W(CORE, DIRTY, MARTS) + of_dirty(_declarative("not_null"))
    too_long = {c: f"(SELECT count(*) FROM bronze WHERE length({c}) > {n})" for c, n in TEXT_LIMITS.items()}
    sql["dq_23"] = W(BRONZE) + check_row(
        "text_lengths", "bronze", "ERROR", "(" + " + ".join(too_long.values()) + ")", "'All text columns fit their declared lengths.'",
        "concat_ws('; ', " + ", ".join(f"CASE WHEN {n} > 0 THEN 'Column ''{c}'' has ' || CAST({n} AS VARCHAR) || "
                                       f"' value(s) longer than {TEXT_LIMITS[c]} characters.' END" for c, n in too_long.items()) + ")")
    sql["dq_24"] = core + """
SELECT 'arr_flights' AS column_name, 'int' AS expected, 'string' AS found, (SELECT count(*) FROM staging WHERE arr_flights % 7 = 0) AS rows_lost
UNION ALL SELECT 'weather_delay', 'decimal(10,2)', NULL, 0
UNION ALL SELECT 'note', NULL, 'string', 0"""
    sql["dq_22"] = core_marts + _declarative("relationships")

    run = _run_core()
    gold_fact = "\ngold_fact AS (SELECT * FROM fact WHERE year = 1998)"
    sql["mod_12"] = W(run) + _gold_dims_union()
    sql["mod_13"] = W(run, gold_fact) + f"SELECT {fact_cols} FROM gold_fact"
    sql["mod_14"] = W(run, gold_fact, MARTS) + _all_checks_run()
    sql["mod_15"] = W(run) + f"SELECT {fact_cols} FROM fact WHERE year IN (1996, 1997, 1998)"
    # the daily run publishes 1998 of the first load; the second delivery of that year has one more flight per record
    phases = [("published", "first_1998"), ("interrupted", "first_1998"), ("rerun", "second_1998")]
    trio = ["gold_fact_flight_delays", "gold_carrier_state", "gold_monthly_state"]
    sql["mod_16"] = W(BRONZE, "\nfirst_1998 AS (SELECT arr_flights FROM batch1 WHERE year = 1998)",
                      "\nsecond_1998 AS (SELECT arr_flights FROM reload)") + "\nUNION ALL\n".join(
        f"SELECT '{phase}' AS phase, '{table}' AS table_name, CAST(1998 AS INTEGER) AS year, CAST(sum(arr_flights) AS BIGINT) AS flights FROM {src}"
        for phase, src in phases for table in trio)
    sql["mod_17"] = core_marts + "SELECT * FROM carrier_delay_performance"
    sql["mod_18"] = core_marts + "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, year, count(*) AS row_count, year = 1998 AS rewritten FROM {src} GROUP BY year"
        for name, src in (("fact_flight_delays", "fact"), ("monthly_delay_trends", "monthly_delay_trends")))
    sql["mod_19"] = core_marts + "SELECT * FROM monthly_delay_trends"
    sql["src_01"] = W(BRONZE) + "SELECT " + present(CSV_COLUMNS, BRONZE_DECIMALS) + " FROM batch1"
    sql["stream_01"] = core + f"SELECT {staging_cols} FROM staging"
    return sql
