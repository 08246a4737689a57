"""Wired check suites per layer (DQ-07..22).

Every suite returns a CHECK_RESULT DataFrame. Within a table all
null/range/count/freshness rules share one aggregation pass, and so do the
foreign keys to parents of a counted, bounded size. Uniqueness shuffles an
8-byte hash per row; keys are counted only where a hash occurs twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.operators import quality as Q
from tarmac.session import in_parallel
from tarmac.schemas import DELAY_COLUMNS, KEY_COLUMNS

SILVER_KEYS = KEY_COLUMNS + ["airline_delay_id"]
FRESHNESS_HOURS = 25

# Check names, severities and the messages they report, kept
# word for word. name: (severity, message when passed, message when failed);
# a failed message of None means the validator's own message is used.
CHECKS = {
    "no_null_key_columns": ("ERROR", "All key columns are non-null.", None),
    "minimum_row_count": ("ERROR", "Row count is {n}.", None),
    "data_freshness": ("WARN", "Bronze data is fresh.", None),
    "unique_surrogate_key": ("ERROR", "Surrogate key is unique.", None),
    "month_range": ("ERROR", "All month values are in range [1, 12].", None),
    "non_negative_delays": ("WARN", "All delay columns are non-negative.", None),
    "fact_row_count": ("ERROR", "fact_flight_delays has {n} rows.", "fact_flight_delays is empty."),
    "no_null_carrier_columns": ("ERROR", "All carrier columns are populated.",
                                "{n} rows have empty carrier_key, carrier, or carrier_name."),
    "no_null_airport_columns": ("ERROR", "All airport columns are populated.",
                                "{n} rows have empty airport_key, airport, or airport_name."),
    "no_orphaned_carrier_keys": ("ERROR", "All carrier_key values resolve to dim_carrier.",
                                 "{n} fact rows have orphaned carrier_key values."),
    "no_orphaned_airport_keys": ("ERROR", "All airport_key values resolve to dim_airport.",
                                 "{n} fact rows have orphaned airport_key values."),
    "no_orphaned_date_keys": ("ERROR", "All date_key values resolve to dim_date.",
                              "{n} fact rows have orphaned date_key values."),
}


def _sev(name: str) -> str:
    return CHECKS[name][0]


def _ok(name: str) -> str:
    return CHECKS[name][1]


def _count_check(name: str, layer: str, condition: Column | None = None) -> Q.Rule:
    """Violations = rows matching ``condition``, or the sum of ``__n`` (rows per key); fixed messages."""
    m, n = Q.metric(F.count_if(condition) if condition is not None else F.coalesce(F.sum("__n"), F.lit(0)))
    return Q.Rule(name, layer, _sev(name), [m], n, Q.message(CHECKS[name][2], n=n), F.lit(_ok(name)))


def bronze_checks(bronze: DataFrame, now: Column) -> DataFrame:
    return Q.evaluate(
        bronze,
        [
            Q.no_nulls(KEY_COLUMNS, "no_null_key_columns", "bronze", _sev("no_null_key_columns"),
                       _ok("no_null_key_columns")),
            Q.min_row_count(1, "minimum_row_count", "bronze", _sev("minimum_row_count"), _ok("minimum_row_count")),
            Q.freshness("_ingested_at", now, FRESHNESS_HOURS, "data_freshness", "bronze", _sev("data_freshness"),
                        _ok("data_freshness")),
        ],
    )


def silver_rules() -> list[Q.Rule]:
    """The row rules of the silver suite (uniqueness aside)."""
    return [
        Q.no_nulls(SILVER_KEYS, "no_null_key_columns", "silver", _sev("no_null_key_columns"), _ok("no_null_key_columns")),
        Q.value_range("month", 1, 12, "month_range", "silver", _sev("month_range"), _ok("month_range")),
        Q.combine([Q.value_range(c, 0, None, "non_negative_delays", "silver") for c in DELAY_COLUMNS],
                  "non_negative_delays", "silver", _sev("non_negative_delays"), _ok("non_negative_delays")),
    ]


def _fact_rows() -> Q.Rule:
    return Q.min_row_count(1, "fact_row_count", "gold", _sev("fact_row_count"), _ok("fact_row_count"), CHECKS["fact_row_count"][2])


def silver_checks(staging: DataFrame, only: set[str] | None = None) -> DataFrame:
    """Silver suite; ``only`` limits it to the named checks (nothing else runs)."""
    want = lambda name: only is None or name in only
    rules = [r for r in silver_rules() if want(r.check)]
    frames = [Q.evaluate(staging, rules)] if rules else []
    if want("unique_surrogate_key"):
        frames.insert(0, Q.evaluate(
            Q.repeated_keys(staging, ["airline_delay_id"]),
            [Q.duplicates_rule(["airline_delay_id"], "unique_surrogate_key", "silver", _sev("unique_surrogate_key"),
                               _ok("unique_surrogate_key"))],
        ))
    return Q.union_all(frames)


def _empty_text(columns: Sequence[str], name: str) -> Q.Rule:
    """Rows where any of ``columns`` is NULL or the empty string."""
    empty = None
    for c in columns:
        cond = F.col(c).isNull() | (F.col(c) == "")
        empty = cond if empty is None else (empty | cond)
    return _count_check(name, "gold", empty)


def gold_checks(fact: DataFrame, carriers: DataFrame, airports: DataFrame, dates: DataFrame,
                only: set[str] | None = None) -> DataFrame:
    """Gold suite; ``only`` limits it to the named checks (nothing else runs)."""
    want = lambda name: only is None or name in only
    frames = []
    if want("fact_row_count"):
        frames.append(Q.evaluate(fact, [_fact_rows()]))
    if want("no_null_carrier_columns"):
        frames.append(Q.evaluate(carriers, [_empty_text(["carrier_key", "carrier", "carrier_name"],
                                                        "no_null_carrier_columns")]))
    if want("no_null_airport_columns"):
        frames.append(Q.evaluate(airports, [_empty_text(["airport_key", "airport", "airport_name"],
                                                        "no_null_airport_columns")]))
    for key, frame in (("carrier_key", carriers), ("airport_key", airports), ("date_key", dates)):
        name = f"no_orphaned_{key.replace('_key', '')}_keys"
        if want(name):
            frames.append(Q.evaluate(Q.orphans_frame(fact, frame, key), [_count_check(name, "gold")]))
    return Q.union_all(frames)


# Declarative tests: model -> columns (unique / not_null), and relationships.
UNIQUE_TESTS = {
    "stg_airline_delay_data": ["airline_delay_id"],
    "dim_carrier": ["carrier_key"],
    "dim_airport": ["airport_key"],
    "dim_date": ["date_key"],
    "fact_flight_delays": ["airline_delay_id"],
    "carrier_delay_performance": ["carrier_key"],
    "monthly_delay_trends": ["date_key"],
}
NOT_NULL_TESTS = {
    "stg_airline_delay_data": ["airline_delay_id", "year", "month", "carrier", "airport"],
    "dim_carrier": ["carrier_key", "carrier", "carrier_name"],
    "dim_airport": ["airport_key", "airport", "airport_name"],
    "dim_date": ["date_key", "year", "month"],
    "fact_flight_delays": ["airline_delay_id", "date_key", "carrier_key", "airport_key"],
    "carrier_delay_performance": ["carrier_key"],
    "monthly_delay_trends": ["date_key"],
}
RELATIONSHIP_TESTS = [
    ("fact_flight_delays", "date_key", "dim_date"),
    ("fact_flight_delays", "carrier_key", "dim_carrier"),
    ("fact_flight_delays", "airport_key", "dim_airport"),
]


def unique_rule(model: str, column: str) -> Q.Rule:
    """Failures = non-NULL values that occur more than once, over a frame of repeated keys."""
    m, n = Q.metric(F.count_if(F.col(column).isNotNull()))
    return Q.Rule(f"unique_{model}_{column}", model, "ERROR", [m], n, F.concat(n.cast("string"), F.lit(" failing row(s).")), F.lit("Passed."))


def not_null_rules(model: str, columns: Sequence[str]) -> list[Q.Rule]:
    return [Q.failing_rows(f"not_null_{model}_{c}", model, F.col(c).isNull()) for c in columns]


def link_of(child: str, key: str, parent: DataFrame, parent_rows: int | None = None) -> Q.Link:
    """Failures = child rows with a non-NULL key missing from the parent."""
    return Q.Link(key, parent, lambda condition: Q.failing_rows(f"relationships_{child}_{key}", child, condition), True, parent_rows)


def unique_tests(models: Mapping[str, DataFrame], tests: Mapping[str, list[str]] = UNIQUE_TESTS) -> DataFrame:
    """Failures = non-NULL values that occur more than once; 8-byte hashes decide which keys are counted at all."""
    jobs = [(model, c) for model, cols in tests.items() for c in cols]
    frames = in_parallel(*[lambda m=m, c=c: Q.evaluate(Q.repeated_keys(models[m], [c]), [unique_rule(m, c)]) for m, c in jobs])
    return Q.union_all(frames)


def not_null_tests(models: Mapping[str, DataFrame], tests: Mapping[str, list[str]] = NOT_NULL_TESTS) -> DataFrame:
    """Failures = NULL rows; all columns of one model in one pass."""
    return Q.union_all([Q.evaluate(models[model], not_null_rules(model, cols)) for model, cols in tests.items()])


def relationship_tests(models: Mapping[str, DataFrame], tests=RELATIONSHIP_TESTS) -> DataFrame:
    """Failures = child rows with a non-NULL key missing from the parent; all links of a child in one scan."""
    frames = []
    for child in dict.fromkeys(c for c, _, _ in tests):
        links = [link_of(child, key, models[parent]) for c, key, parent in tests if c == child]
        flagged, rules, apart = Q.with_links(models[child], links)
        frames += ([Q.evaluate(flagged, rules)] if rules else []) + apart
    return Q.union_all(frames)


def suite(bronze: DataFrame, models: Mapping[str, DataFrame], gold_fact: DataFrame, gold_dims: Mapping[str, DataFrame],
          now: Column, sizes: Mapping[str, int] | None = None) -> DataFrame:
    """Every check of every layer, with one scan per table for all row and foreign-key rules and one for
    the hashes of its unique columns.

    ``models`` are the tables of UNIQUE_TESTS and NOT_NULL_TESTS, by name,
    ``gold_dims`` the three published dimensions. Nothing is read a third time
    unless a hash occurs twice. ``sizes`` are row counts that writes have
    observed, by name; they save counting parents and hashing small tables.
    """
    sizes = sizes or {}
    staging, fact = "stg_airline_delay_data", "fact_flight_delays"
    links = [link_of(c, key, models[parent], sizes.get(parent)) for c, key, parent in RELATIONSHIP_TESTS if c == fact]
    gold_links = [Q.Link(key, gold_dims[name], lambda condition, check=check: _count_check(check, "gold", condition), parent_rows=sizes.get(name))
                  for name, key, check in (("gold_dim_carrier", "carrier_key", "no_orphaned_carrier_keys"),
                                           ("gold_dim_airport", "airport_key", "no_orphaned_airport_keys"),
                                           ("gold_dim_date", "date_key", "no_orphaned_date_keys"))]
    found = in_parallel(*[lambda m=m: Q.repeated_keys(models[m], UNIQUE_TESTS[m], sizes.get(m)) for m in models])
    repeated = dict(zip(models, found, strict=True))
    frames = [bronze_checks(bronze, now)]
    for model, df in models.items():
        rules, apart = not_null_rules(model, NOT_NULL_TESTS[model]), []
        if model == staging:
            rules = silver_rules() + rules
        if model == fact:
            df, more, apart = Q.with_links(df, links)
            rules += more
        frames += [Q.evaluate(df, rules), *apart]
        keys = [unique_rule(model, c) for c in UNIQUE_TESTS[model]]
        if model == staging:
            keys.insert(0, Q.duplicates_rule(["airline_delay_id"], "unique_surrogate_key", "silver", _sev("unique_surrogate_key"),
                                             _ok("unique_surrogate_key")))
        frames.append(Q.evaluate(repeated[model], keys))
    linked, rules, apart = Q.with_links(gold_fact, gold_links)
    frames += [Q.evaluate(linked, [_fact_rows(), *rules]), *apart]
    for code in ("carrier", "airport"):
        columns = [f"{code}_key", code, f"{code}_name"]
        frames.append(Q.evaluate(gold_dims[f"gold_dim_{code}"], [_empty_text(columns, f"no_null_{code}_columns")]))
    return Q.union_all(frames)
