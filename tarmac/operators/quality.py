"""Data-quality validators as distributed aggregates.

A ``Rule`` is a list of aggregate metrics over one frame plus two
expressions over those metrics: the number of violations and the failure
message. ``evaluate`` runs every rule bound to one frame in a single
aggregation (one scan, partial aggregation per task, one tiny shuffle) and
turns the single result row into one check row per rule. Rules that need
their own shuffle (uniqueness: a group-by on the key; orphans: an anti
join) are rules on a derived frame built by ``duplicates_frame`` /
``orphans_frame``.

Nothing is collected: the result is a DataFrame with the CHECK_RESULT
schema, which a caller may show, write, or turn into an exception.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.dates import age_tenths_half_up
from tarmac.operators.broadcast import DIM_BROADCAST_ROWS, fits
from tarmac.session import materialise

# Message formats of the checks (kept word for word).
MSG_NULLS = "Column '{col}' contains {n} null value(s)."
MSG_MIN_ROWS = "Expected at least {min} row(s), but found {n}."
MSG_DUPLICATES = "Found {n} duplicate row(s) on key column(s): [{cols}]."
MSG_BELOW = "Column '{col}' has {n} value(s) below minimum {min}."
MSG_ABOVE = "Column '{col}' has {n} value(s) above maximum {max}."
MSG_TOO_LONG = "Column '{col}' has {n} value(s) longer than {max} characters."
MSG_CONSISTENCY = "{n} row(s) where [{cols}] differs from '{total}' by more than {tol}."
MSG_NO_TIMESTAMPS = "No ingestion timestamps found — table may be empty."
MSG_STALE = "Latest ingestion is {hours} hour(s) old, exceeding the {max}-hour freshness threshold."

_ids = itertools.count()


def message(template: str, **parts: Column | str) -> Column:
    """Fill ``{name}`` slots of a fixed message with columns or literals."""
    out: list[Column] = []
    rest = template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        if head:
            out.append(F.lit(head))
        part = parts[name]
        out.append(part.cast("string") if isinstance(part, Column) else F.lit(str(part)))
    if rest:
        out.append(F.lit(rest))
    return F.concat(*out)


@dataclass
class Rule:
    check: str
    layer: str
    severity: str
    metrics: list[Column]
    violations: Column
    failure: Column
    success: Column


def metric(agg: Column) -> tuple[Column, Column]:
    name = f"__m{next(_ids)}"
    return agg.alias(name), F.col(name)


def no_nulls(columns: Sequence[str], check: str, layer: str, severity: str = "ERROR",
             success: str = "All key columns are non-null.") -> Rule:
    """One failure message per column that holds NULLs, joined with ``; ``."""
    metrics, counts = zip(*[metric(F.count_if(F.col(c).isNull())) for c in columns])
    msgs = [F.when(n > 0, message(MSG_NULLS, col=c, n=n)) for c, n in zip(columns, counts)]
    total = sum(counts[1:], counts[0])
    return Rule(check, layer, severity, list(metrics), total, F.concat_ws("; ", *msgs), F.lit(success))


def min_row_count(min_rows: int, check: str, layer: str, severity: str = "ERROR",
                  success: str = "Row count is {n}.", failure: str = MSG_MIN_ROWS) -> Rule:
    """Violations = rows missing to reach ``min_rows`` (inclusive bound).

    ``success``/``failure`` are message templates with ``{n}`` (row count)
    and ``{min}`` slots."""
    m, n = metric(F.count(F.lit(1)))
    short = F.greatest(F.lit(min_rows) - n, F.lit(0))
    slots = lambda t: {k: v for k, v in (("n", n), ("min", str(min_rows))) if "{" + k + "}" in t}
    return Rule(check, layer, severity, [m], short, message(failure, **slots(failure)), message(success, **slots(success)))


def value_range(column: str, min_val: int | float | None, max_val: int | float | None, check: str, layer: str,
                severity: str = "ERROR", success: str = "") -> Rule:
    """Inclusive bounds; NULLs are ignored; separate below/above messages."""
    if min_val is None and max_val is None:
        raise ValueError("value_range needs min_val or max_val")
    metrics, counts, msgs = [], [], []
    if min_val is not None:
        m, n = metric(F.count_if(F.col(column) < F.lit(min_val)))
        metrics.append(m), counts.append(n), msgs.append(F.when(n > 0, message(MSG_BELOW, col=column, n=n, min=min_val)))
    if max_val is not None:
        m, n = metric(F.count_if(F.col(column) > F.lit(max_val)))
        metrics.append(m), counts.append(n), msgs.append(F.when(n > 0, message(MSG_ABOVE, col=column, n=n, max=max_val)))
    total = sum(counts[1:], counts[0])
    return Rule(check, layer, severity, metrics, total, F.concat_ws("; ", *msgs), F.lit(success))


def combine(rules: Sequence[Rule], check: str, layer: str, severity: str, success: str) -> Rule:
    """Several rules reported as one check (violations summed, messages joined)."""
    metrics = [m for r in rules for m in r.metrics]
    total = sum([r.violations for r in rules[1:]], rules[0].violations)
    msgs = [F.when(r.violations > 0, r.failure) for r in rules]
    return Rule(check, layer, severity, metrics, total, F.concat_ws("; ", *msgs), F.lit(success))


def consistency(components: Sequence[str], total: str, tolerance: float, check: str, layer: str,
                severity: str = "WARN", success: str = "Components reconcile with the total.") -> Rule:
    """Rows where |sum(components) - total| > tolerance, NULL counted as 0."""
    comp = sum([F.coalesce(F.col(c), F.lit(0)) for c in components[1:]], F.coalesce(F.col(components[0]), F.lit(0)))
    diff = F.abs(comp - F.coalesce(F.col(total), F.lit(0)))
    m, n = metric(F.count_if(diff > F.lit(tolerance)))
    msg = message(MSG_CONSISTENCY, n=n, cols=" + ".join(components), total=total, tol=tolerance)
    return Rule(check, layer, severity, [m], n, msg, F.lit(success))


def freshness(ts_col: str, now: Column, max_age_hours: int, check: str, layer: str, severity: str = "WARN",
              success: str = "Bronze data is fresh.") -> Rule:
    """Newest stamp no older than ``max_age_hours`` (exactly the limit passes)."""
    m, latest = metric(F.max(ts_col))
    age_micros = F.unix_micros(now) - F.unix_micros(latest)
    stale = latest.isNull() | (age_micros > F.lit(max_age_hours * 3_600_000_000))
    tenths = age_tenths_half_up(now, latest)
    hours = F.concat(F.call_function("div", tenths, F.lit(10)).cast("string"), F.lit("."),
                     F.pmod(tenths, F.lit(10)).cast("string"))
    msg = F.when(latest.isNull(), F.lit(MSG_NO_TIMESTAMPS)).otherwise(message(MSG_STALE, hours=hours, max=max_age_hours))
    return Rule(check, layer, severity, [m], F.when(stale, 1).otherwise(0), msg, F.lit(success))


def text_length(limits: Mapping[str, int], check: str, layer: str, severity: str = "ERROR",
                success: str = "All text columns fit their declared lengths.") -> Rule:
    """Values longer than their column's limit (code points); NULLs fit. One message per column."""
    metrics, counts = zip(*[metric(F.count_if(F.length(c) > limit)) for c, limit in limits.items()])
    msgs = [F.when(n > 0, message(MSG_TOO_LONG, col=c, n=n, max=limit)) for (c, limit), n in zip(limits.items(), counts)]
    return Rule(check, layer, severity, list(metrics), sum(counts[1:], counts[0]), F.concat_ws("; ", *msgs), F.lit(success))


def count_rule(check: str, layer: str, severity: str, failure_prefix: str, failure_suffix: str, success: str,
               weight: str | None = None) -> Rule:
    """Violations = number of rows of the (derived) frame, or the sum of ``weight``, e.g. orphan rows."""
    m, n = metric(F.coalesce(F.sum(weight), F.lit(0)) if weight else F.count(F.lit(1)))
    return Rule(check, layer, severity, [m], n, F.concat(F.lit(failure_prefix), n.cast("string"), F.lit(failure_suffix)),
                F.lit(success))


def duplicates_frame(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per distinct key with its multiplicity (NULL keys group together)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))


def duplicates_rule(keys: Sequence[str], check: str, layer: str, severity: str = "ERROR",
                    success: str = "Surrogate key is unique.") -> Rule:
    """Excess rows (total - distinct) over a ``duplicates_frame``."""
    m, excess = metric(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)))
    msg = message(MSG_DUPLICATES, n=excess, cols=", ".join(keys))
    return Rule(check, layer, severity, [m], excess, msg, F.lit(success))


def orphans_frame(child: DataFrame, parent: DataFrame, key: str, skip_null: bool = False) -> DataFrame:
    """Child keys without a parent row, each with its number of rows ``__n``
    (NULL keys count as orphans unless ``skip_null``).

    The child is counted per key first, combined in each task, so only one
    row per key and task is shuffled for the anti join, however skewed the key.
    """
    c = child.select(key)
    if skip_null:
        c = c.where(F.col(key).isNotNull())
    return c.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).join(parent.select(key), key, "left_anti")


def failing_rows(check: str, layer: str, condition: Column | None) -> Rule:
    """Violations = rows matching ``condition``, or (None) the sum of ``__n``: rows per key of a derived frame."""
    m, n = metric(F.coalesce(F.sum("__n"), F.lit(0)) if condition is None else F.count_if(condition))
    return Rule(check, layer, "ERROR", [m], n, F.concat(n.cast("string"), F.lit(" failing row(s).")), F.lit("Passed."))


@dataclass
class Link:
    """A foreign key of a table. ``rule(condition)`` gives its check from a condition on the table's rows, or
    (None) on a frame of orphan keys with their number of rows ``__n``."""

    key: str
    parent: DataFrame
    rule: Callable[[Column | None], Rule]
    skip_null: bool = False
    parent_rows: int | None = None  # where a write has counted them


def with_links(df: DataFrame, links: Sequence[Link], max_rows: int = DIM_BROADCAST_ROWS) -> tuple[DataFrame, list[Rule], list[DataFrame]]:
    """``df`` with its parents' keys joined on, rules over them, and check rows of links to large parents.

    Parents whose keys fit (counted rows and bytes, no estimate) are broadcast,
    so all their foreign keys are counted in the scan that serves the table's
    other rules; distinct keys are joined, so no row is doubled. A larger
    parent gets the anti join on counted keys of ``orphans_frame`` instead.
    """
    out, rules, apart = df, [], []
    for i, link in enumerate(links):
        known = link.parent_rows
        if known > max_rows if known is not None else not fits(link.parent.select(link.key), max_rows):
            apart.append(evaluate(orphans_frame(df, link.parent, link.key, link.skip_null), [link.rule(None)]))
            continue
        found = f"__parent{i}"
        keys = link.parent.select(F.col(link.key).alias(found)).where(F.col(found).isNotNull()).distinct()
        out = out.join(F.broadcast(keys), F.col(link.key) == F.col(found), "left")
        missing = F.col(found).isNull()
        rules.append(link.rule(missing & F.col(link.key).isNotNull() if link.skip_null else missing))
    return out, rules, apart


def repeated_keys(df: DataFrame, keys: Sequence[str], rows: int | None = None, max_rows: int = DIM_BROADCAST_ROWS) -> DataFrame:
    """The keys that occur more than once, with their number of rows ``__n`` (NULL keys group together).

    A table known to have at most ``max_rows`` ``rows`` is counted by key at once.

    Otherwise only an 8-byte hash per row is shuffled to find hashes seen twice; these
    candidates are written first. Without any (the usual case) the table is not read
    again; otherwise a second scan counts exactly, and shuffles the
    candidates' rows only.
    """
    if rows is not None and rows <= max_rows:
        return duplicates_frame(df, keys).where("__n > 1")
    hashed = F.xxhash64(*keys).alias("__h")
    twice, seen = materialise(df.select(hashed).groupBy("__h").agg(F.count(F.lit(1)).alias("__c")).where("__c > 1").select("__h"),
                              "twice", {"rows": F.count(F.lit(1))})
    found = seen.get("rows") or 0
    if not found:
        return df.sparkSession.createDataFrame([], T.StructType([df.schema[k] for k in keys])).withColumn("__n", F.lit(0).cast("long"))
    if found <= max_rows:
        twice = F.broadcast(twice)
    return df.select(*keys, hashed).join(twice, "__h", "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")


def evaluate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All rules of one frame in one aggregation -> one check row per rule."""
    metrics = [m for r in rules for m in r.metrics]
    rows = [
        F.struct(
            F.lit(r.check).alias("check"),
            F.lit(r.layer).alias("layer"),
            F.lit(r.severity).alias("severity"),
            r.violations.cast("long").alias("violations"),
            (r.violations == 0).alias("passed"),
            F.when(r.violations == 0, r.success).otherwise(r.failure).alias("description"),
        )
        for r in rules
    ]
    return df.agg(*metrics).select(F.inline(F.array(*rows)))


def drift(df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row per column that differs from the contract: expected and found type (null: no such column),
    and the rows that hold a value the expected type cannot take. One aggregation; no row if all agree."""
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    changed = [c for c in [*want, *[c for c in found if c not in want]] if found.get(c) != want.get(c)]
    metrics, rows = [], []
    for c in changed:
        lost = F.col(f"`{c}`").isNotNull() & F.expr(f"try_cast(`{c}` AS {want[c]})").isNull() if c in found and c in want else F.lit(False)
        m, n = metric(F.count_if(lost))
        metrics.append(m)
        rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(want.get(c)).cast("string").alias("expected"),
                             F.lit(found.get(c)).cast("string").alias("found"), n.cast("long").alias("rows_lost")))
    if not rows:
        return df.sparkSession.createDataFrame([], "column_name string, expected string, found string, rows_lost long")
    return df.agg(*metrics).select(F.inline(F.array(*rows)))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
