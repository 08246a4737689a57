"""Silver model: incremental, deduplicated, cleaned delay records (MOD-01).

bronze --(high-water mark)--> new rows --(latest per key)--> one row per
(year, month, carrier, airport) --(casts, trims, md5 id)--> staging.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.keys import clean_name, delay_record_id, norm_code
from tarmac.operators.dedupe import latest_per_key
from tarmac.schemas import (
    CAUSE_COUNT_COLUMNS,
    COUNT_COLUMNS,
    DELAY_COLUMNS,
    MEASURE_COLUMNS,
    SILVER_DECIMAL,
    STAGING,
    STAGING_COLUMNS,
)


def high_water_mark(target: DataFrame):
    """``max(_ingested_at)`` of the target in microseconds since 1970 UTC (or None).

    A literal (unlike a scalar subquery) is pushed into the parquet scan of
    bronze, where the row-group min/max statistics skip every file of
    earlier batches: bronze only grows, so this keeps an incremental run
    proportional to the new data.
    """
    return target.agg(F.unix_micros(F.max("_ingested_at")).alias("mark")).first()["mark"]


def new_rows(bronze: DataFrame, target: DataFrame | None) -> DataFrame:
    """Rows ingested after the newest row already in ``target``.

    With no target, or a target without any stamp, everything is new
    (an empty target must not block the first load). Rows without a stamp are
    loaded on a full load only.
    """
    if target is None:
        return bronze
    return rows_after(bronze, high_water_mark(target))


def rows_after(bronze: DataFrame, mark: int | None) -> DataFrame:
    """Rows stamped after ``mark`` (microseconds); all rows without a mark."""
    return bronze if mark is None else bronze.where(F.col("_ingested_at") > F.timestamp_micros(F.lit(mark)))


def dedupe_order() -> list[Column]:
    """Total order for latest-wins: newest stamp first (NULL counts as newest,
    as in a descending sort that puts NULLs first), then every other column
    descending, so that in-batch ties resolve the same way on every run."""
    cols = ["_ingested_at"] + MEASURE_COLUMNS + ["carrier_name", "airport_name", "carrier", "airport"]
    return [F.col(c).desc_nulls_first() for c in cols]


def _clean(df: DataFrame) -> DataFrame:
    carrier, airport = norm_code("carrier"), norm_code("airport")
    exprs = {
        "airline_delay_id": delay_record_id("year", "month", carrier, airport),
        "year": F.col("year").cast("int"),
        "month": F.col("month").cast("int"),
        "carrier": carrier,
        "airport": airport,
        "carrier_name": clean_name("carrier_name"),
        "airport_name": clean_name("airport_name"),
        "_ingested_at": F.col("_ingested_at"),
    }
    for c in COUNT_COLUMNS:
        exprs[c] = F.round(F.col(c), 0).cast("int")
    for c in CAUSE_COUNT_COLUMNS + DELAY_COLUMNS:
        exprs[c] = F.col(c).cast(SILVER_DECIMAL)
    return df.select(*[exprs[c].alias(c) for c in STAGING_COLUMNS])


def stage(bronze: DataFrame, target: DataFrame | None = None, normalise_first: bool = True) -> DataFrame:
    """Build the staging rows to upsert from ``bronze``.

    ``normalise_first=True`` dedupes on normalised codes, so ``' aa '`` and
    ``'AA'`` are one record; ``False`` dedupes on the raw codes as the
    original model did, which lets two rows share one surrogate id.
    """
    source = new_rows(bronze, target)
    if normalise_first:
        keys = [F.col("year"), F.col("month"), norm_code("carrier"), norm_code("airport")]
    else:
        keys = [F.col("year"), F.col("month"), F.col("carrier"), F.col("airport")]
    return _clean(latest_per_key(source, keys, dedupe_order()))


def check_schema(df: DataFrame, expected=STAGING) -> None:
    """Schema-drift guard: refuse to write a frame whose columns or types differ."""
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in expected.fields]
    if got != want:
        raise ValueError(f"schema drift: expected {want}, got {got}")


def check_target(target: DataFrame, batch: DataFrame) -> None:
    """Refuse to write a batch into a stored table of other columns or types (order aside)."""
    stored = {f.name: f.dataType.simpleString() for f in target.schema.fields}
    new = {f.name: f.dataType.simpleString() for f in batch.schema.fields}
    if stored != new:
        changed = sorted(c for c in stored.keys() | new.keys() if stored.get(c) != new.get(c))
        raise ValueError("schema drift against the stored table: " + ", ".join(
            f"{c}: stored {stored.get(c)}, new {new.get(c)}" for c in changed))
