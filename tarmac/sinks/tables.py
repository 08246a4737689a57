"""Table sinks: append, full reload, slice replace, upsert, layout.

Tables of a ``Store`` are parquet under one folder on shared storage: plain
catalog tables, or tables governed by commit records (``sinks.commits``), whose
partitions are written once into new folders and become visible with one
record. Writes never pass through the driver; row counts come from an
``Observation`` on the written frame, not from a second scan.

Rerun safety:

* ``append`` / ``append_batch`` add a batch again on a rerun (bag semantics of a raw layer);
* ``full_reload`` replaces the whole table (empty input -> empty table);
* ``replace_slice`` / ``replace_slices`` replace whole ``year`` partitions
  (a slice that came out empty leaves no old rows); ``stage_slices`` stops
  before the commit, so slices of several tables can be published as one;
* ``upsert`` replaces rows by key inside the touched partitions only.

A governed write that fails before its commit changes nothing readers see.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarmac.session import work_dir
from tarmac.sinks.commits import CommitLog, Record, Staged, in_values
from tarmac.sinks.layout import interleaved

BATCH = "_batch"
#: distinct codes of a row group that a bloom filter is sized for (about 12 KB)
BLOOM_DISTINCT = 10_000


class Store:
    """A database of parquet tables located under one shared folder, with its commit records."""

    def __init__(self, spark: SparkSession, root: str | None = None, database: str | None = None):
        self.spark = spark
        self.root = root or work_dir(spark, "store")
        self.database = database or f"tarmac_{uuid.uuid4().hex[:10]}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.root}'")
        self.log = CommitLog(spark, self.root, f"{self.database}_shown")

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def governed(self, table: str) -> bool:
        """Whether commit records hold the table."""
        return table in self.log.head().tables

    def exists(self, table: str) -> bool:
        return self.governed(table) or self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        """The table as last committed; the frame keeps this version."""
        head = self.log.head()
        return self.log.read(table, head) if table in head.tables else self.spark.table(self.name(table))

    def drop(self) -> None:
        """Drop the database with its tables and files (frames read from it stop working)."""
        self.log.drop()
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.database} CASCADE")


@contextmanager
def scratch_table(df: DataFrame, store: Store, label: str) -> Iterator[DataFrame]:
    """``df`` written once as a managed table of ``store``, read back for the
    block and dropped afterwards (its files go with it), so a daily run
    leaves no intermediate data behind in shared storage."""
    name = store.name(f"{label}__scratch_{uuid.uuid4().hex[:8]}")
    df.write.format("parquet").saveAsTable(name)
    try:
        yield store.spark.table(name)
    finally:
        store.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _check_chunk(chunk_size: int | None) -> None:
    if chunk_size is not None and chunk_size <= 0:
        raise ValueError("chunk_size must be greater than 0")


def _chunk(chunk_size: int | None) -> dict[str, int]:
    return {"maxRecordsPerFile": chunk_size} if chunk_size else {}


def _by_partition(df: DataFrame, partition_col: str) -> DataFrame:
    """Rows of a partition value together, in evenly sized tasks (AQE merges small
    values and splits large ones), so a write opens about one file per value and
    advisory size instead of one per task and value."""
    return df.hint("rebalance", partition_col)


def _observed(df: DataFrame, label: str, *extra) -> tuple[DataFrame, Observation]:
    obs = Observation(f"{label}_{uuid.uuid4().hex[:8]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *extra), obs


def append(df: DataFrame, store: Store, table: str, partition_by: Sequence[str] = ()) -> int:
    """Append a batch (creating the table on first use); returns rows written."""
    observed, obs = _observed(df, "append")
    writer = observed.write.format("parquet").mode("append")
    if partition_by and not store.exists(table):
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(store.name(table))
    return int(obs.get.get("rows", 0))


def append_batch(df: DataFrame, store: Store, table: str, stamp_col: str = "_ingested_at", label: str | None = None,
                 latest_by: Mapping | None = None) -> int:
    """Append a batch as a partition of its own, named in the commit record with its newest stamp.

    Readers of new batches (``new_batches``) open no older file, however many
    there are. A batch of a given ``label`` takes the place of an earlier one of
    that label, and one that a compaction has taken in is not written again, so a
    replayed write changes nothing.
    """
    base = store.log.head()
    if label and any("first" in e and e["first"] <= label <= e["last"] for e in base.parts(table).values()):
        return 0
    label = label or f"{len(base.parts(table)) + 1:08d}-{uuid.uuid4().hex[:8]}"
    staged, got = store.log.stage(df.withColumn(BATCH, F.lit(label)), table, BATCH, replaces=[label], hidden=True,
                                  observe={"newest": F.unix_micros(F.max(stamp_col))}, latest_by=latest_by and dict(latest_by))
    if staged.parts[label] is not None:  # not an empty batch
        staged.parts[label].update(newest=got.get("newest"), rows=staged.rows)
    store.log.commit([staged], base)
    return staged.rows


def new_batches(record: Record, table: str, mark: int | None) -> list[str]:
    """Batches that hold rows stamped after ``mark`` (microseconds); all of them without a mark.

    Decided from the commit record alone.
    """
    return [b for b, e in record.parts(table).items() if mark is None or (e["newest"] is not None and e["newest"] > mark)]


def full_reload(df: DataFrame, store: Store, table: str, chunk_size: int | None = None) -> int:
    """Truncate-and-insert: the table afterwards holds exactly ``df``.

    ``chunk_size`` optionally bounds the rows per output file; it must be
    positive. Without it files follow the tasks' sizes.
    """
    _check_chunk(chunk_size)
    base = store.log.head()
    if table in base.tables:
        staged, _ = store.log.stage(df, table, base.tables[table]["partition_col"], options=_chunk(chunk_size))
        store.log.commit([staged], base)
        return staged.rows
    observed, obs = _observed(df, "reload")
    writer = observed.write.format("parquet").mode("overwrite")
    if chunk_size:
        writer = writer.option("maxRecordsPerFile", chunk_size)
    writer.saveAsTable(store.name(table))
    return int(obs.get.get("rows", 0))


def govern(store: Store, table: str, partition_col: str) -> None:
    """Bring a plain catalog table under the commit records: written once more, whole."""
    if not store.governed(table) and store.exists(table):
        staged, _ = store.log.stage(_by_partition(store.read(table), partition_col), table, partition_col)
        store.log.commit([staged], store.log.head())


def replace_slice(df: DataFrame, store: Store, table: str, year: int, partition_col: str = "year",
                  chunk_size: int | None = None) -> int:
    """Replace partition ``year`` with the rows of ``df`` for that year;
    an empty slice leaves the partition empty (it is dropped)."""
    return replace_slices(df, store, table, [year], partition_col, chunk_size)


def stage_slices(df: DataFrame, store: Store, table: str, values: Iterable | None, partition_col: str = "year",
                 chunk_size: int | None = None, sort_cols: Sequence[str] = (), bloom_cols: Sequence[str] = (),
                 as_is: bool = False) -> Staged:
    """Write the rows of these partition values once, for a later ``store.log.commit``.

    Values without rows go with the commit; None replaces the whole table.
    With ``sort_cols`` the files have the serving layout (see ``write_layout``).
    ``as_is`` writes rows where they are: for small aggregates, whose own
    shuffle has gathered them already.
    """
    _check_chunk(chunk_size)
    if values is not None:
        values = list(dict.fromkeys(values))
        df = df.where(in_values(partition_col, values))
    arranged = _layout(df, partition_col, sort_cols) if sort_cols else df if as_is else _by_partition(df, partition_col)
    staged, _ = store.log.stage(arranged, table, partition_col, replaces=values, options={**_chunk(chunk_size), **_blooms(bloom_cols)})
    return staged


def replace_slices(df: DataFrame, store: Store, table: str, years: Iterable[int], partition_col: str = "year",
                   chunk_size: int | None = None) -> int:
    """Replace several year partitions with one write and one commit; returns the rows written.

    Years of ``years`` with no rows in ``df`` end up empty. The set of years
    written is gathered by the write itself (an observed ``collect_set`` of a
    handful of integers).
    """
    _check_chunk(chunk_size)
    govern(store, table, partition_col)
    base = store.log.head()
    staged = stage_slices(df, store, table, sorted({int(y) for y in years}), partition_col, chunk_size)
    store.log.commit([staged], base)
    return staged.rows


def upsert(batch: DataFrame, store: Store, table: str, key: str = "airline_delay_id",
           partition_col: str = "year", version_col: str | None = None, properties: Mapping | None = None) -> int:
    """delete+insert by ``key``: rows of ``batch`` replace rows with the same key.

    Only partitions touched by the batch are rewritten, once: their existing
    rows minus the batch keys (anti join) plus the batch go to new folders,
    which the commit puts in the old ones' place together with
    ``properties``. A key cannot move between partitions because the partition
    column is part of the key. NULL keys never match, so existing NULL-key rows
    stay, those of the NULL partition included.
    With ``version_col`` a stored row whose version is newer (NULL is newest)
    stays and the batch row is left out, whatever the order of arrival; at
    equal versions the later arrival wins.
    ``batch`` should be materialised: it is read for its years, its keys
    and its rows. Returns the row count of the rewritten partitions.
    """
    govern(store, table, partition_col)
    base = store.log.head()
    if table not in base.tables:  # first load: nothing to replace
        staged, _ = store.log.stage(_by_partition(batch, partition_col), table, partition_col)
        store.log.commit([staged], base, properties)
        return staged.rows
    touched = [r[0] for r in batch.select(partition_col).distinct().collect()]  # a handful of years
    if not touched:
        if properties:
            store.log.commit([], base, properties)
        return 0
    existing = store.log.read(table, base, touched)
    if version_col:
        stored = existing.select(F.col(key).alias("__key"), F.col(version_col).alias("__version"))
        newer = (F.col("__version").isNull() & F.col(version_col).isNotNull()) | (F.col("__version") > F.col(version_col))
        batch = batch.join(stored, (F.col(key) == F.col("__key")) & newer, "left_anti")
    kept = existing.join(batch.select(key), key, "left_anti")  # duplicate batch keys cannot change an anti join
    merged = kept.select(*existing.columns).unionByName(batch.select(*existing.columns))
    staged, _ = store.log.stage(_by_partition(merged, partition_col), table, partition_col, replaces=touched)
    store.log.commit([staged], base, properties)
    return staged.rows


def _layout(df: DataFrame, partition_col: str, sort_cols: Sequence[str]) -> DataFrame:
    return df.repartitionByRange(partition_col, *sort_cols).sortWithinPartitions(partition_col, *sort_cols)


def _blooms(bloom_cols: Sequence[str], distinct: int = BLOOM_DISTINCT) -> dict[str, str]:
    """Writer options that make the filters exist: the Parquet writer leaves out the filter of a column
    whose pages are all dictionary-encoded, as pages of codes would be."""
    return {option: value for c in bloom_cols for option, value in (
        (f"parquet.bloom.filter.enabled#{c}", "true"), (f"parquet.enable.dictionary#{c}", "false"),
        (f"parquet.bloom.filter.expected.ndv#{c}", str(distinct)))}


def write_layout(df: DataFrame, store: Store, table: str, partition_col: str = "year",
                 sort_cols: Sequence[str] = ("carrier_key", "airport_key", "date_key"),
                 bloom_cols: Sequence[str] = ("carrier", "airport"), chunk_size: int | None = None,
                 interleave: bool = False) -> int:
    """Full write with the serving layout of the fact table.

    Rows are range-partitioned on (partition, sort key) and sorted inside
    each task, so each year directory holds files whose row groups cover
    narrow key ranges (min/max statistics skip the rest) and no single task
    owns a whole year; parquet bloom filters on the code columns let point
    lookups skip row groups. With ``interleave`` rows are ordered by the
    bit-interleaved ranks of ``sort_cols`` instead, so that lookups on any one
    of them skip row groups, not on the first alone.
    """
    _check_chunk(chunk_size)
    if interleave:
        ordered = _layout(interleaved(df, sort_cols), partition_col, ["__z", *sort_cols]).drop("__z")
    else:
        ordered = _layout(df, partition_col, sort_cols)
    observed, obs = _observed(ordered, "layout")
    writer = observed.write.format("parquet").mode("overwrite").partitionBy(partition_col)
    writer.options(**_blooms(bloom_cols), **_chunk(chunk_size)).saveAsTable(store.name(table))
    return int(obs.get.get("rows", 0))


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", chunk_size: int = 10_000,
               num_partitions: int | None = None, properties: dict[str, str] | None = None) -> None:
    """Batched JDBC write: ``chunk_size`` rows per insert batch, at most
    ``num_partitions`` concurrent connections. Not exercised here (no
    database may run in this environment)."""
    _check_chunk(chunk_size)
    writer = df.write.mode(mode).option("batchsize", chunk_size)
    if num_partitions:
        writer = writer.option("numPartitions", num_partitions)
    writer.jdbc(url, table, properties=dict(properties or {}))
