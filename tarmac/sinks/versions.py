"""Tables of versions: merge on read, and compaction.

``append_versions`` writes a batch of rows and nothing else: what a write costs
does not depend on the table. Readers see the newest version of each key
(``Store.read``: highest version, NULL newest, then the latest arrival; rows with
a NULL key all stay). ``compact`` rewrites batches as one that holds the newest
version per key; newest-of-newest is newest, so any run of neighbouring
batches may be merged while others stay. Readers keep the folders of the
record they started from, batches that arrive meanwhile are kept by the
commit, and two compactions of the same batches cannot both land.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.sinks import tables as sink
from tarmac.sinks.commits import newest


@dataclass(frozen=True)
class Compacted:
    batches: int
    rows_before: int
    rows_after: int


def append_versions(df: DataFrame, store: sink.Store, table: str, keys: Sequence[str], version_col: str = "_ingested_at",
                    label: str | None = None) -> int:
    """Add a batch of versions; returns its rows. Labels order arrivals: a later batch needs a greater label."""
    return sink.append_batch(df, store, table, version_col, label, {"keys": list(keys), "version": version_col})


def due(store: sink.Store, table: str, factor: float = 1.0) -> list[str]:
    """The youngest batches worth merging: as many as do not reach ``factor`` times the rows of the next older one.

    Every row is then rewritten a number of times logarithmic in the table's size.
    """
    parts = store.log.head().parts(table)
    young, rows = [], 0
    for label in sorted(parts, reverse=True):
        if len(young) > 1 and parts[label]["rows"] * factor > rows:
            break
        young.append(label)
        rows += parts[label]["rows"]
    return sorted(young) if len(young) > 1 else []


def compact(store: sink.Store, table: str, batches: Sequence[str] | None = None, files: int | None = None) -> Compacted:
    """Merge ``batches`` (neighbours in arrival; all by default) into one that holds the newest version per key.

    The merged batch is labelled right after the greatest of its parts, so it
    stays behind every later arrival, and notes the labels it spans: a replay of
    one of them writes nothing. ``files`` fixes the number of files; by default
    AQE sizes them.
    """
    base = store.log.head()
    told = base.tables[table]
    parts = told["parts"]
    batches = sorted(parts if batches is None else batches)
    inside = [b for b in parts if batches and batches[0] <= b <= batches[-1]]
    if sorted(inside) != batches:
        raise ValueError("batches to be merged must be neighbours in arrival")
    before = sum(parts[b]["rows"] for b in batches)
    if len(batches) < 2:
        return Compacted(len(batches), before, before)
    label = f"{batches[-1]}~"
    rows = newest(store.log.stored(table, base, batches), told["latest_by"], told["partition_col"])
    rows = rows.withColumn(told["partition_col"], F.lit(label)).select(*told["columns"], told["partition_col"])
    rows = rows.repartition(files) if files else rows.hint("rebalance")
    version = told["latest_by"]["version"]
    staged, got = store.log.stage(rows, table, told["partition_col"], replaces=[*batches, label], hidden=True, latest_by=told["latest_by"],
                                  observe={"newest": F.unix_micros(F.max(version))})
    first, last = parts[batches[0]].get("first", batches[0]), batches[-1]
    staged.parts[label].update(newest=got.get("newest"), rows=staged.rows, first=first, last=last)
    store.log.commit([staged], base)
    return Compacted(len(batches), before, staged.rows)
