"""What a table's files look like, as DataFrames: footers, skipping, clustering; and an interleaved sort key.

``footers`` reads the Parquet footer of every file in tasks: one row per row
group and column with its value range and whether a bloom filter exists.
``skipped_share`` says which share of the row groups an equality lookup on a
column skips by value range; ``clustering`` measures order inside files
and overlap between them from the rows themselves. ``interleaved`` gives a
sort key that keeps several columns' ranges narrow at once.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tarmac.operators.broadcast import DIM_BROADCAST_ROWS, bounded_broadcast
from tarmac.session import materialise

# the footer reader travels with the job: executors need pyarrow, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Field numbers of the Parquet footer (Thrift compact protocol).
ROW_GROUPS, COLUMNS, NUM_ROWS, META_DATA, PATH, BLOOM_OFFSET = 4, 1, 3, 3, 3, 14

FOOTERS = "file string, row_group int, rows long, column string, has_bloom boolean, min_value string, max_value string"


class _Thrift:
    """Structs of the Thrift compact protocol as {field number: value}."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def _varint(self) -> int:
        shift = out = 0
        while True:
            byte = self.data[self.at]
            self.at += 1
            out |= (byte & 0x7F) << shift
            if byte < 0x80:
                return out
            shift += 7

    def _signed(self) -> int:
        n = self._varint()
        return (n >> 1) ^ -(n & 1)

    def struct(self) -> dict[int, object]:
        out, number = {}, 0
        while kind := self.data[self.at]:
            self.at += 1
            number = number + (kind >> 4) if kind >> 4 else self._signed()
            out[number] = self._value(kind & 0x0F)
        self.at += 1
        return out

    def _value(self, kind: int, in_list: bool = False):
        if kind in (1, 2):
            if in_list:
                self.at += 1
                return self.data[self.at - 1] == 1
            return kind == 1
        if kind == 3:
            self.at += 1
            return self.data[self.at - 1]
        if kind in (4, 5, 6):
            return self._signed()
        if kind == 7:
            self.at += 8
            return self.data[self.at - 8:self.at]
        if kind == 8:
            n = self._varint()
            self.at += n
            return self.data[self.at - n:self.at]
        if kind in (9, 10):
            head = self.data[self.at]
            self.at += 1
            count = head >> 4 if head >> 4 < 15 else self._varint()
            return [self._value(head & 0x0F, True) for _ in range(count)]
        if kind == 12:
            return self.struct()
        raise ValueError(f"unexpected Thrift type {kind}")


def _open(uri: str):
    """A file of any store that pyarrow's file systems reach."""
    from urllib.parse import unquote, urlparse

    from pyarrow import fs

    told = urlparse(uri)
    if told.scheme in ("", "file"):
        return fs.LocalFileSystem().open_input_file(unquote(told.path))
    system, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://"))
    return system.open_input_file(unquote(path))


def _bloom_columns(source) -> list[set[str]]:
    """Per row group, the columns whose chunk has a bloom filter."""
    size = source.size()
    source.seek(size - 8)
    length = int.from_bytes(source.read(4), "little")
    source.seek(size - 8 - length)
    groups = _Thrift(source.read(length)).struct()[ROW_GROUPS]
    chunks = [[c[META_DATA] for c in g[COLUMNS]] for g in groups]
    return [{".".join(p.decode() for p in m[PATH]) for m in metas if BLOOM_OFFSET in m} for metas in chunks]


def footers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per file, row group and column of the files behind ``df`` (its partition filters apply).

    ``min_value`` and ``max_value`` are the footer's statistics as text.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        for batch in batches:
            for uri in batch.column(0).to_pylist():
                with _open(uri) as source:
                    blooms = _bloom_columns(source)
                    source.seek(0)
                    told = pq.read_metadata(source)
                rows = []
                for g in range(told.num_row_groups):
                    group = told.row_group(g)
                    for i in range(group.num_columns):
                        c = group.column(i)
                        if c.path_in_schema in columns:
                            s = c.statistics if c.is_stats_set and c.statistics.has_min_max else None
                            rows.append((uri, g, group.num_rows, c.path_in_schema, c.path_in_schema in blooms[g],
                                         s and str(s.min), s and str(s.max)))
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                        pa.string(), pa.int32(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.string()), strict=True)],
                        names=["file", "row_group", "rows", "column", "has_bloom", "min_value", "max_value"])

    files = sorted(df.inputFiles())
    spark = df.sparkSession
    listed = spark.createDataFrame([(f,) for f in files], "file string").repartition(max(1, min(len(files), 10_000)), "file")
    return listed.mapInArrow(read, FOOTERS)


def skipped_share(told: DataFrame, values: DataFrame, cast: str = "string") -> DataFrame:
    """column -> mean share of row groups whose range excludes a looked-up value.

    ``told`` are ``footers`` rows; ``values`` holds (column, value) lookups, a
    small set. Row groups without statistics are never skipped.
    """
    v, lo, hi = (F.col(c).cast(cast) for c in ("value", "min_value", "max_value"))
    pairs = told.join(F.broadcast(values), "column")
    return pairs.groupBy("column").agg(
        F.count(F.lit(1)).alias("lookups"),
        (F.sum(F.when((v < lo) | (v > hi), 1).otherwise(0)) / F.count(F.lit(1))).alias("skipped"))


def clustering(df: DataFrame, sort_cols: Sequence[str], partition_col: str = "year") -> DataFrame:
    """Per partition value: rows, files, rows out of order inside their file, and the greatest number of
    files whose key ranges share a point (1: no two files overlap).

    Order is checked between neighbours of a file's row positions; ranges are
    swept once per partition value, over two events a file.
    """
    key = F.struct(*sort_cols)
    placed = df.select(partition_col, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"), key.alias("k"))
    before = F.lag("k").over(W.partitionBy("file").orderBy("at"))
    checked = placed.withColumn("wrong", (F.coalesce(before > F.col("k"), F.lit(False))).cast("int"))
    files = checked.groupBy(partition_col, "file").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("wrong").alias("wrong"), F.min("k").alias("lo"), F.max("k").alias("hi"))
    ends = files.select(partition_col, "rows", "wrong", F.explode(F.array(
        F.struct(F.col("lo").alias("k"), F.lit(1).alias("step")), F.struct(F.col("hi").alias("k"), F.lit(-1).alias("step")))).alias("e"))
    sweep = W.partitionBy(partition_col).orderBy(F.col("e.k"), F.col("e.step").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    depth = ends.withColumn("open", F.sum("e.step").over(sweep))
    opens = F.col("e.step") == 1
    return depth.groupBy(partition_col).agg(
        F.sum(F.when(opens, F.col("rows"))).alias("row_count"), F.count_if(opens).alias("files"),
        F.sum(F.when(opens, F.col("wrong"))).alias("out_of_order"), F.max("open").alias("overlap_depth"))


def value_buckets(df: DataFrame, column: str, bits: int) -> DataFrame:
    """(column, bucket): each distinct value's place among ranges of about equally many values, spread
    over 0 .. 2^bits - 1 however few they are.

    The ranges come from a range partitioning of the distinct values, so no
    task sees all of them; null gets the first bucket.
    """
    values = df.select(column).distinct().repartitionByRange(1 << bits, column)
    ranges, seen = materialise(values.select(column, F.spark_partition_id().alias("range")), "buckets", {"top": F.max("range")})
    spread = F.floor(F.col("range") * (1 << bits) / F.lit((seen.get("top") or 0) + 1))
    return ranges.select(column, spread.cast("int").alias("bucket"))


def interleave(buckets: Sequence[Column], bits: int) -> Column:
    """Bits of several integer columns in turn, the highest first: near in the key means near in every column."""
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for i, b in enumerate(buckets):
            place = bit * len(buckets) + len(buckets) - 1 - i
            key = key.bitwiseOR(F.shiftleft(F.shiftright(b.cast("long"), bit).bitwiseAND(F.lit(1).cast("long")), place))
    return key


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = 6, max_rows: int = DIM_BROADCAST_ROWS) -> DataFrame:
    """``df`` with the sort key ``__z`` over ``columns`` (bits x columns must stay below 64)."""
    if bits * len(columns) > 63:
        raise ValueError("bits x columns must stay below 64")
    out = df
    for i, c in enumerate(columns):
        places = value_buckets(df, c, bits).select(F.col(c).alias(f"__v{i}"), F.col("bucket").alias(f"__b{i}"))
        out = out.join(bounded_broadcast(places, max_rows), F.col(c).eqNullSafe(F.col(f"__v{i}")), "left").drop(f"__v{i}")
    key = interleave([F.col(f"__b{i}") for i in range(len(columns))], bits)
    return out.withColumn("__z", key).drop(*[f"__b{i}" for i in range(len(columns))])


def rows_read(df: DataFrame) -> int:
    """Rows that the file scans behind ``df`` hand on: what is left after row groups were skipped.

    ``df`` is a scan with filters, without shuffles; it runs once, counted by the scans' own metrics.
    """
    plan = df.select(F.lit(1))._jdf.queryExecution().executedPlan()
    plan.execute().count()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()))
