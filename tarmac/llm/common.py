"""Shared helpers: the documents contract, stable row ids, ordered running totals."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tarmac.plans.layers import materialise

# The word rule of the contracts (ASCII white space separates).
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

UID = "__uid"


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def read_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A public tokenizer's file; an installed package names its place."""
    import public_tokenizers

    return public_tokenizers.path(name)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def with_row_ids(df: DataFrame, label: str) -> DataFrame:
    """``df`` plus a unique row id, written to the shared folder and read back.

    The id is fixed by the write, so later jobs (also after an executor is
    lost) see the same id for the same row; repeated rows and null doc_ids
    stay apart.
    """
    return materialise(df.withColumn(UID, F.monotonically_increasing_id()), label)


def running_totals(df: DataFrame, order: list[Column], sums: dict[str, Column], label: str) -> DataFrame:
    """Ordered running sums over a whole table without a one-task window.

    Range partitions hold consecutive rows; each one's totals (one row per
    partition) give the offset of the next. Adds, per name, the sum over all
    rows before this one. Ties in ``order`` are kept in one partition, in any order.
    """
    parts = materialise(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), label)
    each = parts.groupBy("__part").agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = each.select("__part", *[F.coalesce(F.sum(f"__{n}").over(before), F.lit(0)).alias(f"__off_{n}") for n in sums])
    within = W.partitionBy("__part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    out = parts.join(offsets, "__part")
    for n, c in sums.items():
        out = out.withColumn(n, F.col(f"__off_{n}") + F.coalesce(F.sum(c).over(within), F.lit(0)))
    return out.drop("__part", *[f"__off_{n}" for n in sums])


def fresh(prefix: str) -> str:
    """A column or view name no input can carry."""
    return f"__{prefix}_{uuid.uuid4().hex[:8]}"


def total_bytes(df: DataFrame, column: str = "text") -> tuple[int, int]:
    """(rows, UTF-8 bytes) of a text column: one pass, one row to the driver."""
    row = df.select(F.octet_length(text_or_empty(column)).alias("b")).agg(F.count(F.lit(1)), F.sum("b")).first()
    return row[0], row[1] or 0


def in_parts(batches: Iterator[pa.RecordBatch], texts: int = 2_000) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most so many rows, in their order."""
    for batch in batches:
        for at in range(0, batch.num_rows, texts):
            yield batch.slice(at, texts)
