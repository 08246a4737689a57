"""Incremental staging as a Structured Streaming job.

Bronze files are the stream source; ``trigger(availableNow=True)`` processes
everything that arrived since the last run and stops, so the job can be
scheduled like a batch. The streaming checkpoint (in the shared checkpoint
folder) remembers which files were processed, which replaces the
``max(_ingested_at)`` high-water-mark query. Each micro-batch is deduped
and cleaned by the batch staging model, and its winners are appended as
versions (``sinks.versions``): what a micro-batch reads and writes does not
depend on the table. The versions are the keyed state: a reader sees the
newest per surrogate key, so late files of older records change nothing, and
a micro-batch replayed after a failure takes its own place. When a run ends,
batches that have grown together are compacted.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.plans.staging import check_schema, stage
from tarmac.schemas import BRONZE, BRONZE_DECIMAL, STAGING_COLUMNS
from tarmac.session import work_dir
from tarmac.sinks import tables as sink
from tarmac.sinks.versions import append_versions, compact, due
from tarmac.sources.star_adapter import bronze_batch, reload_batch


def start_staging_stream(spark: SparkSession, bronze_dir: str, store: sink.Store, checkpoint: str,
                         normalise_first: bool = True):
    """Start (and return) an availableNow query from ``bronze_dir`` into ``store.staging``."""

    if store.exists("staging") and not store.governed("staging"):
        raise ValueError("staging was not written by a stream: its rows have no versions")

    stream = hashlib.md5(checkpoint.encode()).hexdigest()[:8]  # another checkpoint counts its epochs anew

    def append_winners(batch: DataFrame, epoch_id: int) -> None:
        staged = stage(batch, None, normalise_first=normalise_first)
        check_schema(staged)
        append_versions(staged, store, "staging", ["airline_delay_id"], label=f"epoch-{epoch_id:012d}-{stream}")

    source = spark.readStream.schema(BRONZE).parquet(bronze_dir)
    return (
        source.writeStream.foreachBatch(append_winners)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def compact_due(store: sink.Store) -> None:
    """Merge the stream's youngest batches where they have grown to the size of the one before."""
    if batches := due(store, "staging"):
        compact(store, "staging", batches)


def stream_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries arrive one after the other, the last an old one of other values
    that comes late; each run picks up only the new files. Batches are compacted after the second."""
    root = work_dir(spark, "stream")
    bronze_dir, checkpoint = f"{root}/bronze", f"{root}/_checkpoint"
    store = sink.Store(spark, f"{root}/tables")
    first = bronze_batch(spark, sf_dir)
    first.write.mode("append").parquet(bronze_dir)
    start_staging_stream(spark, bronze_dir, store, checkpoint).awaitTermination()
    reload_batch(spark.read.schema(BRONZE).parquet(bronze_dir)).write.mode("append").parquet(bronze_dir)
    start_staging_stream(spark, bronze_dir, store, checkpoint).awaitTermination()
    compact_due(store)
    late = bronze_batch(spark, sf_dir).withColumn("arr_flights", (F.col("arr_flights") + 7).cast(BRONZE_DECIMAL)).withColumn(
        "_ingested_at", F.col("_ingested_at") - F.expr("INTERVAL 365 DAYS"))
    late.select([f.name for f in BRONZE.fields]).write.mode("append").parquet(bronze_dir)
    start_staging_stream(spark, bronze_dir, store, checkpoint).awaitTermination()
    return store.read("staging").select(*STAGING_COLUMNS)
