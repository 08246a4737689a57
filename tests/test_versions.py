"""Tables of versions: merge on read, compaction, replays, what a micro-batch writes."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from engine_helpers import SF_SMALL
from tarmac.sinks import versions as V
from tarmac.sinks.commits import CommitConflict


def batch(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, t int").withColumn(
        "_ingested_at", F.timestamp_seconds("t")).drop("t")


def shown(df):
    return sorted(((r.k, r.v) for r in df.collect()), key=str)


def newest(batches):
    best, loose = {}, []
    for i, rows in enumerate(batches):
        for k, v, t in rows:
            if k is None:
                loose.append((k, v))
            else:
                rank = (t is None, t or 0, i)
                if k not in best or rank >= best[k][0]:
                    best[k] = (rank, v)
    return sorted([(k, v) for k, (_, v) in best.items()] + loose, key=str)


def test_reads_equal_the_newest_versions_through_compactions(spark, store):
    rng = random.Random(4)
    batches, whole = [], None
    for i in range(6):
        rows = [(rng.choice([f"k{j}" for j in range(30)]), 100 * i + n, rng.choice([1, 2, 3, None])) for n in range(40 - 6 * i)]
        rows = list({r[0]: r for r in rows}.values()) + [(None, -i, 1)]
        batches.append(rows)
        V.append_versions(batch(spark, rows), store, "t", ["k"])
        whole = newest(batches)
        assert shown(store.read("t")) == whole
    labels = sorted(store.log.head().parts("t"))
    old = store.read("t")
    got = V.compact(store, "t", labels[2:5])
    assert got.batches == 3 and got.rows_after < got.rows_before and shown(store.read("t")) == whole
    V.compact(store, "t", files=1)
    assert shown(store.read("t")) == whole == shown(old)  # a reader of the old version is not disturbed
    assert len(store.log.head().parts("t")) == 1 and len(store.read("t").inputFiles()) < len(old.inputFiles())
    with pytest.raises(ValueError):
        V.compact(store, "t", ["nothing"])
    store.log.vacuum(keep=1, min_age=0)
    assert shown(store.read("t")) == whole


def test_a_batch_that_arrives_during_a_compaction_is_kept(spark, store, monkeypatch):
    for v in (1, 2):
        V.append_versions(batch(spark, [("a", v, v), (f"b{v}", v, v)]), store, "t", ["k"])
    commit = store.log.commit

    def later(staged, base, properties=None):
        monkeypatch.setattr(store.log, "commit", commit)
        V.append_versions(batch(spark, [("a", 9, 9)]), store, "t", ["k"])
        return commit(staged, base, properties)

    monkeypatch.setattr(store.log, "commit", later)
    V.compact(store, "t")
    assert shown(store.read("t")) == [("a", 9), ("b1", 1), ("b2", 2)] and len(store.log.head().parts("t")) == 2


def test_two_compactions_of_the_same_batches_cannot_both_land(spark, store, monkeypatch):
    for v in (1, 2):
        V.append_versions(batch(spark, [("a", v, v)]), store, "t", ["k"])
    commit = store.log.commit

    def second(staged, base, properties=None):
        monkeypatch.setattr(store.log, "commit", commit)
        V.compact(store, "t")
        return commit(staged, base, properties)

    monkeypatch.setattr(store.log, "commit", second)
    with pytest.raises(CommitConflict):
        V.compact(store, "t")
    assert shown(store.read("t")) == [("a", 2)]


def test_a_replayed_batch_takes_its_own_place(spark, store):
    rows = [("a", 1, 1), (None, 5, 1)]
    for _ in range(2):
        V.append_versions(batch(spark, rows), store, "t", ["k"], label="epoch-1")
    assert shown(store.read("t")) == [("a", 1), (None, 5)] and len(store.log.head().parts("t")) == 1


def test_a_replay_after_a_compaction_writes_nothing(spark, store):
    for i, rows in enumerate(([("a", 1, 1), (None, 5, 1)], [("a", 2, 2), (None, 6, 1)], [("b", 3, 3)])):
        V.append_versions(batch(spark, rows), store, "t", ["k"], label=f"epoch-{i}")
    V.compact(store, "t", ["epoch-0", "epoch-1"])
    V.compact(store, "t", sorted(store.log.head().parts("t")))
    whole = shown(store.read("t"))
    for label in ("epoch-0", "epoch-1", "epoch-2"):
        assert V.append_versions(batch(spark, [("a", 1, 1), (None, 5, 1)]), store, "t", ["k"], label=label) == 0
    assert shown(store.read("t")) == whole == [("a", 2), ("b", 3), (None, 5), (None, 6)]
    V.append_versions(batch(spark, [("a", 4, 4)]), store, "t", ["k"], label="epoch-3")
    assert ("a", 4) in shown(store.read("t"))


def test_merges_are_due_when_young_batches_reach_the_older_one(spark, store):
    for i, n in enumerate((64, 8, 8)):
        V.append_versions(batch(spark, [(f"{i}-{j}", j, i) for j in range(n)]), store, "t", ["k"])
    assert len(V.due(store, "t")) == 2
    V.compact(store, "t", V.due(store, "t"))
    assert sorted(e["rows"] for e in store.log.head().parts("t").values()) == [16, 64]


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="driver data missing")
def test_a_micro_batch_writes_its_own_rows_only(spark):
    from tarmac.session import work_dir
    from tarmac.sinks.tables import Store
    from tarmac.sources.star_adapter import bronze_batch
    from tarmac.streaming.staging_stream import start_staging_stream

    root = work_dir(spark, "stream-rows")
    store = Store(spark, f"{root}/tables")
    first = bronze_batch(spark, SF_SMALL)
    first.write.parquet(f"{root}/bronze")
    start_staging_stream(spark, f"{root}/bronze", store, f"{root}/_ckpt").awaitTermination()
    whole = store.read("staging").count()
    assert whole == first.count()
    some = first.where("year = 1998 AND month = 3").withColumn("_ingested_at", F.col("_ingested_at") + F.expr("INTERVAL 1 DAY"))
    some.write.mode("append").parquet(f"{root}/bronze")
    start_staging_stream(spark, f"{root}/bronze", store, f"{root}/_ckpt").awaitTermination()
    parts = store.log.head().parts("staging")
    assert sorted(e["rows"] for e in parts.values()) == sorted([whole, some.count()]) and some.count() < whole / 20
    assert store.read("staging").count() == whole
    store.drop()
