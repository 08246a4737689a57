"""File layout: bloom filters exist and skip, interleaved order skips by every column, clustering is measured."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tarmac.sinks import layout
from tarmac.sinks import tables as sink


def fact(spark, n=6000):
    rng = random.Random(2)
    return spark.createDataFrame([(2024, f"C{rng.randrange(24):02d}", f"A{rng.randrange(24):02d}", 202401 + rng.randrange(12), i) for i in range(n)],
                                 "year int, carrier string, airport string, month_key int, v int")


def test_bloom_filters_exist_only_where_asked_and_skip(spark, store):
    df = fact(spark)
    sink.write_layout(df, store, "b", sort_cols=("month_key",), bloom_cols=("carrier",), chunk_size=1000)
    told = {(r.file, r.row_group, r.column): r for r in layout.footers(store.read("b"), ["carrier", "airport"]).collect()}
    assert len(told) >= 12 and all(r.has_bloom == (c == "carrier") for (_, _, c), r in told.items())
    assert sum(r.rows for r in told.values()) == 2 * 6000 and {r.min_value for r in told.values()} <= {"C00", "A00", "A01", "C01"}
    inside = "C07x"  # between existing codes: value ranges cannot exclude it
    assert layout.rows_read(store.read("b").where(F.col("carrier") == inside)) == 0
    assert layout.rows_read(store.read("b").where(F.col("carrier") == "C07")) > 0


def test_interleave_bits():
    def plain(values, bits):
        out = 0
        for bit in reversed(range(bits)):
            for v in values:
                out = out << 1 | v >> bit & 1
        return out

    from itertools import product

    assert plain((0b10, 0b01), 2) == 0b1001
    for values in product(range(4), repeat=3):
        assert plain(values, 2) == sum((v >> b & 1) << (3 * b + 2 - i) for i, v in enumerate(values) for b in range(2))


def test_interleaved_key_matches_plain_python(spark):
    df = fact(spark, 800)
    places = {c: {r[0]: r.bucket for r in layout.value_buckets(df, c, 3).collect()} for c in ("carrier", "airport", "month_key")}
    for found in places.values():
        ranked = [found[v] for v in sorted(found)]
        assert ranked == sorted(ranked) and len(set(ranked)) > 4 and max(ranked) == 7
    for r in layout.interleaved(df, ["carrier", "airport", "month_key"], bits=3).collect():
        values = [places[c][r[c]] for c in ("carrier", "airport", "month_key")]
        assert r["__z"] == sum((v >> b & 1) << (3 * b + 2 - i) for i, v in enumerate(values) for b in range(3))
    nulls = spark.createDataFrame([(None, 1), ("b", 2)], "c string, v int")
    assert layout.interleaved(nulls, ["c"], bits=2).count() == 2


def test_interleaved_layout_skips_by_every_column_and_linear_does_not(spark, store):
    df = fact(spark)
    columns = ["carrier", "airport", "month_key"]
    values = None
    for c in columns:
        some = df.select(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")).distinct()
        values = some if values is None else values.unionByName(some)
    shares = {}
    for name, z in (("z", True), ("linear", False)):
        sink.write_layout(df, store, name, sort_cols=columns, bloom_cols=(), chunk_size=120, interleave=z)
        shares[name] = {r.column: r.skipped for r in layout.skipped_share(layout.footers(store.read(name), columns), values).collect()}
        assert store.read(name).count() == 6000 and "__z" not in store.read(name).columns
    assert min(shares["z"].values()) > 0.4, shares
    assert shares["linear"]["carrier"] > 0.8 and shares["linear"]["month_key"] < 0.2


def test_clustering_finds_disorder_and_overlap(spark, store):
    df = fact(spark, 3000).dropDuplicates(["carrier", "airport", "month_key"])
    sort = ["carrier", "airport", "month_key"]
    sink.write_layout(df, store, "sorted", sort_cols=sort, bloom_cols=(), chunk_size=300)
    good = layout.clustering(store.read("sorted"), sort).first()
    assert (good.row_count, good.out_of_order, good.overlap_depth) == (df.count(), 0, 1) and good.files > 5
    df.repartition(4, "v").write.partitionBy("year").saveAsTable(store.name("heap"))
    bad = layout.clustering(store.read("heap"), sort).first()
    assert bad.out_of_order > 500 and bad.overlap_depth == 4 == bad.files
