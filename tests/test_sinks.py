import pytest
from pyspark.sql import functions as F

from tarmac.sinks import tables as sink


def frame(spark, rows):
    return spark.createDataFrame(rows, "airline_delay_id string, year int, v int")


def rows_of(store, table):
    return sorted(tuple(r) for r in store.read(table).select("airline_delay_id", "year", "v").collect())


def test_append_counts_and_doubles_on_rerun(spark, store):
    df = frame(spark, [("a", 2024, 1), ("b", 2024, 2)])
    assert sink.append(df, store, "bronze") == 2
    assert sink.append(df, store, "bronze") == 2
    assert store.read("bronze").count() == 4
    assert sink.append(df.limit(0), store, "bronze") == 0


def test_full_reload_replaces_and_empty_truncates(spark, store):
    sink.full_reload(frame(spark, [("a", 2024, 1)]), store, "dim")
    sink.full_reload(frame(spark, [("b", 2024, 2)]), store, "dim")
    assert rows_of(store, "dim") == [("b", 2024, 2)]
    sink.full_reload(frame(spark, [("b", 2024, 2)]).limit(0), store, "dim")
    assert store.read("dim").count() == 0
    with pytest.raises(ValueError):
        sink.full_reload(frame(spark, []), store, "dim", chunk_size=0)


def test_replace_slice_idempotent_and_empty_slice_clears(spark, store):
    df = frame(spark, [("a", 2023, 1), ("b", 2024, 2), ("c", 2024, 3)])
    sink.replace_slice(df, store, "fact", 2023)
    sink.replace_slice(df, store, "fact", 2024)
    sink.replace_slice(df, store, "fact", 2024)
    assert rows_of(store, "fact") == [("a", 2023, 1), ("b", 2024, 2), ("c", 2024, 3)]
    sink.replace_slice(df.where(F.col("year") != 2024), store, "fact", 2024)  # the year vanished upstream
    assert rows_of(store, "fact") == [("a", 2023, 1)]


def test_replace_slices_one_job_with_empty_year(spark, store):
    df = frame(spark, [("a", 2023, 1), ("b", 2024, 2)])
    sink.replace_slices(df, store, "fact", [2023, 2024])
    sink.replace_slices(frame(spark, [("z", 2024, 9)]), store, "fact", [2023, 2024])
    assert rows_of(store, "fact") == [("z", 2024, 9)]


def test_upsert_replaces_keys_in_touched_partitions_only(spark, store):
    sink.upsert(frame(spark, [("a", 2023, 1), ("b", 2024, 2), ("c", 2024, 3)]), store, "staging")
    batch = frame(spark, [("b", 2024, 20), ("d", 2024, 4)])
    sink.upsert(batch, store, "staging")
    sink.upsert(batch, store, "staging")  # replay is harmless
    assert rows_of(store, "staging") == [("a", 2023, 1), ("b", 2024, 20), ("c", 2024, 3), ("d", 2024, 4)]


def test_write_layout_partitions_by_year_and_prunes(spark, store):
    from engine_helpers import plan_text

    df = spark.createDataFrame([(y, f"K{i}", f"A{i}", y * 100 + 1, "AA", "JFK") for y in (2023, 2024) for i in range(5)],
                               "year int, carrier_key string, airport_key string, date_key int, carrier string, "
                               "airport string")
    assert sink.write_layout(df, store, "fact", chunk_size=3) == 10
    read = store.read("fact").where(F.col("year") == 2024).select("carrier_key")
    plan = plan_text(read)
    assert "PartitionFilters: [isnotnull(year" in plan and "(year#" in plan
    assert read.count() == 5


def test_jdbc_argument_checks(spark):
    from tarmac.sources.jdbc import read_jdbc

    with pytest.raises(ValueError):
        sink.write_jdbc(spark.range(1), "jdbc:none", "t", chunk_size=0)
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none", "t", partition_column="id", lower_bound=0, upper_bound=10, num_partitions=0)


def test_bloom_filter_layout_point_lookup(spark, store):
    df = spark.createDataFrame([(2024, f"K{i}", "A", 202401, f"C{i % 7}", "JFK") for i in range(50)],
                               "year int, carrier_key string, airport_key string, date_key int, carrier string, "
                               "airport string")
    sink.write_layout(df, store, "fact_bloom", bloom_cols=("carrier",))
    hit = store.read("fact_bloom").where(F.col("carrier") == "C3")
    from engine_helpers import plan_text

    assert "PushedFilters: [IsNotNull(carrier), EqualTo(carrier,C3)]" in plan_text(hit)
    assert hit.count() == len([i for i in range(50) if i % 7 == 3])


def test_sample_rows_is_seeded_and_independent_of_partitioning(spark):
    import hashlib

    from tarmac.operators.sample import sample_rows

    df = spark.range(500).select(F.format_string("id-%d", "id").alias("k"), F.col("id").alias("v"))
    got = [r.k for r in sample_rows(df, 7, "k", seed=3).collect()]
    again = [r.k for r in sample_rows(df.repartition(5), 7, "k", seed=3).collect()]
    brute = sorted((hashlib.md5(f"id-{i}3".encode()).hexdigest(), f"id-{i}") for i in range(500))[:7]
    assert got == again == [k for _, k in brute]
    assert got != [r.k for r in sample_rows(df, 7, "k", seed=4).collect()]
    with pytest.raises(ValueError):
        sample_rows(df, 0, "k")


def test_scratch_table_is_dropped_even_on_failure(spark, store):
    df = spark.range(10)
    with sink.scratch_table(df, store, "tmp") as written:
        assert written.count() == 10
    with pytest.raises(RuntimeError):
        with sink.scratch_table(df, store, "tmp"):
            raise RuntimeError("job failed")
    assert [t.name for t in spark.catalog.listTables(store.database) if "__scratch_" in t.name] == []
