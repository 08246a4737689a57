"""The corpus pipeline stage by stage, and its registration."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from llm_cases import edge_docs, label_rows, no_docs, prose
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tarmac.llm import mixing, quality, secrets, simhash
from tarmac.llm.common import read_documents, read_labels

SF = "/root/testdata/sf0.001"
NAMES = [name for name, _ in corpus_pipeline.STAGES]


def test_stages_and_registration():
    assert NAMES == ["quality_classifier", "simhash_near_dedup", "secret_scans", "source_mixing", "best_fit_packing"]
    found = __spark_entry__.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {k.split("_")[0] + "_" for k in found if k.startswith("op")}
    assert "pipeline" in found and "pipeline" not in __spark_entry__.oracle_sql()


@pytest.mark.parametrize("make", [edge_docs, no_docs])
def test_stages_on_edges(spark, make):
    docs = make(spark)
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        if name == "secret_scans":
            assert out.count() == n
        if not n:
            assert out.count() == 0


def test_the_driver_does_not_learn_the_classifier(spark):
    import tracemalloc

    texts = [prose(k, 40) for k in range(300)]
    docs = spark.createDataFrame([(k, t, None, None) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    labels = label_rows(spark, [(k, k % 2, 0) for k in range(300)])
    quality.fit(docs, labels)  # what Spark and the libraries keep
    tracemalloc.start()
    try:
        model = quality.fit(docs, labels)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < quality.TERMS ** 2 * 8 / 4  # the products alone took four times as much
    assert model.vectors.shape == (300, quality.AXES) and model.labels.tolist() == [0.0] * 150 + [1.0] * 150
    ids = [r[0] for r in docs.select("doc_id", F.xxhash64("doc_id", F.lit(17)).alias("h")).orderBy(F.col("doc_id") % 2, "h").collect()]
    here = quality.learn([texts[i] for i in ids], np.array([i % 2 for i in ids], np.float64))
    assert np.allclose(model.score(texts), here.score(texts), atol=1e-4) and model.prior == here.prior


def test_each_stage_does_its_operators_work(spark, tmp_path):
    docs = read_documents(spark, SF)

    def step(name, before):
        path = str(tmp_path / name)
        dict(corpus_pipeline.STAGES)[name](spark, before, SF).write.parquet(path)
        return spark.read.parquet(path)

    good = step("quality_classifier", docs)
    scored = quality.with_scores(docs, quality.fit(docs, read_labels(spark, SF)), "q").where("q >= 0.3")
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in scored.collect()}
    labels = read_labels(spark, SF).where("quality = 1")
    clean = docs.join(labels, "doc_id")
    assert good.join(labels, "doc_id").count() >= 0.95 * clean.count()

    single = step("simhash_near_dedup", good)
    groups = {r.component_id for r in simhash.component_table(good).collect()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(groups)

    safe = step("secret_scans", single)
    assert safe.count() == single.count()
    assert safe.where(F.col("text").rlike(r"(?i)token = \"[0-9a-f]{40}\"")).count() == 0
    assert safe.where(F.col("text").contains(secrets.REDACTED)).count() == single.where(F.col("text").rlike(r"(?i)token = \"[0-9a-f]{40}\"")).count()

    mixed = step("source_mixing", safe)
    drawn = mixing.draw(safe, ["doc_id"]).collect()
    times = {r.doc_id: r.taken // r["size"] for r in drawn if r["size"]}
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {i: n for i, n in times.items() if n}

    packed = step("best_fit_packing", mixed)
    assert packed.where("piece = 0").count() == mixed.count()


def test_the_packed_result_holds_its_tokens(spark):
    out = dict(corpus_pipeline.STAGES)["best_fit_packing"](spark, edge_docs(spark), SF)
    rows = out.select("length", "ids", "ids_crc32").collect()
    assert rows and all(len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<i4").tobytes()) == r.ids_crc32 for r in rows)
