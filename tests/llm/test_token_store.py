"""Token-id files: ids by the untouched tokenizer, order, blocks, lookups, edge cases."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import edge_docs, edge_rows, no_docs, prose
from tarmac.llm import token_store
from tarmac.llm.common import tokenizer_path
from tarmac.session import work_dir

PATH = tokenizer_path("word_bpe_49k.json")


def expected(texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(PATH)
    return [[*e.ids, 1] for e in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.fixture()
def many_parts(spark):
    """Small shuffles stay in as many parts as a large one has."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_edge_rows_round_trip(spark):
    rows = [(r[0], r[1]) for r in edge_rows()]
    got = token_store.token_table(edge_docs(spark), PATH, 1).collect()
    assert sorted(((g.doc_id or -1, g.n_tokens, g.ids_crc32) for g in got)) == sorted(
        (i or -1, len(ids), crc(ids)) for (i, _), ids in zip(rows, expected(t for _, t in rows), strict=True))
    ordered = sorted(got, key=lambda g: g.start)
    ids = [g.doc_id for g in ordered]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)  # null first, then ascending
    assert [g.start for g in ordered] == list(np.cumsum([0, *[g.n_tokens for g in ordered[:-1]]]))


def test_odd_texts_match_the_untouched_tokenizer(spark):
    texts = ["a <|endoftext|> b", "<|startoftext|>x<|endoftext|>", "é ́lan", " wide space line", "İSTANBUL ΣΣ",
             "it's we'll 'S 12 3½", "\x1c\x1d \x85 \x0b\x0c", "\U0001f600\U0001f468‍\U0001f469", "don't\tstop\r\nnow", "'", " ' s"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = token_store.write_store(docs, work_dir(spark, "store"), PATH, 1)
    got = {r.doc_id: r.ids for r in token_store.read_store(spark, path, with_ids=True).collect()}
    assert got == dict(enumerate(expected(texts)))


def test_parts_met_again_are_encoded_once(monkeypatch):
    monkeypatch.setattr(token_store, "CACHE_WORDS", 50)
    encoder = token_store.Encoder(PATH)
    sent: list[str] = []
    real = encoder._new_tokens
    monkeypatch.setattr(encoder, "_new_tokens", lambda parts: (sent.extend(parts), real(parts))[1])
    lots = [["  it's Ünder 3½ ", "", "\n", "don't' '' 12", "aé\x0bb"], *[[prose(k, 300, 80) for k in range(3)]] * 2, ["it's new here", "日本 it's"]]
    for texts in lots:  # the cache starts afresh on the way
        ids = [[*np.frombuffer(b, f"<u{encoder.width}").tolist(), 1] for b in encoder.encode(texts)]
        assert ids == expected(texts)
    assert len(encoder.older) > 50 and len(sent) > 200
    assert len(sent) == len(set(sent))


def test_small_blocks_and_lookup(spark, many_parts):
    texts = [prose(i, 5 + 37 * i % 300) for i in range(300)]
    docs = spark.createDataFrame([(i * 7 % 300, texts[i * 7 % 300]) for i in range(300)], "doc_id long, text string").repartition(5)
    path = token_store.write_store(docs, work_dir(spark, "store"), PATH, 1, block_bytes=2_000)
    blocks = spark.read.parquet(f"{path}/blocks")
    assert blocks.count() > 20 and blocks.select("part").distinct().count() > 1
    assert blocks.select(F.max(F.octet_length("data"))).first()[0] < 4_000
    want, start = expected(texts), 0
    for r in token_store.read_store(spark, path).orderBy("start").collect():
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(want[r.doc_id]), crc(want[r.doc_id]))
        start += r.n_tokens
    asked = spark.createDataFrame([(5,), (250,), (250,), (999,)], "doc_id long")
    assert {r.doc_id: r.ids for r in token_store.lookup(spark, path, asked).collect()} == {5: want[5], 250: want[250]}
    dictionary = spark.read.parquet(f"{path}/dictionary").first()
    assert dictionary.id_width == 2 and dictionary.end_id == 1 and len(dictionary.dictionary) > 1000


def test_many_rows_of_one_id_spread_over_parts(spark, many_parts):
    docs = spark.createDataFrame([(None if i % 3 else i, prose(i % 50, 30)) for i in range(600)], "doc_id long, text string").repartition(6)
    path = token_store.write_store(docs, work_dir(spark, "store"), PATH, 1, block_bytes=1_000)
    nulls = token_store.index(spark, path).where("doc_id IS NULL").groupBy("part").count().collect()
    assert sum(r["count"] for r in nulls) == 400 and len(nulls) > 1
    got = token_store.read_store(spark, path).orderBy("start").collect()
    assert [g.start for g in got] == list(np.cumsum([0, *[g.n_tokens for g in got[:-1]]]))


def test_empty_table_and_foreign_dictionary(spark):
    assert token_store.token_table(no_docs(spark), PATH, 1).collect() == []
    docs = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    path = token_store.write_store(docs, work_dir(spark, "store"), PATH, 1)
    data = bytes(spark.read.parquet(f"{path}/blocks").first().data)
    with pytest.raises(ValueError):
        token_store.offsets_of(data, b"12345678")


def test_string_ids(spark):
    docs = spark.createDataFrame([("b", "one"), ("a", "two words")], "doc_id string, text string")
    got = token_store.token_table(docs, PATH, 1).orderBy("start").collect()
    assert [g.doc_id for g in got] == ["a", "b"]
