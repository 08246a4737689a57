"""Registered queries of the subpackage: one thin query per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tarmac.llm import (
    conversations, imatch, langid, line_rules, lm, mixing, packing, quality, repeats, secrets, simhash, spelling, token_store)
from tarmac.llm.common import read_documents, read_labels, tokenizer_path


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, as labels.quality marks it; learnt from rows outside fold 0 of 5."""
    return quality.quality_table(read_documents(spark, sf_dir), read_labels(spark, sf_dir))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document, by weighted sources and whole epochs."""
    drawn = mixing.draw(read_documents(spark, sf_dir), ["doc_id"])
    return drawn.select("doc_id", "size", "source_size", "target", "taken")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 4-word shingles, links within 4 bits."""
    return simhash.component_table(read_documents(spark, sf_dir), shingle=4, radius=4)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 2048 tokens, with their group's certificate."""
    return packing.pack_documents(read_documents(spark, sf_dir), tokenizer_path(), capacity=2048, certificate=True).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "bins", "bound")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document, learnt from rows outside fold 0 of 10."""
    return lm.lm_table(read_documents(spark, sf_dir))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from rows outside fold 1 of 3."""
    return langid.language_table(read_documents(spark, sf_dir))


def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line and word counts of every document and the verdict without frequent lines of its host."""
    return line_rules.line_rules(read_documents(spark, sf_dir))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate secrets of every document with the forest's score."""
    return secrets.secret_table(read_documents(spark, sf_dir))


def op9_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match signatures of every document, its edited text and the next document."""
    return imatch.fingerprint_table(read_documents(spark, sf_dir))


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without 200-byte passages that stand elsewhere."""
    return repeats.repeat_table(read_documents(spark, sf_dir), length=200)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired hash of every conversation, after seeded damage."""
    return conversations.repair_table(spark.read.parquet(f"{sf_dir}/conversations.parquet"), with_damage=True)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words one edit apart, with their far more frequent form and its root, after seeded damage."""
    return spelling.variant_table(read_documents(spark, sf_dir), min_length=7, min_count=2, ratio=10, damage=31)


def op13_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, as read back from the token store's files."""
    return token_store.token_table(read_documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), end_id=1)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over documents."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    fn.__name__: fn for fn in (
        op1_quality_classifier, op2_source_mix, op3_simhash_near_dedup, op4_best_fit_packing, op5_lm_scoring, op6_language_id,
        op7_line_rules, op8_secret_scan, op9_imatch_fingerprints, op10_repeated_passages,
        op11_conversation_repair, op12_spelling_variants, op13_token_store, pipeline)
}
