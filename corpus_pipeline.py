"""The corpus pipeline: documents through five of the training-data operators.

Each stage is a function (spark, docs, sf_dir) -> DataFrame whose result is
written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``documents``. Every stage copes with null columns,
empty and very long texts, repeated rows, empty tables and extra columns
(kept up to the last stage); see the operators for the defined results.

A stage leaves tables in the shared work folder that its lazy result reads.
When the next stage starts on the same corpus, that result has been written and read
again, and those tables go, unless its ``docs`` still read them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tarmac.llm import mixing, packing, quality, secrets, simhash
from tarmac.llm.common import read_documents, read_labels, tokenizer_path
from tarmac.plans.layers import materialise
from tarmac.session import configure, drop_work, work_dirs_made

#: work folders of the stage that ran last, by corpus
_left: dict[str, list[str]] = {}


def _stage(fn: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    @wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        configure(spark)
        left = drop_work(spark, _left.pop(sf_dir, []), docs)
        with work_dirs_made() as made:
            out = fn(spark, docs, sf_dir)
        _left[sf_dir] = left + made
        return out

    return run


@_stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scoring under 0.3 go; the others stay as they are."""
    return quality.keep_good(docs, read_labels(spark, sf_dir), threshold=0.3)


@_stage
def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked within 4 bits over 4-word shingles, the least doc_id stays."""
    return simhash.keep_one(docs, shingle=4, radius=4)


@_stage
def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found secrets are replaced in the text; no document goes."""
    return secrets.redact(docs)


@_stage
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: repeated rows, or none."""
    return mixing.mix(docs)


@_stage
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mixed documents with their token ids, packed into sequences of 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_path(), capacity=2048, with_ids=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scans", secret_scans),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

# SQL cannot express the classifier, the forest and the tokenizer; tests hold
# the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read back; a stage's
    output goes when the next one's is written."""
    docs, written = read_documents(spark, sf_dir), []
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        with work_dirs_made() as made:
            docs = materialise(out, name)
        drop_work(spark, written, docs)
        written = made
    return STAGES[-1][1](spark, docs, sf_dir)
