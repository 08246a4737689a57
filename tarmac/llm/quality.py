"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

Terms are hashed byte trigrams plus a few repetition terms; a bounded sample
of labelled documents (``per_class`` rows of each label, chosen by hash) gives
the idf weights, the latent axes (leading eigenvectors of the weighted
term-term matrix) and the labelled vectors. All three have a fixed size and
are broadcast; every document is then projected, compared with every labelled
vector in blocks (exact cosines), and scored by the labels of its nearest
neighbours, each weighted by its similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import fold, text_or_empty

TERMS = 2048
AXES = 64
NEIGHBOURS = 25
PER_CLASS = 1500
BLOCK = 256
#: bytes whose trigrams are counted at once
CHUNK = 1 << 20
#: last columns of the term space: repetition terms
REPEATS = 8


def _pieces(raw: list[bytes]) -> Iterator[list[tuple[int, bytes]]]:
    """(text, bytes) pieces in lots of about CHUNK bytes; a longer text is cut, two bytes shared at each cut."""
    lot, held = [], 0
    for i, b in enumerate(raw):
        for at in range(0, max(1, len(b) - 2), CHUNK):
            piece = b[at:at + CHUNK + 2]
            if lot and held + len(piece) > CHUNK:
                yield lot
                lot, held = [], 0
            lot.append((i, piece))
            held += len(piece)
    if lot:
        yield lot


def term_counts(texts: list[str]) -> np.ndarray:
    """Log-damped term counts, one row per text; memory beyond the rows is bounded, however long a text."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    counts = np.zeros((len(raw), TERMS), np.float32)
    for lot in _pieces(raw):
        flat = np.frombuffer(b"".join(b for _, b in lot), np.uint8).astype(np.uint32)
        if len(flat) < 3:
            continue
        piece = np.repeat(np.arange(len(lot)), [len(b) for _, b in lot])
        code = (flat[:-2] << 16) | (flat[1:-1] << 8) | flat[2:]
        term = ((code * np.uint32(2654435761)) >> np.uint32(8)) % np.uint32(TERMS - REPEATS)
        inside = piece[:-2] == piece[2:]
        first, last = lot[0][0], lot[-1][0]  # neighbours in the list of texts
        text = np.array([i - first for i, _ in lot])
        found = np.bincount(text[piece[:-2][inside]] * TERMS + term[inside], minlength=(last - first + 1) * TERMS)
        counts[first:last + 1] += found.reshape(-1, TERMS)
    counts = np.log1p(counts)
    for i, b in enumerate(raw):
        words = b.split()
        if len(words) > 1:
            n = len(words)
            same = sum(map(eq, words, words[1:])) / (n - 1)
            distinct = len(set(words)) / n
            scale = np.sqrt((counts[i] ** 2).sum())  # as heavy as all trigrams together when total
            counts[i, TERMS - 1] = scale * same
            counts[i, TERMS - 2] = scale * max(0.0, 0.5 - distinct)
    return counts


#: a model's arrays and their types, as the learning task sends them
PARTS = {"weights": np.float32, "axes": np.float32, "vectors": np.float32, "labels": np.float64}


@dataclass
class Model:
    weights: np.ndarray  # idf per term
    axes: np.ndarray     # term x axis
    vectors: np.ndarray  # labelled sample x axis, unit length
    labels: np.ndarray   # 0 / 1
    prior: float

    def project(self, texts: list[str]) -> np.ndarray:
        out = (term_counts(texts) * self.weights) @ self.axes
        return out / np.maximum(np.sqrt((out ** 2).sum(axis=1, keepdims=True)), 1e-12)

    def score(self, texts: list[str]) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest labelled vectors."""
        scores = np.full(len(texts), self.prior)
        if not len(self.labels):
            return scores
        k = min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(texts), BLOCK):
            cosine = self.project(texts[at:at + BLOCK]) @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0.0).astype(np.float64) ** 4
            total = weight.sum(axis=1)
            vote = (weight * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-300)
            scores[at:at + BLOCK] = np.where(total > 1e-9, vote, self.prior)
        return scores


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Model:
    """Learn from a bounded sample: per label the ``per_class`` documents least by hash.

    Rows without a label are ignored; a doc_id labelled twice counts by its
    highest label; of repeated documents one text is used. Without any labelled
    document every score is 0.5. One task learns from the sample: its texts, counts
    and products stay out of the driver.
    """
    judged = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("__label")))
    order = [F.xxhash64("doc_id", F.lit(17)), F.col("doc_id")]
    # twice the sample size, as labels may name documents that are not there
    chosen = None
    for value in (0, 1):
        part = judged.where(F.col("__label") == value).orderBy(*order).limit(2 * per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = F.broadcast(chosen.select(F.col("doc_id").alias("__id"), "__label"))  # at most 4 x per_class rows
    sample = (docs.select("doc_id", text_or_empty().alias("text")).join(chosen, F.col("doc_id") == F.col("__id"))
              .groupBy("doc_id", "__label").agg(F.min("text").alias("text")))
    sample = sample.withColumn("h", F.xxhash64("doc_id", F.lit(17)))
    both = [sample.where(F.col("__label") == value).orderBy("h", "doc_id").limit(per_class) for value in (0, 1)]
    rows = both[0].unionByName(both[1]).coalesce(1).sortWithinPartitions("__label", "h", "doc_id").select("text", "__label")

    def learnt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, known = [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            known += batch.column(1).to_pylist()
        if texts:
            model = learn(texts, np.array(known, np.float64))
            yield pa.record_batch([pa.array([getattr(model, p).tobytes()], pa.binary()) for p in PARTS], names=list(PARTS))

    # at most 2 x per_class texts, in one task; the driver gets the model, which has a fixed size
    made = rows.mapInArrow(learnt, ", ".join(f"{p} binary" for p in PARTS)).first()
    if made is None:
        return learn([], np.zeros(0))
    weights, axes, vectors, known = (np.frombuffer(made[p], kind) for p, kind in PARTS.items())
    return Model(weights, axes.reshape(-1, AXES), vectors.reshape(-1, AXES), known, float(known.mean()))


def learn(texts: list[str], labels: np.ndarray) -> Model:
    if not texts:
        empty = np.zeros((0, AXES), np.float32)
        return Model(np.zeros(TERMS, np.float32), np.zeros((TERMS, AXES), np.float32), empty, labels, 0.5)
    counts = np.empty((len(texts), TERMS), np.float32)
    for i in range(0, len(texts), BLOCK):
        counts[i:i + BLOCK] = term_counts(texts[i:i + BLOCK])
    weights = np.log((1 + len(texts)) / (1 + np.count_nonzero(counts, axis=0))).astype(np.float32) + np.float32(0.1)
    for i in range(0, len(texts), BLOCK):  # in place: the sample's counts are held once
        part = counts[i:i + BLOCK]
        part *= weights
        part /= np.maximum(np.sqrt((part ** 2).sum(axis=1, keepdims=True)), 1e-12)
    products = (counts.T @ counts).astype(np.float64)
    del counts, part
    axes = np.linalg.eigh(products)[1][:, ::-1][:, :AXES]
    model = Model(weights, np.ascontiguousarray(axes).astype(np.float32), np.zeros((0, AXES), np.float32),
                  labels, float(labels.mean()))
    del axes, products
    model.vectors = np.concatenate([model.project(texts[i:i + BLOCK]) for i in range(0, len(texts), BLOCK)])
    return model


def with_scores(docs: DataFrame, model: Model, name: str, text: str = "text") -> DataFrame:
    """``docs`` plus column ``name``, 0 to 1. Null and empty texts, which resemble
    nothing, get the sample's share of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(  # fixed size: TERMS x AXES + 2 x per_class x AXES floats
        (model.weights, model.axes, model.vectors, model.labels, model.prior))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Model(*shared.value)  # plain values travel; workers need not have this package
        for batch in batches:
            yield pd.Series(known.score(batch.tolist()))

    return docs.withColumn(name, score(text_or_empty(text)))


def quality_table(docs: DataFrame, labels: DataFrame, held_out_folds: int = 5, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs``; learns only from rows not held out.

    Repeated rows are scored each; an empty table gives no rows. Among labelled
    vectors of equal similarity at the last place, the partial sort's choice
    counts, which depends on the sample alone. Very long texts are counted whole,
    in pieces. See ``with_scores`` for null and empty texts.
    """
    model = fit(docs, labels.where(fold(F.col("doc_id"), held_out_folds) != 0))
    scored = with_scores(docs.select("doc_id", "text"), model, "score")
    return scored.select("doc_id", (fold(F.col("doc_id"), held_out_folds) == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``; learns from all labels."""
    return with_scores(docs, fit(docs, labels), "__quality").where(F.col("__quality") >= threshold).select(*docs.columns)
