"""Language ID: multinomial naive Bayes over hashed character n-grams.

Gram counts come from every training document (one row per language and
occupied slot from each task, summed by Spark). The log-probability matrix
(languages x slots) is broadcast; texts are scored in sparse batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from unicodedata import category

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import fold, text_or_empty

SLOTS = 1 << 15
GRAMS = (1, 2, 3)
SMOOTHING = 0.5
BATCH_CHARS = 1 << 20
UNKNOWN = "und"
_MAYBE_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Whether a character of Unicode category L stands in the text (numbers such as ² or Ⅷ do not count)."""
    return any(category(c[0])[0] == "L" for c in _MAYBE_LETTER.finditer(text))


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(slot, text number) of every n-gram of letters and single gaps, lower-cased."""
    parts = [" " + t.lower() + " " for t in texts]
    code = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    # utf-32 has one unit per code point; lower() may lengthen a text, so sizes are taken after it
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    plain = np.ones(128, bool)
    plain[[*range(65, 91), *range(97, 123)]] = False
    gap = (code < 128) & plain[np.minimum(code, 127)]
    code = np.where(gap, np.uint32(32), code)
    keep = np.r_[True, ~(gap[1:] & gap[:-1] & (owner[1:] == owner[:-1]))]
    code, owner = code[keep], owner[keep]
    slots, owners = [], []
    for n in GRAMS:
        if len(code) < n:
            continue
        h = np.full(len(code) - n + 1, n * 0x1E3779B1 % (1 << 32), np.uint32)
        for j in range(n):
            h = (h ^ code[j:len(code) - n + 1 + j]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(13)
        same = owner[:len(h)] == owner[n - 1:]
        slots.append((h % np.uint32(SLOTS))[same].astype(np.int64))
        owners.append(owner[:len(h)][same])
    return np.concatenate(slots), np.concatenate(owners)


def in_batches(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """(first index, texts): batches of bounded length, at least one text each."""
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (upto == at or size + len(texts[upto]) <= BATCH_CHARS):
            size += len(texts[upto])
            upto += 1
        yield at, texts[at:upto]
        at = upto


@dataclass
class Model:
    langs: list[str]
    logp: np.ndarray   # languages x slots
    prior: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and posterior per text; ``und`` and 0 without a letter or a model."""
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.langs:
            return names, scores
        for at, part in in_batches(texts):
            slot, owner = grams(part)
            log = np.stack([np.bincount(owner, weights=row[slot], minlength=len(part)) for row in self.logp]) + self.prior[:, None]
            best = log.argmax(axis=0)
            posterior = 1.0 / np.exp(log - log.max(axis=0)).sum(axis=0)
            for i, t in enumerate(part):
                if has_letter(t):
                    names[at + i], scores[at + i] = self.langs[best[i]], posterior[i]
        return names, scores


def fit(docs: DataFrame) -> Model:
    """Learn from every row with a language and a text; languages in code point order.

    The matrix has a fixed number of slots per language; only summed counts
    reach the driver (at most languages x SLOTS rows).
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        docs_of: dict[str, int] = {}
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in sorted(set(names)):
                own = [t for n, t in zip(names, texts, strict=True) if n == lang]
                docs_of[lang] = docs_of.get(lang, 0) + len(own)
                table = held.setdefault(lang, np.zeros(SLOTS, np.int64))
                for _, part in in_batches(own):
                    table += np.bincount(grams(part)[0], minlength=SLOTS)
        for lang, table in held.items():
            slot = np.flatnonzero(table)
            yield pa.record_batch([pa.array([lang] * (len(slot) + 1)), pa.array(np.r_[-1, slot]), pa.array(np.r_[docs_of[lang], table[slot]])],
                                  names=["lang", "slot", "c"])

    got = rows.mapInArrow(count, "lang string, slot long, c long").groupBy("lang", "slot").agg(F.sum("c").alias("c")).toPandas()
    langs = sorted(set(got["lang"]))
    if not langs:
        return Model([], np.zeros((0, SLOTS), np.float32), np.zeros(0))
    table, seen = np.zeros((len(langs), SLOTS)), np.zeros(len(langs))
    where = {lang: i for i, lang in enumerate(langs)}
    row, slot, c = got["lang"].map(where).to_numpy(), got["slot"].to_numpy(), got["c"].to_numpy(float)
    table[row[slot >= 0], slot[slot >= 0]] = c[slot >= 0]
    seen[row[slot < 0]] = c[slot < 0]
    table += SMOOTHING
    return Model(langs, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32), np.log(seen / seen.sum()))


def with_language(docs: DataFrame, model: Model, name: str, text: str = "text") -> DataFrame:
    """``docs`` plus a struct column ``name`` (lang, score)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.logp, model.prior))  # languages x SLOTS floats

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Model(*shared.value)  # plain values travel; workers need not have this package
        for batch in batches:
            names, scores = known.predict(batch.tolist())
            yield pd.DataFrame({"lang": names, "score": scores})

    return docs.withColumn(name, predict(text_or_empty(text)))


def language_table(docs: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, lang_pred, score per row of ``docs``.

    Learns only from rows that are not held out. Null texts, texts without a
    letter, and all texts if nothing could be learned, are ``und`` with score 0.
    """
    part = fold(F.col("doc_id"), folds)
    model = fit(docs.where(part != held_out))
    scored = with_language(docs.select("doc_id", "text"), model, "__language")
    return scored.select("doc_id", (part == held_out).alias("held_out"), F.col("__language.lang").alias("lang_pred"),
                         F.col("__language.score").alias("score"))
