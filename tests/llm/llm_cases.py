"""Small inputs and plain re-computations shared by the tests of the training-data operators."""

from __future__ import annotations

import re

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EXTRA = "score double, key string, size long, fingerprint string, g int, length int, h long, c int, k int, word string, lang_pred string"
DOCS = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = np.random.default_rng(seed)
    stems = ["".join(rng.choice(list("abcdefghijklmnoprstuvwz"), rng.integers(2, 9))) for _ in range(vocabulary)]
    return " ".join(rng.choice(stems, words))


def edge_rows() -> list[tuple]:
    """Null columns, empty and long texts, ties, repeated rows, a null id, odd white space and characters."""
    junk = (0.5, "x", 7, "f", 1, 2, 3, 4, 5, "w", "zz")
    base = prose(1, 260)
    texts = [
        (1, base, "en", "s0"), (1, base, "en", "s0"), (2, base + " tail", "en", "s0"), (3, None, None, None), (4, "", "en", "s1"),
        (5, " \t\n", None, "s1"), (None, prose(2, 40), "en", None), (None, None, None, None), (6, prose(3, 30_000), "de", "s2"),
        (7, "1234 5678", "fr", "s2"), (8, "Été déjà vu 漢字 \U0001f600 ok", "fr", "s2"), (9, base, "en", "s3"),
        (10, "dup line here\n" * 30, "en", "s3"), (11, "word " * 500, "en", "s3"), (12, "x" * 5000, "en", "s3"),
        (13, f"the access token = \"{'a1b2c3d4e5' * 4}\" and more words", "en", "s3"), (14, prose(4, 120), "de", "s4"), (14, prose(5, 90), "de", "s4")]
    return [(i, t, lang, source, None if t is None else len(t), *junk) for i, t, lang, source in texts]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def label_rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def components(n: int, links) -> list[int]:
    """Least member reachable, by plain union-find."""
    up = list(range(n))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]
