"""Spelling variants against plain Python: counts, near words, forms, roots."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from llm_cases import edge_docs, edge_rows, no_docs
from tarmac.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SMALL = {c: chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_counts(rows, damage=31):
    seen = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            word = "".join(SMALL.get(c, c) for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if damage and h % damage == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            seen[word] += 1
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}


def brute_table(counts):
    near = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in counts}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def texts(seed: int, stems: int, draws: int) -> list[tuple]:
    """Documents over a small vocabulary in which words are misspelt in rare, repeated ways."""
    rng = random.Random(seed)
    letters = "abcdefghéÿ×"
    vocabulary = ["".join(rng.choices(letters, k=rng.randint(6, 13))) for _ in range(stems)]

    def edited(w):
        i = rng.randrange(len(w) + 1)
        return rng.choice([w[:i] + rng.choice(letters) + w[i:], w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i + 1:]])

    near = [edited(w) for w in vocabulary] + [edited(edited(w)) for w in vocabulary]
    pool = vocabulary * 12 + near
    return [(i, " ".join(rng.choice(pool).upper() if rng.random() < 0.1 else rng.choice(pool) for _ in range(60)) + ". Œ 一x")
            for i in range(draws)]


def found(df):
    return sorted(map(tuple, df.collect()), key=lambda r: r[0])


@pytest.mark.parametrize("tile", [32_768, 5])
def test_equals_brute_force(spark, tile):
    rows = texts(3, 120, 120)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_table(brute_counts(rows))
    assert len({r[2] for r in want if r[1]}) > 20 and max(r[4] for r in want) > 1
    assert found(spelling.variant_table(docs, damage=31, tile=tile)) == sorted(want, key=lambda r: r[0])


def test_a_chain_of_forms_ends_at_its_root(spark):
    chain = {"abcdefgh": 20_000, "abcdefg": 2_000, "abcdefx": 200, "abcdexx": 20, "abcdxxx": 2, "zzzzzzz": 3}
    docs = spark.createDataFrame([(1, " ".join(w for w, n in chain.items() for _ in range(n)))], "doc_id long, text string")
    got = found(spelling.variant_table(docs))
    assert got == sorted(brute_table(chain), key=lambda r: r[0])
    assert {r[0]: r[2] for r in got}["abcdxxx"] == "abcdefgh"


def test_edge_rows(spark):
    rows = [(r[0], r[1]) for r in edge_rows()] + [(50, "LÉGENDE lÉgende lÉgendes x×y÷zabc x×y÷zabc")] * 2
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(spelling.variant_table(plain, damage=31)) == sorted(brute_table(brute_counts(rows)), key=lambda r: r[0])
    assert {r.word: r.n for r in spelling.word_counts(edge_docs(spark), damage=31).collect()} == brute_counts(
        [(r[0], r[1]) for r in edge_rows()])  # extra columns named word, n, k change nothing
    assert spelling.variant_table(no_docs(spark), damage=31).collect() == []


def test_ties_go_by_code_point(spark):
    counts = {"abcdefg": 2, "abcdefz": 30, "abcdefà": 30, "abcdefgh": 30}
    docs = spark.createDataFrame([(1, " ".join(w for w, n in counts.items() for _ in range(n)))], "doc_id long, text string")
    assert {r.word: r.form for r in spelling.variant_table(docs).collect()}["abcdefg"] == "abcdefgh"


def test_index_matches_brute_force_on_a_large_block():
    rng = random.Random(1)
    block = {"same" + "".join(rng.choices("abc", k=rng.choice((4, 5)))) for _ in range(900)}
    index = spelling.Index([(w, i) for i, w in enumerate(sorted(block))], 8, 4, False)
    for word in sorted(block)[::7]:
        want = {v for v in block if one_edit(v, word) and (len(v), len(word)) != (9, 9)}
        bits = index.near(word)
        assert {index.rows[i][0] for i in range(len(index.rows)) if bits >> i & 1} == want
