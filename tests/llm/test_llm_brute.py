"""Operators without SQL held against plain re-computations of their definitions."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from llm_cases import edge_rows, prose
from pyspark.sql import functions as F

from tarmac.llm import langid, quality, secrets


def plain_terms(text: str) -> np.ndarray:
    raw = text.encode("utf-8", "surrogatepass")
    out = np.zeros(quality.TERMS)
    for i in range(len(raw) - 2):
        code = raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2]
        out[(code * 2654435761 % (1 << 32) >> 8) % (quality.TERMS - quality.REPEATS)] += 1
    out = np.log1p(out)
    words = raw.split()
    if len(words) > 1:
        scale = math.sqrt((out ** 2).sum())
        out[-1] = scale * sum(a == b for a, b in zip(words, words[1:], strict=False)) / (len(words) - 1)
        out[-2] = scale * max(0.0, 0.5 - len(set(words)) / len(words))
    return out


def test_terms_do_not_depend_on_the_pieces(monkeypatch):
    texts = ["", "ab", "abc", prose(1, 50), prose(2, 400), "xy", "é", prose(3, 30)]
    whole = quality.term_counts(texts)
    assert np.allclose(whole, np.stack([plain_terms(t) for t in texts]), rtol=1e-5)
    for size in (1, 2, 3, 7, 100, 1000):
        monkeypatch.setattr(quality, "CHUNK", size)
        assert (quality.term_counts(texts) == whole).all()


def test_quality_votes_by_plain_cosines():
    rng = random.Random(6)
    good = [prose(i, rng.randint(20, 80)) for i in range(40)]
    bad = [" ".join(rng.choice(["buy", "now", "!!!", "#1", "$$$"]) for _ in range(rng.randint(20, 80))) + prose(900 + i, 5) for i in range(40)]
    model = quality.learn(good + bad, np.array([1.0] * 40 + [0.0] * 40))
    asked = [prose(500 + i, 30) for i in range(10)] + bad[:3] + [t for _, t, *_ in edge_rows() if t and len(t) < 20_000]
    got = model.score(asked)
    for text, score in zip(asked, got, strict=True):
        v = (plain_terms(text) * model.weights) @ model.axes
        v = v / max(float(np.linalg.norm(v)), 1e-12)
        near = sorted(((float(v @ w), y) for w, y in zip(model.vectors, model.labels, strict=True)), reverse=True)[:quality.NEIGHBOURS]
        votes = [(max(c, 0.0) ** 4, y) for c, y in near]
        total = sum(w for w, _ in votes)
        assert score == pytest.approx(sum(w * y for w, y in votes) / total if total > 1e-9 else model.prior, abs=2e-3), text[:40]


def plain_grams(text: str) -> Counter:
    """(n, characters) of the lower-cased text in which every run of ASCII non-letters is one gap."""
    low, letters = " " + text.lower() + " ", []
    for c in low:
        gap = ord(c) < 128 and not c.isalpha()
        if not (gap and letters and letters[-1] == " "):
            letters.append(" " if gap else c)
    return Counter(tuple(letters[i:i + n]) for n in langid.GRAMS for i in range(len(letters) - n + 1))


def slot_of(gram: tuple) -> int:
    h = len(gram) * 0x1E3779B1 % (1 << 32)
    for c in gram:
        h = (h ^ ord(c)) * 0x85EBCA6B % (1 << 32)
        h ^= h >> 13
    return h % langid.SLOTS


def test_language_posteriors_by_plain_naive_bayes(spark):
    rng = random.Random(8)
    stems = {"aa": ["tha", "ing", "oune", "wh"], "bb": ["qué", "eño", "lá", "ría"], "cc": ["ßen", "ich", "äu", "tz"]}
    make = lambda lang, n: " ".join("".join(rng.choices(stems[lang], k=rng.randint(1, 3))) for _ in range(n))
    rows = [(i, make(lang, rng.randint(3, 12)), lang) for i, lang in enumerate(rng.choices(["aa", "bb", "cc"], k=60))]
    rows += [(100, "12 ²", "aa"), (101, None, "bb"), (102, "tha qué", None)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3))
    assert model.langs == ["aa", "bb", "cc"]
    learned = [(t, lang) for _, t, lang in rows if t is not None and lang is not None]
    counts = {lang: Counter() for lang in model.langs}
    for t, lang in learned:
        for gram, n in plain_grams(t).items():
            counts[lang][slot_of(gram)] += n
    asked = [make(lang, 4) for lang in ("aa", "bb", "cc")] + ["tha ich", "Ñ!", "x y z", "ÉÀ 12"]
    names, scores = model.predict(asked)
    for text, name, score in zip(asked, names, scores, strict=True):
        log = []
        for lang in model.langs:
            whole = sum(counts[lang].values()) + langid.SMOOTHING * langid.SLOTS
            log.append(math.log(sum(x == lang for _, x in learned) / len(learned)) + sum(
                n * math.log((counts[lang][slot_of(g)] + langid.SMOOTHING) / whole) for g, n in plain_grams(text).items()))
        best = max(log)
        assert name == model.langs[log.index(best)] and score == pytest.approx(1 / sum(math.exp(x - best) for x in log), abs=1e-3)
    assert model.predict(["", "² ½", "7"]) [0] == ["und"] * 3


def planted(seed: int, n: int):
    """(text, planted value or None): secrets of several kinds in prose, and look-alikes that are none."""
    rng = random.Random(seed)
    hexa = lambda k: "".join(rng.choices("0123456789abcdef", k=k))
    base = lambda k: "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=k))
    word = lambda: "".join(rng.choices("abcdefghijklmnoprstuvw", k=rng.randint(4, 8)))
    kinds = {
        "hex": lambda: (hexa(40), "{}"), "named hex": lambda: (hexa(32), 'api_key = "{}"'),
        "base64": lambda: (base(36), "token: {}"), "jwt": lambda: (f"{base(20)}.{base(24)}.{base(22)}", "Authorization: Bearer {}"),
        "password": lambda: (f"{word().title()}!{word()}{rng.randint(100, 999)}", 'password = "{}"')}
    harmless = {
        "slug": lambda: "-".join(word() for _ in range(4)) + f"-{rng.randint(1, 99)}", "path": lambda: "/".join(word() for _ in range(4)) + "/v2",
        "number": lambda: str(rng.randint(10 ** 17, 10 ** 18)), "version": lambda: ".".join(word() for _ in range(3)) + ".v1",
        "date": lambda: f"{rng.randint(1990, 2030)}-01-02/{rng.randint(10, 99)}/{rng.randint(10, 99)}"}
    rows = []
    for i in range(n):
        for name, make in kinds.items():
            value, shape = make()
            rows.append((name, f"{prose(7 * i, 12)} {shape.format(value)} {prose(7 * i + 1, 10)}", value))
        for name, make in harmless.items():
            rows.append((name, f"{prose(7 * i + 2, 12)} {make()} {prose(7 * i + 3, 10)}", None))
    return rows


def test_planted_secrets_of_all_kinds_are_found_and_lookalikes_left(spark):
    rows = planted(3, 60)
    docs = spark.createDataFrame([(i, text) for i, (_, text, _) in enumerate(rows)], "doc_id long, text string").repartition(4)
    found: dict = {}
    for r in secrets.secret_table(docs).where("is_secret").collect():
        found.setdefault(r.doc_id, []).append(rows[r.doc_id][1][r.start:r.start + r.length])
    hits, totals, wrong = Counter(), Counter(), Counter()
    for i, (name, _, value) in enumerate(rows):
        totals[name] += 1
        if value is None:
            wrong[name] += bool(found.get(i))
        else:
            hits[name] += any(value in x for x in found.get(i, []))
    recall = {k: hits[k] / totals[k] for k in ("hex", "named hex", "base64", "jwt", "password")}
    false = {k: wrong[k] / totals[k] for k in ("slug", "path", "number", "version", "date")}
    assert min(recall.values()) >= 0.9 and max(false.values()) <= 0.1, (recall, false)


def test_redact_keeps_columns_named_like_its_own(spark):
    key = "0f1e2d3c4b" * 4
    rows = [(i, f'some words before token = "{key}" and after it number {i}', "cand", 7, "b", "a", 0.5, "u", True) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, candidate string, start int, before string, after string, score double, "
                                       "key string, is_secret boolean")
    out = secrets.redact(docs)
    assert out.columns == docs.columns
    got = sorted(out.collect())
    assert [tuple(r)[2:] for r in got] == [r[2:] for r in rows]
    assert all(key not in r.text and secrets.REDACTED in r.text for r in got)


def test_ties_at_the_last_neighbour_do_not_depend_on_the_batch():
    texts = [prose(1, 30)] * 40 + [prose(2, 30)] * 40
    model = quality.learn(texts, np.array(([1.0, 0.0] * 20) * 2))
    asked = [prose(1, 30), prose(2, 30), prose(3, 30)]
    one = [float(model.score([t])[0]) for t in asked]
    assert model.score(asked).tolist() == pytest.approx(one, abs=1e-6) and all(0 <= s <= 1 for s in one)
