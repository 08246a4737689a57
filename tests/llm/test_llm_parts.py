"""The operators' task-side parts against plain re-computations (no Spark)."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from llm_cases import WORD, components, edge_rows, prose
from tokenizers import Tokenizer

from tarmac.llm import imatch, langid, lm, packing, quality, repeats, simhash

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def plain_simhash(text: str) -> int:
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \n", "One", "a b c d", "A b C d E f", prose(7, 60), "É é x " * 9])
def test_simhash_of_a_text(text):
    assert simhash.simhash(text, 4) == plain_simhash(text)


@pytest.mark.parametrize("n,runs,flips", [(1, 1, 0), (12, 3, 5), (400, 2, 6), (1200, 1, 4), (900, 300, 3)])
def test_bit_sliced_links_lose_nothing(n, runs, flips):
    rng = np.random.default_rng(n)
    seeds = rng.integers(0, 2**63, max(1, n // 8), dtype=np.uint64)
    values = []
    for _ in range(n):
        v = int(seeds[rng.integers(len(seeds))])
        for b in rng.choice(64, rng.integers(0, flips + 1), replace=False):
            v ^= 1 << int(b)
        values.append(v)
    values, number = np.array(values, np.uint64), np.sort(rng.integers(0, runs, n))
    links = [(i, j) for i in range(n) for j in range(i + 1, n)
             if number[i] == number[j] and int(values[i] ^ values[j]).bit_count() <= 4]
    want = components(n, links)
    got = simhash.link_runs(values, number, 4, work=2048)
    first: dict = {}
    assert [first.setdefault(g, i) for i, g in enumerate(got.tolist())] == want


@pytest.mark.parametrize("text", [t for _, t, *_ in edge_rows() if t] + [
    "two  spaces\n\nand  tabs\t\tx", "it's we're I'll <|endoftext|> end ", "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n y", "<|endoftext |>", " lead", "trail \n ", "a b c　d", "x\x1cy z\x85w"])
def test_chunked_encoding_equals_the_tokenizer(text):
    plain = Tokenizer.from_file(TOKENIZER)
    ids = np.frombuffer(packing.Encoder(TOKENIZER).encode(text), "<u4").tolist()
    assert ids == plain.encode(text, add_special_tokens=False).ids


def test_cut_only_longer_documents():
    assert packing.cut(1, 2048) == [(0, 1)]
    assert packing.cut(2048, 2048) == [(0, 2048)]
    assert packing.cut(2049, 2048) == [(0, 1), (1, 2048)]
    assert packing.cut(5000, 2048) == [(0, 904), (904, 2048), (2952, 2048)]


@pytest.mark.parametrize("seed", range(4))
def test_best_fit_and_its_bound(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 100 if seed % 2 else 60, 300)
    bins, offsets, count = packing.best_fit_decreasing(lengths, 100)
    filled = Counter()
    for b, o, n in sorted(zip(bins.tolist(), offsets.tolist(), lengths.tolist(), strict=True)):
        assert filled[b] == o  # gapless
        filled[b] += n
    assert len(filled) == count and max(filled.values()) <= 100
    assert -(-lengths.sum() // 100) <= packing.lower_bound(lengths, 100) <= count


def test_bounds_see_large_items():
    assert packing.lower_bound(np.array([51, 51, 51]), 100) == 3
    assert packing.lower_bound(np.array([34] * 5), 100) == 3  # two fit a bin
    assert packing.lower_bound(np.array([], np.int64), 100) == 0


@pytest.mark.parametrize("hot", [False, True])
def test_phrases_cover_each_window_once(hot):
    text = (("ab" * 300 if hot else prose(9, 300)) + prose(10, 50)).encode()
    found = repeats.parse([text, b"short", text[5:]], 40, 8)
    for doc, raw in ((0, text), (2, text[5:])):
        own = found[found["doc"] == doc].sort_values("start")
        assert own["n"].sum() == len(raw) - 39
        assert (own["start"].to_numpy() == np.r_[0, np.cumsum(own["n"])[:-1]]).all()
        assert ((own["anchor"] >= own["n"] - 1) & (own["anchor"] <= 39)).all()


def test_repeated_windows_of_a_dictionary():
    raw = [b"AAAAAxyzKEYabcdefgh", b"BBBBAxyzKEYabcdefgQ", b"CCCCCCyzKEYabZZZZZZ"]
    length = 10
    n = np.array([len(r) - length + 1 for r in raw])
    anchor = np.full(3, 8)
    n = np.minimum(n, anchor + 1)
    got = sorted(repeats.repeated_windows(raw, anchor, n, np.zeros(3, int), length))
    want = []
    for i, r in enumerate(raw):
        for s in range(n[i]):
            w = r[s:s + length]
            if sum(q[t:t + length] == w for j, q in enumerate(raw) for t in range(n[j])) > 1:
                want.append((i, s))
    assert [(i, s) for i, a, b in got for s in range(a, b)] == want


def test_words_are_spelled_properly():
    words = [b"", b"the", b"\xc3\xa9t\xc3\xa9", b"the"]
    code = lm.Code(np.ones(256))
    assert abs(sum(2.0 ** -n for n in code.length) - 1) < 1e-9  # a complete prefix code
    table = np.zeros((2, int(lm.OFFSETS[-1])), np.float32)
    lm.add_counts(table, code, words[:2], np.array([0, 0]), np.array([5.0, 95.0]))
    model = lm.Model(code, lm.packed(table))
    logs = model.log10_words(words, np.zeros(4, int))
    assert logs[1] == logs[3] > logs[0] > logs[2]
    assert 10 ** logs[:3].sum() < 1 and 10 ** logs[0] + 10 ** logs[1] + 10 ** logs[2] <= 1


def test_one_byte_words_share_one():
    rng = np.random.default_rng(0)
    code = lm.Code(rng.random(256))
    model = lm.Model(code, rng.integers(-4000, 4000, int(lm.OFFSETS[-1])).astype(np.int16))
    # the first byte's decisions are a distribution over all bytes
    total = 0.0
    for byte in range(256):
        flat, _, place, contexts = lm.spell([bytes([byte])], np.zeros(1, int))
        log = 0.0
        for k, still, node, bit, rows in code.decisions(flat[:1], [c[:1] for c in contexts]):
            values = [model.slots.take(s) for s in lm.slots(rows, node)]
            first, spot, cell = model._gates([v & 3 for v in values], place[:1], k)
            x = model._mix(np.stack([v >> 2 for v in values], axis=1).astype(np.float32), first, spot) / lm.ODDS_STEPS
            x = np.clip(x, -11.99, 11.99)
            x = 0.5 * (x + model._refine(x, cell)[0])
            log -= np.log1p(np.exp(-x if bit[0] == 1 else x))[0]
        total += np.exp(log)
    assert abs(total - 1) < 1e-3


def test_likeness_of_fingerprints():
    terms = np.sort(np.random.default_rng(1).integers(0, 2**63, 60, dtype=np.uint64))
    a = imatch.fingerprint(b"a", terms)
    assert len(a) == imatch.DIGITS * 2 + imatch.FAMILIES * imatch.DIGITS * (imatch.LEVELS - 1)
    near, far = imatch.fingerprint(b"b", terms[5:]), imatch.fingerprint(b"c", terms ^ np.uint64(12345))
    assert imatch.likeness(a, a) == 1.0
    assert imatch.likeness(a, near) > 0.5 > 0.2 > imatch.likeness(a, far)
    none = imatch.fingerprint(b"x", terms[:0])
    assert none != imatch.fingerprint(b"y", terms[:0]) and imatch.likeness(none, imatch.fingerprint(b"y", terms[:0])) == 0.0


def test_edited_text():
    assert imatch.edited("abcdef", "XYZ") == "abcdXY"
    assert imatch.edited("ab", "XYZ") == "ab"
    assert imatch.edited("abcdef", "") == "abcd"


def test_grams_stay_inside_texts():
    slot, owner = langid.grams(["ab", "", "1 2", "İx"])
    assert set(owner.tolist()) == {0, 1, 2, 3} and len(slot) == len(owner)
    alone = [langid.grams([t])[0].tolist() for t in ("ab", "", "1 2", "İx")]
    assert sorted(slot.tolist()) == sorted(sum(alone, []))


def test_quality_model_without_and_with_labels():
    assert quality.learn([], np.zeros(0)).score(["x", ""]).tolist() == [0.5, 0.5]
    texts = [prose(i, 80) for i in range(40)] + ["!!! ".join(prose(i, 60).upper().split()) for i in range(40)]
    model = quality.learn(texts, np.array([1.0] * 40 + [0.0] * 40))
    good, bad, empty = model.score([prose(99, 70), "!!! ".join(prose(98, 70).upper().split()), ""])
    assert good > 0.7 > 0.3 > bad and empty == 0.5


def test_merged_spans():
    assert repeats.merged([(0, 5), (3, 9), (9, 12), (20, 21)]) == [(0, 12), (20, 21)]
    assert zlib.crc32(b"") == 0  # the fold of a null id


def test_batch_words_equal_the_word_rule():
    import pyarrow as pa

    texts = ["", " \t\n\x0b\x0c\r", "A b\x0bC\x0cd\re", "x\x1cy z\x85w", " Été  ÀB ", "a"]
    bags = lm.Bags.of(pa.array(texts, pa.string()))
    got = [[bags.words[i] for i in bags.ids[bags.owner == t]] for t in range(len(texts))]
    want = [[w.encode().lower() for w in WORD.findall(t)] for t in texts]
    assert got == want == [lm.tokens_of(t) for t in texts]


def test_contexts_cross_words_and_chunks():
    rng = np.random.default_rng(0)
    words = [bytes(rng.integers(97, 100, rng.integers(1, 5)).astype(np.uint8)) for _ in range(40)] + [b""]
    texts, zeros = np.repeat([0, 1], [20, 21]), np.zeros(41, int)
    whole = lm.spell(words, zeros, texts)
    parts = list(lm.spelled(words, zeros, texts, 7))
    for k in range(lm.CONTEXTS):
        assert (np.concatenate([s[3][k] for _, _, s in parts]) == whole[3][k]).all()
        assert (lm.spell(words[20:], zeros[20:], texts[20:])[3][k] == whole[3][k][whole[1] >= 20]).all()
    moved = lm.spell(words[::-1][1:], zeros[:40], texts[:40])
    assert len(moved[0]) == len(whole[0]) - 1 and set(moved[3][6]) != set(whole[3][6])


def plain_fields(terms):
    """One text's fields by the definition, in plain integers: per family and level, the terms that reach it."""
    full = (1 << 64) - 1

    def mixed(h):
        h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 & full
        h = (h ^ (h >> 27)) * 0x94D049BB133111EB & full
        return h ^ (h >> 31)

    out = []
    for family in range(1, imatch.FAMILIES + 1):
        zeros = {t: 64 - mixed(t ^ (family * 0x9E3779B97F4A7C15 & full)).bit_length() for t in terms}
        for level in range(1, imatch.LEVELS):
            part = [t for t in sorted(terms) if zeros[t] >= level]
            h = sum(mixed(t) * pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i, t in enumerate(part)) & full
            out.append(mixed(h) % 65535 + 1 if part else 0)
    return out


def test_signatures_by_plain_integers():
    rng = np.random.default_rng(3)
    words = [bytes(rng.choice(list(b"abcdefg"), 5)) for _ in range(300)]
    lexicon = np.unique(imatch.term_hashes(set(words[:200])))
    texts = [b" ".join(words[i] for i in rng.integers(0, 300, n)) for n in (0, 1, 3, 40, 400, 2)] + [b"", b"out of lexicon"]
    signs, fields = imatch.Signer(lexicon).sign(texts)
    inside = set(lexicon.tolist())
    for text, sign, found in zip(texts, signs, fields, strict=True):
        terms = {int(h) for h in imatch.term_hashes(imatch.terms_of(text))} & inside
        assert found.ravel().tolist() == plain_fields(terms)
        assert sign == imatch.fingerprint(text, np.array(sorted(terms), np.uint64)) and sign[8:] == "".join(f"{x:04x}" for x in found.ravel())
    a, b = fields[:-1], fields[1:]
    same = np.array([x == y for x, y in zip(signs, signs[1:], strict=False)])
    assert imatch.likenesses(a, b, same).tolist() == [imatch.likeness(x, y) for x, y in zip(signs, signs[1:], strict=False)]


def test_letters_are_of_category_l():
    assert not any(langid.has_letter(t) for t in ("", "²", "½ 3", "Ⅷ", "1_2", "٣", "!?", "\u0301"))
    assert all(langid.has_letter(t) for t in ("a", "3é", "漢", "ª", "1ʰ"))


def test_lm_classes_are_learnt_from_every_text(spark):
    """Shares and words of the classes add up to all texts: no text is left out, copies count."""
    two = [("the cat and the dog " * 4, 2100), ("der hund und die katze " * 4, 700)]
    rows = [(f"{text}{i if i % 2 else 'x'}",) for text, times in two for i in range(times)] + [("",), (None,), (" \t",)]
    classes = lm.fit_classes(spark.createDataFrame(rows, "text string").repartition(5))
    sizes = np.exp(classes.log_share) * (2800 + 0.5 * len(classes.log_share))
    assert np.allclose(sizes - 0.5, np.round(sizes - 0.5), atol=1e-6) and round((sizes - 0.5).sum()) == 2800
    bags = lm.Bags.of(pa.array([t for t, _ in two]))
    own = classes.of(bags)
    assert own[0] != own[1]
    spots = lm.buckets([b"cat", b"katze"])
    per_text = np.exp(classes.log_words[own][:, spots])
    assert per_text[0, 0] > 50 * per_text[0, 1] and per_text[1, 1] > 50 * per_text[1, 0]


def test_lm_classes_without_a_word(spark):
    empty = spark.createDataFrame([("",), (None,)], "text string")
    for texts in (empty, empty.limit(0)):
        classes = lm.fit_classes(texts)
        assert classes.log_share.tolist() == [0.0] and classes.of(lm.Bags.of(pa.array(["a b", ""]))).tolist() == [0, 0]
    one = lm.fit_classes(spark.createDataFrame([("just one text",)], "text string"))
    assert len(one.log_share) == 1


class Tasks:
    """Stands for a frame: keeps the function its tasks would run first."""

    def __init__(self, schema=None):
        self.schema, self.first = schema, None

    def select(self, *_):
        return self

    coalesce = repartition = select

    def mapInArrow(self, fn, _):  # noqa: N802
        self.first = self.first or fn
        return self


def test_lm_tasks_send_blocks_of_counts(spark, monkeypatch):
    """A task sends a block of its table per row, not a row per slot, and never lists all slots at once."""
    texts = pa.array([prose(i, 60) for i in range(40)])
    classes, code = lm.Classes(np.zeros(1), np.zeros((1, lm.CLASS_BUCKETS))), lm.Code(np.ones(256))
    tasks = Tasks()
    monkeypatch.setattr(lm, "materialise", lambda df, _: type("Empty", (), {"toLocalIterator": lambda self: iter(())})())
    lm.context_counts(tasks, 1, code, classes)
    sent = list(tasks.first(iter([pa.record_batch([texts], names=["text"])])))
    size = int(lm.OFFSETS[-1])
    assert sum(b.num_rows for b in sent) <= 2 * -(-2 * size // lm.BLOCK_SLOTS) and max(b.nbytes for b in sent) < 7 * lm.BLOCK_SLOTS
    listed = sum(len(v) // 2 for b in sent for v in b.column(1).to_pylist())
    assert sum(len(v) for b in sent for v in b.column(2).to_pylist()) < 1.5 * listed  # most counts take one byte
    want = np.zeros((2, size), np.float32)
    for words, own, owner in lm.sequences(iter([pa.record_batch([texts], names=["text"])]), classes):
        lm.add_counts(want, code, words, own, np.ones(len(words)), owner)
    monkeypatch.undo()
    frame = spark.createDataFrame([(t,) for t in texts.to_pylist()], "text string").repartition(3)
    monkeypatch.setattr(lm, "TASK_TOKENS", 900)  # three tasks
    assert (lm.context_counts(frame, 2700, code, classes) == want).all() and want.sum() > 10_000


def test_lm_weights_are_learnt_by_all_tasks_at_once(spark):
    """The tasks that learn weights run in one job, not one job after the other."""
    texts = [prose(i, 40) for i in range(60)]
    classes, code = lm.Classes(np.zeros(1), np.zeros((1, lm.CLASS_BUCKETS))), lm.Code(np.ones(256))
    table = np.zeros((2, int(lm.OFFSETS[-1])), np.float32)
    for words, own, owner in lm.sequences(iter([pa.record_batch([pa.array(texts)], names=["text"])]), classes):
        lm.add_counts(table, code, words, own, np.ones(len(words)), owner)
    context = spark.sparkContext
    frame = spark.createDataFrame(context.parallelize([(t,) for t in texts], 5), "text string")
    model = lm.Model(code, lm.packed(table))
    context.setJobGroup("lm weights", "")
    try:
        lm.fit_weights(frame, model, lm.left_out(table), classes)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("lm weights")]
    stages = [tracker.getStageInfo(s) for j in jobs for s in j.stageIds]
    assert max(s.numTasks for s in stages if s) == 5 and not np.array_equal(model.by_seen, lm.Model(code, model.slots).by_seen)


def test_lm_code_follows_the_byte_before():
    """Each byte before has a complete code of its own; what is scored, bit by bit, is what a plain loop over the tables gives."""
    text = [b"the", b"then", b"hat", b"qu\xc3\xa9", b"the", b""]
    pairs = lm.pair_counts(text, np.array([9.0, 2, 3, 1, 0, 1]))
    assert pairs.sum() == 9 * 4 + 2 * 5 + 3 * 4 + 5 + 1 and pairs[32, ord("t")] == 11 and pairs[ord("t"), 32] == 3 and pairs[32, 32] == 1
    code = lm.Code(pairs)
    assert np.allclose((2.0 ** -code.length.reshape(256, 256)).sum(axis=1), 1)
    assert code.length[ord("t") * 256 + ord("h")] == 1 < lm.Code(pairs.sum(axis=0)).length[ord("h")]
    kinds, texts = np.array([0, 0, 0, 1, 1, 1]), np.array([0, 0, 0, 1, 1, 1])
    table = np.zeros((2, int(lm.OFFSETS[-1])), np.float32)
    lm.add_counts(table, code, text, kinds, np.ones(6), texts)
    flat, owner, place, contexts = lm.spell(text, kinds, texts)
    plain, logs = {}, np.zeros(6)
    steps = [[(k, int(n), int(b), rows) for k, _, (n,), (b,), rows in code.decisions(flat[i:i + 1], [c[i:i + 1] for c in contexts])] for i in range(len(flat))]
    for step in steps:
        for _, node, bit, rows in step:
            for where in lm.slots(rows, np.array([node], np.uint64)):
                plain[bit, int(where[0])] = plain.get((bit, int(where[0])), 0) + 1
    assert {(b, int(s)): int(table[b, s]) for b, s in zip(*np.nonzero(table), strict=True)} == plain
    model = lm.Model(code, lm.packed(table))
    for i, step in enumerate(steps):
        for k, node, bit, rows in step:
            values = [model.slots.take(s) for s in lm.slots(rows, np.array([node], np.uint64))]
            first, spot, cell = model._gates([v & 3 for v in values], place[i:i + 1], k)
            x = np.clip(model._mix(np.stack([v >> 2 for v in values], axis=1).astype(np.float32), first, spot) / lm.ODDS_STEPS, -11.99, 11.99)
            x = 0.5 * (x + model._refine(x, cell)[0])
            logs[owner[i]] -= np.log10(1 + np.exp(-x if bit else x))[0]
    assert np.allclose(model.log10_words(text, kinds, texts), logs, atol=1e-5)
    # one occurrence less, whichever bit
    odds = lm.left_out(table)
    for bit in (0, 1):
        less = table.copy()
        less[bit] = np.maximum(less[bit] - 1, 0)
        assert (odds[bit] == lm.packed(less)).all()


def test_pieces_are_made_from_few_texts_at_once(spark):
    """Ids of a whole batch are never held together; the pieces are the same."""
    docs = spark.createDataFrame([(i, prose(i, 30)) for i in range(1_700)], "doc_id long, text string").coalesce(1)
    tasks = Tasks(docs.schema)
    packing.pieces(tasks, public_tokenizers.path("byte_bpe_50k.json"), 16, with_ids=True)
    batch = docs.toArrow().combine_chunks().to_batches()[0]
    sent = list(tasks.first(iter([batch])))
    assert len(sent) > 1 and max(len(set(b.column(0).to_pylist())) for b in sent) <= packing.PART_TEXTS
    assert [i for b in sent for i in dict.fromkeys(b.column(0).to_pylist())] == list(range(1_700))
    want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids: dict[int, list[int]] = {}
    for b in sent:
        for i, part in zip(b.column(0).to_pylist(), b.column(5).to_pylist(), strict=True):
            ids.setdefault(i, []).extend(part)
    for i in (0, 499, 500, 1_699):
        assert ids[i] == [*want.encode(prose(i, 30), add_special_tokens=False).ids, 0]


def test_learning_quality_holds_the_counts_once():
    import tracemalloc

    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"], 8)) for _ in range(3_000)]
    tracemalloc.start()
    try:
        model = quality.learn(texts, np.arange(3_000) % 2.0)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    square, counts = quality.TERMS ** 2 * 8, 3_000 * quality.TERMS * 4
    assert peak < 2 * square + counts + (8 << 20)  # products and axes, or the counts once
    assert model.vectors.shape == (3_000, quality.AXES)
