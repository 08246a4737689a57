"""Spelling variants: words one edit apart, grouped under their far more frequent form.

``word_counts`` counts the words of all texts. ``near_words`` finds, for every
word, the words at edit distance exactly one: the vocabulary falls into blocks
of words that share a half (one error leaves one half of a word as it is), and
in a block a bit-sliced position index holds, per (position, letter), the set
of words with that letter there, as one long integer with a bit per word. A
query word is read letter by letter; word-parallel recurrences update the sets
of words without an error so far and with one replaced, inserted or deleted
letter (positions shifted by one after an insertion or deletion). Words stand
in the index by falling count, so the number of near words and the best one
are read off the final set without listing it: no pair is ever written.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import text_or_empty
from tarmac.plans.layers import materialise

MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
#: words of one index; larger blocks are dealt in tiles of this size
TILE = 32_768
#: distinct words a task counts before it passes them on
HELD_WORDS = 200_000
#: rows (a word in a block) that one task compares
TASK_ROWS = 100_000


def _letters() -> bytes:
    """Latin-1 byte -> lower-cased ASCII letter, letter from U+00C0 on, or a space."""
    keep = {c: c for c in range(0xC0, 0x100)} | {c: c for c in range(ord("a"), ord("z") + 1)}
    keep |= {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
    return bytes(keep.get(c, 0x20) for c in range(256))


LETTERS = _letters()


def words_of(text: str, doc_id: str, min_length: int, damage: int | None) -> Iterator[tuple[bytes, int]]:
    """(word in Latin-1, occurrences) of one text.

    Letters lie below U+0100, so every other character may become a
    separator before the runs are cut. With ``damage`` a run whose crc32 (with
    the doc_id) it divides loses one letter.
    """
    runs = Counter(w for w in text.encode("latin-1", "replace").translate(LETTERS).split() if len(w) >= min_length)
    if damage is None:
        yield from runs.items()
        return
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % damage == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < min_length:
                continue
        yield run, n


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, damage: int | None = None) -> DataFrame:
    """word, n: words of at least ``min_length`` letters and ``min_count`` occurrences over all texts.

    A null text has no words; a null doc_id counts as empty text.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def passed_on() -> pa.RecordBatch:
            out = pa.record_batch([pa.array([w.decode("latin-1") for w in held], pa.string()),
                                   pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(*batch.columns, strict=True):
                for word, n in words_of(text.as_py(), doc_id.as_py(), min_length, damage):
                    held[word] += n
                if len(held) >= HELD_WORDS:
                    yield passed_on()
        if held:
            yield passed_on()

    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), text_or_empty().alias("text"))
    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


class Index:
    """Bit-sliced position index of the words of one block.

    ``short`` is the length of the block's shorter words; the others have one
    letter more. Bit i stands for the i-th word by falling count (ties: code
    points), so the lowest bit of a set is its best word.
    """

    def __init__(self, rows: Iterable[tuple[str, int]], short: int, half: int, skip_prefix: bool):
        self.rows = sorted(rows, key=lambda r: (-r[1], r[0]))
        self.short, self.half, self.skip_prefix = short, half, skip_prefix
        self.everything = (1 << len(self.rows)) - 1
        members: dict[tuple[int, str], list[int]] = {}
        lengths: dict[int, list[int]] = {short: [], short + 1: []}
        for i, (word, _) in enumerate(self.rows):
            lengths[len(word)].append(i)
            for at in enumerate(word):
                members.setdefault(at, []).append(i)
        self.at = {key: self._bits(some) for key, some in members.items()}
        self.shorter, self.longer = self._bits(lengths[short]), self._bits(lengths[short + 1])

    def _bits(self, members: list[int]) -> int:
        if len(self.rows) < 512:
            return sum(1 << i for i in members)
        flags = np.zeros(len(self.rows), np.bool_)
        flags[members] = True
        return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")

    def near(self, word: str) -> int:
        """The set of words exactly one edit away from ``word``, of the pairs this block answers for.

        A block answers for pairs of two shorter words and of a shorter and a
        longer one; with ``skip_prefix``, not for pairs that share the first half.
        """
        at = self.at.get
        exact, shared = self.everything, 0
        if len(word) == self.short:
            replaced = inserted = 0
            for i, letter in enumerate(word):
                if i == self.half:
                    shared = exact
                here = at((i, letter), 0)
                if exact:
                    inserted = (inserted | exact) & at((i + 1, letter), 0)
                    still = exact & here
                    replaced = (replaced & here) | (exact ^ still)
                    exact = still
                else:
                    inserted &= at((i + 1, letter), 0)
                    replaced &= here
                    if not inserted and not replaced:
                        return 0
            found = (replaced & self.shorter) | ((inserted | exact) & self.longer)
        else:
            deleted = 0
            for i, letter in enumerate(word):
                if i == self.half:
                    shared = exact
                deleted = (deleted & at((i - 1, letter), 0)) | exact
                exact &= at((i, letter), 0)
                if not deleted:
                    return 0
            found = deleted & self.shorter
        return found & ~shared if self.skip_prefix else found

    def answer(self, word: str) -> tuple[str, int, int, str] | None:
        """word, number of near words, the best one's count and spelling."""
        found = self.near(word)
        if not found:
            return None
        best, n = self.rows[(found & -found).bit_length() - 1]
        return word, found.bit_count(), n, best


def _blocks(words: DataFrame, min_length: int, tile: int) -> DataFrame:
    """k, tile, short, second, own, word, n: every word in each block it meets.

    Blocks of a pair of lengths (short, short + 1) share the first half of the
    shorter word's letters, or the rest of them at the end. A block above ``tile`` words
    is dealt: each tile indexes its own words and is asked for all.
    """
    sides = []
    for less in (0, 1):  # the word as the shorter, or as the longer of a pair
        short = f"(length(word) - {less})"
        for second, half in ((0, f"left(word, {short} div 2)"), (1, f"right(word, {short} - {short} div 2)")):
            sides.append(f"named_struct('k', xxhash64({short}, {second}, {half}), 'short', {short}, 'second', {second})")
    keyed = words.select("word", "n", F.explode(F.expr(f"array({', '.join(sides)})")).alias("b")).select(
        "b.*", "word", "n").where(F.col("short") >= min_length)
    large = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > tile)
    tiles = keyed.join(large, "k", "left").withColumn("tiles", F.coalesce(F.ceil(F.col("c") / tile), F.lit(1)))
    mine = F.pmod(F.xxhash64("word", F.lit(7)), F.col("tiles"))
    return tiles.withColumn("mine", mine).select(
        "k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("tile"), "short", "second", "mine", "word", "n",
    ).select("k", "tile", "short", "second", (F.col("tile") == F.col("mine")).alias("own"), "word", "n")


def near_words(words: DataFrame, min_length: int = MIN_LENGTH, tile: int = TILE) -> DataFrame:
    """word, n_near, near_n, near_word: number of words one edit away and the best of them
    (largest n, then least in code-point order), for words (word, n) that have any.

    ``words`` should be written: it is read three times. Tasks are as many as
    the counted words ask for, each word standing in four blocks.
    """
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, members, index, out = None, [], None, []

        def own_words() -> Index:
            """The index of the block's own words, which are asked first."""
            made = Index(members, block[2], block[2] // 2, block[3] == 1)
            out.extend(filter(None, (made.answer(w) for w, _ in members)))
            return made

        def rows() -> pa.RecordBatch:
            made = pa.record_batch([pa.array(c, t) for c, t in zip(
                zip(*out, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                names=["word", "n_near", "near_n", "near_word"])
            out.clear()
            return made

        for batch in batches:
            for k, at, short, second, own, word, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (k, at, short, second) != block:
                    if len(members) > 1 and index is None:
                        own_words()
                    block, members, index = (k, at, short, second), [], None
                if own:
                    members.append((word, n))
                    continue
                if index is None:
                    index = own_words()
                if (got := index.answer(word)) is not None:
                    out.append(got)
            if len(out) >= 10_000:
                yield rows()
        if len(members) > 1 and index is None:
            own_words()
        if out:
            yield rows()

    dealt = _blocks(words, min_length, tile)
    order = ["k", "tile", "short", "second", F.col("own").desc()]
    tasks = max(1, -(-4 * words.count() // TASK_ROWS))
    found = dealt.repartition(tasks, "k", "tile").sortWithinPartitions(*order).mapInArrow(
        compare, "word string, n_near long, near_n long, near_word string")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near_word").alias("w")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.m")).alias("near_n"), F.col("best.w").alias("near_word"))


def roots(forms: DataFrame, steps: int) -> DataFrame:
    """word, root for rows (word, form): forms followed to the last, at most ``steps`` of them, by doubling."""
    links = materialise(forms.select("word", F.col("form").alias("root")), "forms")
    for _ in range(max(0, math.ceil(math.log2(max(1, steps))))):
        onward = links.select(F.col("word").alias("__at"), F.col("root").alias("__next"))
        links = materialise(links.join(onward, F.col("root") == F.col("__at"), "left").select(
            "word", F.coalesce("__next", "root").alias("root")), "forms")
    return links


def variant_table(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO,
                  damage: int | None = None, tile: int = TILE) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``docs`` (doc_id, text).

    A word's form is its near word of largest n (ties: least in code-point
    order) if that is at least ``ratio`` times the word's own; its root is
    where the forms end, the word itself without one. Repeated rows count
    each; null and empty texts have no words; an empty table gives no rows; a
    very long text is cut into words at once, in its task. Columns besides doc_id and
    text are not read.
    """
    if ratio <= 1 or min_length < 2:
        raise ValueError("ratio must be above 1 and min_length at least 2")
    words = materialise(word_counts(docs, min_length, min_count, damage), "words")
    near = near_words(words, min_length, tile)
    good = F.col("near_n") >= ratio * F.col("n")
    judged = materialise(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(good, F.col("near_word")).alias("form"), F.when(good, F.col("near_n")).alias("form_n")), "judged")
    most = judged.agg(F.max("n")).first()[0] or 0
    # each step multiplies n by ratio or more, from min_count on
    steps = 0
    while min_count * ratio ** (steps + 1) <= most:
        steps += 1
    ends = roots(judged.where("form IS NOT NULL"), steps)
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
