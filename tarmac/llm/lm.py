"""LM scoring: logistic context mixing over the bits of token sequences.

A text is its class, its lower-cased words in their order and one end. Words are
spelled byte by byte with a terminator (the end is the empty word), each byte by the
bits of the Huffman code that belongs to the byte before; several predictors, one per
hashed context, give a bit's log odds from counts. Contexts run across the words of a text: the last 1 to 4 bytes,
terminators included, the word so far, and the word so far after the previous word and
after the previous two; some are joined with the class. Two weight vectors, chosen by how much the contexts have seen and by the place
in the word and the bit, mix them (gated); an adaptive probability map refines
the result; the logs of the bits' probabilities add up to the score. The class
of a text (a cluster of the training texts: a language, a register) is coded
first, so the score is a proper log probability of the sequence; bits per byte divide it
by the bytes of the words and terminators.

What is learnt, in order: classes, in rounds over all training texts; exact token counts of
all training documents (combined in each task, then by Spark); context counts from
every token occurrence of every training text, by the tasks that hold them, into
tables of a fixed size; mixing weights and map online over all training texts, each
bit predicted with its own occurrence left out of the counts, as if it came next:
each task learns from its texts, and the tasks' results are averaged by their tokens.
The unigram base score needs every token's
count: the most frequent tokens (a bounded table) are broadcast, the others meet
their counts in a join.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import UID, fold, in_parts, text_or_empty, with_row_ids
from tarmac.plans.layers import materialise

#: (last bytes, or "word" so far alone, after the previous word, after the previous two; joined with the class?; log2 of slots)
CONTEXT_KINDS = ((1, True, 18), (2, True, 20), (3, False, 20), (4, False, 20), ("word", False, 20), ("word", True, 20),
                 ("after one", False, 22), ("after two", False, 22))
CONTEXTS = len(CONTEXT_KINDS)
OFFSETS = np.cumsum([0] + [1 << k[2] for k in CONTEXT_KINDS])
#: contexts whose experience chooses the first weight vector
GATING = (5, 6, 3, 2)
CLASSES = 12
CLASS_BUCKETS = 2048
#: texts whose buckets are counted at once
CLASS_TEXTS = 250
CLASS_STARTS = 6
#: rounds that all starts take, and that the best of them may take; a gain (share of the log likelihood) not worth a round
CLASS_TRIALS, CLASS_ROUNDS = 3, 25
CLASS_GAIN = 1e-5
#: tokens whose counts are broadcast
FREQUENT = 1 << 17
ROUND_WORDS = 500
CHUNK_WORDS = 4_000
#: powers of the hash's base that are kept
MOST_POWERS = 1 << 16
#: words before a chunk that its first contexts can reach
LEAD = 4
SEEN_GATES, PLACE_GATES = 256, 64
MAP_STEPS = 24
TASK_TOKENS = 4_000_000
#: slots of a block of the count table (their numbers in it take 16 bits), and parts that add blocks up
BLOCK_SLOTS = 1 << 14
COUNT_PARTS = 64
LEARN_RATE = 0.02
DELTA = 0.1
SMOOTH = 0.1
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def tokens_of(text: str) -> list[bytes]:
    """Words of a text; the end token is the empty word and comes by itself."""
    return text.encode("utf-8", "surrogatepass").lower().split()


@dataclass
class Bags:
    """The words of a batch of texts as numbers: distinct words, and each text's occurrences."""

    words: list[bytes]
    ids: np.ndarray      # word of each occurrence
    owner: np.ndarray    # text of each occurrence
    texts: int

    @staticmethod
    def of(texts: pa.Array) -> Bags:
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        flat, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
        worded = pc.greater(pc.binary_length(flat), 0)  # white space at the ends gives empty strings
        coded = pc.dictionary_encode(flat.filter(worded))
        return Bags(coded.dictionary.cast(pa.binary()).to_pylist(), coded.indices.to_numpy().astype(np.int64),
                    owner.filter(worded).to_numpy().astype(np.int64), len(texts))

    def sequence(self) -> tuple[list[bytes], np.ndarray]:
        """All texts' words in order, each text closed by the end, and the text of each."""
        size = np.bincount(self.owner, minlength=self.texts) + 1
        order = np.full(len(self.ids) + self.texts, len(self.words))
        order[np.arange(len(self.ids)) + self.owner] = self.ids
        words = [*self.words, b""]
        return [words[i] for i in order.tolist()], np.repeat(np.arange(self.texts), size)

    def sums(self, value: np.ndarray) -> np.ndarray:
        """Per text, the sum of ``value[word]`` over its occurrences."""
        return np.bincount(self.owner, weights=value[self.ids], minlength=self.texts)


def _stirred(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (h ^ (h >> _U(29))) * _U(0xC4CEB9FE1A85EC53)


_KEPT: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash's base and of its inverse."""
    size = max(n, MOST_POWERS)
    found = _KEPT.get(size)
    if found is None:
        with np.errstate(over="ignore"):
            found = tuple(np.cumprod(np.r_[_U(1), np.full(size - 1, base, np.uint64)]) for base in (_BASE, _INVERSE))
        if size == MOST_POWERS:  # a very long word's are not kept
            _KEPT[size] = found
    return found[0][:n], found[1][:n]


def spell(words: list[bytes], classes: np.ndarray, texts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Bytes of the terminated words, their word and place, and the context hashes per kind; last, the byte before each (256: none).

    Neighbours with the same number in ``texts`` follow each other in one text;
    without it each word is a text by itself.
    """
    flat = np.frombuffer(b" ".join(words) + b" ", np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    begins = ends - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(flat)) - begins.take(owner)
    texts = np.arange(len(words)) if texts is None else texts
    opens = np.r_[True, texts[1:] != texts[:-1]]
    starts = begins[opens]
    lengths = np.diff(np.r_[starts, len(flat)])
    joined = ((classes.astype(np.uint64) + _U(1)) * _U(0xC2B2AE3D27D4EB4F)).take(owner)
    with np.errstate(over="ignore"):
        history, rows = np.zeros(len(flat), np.uint64), {}
        for back in range(1, 5):  # the last 1, 2, .. bytes; 256 stands for "before the text"
            shifted = np.zeros(len(flat), np.uint64)
            shifted[back:] = flat[:-back]
            for k in range(back):
                shifted[starts[lengths > k] + k] = 256
            history = (history << _U(9)) | shifted
            rows[back] = history * _U(_BASE) + _U(back)
        power, inverse = _powers(len(flat))
        total = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum((flat + _U(1)) * power, out=total[1:])
        upto, back_to_one = total.take(begins), inverse.take(begins)
        prefix = (total[:-1] - upto.take(owner)) * back_to_one.take(owner)
        rows["word"] = (prefix ^ (prefix >> _U(31))) * _U(0xBF58476D1CE4E5B9) + _U(99)
        whole = _stirred((total.take(ends) - upto) * back_to_one)
        one = np.where(opens, _U(1), np.r_[_U(0), whole[:-1]])
        two = np.where(opens, _U(1), np.r_[_U(0), one[:-1]])
        rows["after one"] = rows["word"] ^ _stirred(one * _U(_BASE) + _U(7)).take(owner)
        rows["after two"] = rows["word"] ^ _stirred(_stirred(one * _U(_BASE) + _U(11)) + two * _U(0xD6E8FEB86659FD93)).take(owner)
    kinds = [rows[back] ^ joined if by_class else rows[back] for back, by_class, _ in CONTEXT_KINDS]
    return flat, owner, place, [*[_stirred(h) for h in kinds], history >> _U(27)]


def spelled(words: list[bytes], classes: np.ndarray, texts: np.ndarray | None, step: int) -> Iterator[tuple]:
    """(first word, words, spell() of them) in chunks; contexts reach back over a chunk's edge."""
    for at in range(0, len(words), step):
        lead = min(at, LEAD) if texts is not None else 0
        part = slice(at - lead, at + step)
        flat, owner, place, contexts = spell(words[part], classes[part], None if texts is None else texts[part])
        own = np.searchsorted(owner, lead)
        yield at, len(words[at:at + step]), (flat[own:], owner[own:] - lead, place[own:], [c[own:] for c in contexts])


def rounds(words: list[bytes], classes: np.ndarray, texts: np.ndarray | None) -> Iterator[tuple]:
    """What spelled() gives, spelled in chunks and handed out ROUND_WORDS words at a time."""
    for at, n, (flat, owner, place, contexts) in spelled(words, classes, texts, CHUNK_WORDS):
        edges = np.searchsorted(owner, np.arange(0, n + ROUND_WORDS, ROUND_WORDS))
        for k, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
            first = k * ROUND_WORDS
            yield at + first, min(ROUND_WORDS, n - first), (flat[a:b], owner[a:b] - first, place[a:b], [c[a:b] for c in contexts])


def slots(contexts: list[np.ndarray], node: np.ndarray) -> list[np.ndarray]:
    """Table slots per context for the binary node of each byte."""
    out = []
    with np.errstate(over="ignore"):
        turned = node * _U(0xD6E8FEB86659FD93)
        for row, (_, _, bits), at in zip(contexts, CONTEXT_KINDS, OFFSETS, strict=False):
            where = (((row ^ turned) * _U(0xFF51AFD7ED558CCD)) >> _U(64 - bits)).view(np.int64)
            where += at
            out.append(where)
    return out


def _paths(counts: np.ndarray) -> tuple[list[int], np.ndarray]:
    """The lengths of the symbols' paths in the Huffman tree of the counts, and all their (node, bit) decisions."""
    heap = [(float(c), i, i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    parent: dict[int, tuple[int, int]] = {}
    for node in range(256, 511):
        for bit in (0, 1):
            weight, _, child = heapq.heappop(heap)
            parent[child] = (node, bit)
            total = weight if bit == 0 else total + weight
        heapq.heappush(heap, (total, node, node))
    paths = []
    for symbol in range(256):
        path, at = [], symbol
        while at in parent:
            at, bit = parent[at]
            path.append((at, bit))
        paths.append(path[::-1])
    return [len(p) for p in paths], np.array([step for p in paths for step in p], np.uint16)


class Code:
    """A Huffman code of the 256 bytes: the binary decisions (node, bit) that spell each byte.

    With a row of counts per byte before, each has a code of its own (the start of a
    text counts as a terminator): every context holds the byte before, so nodes of
    different codes never meet in one.
    """

    def __init__(self, byte_counts: np.ndarray):
        self.many = byte_counts.ndim == 2
        if self.many:
            overall = byte_counts.sum(axis=0)
            codes = [_paths(counts + overall / max(overall.sum(), 1) + 1e-3) for counts in byte_counts]
        else:
            codes = [_paths(byte_counts + 1e-3)]
        self.length = np.concatenate([lengths for lengths, _ in codes])
        self.first = np.cumsum(self.length) - self.length
        steps = np.concatenate([s for _, s in codes])
        self.node, self.bit = steps[:, 0].copy(), steps[:, 1].astype(np.uint8)

    def symbols(self, flat: np.ndarray, contexts: list[np.ndarray]) -> np.ndarray:
        """The number of each byte in the codes' tables."""
        symbol = flat.astype(np.int64)
        if self.many:
            before = contexts[-1].astype(np.int64)
            symbol += np.where(before < 256, before, 32) * 256
        return symbol

    def decisions(self, flat: np.ndarray, contexts: list[np.ndarray]) -> Iterator[tuple]:
        """(step, bytes still being spelled, node, bit, their context hashes), step by step."""
        symbol = self.symbols(flat, contexts)
        length, first = self.length.take(symbol), self.first.take(symbol)
        at, contexts = np.arange(len(flat)), contexts[:CONTEXTS]
        for k in range(length.max(initial=0)):
            on = np.flatnonzero(length > k)
            if len(on) < len(at):
                at, length, first, contexts = at.take(on), length.take(on), first.take(on), [c.take(on) for c in contexts]
            yield k, at, self.node.take(first + k).astype(np.uint64), self.bit.take(first + k), contexts

    def every(self, flat: np.ndarray, contexts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(step, byte, node, bit) of all decisions at once, byte by byte."""
        symbol = self.symbols(flat, contexts)
        length = self.length.take(symbol)
        begins = np.cumsum(length) - length
        at = np.repeat(np.arange(len(flat)), length)
        step = np.arange(len(at)) - begins.take(at)
        path = self.first.take(symbol).take(at) + step
        return step, at, self.node.take(path).astype(np.uint64), self.bit.take(path)


def add_counts(table: np.ndarray, code: Code, words: list[bytes], classes: np.ndarray, times: np.ndarray,
               texts: np.ndarray | None = None) -> None:
    """Add the words' bits, weighted, to the (2, slots) count table."""
    counts = table.reshape(-1)
    for at, n, (flat, owner, _, contexts) in spelled(words, classes, texts, CHUNK_WORDS):
        own = times[at:at + n].astype(table.dtype)
        alike = bool((own == own[0]).all())
        weight = own[0] if alike else own[owner]
        for _, still, node, bit, rows in code.decisions(flat, contexts):
            side, w = bit * np.int64(table.shape[1]), weight if alike else weight.take(still)
            for where in slots(rows, node):
                where += side
                np.add.at(counts, where, w)


def stretch(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.log((ones + DELTA) / (zeros + DELTA))


def experience(total: np.ndarray) -> np.ndarray:
    """0 to 3: never seen, once or twice, some, many."""
    return (total > 0.5).astype(np.uint8) + (total > 2.5) + (total > 15)


def _mean_weights(gates: int) -> np.ndarray:
    return np.full((gates, CONTEXTS), 0.15, np.float32)


#: odds are kept in steps of 1 / ODDS_STEPS with the experience in the last two bits
ODDS_STEPS = 400


def packed(table: np.ndarray) -> np.ndarray:
    """Log odds and experience of each slot in 16 bits."""
    odds = np.clip(np.round(stretch(table[0], table[1]) * ODDS_STEPS), -8000, 8000).astype(np.int16)
    return odds * np.int16(4) + experience(table[0] + table[1]).astype(np.int16)


def left_out(table: np.ndarray) -> np.ndarray:
    """packed() with one occurrence of the bit taken away, per bit and slot: what a word's neighbours say of it."""
    out = np.empty(table.shape, np.int16)
    for at in range(0, table.shape[1], 1 << 18):  # never a second table in floats
        part = table[:, at:at + (1 << 18)]
        for bit in (0, 1):
            out[bit, at:at + (1 << 18)] = packed(np.stack([np.maximum(c - (side == bit), 0) for side, c in enumerate(part)]))
    return out


@dataclass
class Model:
    code: Code
    slots: np.ndarray                      # see packed()
    by_seen: np.ndarray = field(default_factory=lambda: _mean_weights(SEEN_GATES))
    by_place: np.ndarray = field(default_factory=lambda: _mean_weights(PLACE_GATES))
    refined: np.ndarray = field(default_factory=lambda: np.tile(np.linspace(-12, 12, MAP_STEPS + 1, dtype=np.float32), 4 * PLACE_GATES))

    def _gates(self, seen: list[np.ndarray], place: np.ndarray, k: int | np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first = np.zeros(len(place), np.int32)
        for i in GATING:
            first = first * 4 + seen[i]
        spot = np.minimum(place, 7) * 8 + np.minimum(k, 7)
        return first, spot, seen[GATING[0]].astype(np.int64) * PLACE_GATES + spot

    def _mix(self, inputs: np.ndarray, first: np.ndarray, spot: np.ndarray) -> np.ndarray:
        weights = self.by_seen.take(first, axis=0)
        weights += self.by_place.take(spot, axis=0)
        return np.einsum("ij,ij->i", inputs, weights)

    def _refine(self, x: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The map's log odds at the nearest step of x, and the map cell."""
        at = cell * (MAP_STEPS + 1) + np.rint(x + 12).astype(np.int64)
        return self.refined.take(at), at

    def log10_words(self, words: list[bytes], classes: np.ndarray, texts: np.ndarray | None = None) -> np.ndarray:
        """log10 probability of each word (terminator included) after the words before it in its text."""
        out = np.zeros(len(words))
        for at, n, (flat, owner, place, contexts) in rounds(words, classes, texts):
            k, still, node, bit = self.code.every(flat, contexts)
            inputs, first, spot, cell = self._inputs(self.slots, None, k, still, node, place, contexts)
            x = self._mix(inputs, first, spot) * np.float32(1.0 / ODDS_STEPS)
            np.clip(x, -11.99, 11.99, out=x)
            x += self._refine(x, cell)[0]
            x *= np.float32(0.5) - bit
            out[at:at + n] = np.bincount(owner.take(still), weights=-np.log1p(np.exp(x)), minlength=n)
        return out / np.log(10.0)

    def _inputs(self, odds: np.ndarray, side: np.ndarray | None, k: np.ndarray, still: np.ndarray, node: np.ndarray, place: np.ndarray,
                contexts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The contexts' packed odds per decision, and its gates and map cell; ``side`` moves the slots to a part of ``odds``."""
        inputs, seen = np.empty((len(still), CONTEXTS), np.float32), []
        for i, where in enumerate(slots([c.take(still) for c in contexts[:CONTEXTS]], node)):
            if side is not None:
                where += side
            value = odds.take(where)
            seen.append(value & 3)
            inputs[:, i] = value >> 2
        return inputs, *self._gates(seen, place.take(still), k)

    def learn(self, odds: np.ndarray, words: list[bytes], classes: np.ndarray, texts: np.ndarray | None = None) -> None:
        """One online pass over the words, in rounds: each bit is predicted before weights and map learn from it.

        ``odds``: see left_out(); the word's own occurrence is left out of the counts.
        """
        size, flat_odds = odds.shape[1], odds.reshape(-1)
        for _, _, (flat, _, place, contexts) in rounds(words, classes, texts):
            k, still, node, bit = self.code.every(flat, contexts)
            inputs, first, spot, cell = self._inputs(flat_odds, bit * np.int64(size), k, still, node, place, contexts)
            x = np.clip(self._mix(inputs, first, spot) * np.float32(1.0 / ODDS_STEPS), -11.99, 11.99)
            error = bit - 1 / (1 + np.exp(-x))
            error *= np.float32(1.0 / ODDS_STEPS)
            steps = [error * column for column in inputs.T]
            for weights, gate in ((self.by_seen, first), (self.by_place, spot)):
                step = np.stack([np.bincount(gate, weights=s, minlength=len(weights)) for s in steps], axis=1)
                weights += (LEARN_RATE * step / np.sqrt(np.maximum(np.bincount(gate, minlength=len(weights)), 1.0))[:, None]).astype(np.float32)
            fine, at_cell = self._refine(x, cell)
            off = bit - 1 / (1 + np.exp(-fine))
            move, met = (np.bincount(at_cell, weights=v, minlength=len(self.refined)) for v in (off, None))
            self.refined = np.clip(self.refined + 0.5 * move / (np.sqrt(met) + 1.0), -16, 16).astype(np.float32)


@dataclass
class Classes:
    """Clusters of texts by their words' hash buckets: multinomials with shares."""

    log_share: np.ndarray   # classes
    log_words: np.ndarray   # classes x buckets

    def of(self, bags: Bags) -> np.ndarray:
        """The class of each text; texts without a word take the most frequent one."""
        spot = buckets(bags.words)[bags.ids]
        edges = np.searchsorted(bags.owner, np.arange(0, bags.texts + CLASS_TEXTS, CLASS_TEXTS))
        out = np.zeros(bags.texts, np.int64)
        for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            texts = min(CLASS_TEXTS, bags.texts - k * CLASS_TEXTS)
            key = (bags.owner[a:b] - k * CLASS_TEXTS) * CLASS_BUCKETS + spot[a:b]
            found = np.bincount(key, minlength=texts * CLASS_BUCKETS).reshape(texts, CLASS_BUCKETS)
            out[k * CLASS_TEXTS:][:texts] = (found @ self.log_words.T + self.log_share).argmax(axis=1)
        return out


def buckets(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) % CLASS_BUCKETS for w in words), np.int64, len(words))


def histograms(texts: DataFrame) -> DataFrame:
    """The hash buckets of each text's words and their counts: one row per text with a word."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, 500):
            bags = Bags.of(batch.column(0))
            full = np.bincount(bags.owner * CLASS_BUCKETS + buckets(bags.words)[bags.ids], minlength=bags.texts * CLASS_BUCKETS)
            key = np.flatnonzero(full)
            edges = np.searchsorted(key, np.arange(bags.texts + 1) * CLASS_BUCKETS)
            spots, counts = (key % CLASS_BUCKETS).astype("<u2"), full[key].astype("<i4")
            rows = [(spots[a:b].tobytes(), counts[a:b].tobytes(), int(counts[a:b].sum(dtype=np.int64)))
                    for a, b in zip(edges, edges[1:], strict=False) if a < b]
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.binary(), pa.int64()), strict=True)],
                                  names=["spots", "counts", "words"])

    return texts.select(text_or_empty().alias("text")).mapInArrow(count, "spots binary, counts binary, words long")


def _unpacked(spots: pa.Array, counts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, count) of the entries of some rows of histograms()."""
    owner = np.repeat(np.arange(len(spots)), pc.binary_length(spots).to_numpy(zero_copy_only=False) // 2)
    spot, n = (np.frombuffer(b"".join(c.to_pylist()), t) for c, t in ((spots, "<u2"), (counts, "<i4")))
    return owner, spot.astype(np.int64), n


def first_centres(kept: DataFrame, mean_words: float) -> np.ndarray:
    """(starts x classes x buckets): where the clusterings begin, different long texts least by hash."""
    chosen = kept.where(F.col("words") >= F.lit(mean_words)).withColumn("h", F.xxhash64("spots", "counts", F.lit(23)))  # short texts are like nothing
    least = chosen.select("h").distinct().orderBy("h").limit(CLASS_STARTS * CLASSES)
    rows = chosen.join(F.broadcast(least), "h").dropDuplicates(["h"]).orderBy("h").select("spots", "counts").toArrow().combine_chunks()
    owner, spot, n = _unpacked(rows.column(0).combine_chunks(), rows.column(1).combine_chunks())
    damped = np.zeros((rows.num_rows, CLASS_BUCKETS))
    damped[owner, spot] = np.sqrt(n)
    damped /= np.maximum(np.linalg.norm(damped, axis=1, keepdims=True), 1e-9)
    starts = max(1, rows.num_rows // CLASSES)
    return np.stack([damped[k::starts][:CLASSES] for k in range(starts)])


def tallied(kept: DataFrame, weights: np.ndarray, bias: np.ndarray, damped: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every text goes to its best class of each start: (texts per class, words per class and bucket, sum of the best values)."""
    starts, kinds, _ = weights.shape
    shared = kept.sparkSession.sparkContext.broadcast((weights.reshape(starts * kinds, -1).T.astype(np.float32), bias.ravel()))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket, start_at = shared.value
        texts, words, value = np.zeros((starts, kinds), np.int64), np.zeros((starts, kinds * CLASS_BUCKETS)), np.zeros(starts)
        for batch in in_parts(batches, 500):
            owner, spot, n = _unpacked(batch.column(0), batch.column(1))
            rows = np.zeros((batch.num_rows, CLASS_BUCKETS), np.float32)
            rows[owner, spot] = np.sqrt(n) if damped else n
            fit = (rows @ by_bucket + start_at).reshape(-1, starts, kinds)
            own = fit.argmax(axis=2)
            value += fit.max(axis=2).sum(axis=0)
            for k in range(starts):
                texts[k] += np.bincount(own[:, k], minlength=kinds)
                words[k] += np.bincount(own[owner, k] * CLASS_BUCKETS + spot, weights=n, minlength=kinds * CLASS_BUCKETS)
        at = [(k, c) for k in range(starts) for c in range(kinds) if texts[k, c]]
        yield pa.record_batch([
            pa.array([k for k, _ in at], pa.int32()), pa.array([c for _, c in at], pa.int32()), pa.array([texts[a] for a in at], pa.int64()),
            pa.array([words.reshape(starts, kinds, -1)[a].astype("<f8").tobytes() for a in at], pa.binary()),
            pa.array([value[k] if c == texts[k].argmax() else 0.0 for k, c in at], pa.float64())], names=["start", "class", "n", "words", "value"])

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(w, "<f8") for w in frame["words"]], axis=0)
        return pd.DataFrame({"start": frame["start"][:1], "class": frame["class"][:1], "n": frame["n"].sum(),
                             "words": [total.tobytes()], "value": frame["value"].sum()})

    schema = "start int, class int, n long, words binary, value double"
    texts, words, value = np.zeros((starts, kinds)), np.zeros((starts, kinds, CLASS_BUCKETS)), np.zeros(starts)
    for r in kept.select("spots", "counts").mapInArrow(tally, schema).groupBy("start", "class").applyInPandas(merge, schema).collect():
        texts[r["start"], r["class"]] = r["n"]
        words[r["start"], r["class"]] = np.frombuffer(r["words"], "<f8")
        value[r["start"]] += r["value"]
    shared.unpersist()
    return texts, words, value


def fit_classes(texts: DataFrame) -> Classes:
    """Hard expectation-maximisation over all texts' buckets: each round, every text goes to its likeliest
    class, and shares and words of the classes are those of all their texts. The likeliest of a few
    fixed starts is followed until its rounds change nothing, or gain next to nothing."""
    kept, seen = materialise(histograms(texts), "classes", {"texts": F.count(F.lit(1)), "words": F.sum("words")})
    if not seen["texts"]:
        return Classes(np.zeros(1), np.zeros((1, CLASS_BUCKETS)))
    weights = first_centres(kept, seen["words"] / seen["texts"])
    bias, before, reached = np.zeros(weights.shape[:2]), None, -np.inf
    for round_no in range(CLASS_ROUNDS):
        sizes, sums, value = tallied(kept, weights, bias, damped=round_no == 0)
        if len(value) > 1 and round_no == CLASS_TRIALS:
            best = [int(value.argmax())]
            sizes, sums, value = sizes[best], sums[best], value[best]
        elif len(value) == 1 and (np.array_equal(sums, before) or round_no > 1 and value[0] - reached < CLASS_GAIN * abs(reached)):
            break
        before, reached = sums, value[0]
        share, words = sizes + 0.5, sums + 0.05
        bias, weights = np.log(share / share.sum(axis=1, keepdims=True)), np.log(words / words.sum(axis=2, keepdims=True))
    return Classes(bias[0], weights[0])


def token_counts(texts: DataFrame, classes: Classes) -> DataFrame:
    """(token binary, class, c) of the rows' tokens, the end (empty) included; combined per batch in each task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, 5_000):
            bags = Bags.of(batch.column(0))
            own = classes.of(bags)
            kinds = len(classes.log_share)
            times = np.bincount(bags.ids * kinds + own[bags.owner], minlength=len(bags.words) * kinds)
            key = np.flatnonzero(times)
            ends = np.bincount(own, minlength=kinds)
            some = np.flatnonzero(ends)
            words = pa.array(bags.words, pa.binary()).take(pa.array(key // kinds))
            yield pa.record_batch([pa.concat_arrays([words, pa.array([b""] * len(some), pa.binary())]),
                                   pa.array(np.r_[key % kinds, some].astype(np.int32)), pa.array(np.r_[times[key], ends[some]])],
                                  names=["token", "class", "c"])

    return (texts.select(text_or_empty().alias("text")).mapInArrow(count, "token binary, class int, c long")
            .groupBy("token", "class").agg(F.sum("c").alias("c")))


def sequences(batches: Iterator[pa.RecordBatch], classes: Classes) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """(words, the class of each, the text of each) of the batches' texts, in order."""
    for batch in in_parts(batches):
        bags = Bags.of(batch.column(0))
        words, texts = bags.sequence()
        yield words, classes.of(bags)[texts], texts


def _block_row(block: int, slot: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array([block], pa.int32()), pa.array([slot.astype("<u2").tobytes()], pa.binary()),
                            pa.array([c.tobytes()], pa.binary())], names=["block", "slot", "c"])


def context_counts(texts: DataFrame, tokens: int, code: Code, classes: Classes) -> np.ndarray:
    """(2, slots) context counts of all token occurrences; each task sums its own texts first.

    A task takes about TASK_TOKENS tokens, as each sends up to one whole table,
    in blocks of BLOCK_SLOTS slots; the tasks' blocks are dealt out and added up.
    """
    size = int(OFFSETS[-1])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((2, size), np.float32)
        for words, own, owner in sequences(batches, classes):
            add_counts(table, code, words, own, np.ones(len(words)), owner)
        flat = table.reshape(-1)
        for block in range(-(-flat.size // BLOCK_SLOTS)):
            part = flat[block * BLOCK_SLOTS:(block + 1) * BLOCK_SLOTS]
            slot = np.flatnonzero(part)
            small = part[slot] < 256
            for some, kind in ((slot[small], "u1"), (slot[~small], "<f4")):  # most counts take one byte
                if len(some):
                    yield _block_row(block, some, part[some].astype(kind))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, slot, c in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if block not in sums:
                    sums[block] = np.zeros(BLOCK_SLOTS, np.float64)
                sums[block][np.frombuffer(slot, "<u2")] += np.frombuffer(c, "u1" if 2 * len(c) == len(slot) else "<f4")
        for block, part in sums.items():
            slot = np.flatnonzero(part)
            yield _block_row(block, slot, part[slot].astype("<f4"))

    schema = "block int, slot binary, c binary"
    tasks = max(1, -(-tokens // TASK_TOKENS))
    dealt = texts.select(text_or_empty().alias("text")).coalesce(tasks)
    summed = dealt.mapInArrow(count, schema).repartition(max(COUNT_PARTS, tasks), "block").mapInArrow(add, schema)
    flat = np.zeros(2 * size, np.float32)
    for block, slot, c in materialise(summed, "contexts").toLocalIterator():
        flat[block * BLOCK_SLOTS + np.frombuffer(slot, "<u2").astype(np.int64)] = np.frombuffer(c, "<f4")
    return flat.reshape(2, size)


def fit_weights(texts: DataFrame, model: Model, odds: np.ndarray, classes: Classes) -> None:
    """Mixing weights and map from every training text: learnt by each task, averaged by tokens."""
    shared = texts.sparkSession.sparkContext.broadcast((model.code, odds, classes))
    parts = ("by_seen", "by_place", "refined")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, counted, known = shared.value
        own, seen = Model(code, np.zeros(0, np.int16)), 0
        for words, kinds, owner in sequences(batches, known):
            own.learn(counted, words, kinds, owner)
            seen += len(words)
        if seen:
            yield pa.record_batch([pa.array([seen]), *[pa.array([getattr(own, p).tobytes()], pa.binary()) for p in parts]], names=["n", *parts])

    total, sums = 0, {p: np.zeros(getattr(model, p).shape) for p in parts}
    found = texts.select(text_or_empty().alias("text")).mapInArrow(learn, "n long, by_seen binary, by_place binary, refined binary")
    for row in materialise(found, "weights").toLocalIterator():  # all tasks at once; the driver takes one result after the other
        total += row["n"]
        for p in parts:
            sums[p] += row["n"] * np.frombuffer(row[p], np.float32).reshape(sums[p].shape)
    if total:
        for p in parts:
            setattr(model, p, (sums[p] / total).astype(np.float32))
    shared.unpersist()


@dataclass
class Trained:
    model: Model
    classes: Classes
    frequent: dict[bytes, int]
    tokens: int      # N
    kinds: int       # V


def pair_counts(tokens: Iterable[bytes], times: np.ndarray) -> np.ndarray:
    """(byte before, byte) counts of the terminated tokens, each after a terminator."""
    words = [bytes(t) + b" " for t in tokens]
    flat = np.frombuffer(b" " + b"".join(words), np.uint8).astype(np.int64)
    weight = np.repeat(times, [len(w) for w in words])
    return np.bincount(flat[:-1] * 256 + flat[1:], weights=weight, minlength=1 << 16).reshape(256, 256)


def train(texts: DataFrame) -> tuple[Trained, DataFrame]:
    """Learn from every row of ``texts``; also the table of all token counts, in the shared folder."""
    classes = fit_classes(texts)
    by_class = token_counts(texts, classes)
    counts, seen = materialise(by_class.groupBy("token").agg(F.sum("c").alias("c")), "tokens", {"kinds": F.count(F.lit(1)), "words": F.sum("c")})
    tokens, kinds = int(seen["words"] or 0), int(seen["kinds"])
    top = counts.orderBy(F.desc("c"), "token").limit(FREQUENT).toPandas()  # a table of fixed size
    code = Code(pair_counts(top["token"], top["c"].to_numpy(np.float64)))
    table = context_counts(texts, tokens, code, classes)
    model = Model(code, packed(table))
    odds = left_out(table)
    del table
    fit_weights(texts, model, odds, classes)
    return Trained(model, classes, {bytes(t): int(c) for t, c in zip(top["token"], top["c"], strict=True)}, tokens, kinds), counts


def score(docs: DataFrame, keep: list[str], trained: Trained, counts: DataFrame) -> DataFrame:
    """Rows of ``docs`` (columns ``keep``) with n_tokens, n_known, n_bytes, base_score, score, bits_per_byte; every whole text, null as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(trained)  # FREQUENT tokens and the fixed tables

    kept = [F.col(c).alias(f"__d{i}") for i, c in enumerate(keep)]

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        unit = np.log10(known.tokens + SMOOTH * (known.kinds + 1))
        common = known.frequent.get
        for batch in in_parts(batches):
            bags = Bags.of(batch.column(0))
            own = known.classes.of(bags)
            words = [*bags.words, b""]
            sequence, texts = bags.sequence()
            total = np.bincount(texts, minlength=bags.texts)
            n_bytes = np.bincount(texts, weights=[len(w) + 1 for w in sequence], minlength=bags.texts).astype(np.int64)
            score = np.bincount(texts, weights=known.model.log10_words(sequence, own[texts], texts), minlength=bags.texts)
            score += known.classes.log_share[own] / np.log(10.0)
            # frequent tokens have their counts here, the others go to the join
            c = np.fromiter((common(w, -1) for w in words), np.float64, len(words))
            sure = c >= 0
            unigram = np.where(sure, np.log10(np.maximum(c, 0) + SMOOTH) - unit, 0.0)
            base = bags.sums(unigram[:-1]) + unigram[-1]
            n_known = bags.sums(sure[:-1].astype(np.float64)) + sure[-1]
            rare = np.flatnonzero(~sure[bags.ids])
            pair, times = np.unique(bags.owner[rare] * len(words) + bags.ids[rare], return_counts=True)
            text, word = pair // len(words), pair % len(words)
            if not sure[-1]:  # the end itself is rare or unknown
                text, word, times = np.r_[text, np.arange(bags.texts)], np.r_[word, np.full(bags.texts, len(words) - 1)], np.r_[times, np.ones(bags.texts, np.int64)]
                order = np.argsort(text, kind="stable")
                text, word, times = text[order], word[order], times[order]
            edges = pa.array(np.searchsorted(text, np.arange(bags.texts + 1)).astype(np.int32))
            tokens = pa.ListArray.from_arrays(edges, pa.array(words, pa.binary()).take(pa.array(word)))
            counts_of = pa.ListArray.from_arrays(edges, pa.array(times.astype(np.int32)))
            yield pa.record_batch([*batch.columns[1:], pa.array(total), pa.array(n_known.astype(np.int64)), pa.array(n_bytes), pa.array(base), pa.array(score), tokens, counts_of],
                                  names=[*batch.schema.names[1:], "n_tokens", "n_known", "n_bytes", "base", "score", "tokens", "times"])

    source = docs.select(text_or_empty().alias("__text"), *kept)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields[1:])
    passed = with_row_ids(source.mapInArrow(
        first_pass, f"{fields}, n_tokens long, n_known long, n_bytes long, base double, score double, tokens array<binary>, times array<int>"), "lm")
    rare = passed.select(UID, F.explode(F.arrays_zip(F.col("tokens").alias("token"), F.col("times").alias("n"))).alias("r")).select(
        UID, F.col("r.token").alias("token"), F.col("r.n").alias("n"))
    unit = float(np.log10(trained.tokens + SMOOTH * (trained.kinds + 1)))  # c is 0 for tokens never trained on
    c = F.coalesce("c", F.lit(0))
    found = (rare.join(counts, "token", "left").groupBy(UID).agg(
        F.sum(F.col("n") * (F.log10(c + F.lit(SMOOTH)) - F.lit(unit))).alias("more"),
        F.sum(F.when(c > 0, F.col("n")).otherwise(F.lit(0))).alias("more_known")))
    # a row with no rare token has no match here
    return passed.join(found, UID, "left").select(
        *[F.col(f"__d{i}").alias(c) for i, c in enumerate(keep)], "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"), "n_bytes",
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score",
        (F.col("score") * F.lit(-float(np.log2(10.0))) / F.col("n_bytes")).alias("bits_per_byte"))


def lm_table(docs: DataFrame, folds: int = 10) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, n_bytes, base_score, score, bits_per_byte per row of ``docs``.

    Learns from the rows not held out, repeated ones each. With nothing to
    learn from, bits cost what untrained predictors say and every base
    probability is equal. An empty table gives an empty result. Texts are read
    whole, 2,000 at once, however long.
    """
    out = fold(F.col("doc_id"), folds) == 0
    trained, counts = train(docs.where(~out))
    scored = score(docs, ["doc_id"], trained, counts)
    return scored.select("doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"), "n_tokens", "n_known",
                         F.lit(trained.tokens).cast("long").alias("train_tokens"), "n_bytes", "base_score", "score", "bits_per_byte")
