"""Document fingerprints by I-Match: hashes of the mid-frequency terms, over randomised lexicons.

Document frequencies cover the whole corpus. The lexicon is the terms whose
inverse document frequency ln(N / df) lies in a band. Its size is bounded
whatever N: a term in it has df >= N e^-high, and the df of all terms add up to
N times the mean number of distinct terms, so there are at most (mean distinct
terms) x e^high of them.

Each of FAMILIES hashes orders the lexicon at random; level l of a family is
the subset whose hash has at least l leading zero bits (a share 2^-l of the
lexicon, nested). A fingerprint holds, per family and level, a short hash of
the sorted distinct terms of the document in that subset. Sparse levels
tolerate edits in long texts, dense ones in short texts.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import text_or_empty, total_bytes

IDF_LOW, IDF_HIGH = 4.0, 8.0
FAMILIES, LEVELS = 10, 12
DIGITS = 4
PART_BYTES = 8 << 20
#: parts are streamed in order, so a part may be larger than PART_BYTES; bounds stay few
MAX_PARTS = 20_000
SAMPLE_PER_PART = 20
#: terms whose place in the lexicon a worker remembers; characters of texts signed at once
HELD_TERMS, HELD_CHARS = 500_000, 2 << 20
_U = np.uint64
EMPTY = "0" * DIGITS


def terms_of(raw: bytes) -> set[bytes]:
    return set(raw.lower().split())


def term_hashes(terms) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(t) for t in terms], np.uint64)


def lexicon_of(docs: DataFrame, low: float = IDF_LOW, high: float = IDF_HIGH) -> np.ndarray:
    """Sorted hashes of the terms in the idf band (see the module text for the bound).

    Each task counts its own documents' terms before the shuffle.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def settle() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch([pa.array(values.view(np.int64)), pa.array(counts)], names=["t", "df"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(term_hashes(terms_of(text.encode("utf-8", "surrogatepass"))))
                size += len(held[-1])
                if size > 4_000_000:
                    yield settle()
                    held, size = [], 0
        if size:
            yield settle()

    df = docs.select(text_or_empty().alias("text")).mapInArrow(count, "t long, df long").groupBy("t").agg(F.sum("df").alias("df"))
    n = docs.count()
    rows = df.where((F.lit(float(n)) / F.col("df") >= float(np.exp(low))) & (F.lit(float(n)) / F.col("df") <= float(np.exp(high)))).select("t").toPandas()
    return np.sort(rows["t"].to_numpy(np.int64).view(np.uint64))


def family_levels(terms: np.ndarray) -> np.ndarray:
    """(families, terms): the deepest level of each family a term belongs to."""
    with np.errstate(over="ignore"):
        seeds = np.arange(1, FAMILIES + 1, dtype=np.uint64)[:, None] * _U(0x9E3779B97F4A7C15)
        h = terms[None, :] ^ seeds
        h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
        h ^= h >> _U(31)
    top = (h >> _U(64 - LEVELS)).astype(np.int64)
    return np.where(top == 0, LEVELS, LEVELS - 1 - np.floor(np.log2(np.maximum(top, 1))).astype(np.int64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def run_hashes(terms: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owners, hash of each owner's terms in their order): a polynomial in an odd number, modulo 2^64, over mixed terms.

    ``owner`` ascends; nothing is returned for owners without terms.
    """
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    sizes = np.diff(np.r_[starts, len(owner)])
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(sizes.max()), _U(0x9E3779B97F4A7C15)))
        place = np.arange(len(owner)) - np.repeat(starts, sizes)
        return owner[starts], _mixed(np.add.reduceat(_mixed(terms) * powers[place], starts))


def fields_of(terms: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """(texts, families, levels) 16-bit fields; 0 where a subset holds no term of the text.

    Each text's sorted distinct lexicon terms lie together. A level's terms
    are a subset of the level's before it, so a family costs about one pass.
    """
    out = np.zeros((count, FAMILIES, LEVELS - 1), np.uint16)
    if not len(terms):
        return out
    for family, deepest in enumerate(family_levels(terms)):
        part, own = terms, owner
        for level in range(1, LEVELS):
            keep = deepest >= level
            part, own, deepest = part[keep], own[keep], deepest[keep]
            if not len(part):
                break
            rows, h = run_hashes(part, own)
            out[rows, family, level - 1] = h % _U(16 ** DIGITS - 1) + _U(1)
    return out


def likeness(a: str, b: str) -> float:
    """Share of families with an equal non-empty field, among those with a non-empty field; 1 for equal signatures."""
    if a == b:
        return 1.0
    width = DIGITS * (LEVELS - 1)
    used = equal = 0
    for at in range(DIGITS * 2, len(a), width):
        x, y = a[at:at + width], b[at:at + width]
        if x[:DIGITS] == EMPTY and y[:DIGITS] == EMPTY:
            continue
        used += 1
        equal += any(x[i:i + DIGITS] == y[i:i + DIGITS] != EMPTY for i in range(0, width, DIGITS))
    return equal / used if used else 0.0


def likenesses(a: np.ndarray, b: np.ndarray, same: np.ndarray) -> np.ndarray:
    """``likeness`` of rows of fields; ``same`` says which signatures are equal."""
    used = (a[:, :, 0] | b[:, :, 0]) != 0
    equal = ((a == b) & (a != 0)).any(axis=2)
    total = used.sum(axis=1)
    return np.where(same, 1.0, (equal & used).sum(axis=1) / np.maximum(total, 1))


class Signer:
    """Fingerprints of texts under one lexicon (sorted term hashes).

    A signature's first field hashes all lexicon terms of the text; without
    any it hashes the whole text, so that unlike texts outside the lexicon do
    not meet. A worker remembers the places in the lexicon of the terms it met.
    """

    def __init__(self, lexicon: np.ndarray):
        self.lexicon = lexicon
        self.place: dict[bytes, int] = {}  # 1 + place in the lexicon; 0: not in it

    def _learn(self, terms: list[bytes]) -> None:
        h = term_hashes(terms)
        at = np.minimum(np.searchsorted(self.lexicon, h), max(0, len(self.lexicon) - 1))
        found = self.lexicon[at] == h if len(self.lexicon) else np.zeros(len(h), bool)
        self.place.update(zip(terms, np.where(found, at + 1, 0).tolist(), strict=True))

    def sign(self, raws: list[bytes]) -> tuple[list[str], np.ndarray]:
        """(signatures, fields) of texts."""
        words = [terms_of(r) for r in raws]
        if len(self.place) > HELD_TERMS:
            self.place.clear()
        known = self.place
        if new := [t for t in set().union(*words) if t not in known]:
            self._learn(new)
        flat = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), np.int64, sum(map(len, words)))
        owner = np.repeat(np.arange(len(raws)), [len(w) for w in words])
        width = len(self.lexicon) + 1
        both = np.unique(owner[flat > 0] * width + flat[flat > 0])
        owner, terms = both // width, self.lexicon[both % width - 1] if len(both) else np.zeros(0, np.uint64)
        fields = fields_of(terms, owner, len(raws))
        first = [xxhash.xxh3_128_hexdigest(r)[:DIGITS * 2] for r in raws]
        if len(both):
            for row, h in zip(*(x.tolist() for x in run_hashes(terms, owner)), strict=True):
                first[row] = f"{h >> 32:08x}"
        return [a + f.tobytes().hex() for a, f in zip(first, fields.astype(">u2"), strict=True)], fields


def fingerprint(raw: bytes, terms: np.ndarray) -> str:
    """The signature of a text with sorted lexicon terms ``terms``."""
    if not len(terms):
        return xxhash.xxh3_128_hexdigest(raw)[:DIGITS * 2] + EMPTY * (FAMILIES * (LEVELS - 1))
    own = np.zeros(len(terms), np.int64)
    return f"{int(run_hashes(terms, own)[1][0]) >> 32:08x}" + fields_of(terms, own, 1).astype(">u2").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many of the next text's first."""
    cut = len(text) // 3
    return text[:len(text) - cut] + following[:cut]


def _order(doc_id: int | None, h: int) -> tuple:
    """Descending doc_id, null last; equal ids by text hash."""
    return (doc_id is None, -(doc_id or 0), h)


def fingerprint_table(docs: DataFrame, low: float = IDF_LOW, high: float = IDF_HIGH) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next per row.

    The next document is the next lower doc_id (the highest after the last);
    null ids come last, equal ids go by text hash. Null text is empty. A table
    of one row is its own next; an empty table gives an empty result. Ids are
    cast to long (text that is no number raises under ANSI); rows equal in id and
    text are interchangeable. A very long text is signed by itself.

    Texts move once, compressed, into parts of consecutive rows; a copy of the
    first row of each part goes to the part before it as its last row's next.
    Part bounds come from a bounded sample (they shape the parts' sizes only).
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("h"), text_or_empty().alias("text"))
    signer = Signer(lexicon_of(docs, low, high))
    _, size = total_bytes(docs)
    parts = min(MAX_PARTS, max(1, -(-size // PART_BYTES)))
    # a bounded sample, least by hash
    sample = texts.select("doc_id", "h").orderBy(F.xxhash64("h", "doc_id"), "doc_id").limit(parts * SAMPLE_PER_PART).collect()
    keys = sorted(_order(r[0], r[1]) for r in sample)
    bounds = sorted({keys[i * len(keys) // parts] for i in range(1, parts)}) if keys else []

    @F.pandas_udf("long")
    def part_of(doc_id, h):
        import pandas as pd
        return pd.Series([bisect_left(bounds, _order(None if d != d else int(d), x)) for d, x in zip(doc_id.tolist(), h.tolist(), strict=True)], dtype="int64")

    keyed = texts.select("doc_id", "h").withColumn("p", part_of("doc_id", "h"))
    first_of = {r["p"]: (r["k"]["n"], r["k"]["d"], r["k"]["h"]) for r in keyed.groupBy("p").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.coalesce(-F.col("doc_id"), F.lit(0)).alias("d"), F.col("h").alias("h"))).alias("k")).collect()}
    used = sorted(first_of)  # one row per part
    lends = {first_of[p]: used[i - 1] for i, p in enumerate(used)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(3)
        for batch in batches:
            rows = []
            for d, h, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key, packed = _order(d, h), press.compress(t.encode("utf-8", "surrogatepass"))
                rows.append((bisect_left(bounds, key), False, key[1], key[0], h, d, packed))
                if key in lends:
                    rows.append((lends[key], True, key[1], key[0], h, d, packed))
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                    pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                    names=["p", "lent", "rank", "none", "h", "doc_id", "packed"])

    dealt = texts.mapInArrow(deal, "p long, lent boolean, rank long, none boolean, h long, doc_id long, packed binary")
    shared = spark.sparkContext.broadcast(signer.lexicon)  # plain values travel; workers need not have this package

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        known = Signer(shared.value)
        waiting: list[tuple] = []  # rows of the part so far without a next: (doc_id, text)
        part, over, held = None, False, 0

        def settle(pairs: list[tuple]) -> pa.RecordBatch:
            now, then = [p[0][1] for p in pairs], [p[1][1] for p in pairs]
            new = [edited(a, b) for a, b in zip(now, then, strict=True)]
            # pairs are consecutive rows: the next of each is the one after it
            signs, fields = known.sign([t.encode("utf-8", "surrogatepass") for t in [*now, then[-1]]])
            changed, moved = known.sign([t.encode("utf-8", "surrogatepass") for t in new])
            own, here = signs[:-1], fields[:-1]
            near_edited = likenesses(here, moved, np.array([a == b for a, b in zip(own, changed, strict=True)]))
            near_next = likenesses(here, fields[1:], np.array([a == b for a, b in zip(own, signs[1:], strict=True)]))
            return pa.record_batch([
                pa.array([p[0][0] for p in pairs], pa.int64()), pa.array([len(t) for t in now], pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in new]), pa.array(own), pa.array(changed),
                pa.array(near_edited), pa.array(near_next)],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        for batch in batches:
            for p, lent, d, packed in zip(*(batch.column(c).to_pylist() for c in ("p", "lent", "doc_id", "packed")), strict=True):
                if p != part:
                    part, over = p, False
                if lent and over:
                    continue  # copies of the part's next row
                row = (d, unpack.decompress(packed).decode("utf-8", "surrogatepass"))
                waiting.append(row)
                held += len(row[1])
                if lent or (len(waiting) > 1 and (len(waiting) > 256 or held > HELD_CHARS)):
                    yield settle(list(zip(waiting, waiting[1:], strict=False)))
                    waiting = [] if lent else waiting[-1:]
                    held = sum(len(w[1]) for w in waiting)
                over = lent

    return (dealt.repartition("p").sortWithinPartitions("p", "lent", "none", "rank", "h").select("p", "lent", "doc_id", "packed")
            .mapInArrow(sign, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                              "near_edited double, near_next double"))
