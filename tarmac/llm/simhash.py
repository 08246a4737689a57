"""SimHash near-duplicates: word-shingle fingerprints, linked by Hamming distance.

``fingerprints`` gives one 64-bit value per text; ``link_fingerprints`` finds
all links within the radius between distinct values; ``near_duplicates`` puts
both together.

Candidates come from an exact pigeonhole split: of ``radius + 2`` bit blocks at
least two are equal in any linked pair, so pairs meet under one of the
C(radius + 2, 2) two-block keys. Inside a key the comparison is bit-sliced:
fingerprints are stored as 64 vertical bit planes, 64 lanes to a word, and a
query adds its 64 difference planes into carry-save counters; words in which
every lane exceeds the radius are abandoned. Keys with more than ``tile``
members are split into tiles that meet pairwise, so no task holds an
unbounded group. A task returns one link per member (to the least member of
its local group), never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import text_or_empty
from tarmac.llm.components import connected_components
from tarmac.plans.layers import materialise

SEED = 42
LANES = 64


def simhash(text: str, shingle: int) -> int:
    """Unsigned fingerprint of one text: bit set when over half the shingle hashes have it."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65536):  # bounds memory on very long texts
        part = [digest(b" ".join(words[i:i + shingle]), SEED) for i in range(at, min(n, at + 65536))]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist()))


def fingerprints(docs: DataFrame, name: str, shingle: int = 4, text: str = "text") -> DataFrame:
    """``docs`` plus column ``name``: the fingerprint as a signed 64-bit long."""

    @F.pandas_udf("long")
    def fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([simhash(t, shingle) for t in batch], np.uint64).view(np.int64))

    return docs.withColumn(name, fingerprint(text_or_empty(text)))


def block_bounds(blocks: int) -> list[tuple[int, int]]:
    """(first bit, width) of nearly equal bit blocks covering 64 bits."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def bit_planes(values: np.ndarray) -> np.ndarray:
    """(64, words) array: plane b holds bit b of 64 consecutive values in each word."""
    padded = np.zeros(-(-len(values) // LANES) * LANES, np.uint64)
    padded[:len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, LANES, 8), axis=2, bitorder="little")
    packed = np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64)[:, :, 0]


def lanes_within(planes: np.ndarray, values: np.ndarray, query: np.ndarray, word: np.ndarray,
                 allowed: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, lane) pairs within ``radius`` (at most 7), bit-sliced.

    One row of work is a query value against one 64-lane word. The distance of
    each lane is kept in three counter planes with a sticky overflow; a word is
    abandoned once all its allowed lanes have passed the radius.
    """
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    c = [np.zeros(len(query), np.uint64) for _ in range(3)]
    over = ~allowed
    for b in range(64):
        flip = np.where((values[query] >> np.uint64(b)) & np.uint64(1), full, np.uint64(0))
        carry = planes[b][word] ^ flip
        for plane in c:
            high = plane & carry
            plane ^= carry
            carry = high
        over |= carry
        if b % 6 == 5 or b == 63:
            beyond = over.copy()
            # counter > radius, bit by bit from the top
            tied = np.full(len(query), full)
            for k in (2, 1, 0):
                if (radius >> k) & 1:
                    tied &= c[k]
                else:
                    beyond |= tied & c[k]
                    tied &= ~c[k]
            over = beyond  # a lane beyond the radius never comes back
            keep = over != full
            if b == 63 or keep.mean() < 0.7:
                query, word, over = query[keep], word[keep], over[keep]
                c = [plane[keep] for plane in c]
        if not len(query):
            return
    hits = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, lane = np.nonzero(hits)
    yield query[row], word[row] * LANES + lane


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union the label groups of a[i] and b[i]; labels are least members."""
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def link_runs(values: np.ndarray, runs: np.ndarray, radius: int, work: int = 1 << 16) -> np.ndarray:
    """Least member (index) of each value's group, linking only inside a run.

    ``runs`` numbers consecutive runs. Long runs are first thinned by stars: a
    pivot links all values within the radius at once, and later work between
    two lanes of one star is left out.
    """
    n = len(values)
    label = np.arange(n)
    starts = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]])
    ends = np.r_[starts[1:], n]
    order = np.arange(n)
    for s, e in zip(starts, ends, strict=True):
        if e - s > 4 * LANES:
            free = np.arange(s, e)
            for _ in range(64):
                if not len(free):
                    break
                near = np.bitwise_count(values[free] ^ values[free[0]]) <= radius
                label[free[near]] = free[0]
                free = free[~near]
            order[s:e] = s + np.argsort(label[s:e], kind="stable")
    values, star = values[order], label[order]
    planes = bit_planes(values)
    first, last = np.repeat(starts, ends - starts), np.repeat(ends, ends - starts)
    local = np.arange(n)
    local = _merge(local, local.copy(), np.argsort(order)[star])
    padded = np.r_[star, np.full(-n % LANES, -1)].reshape(-1, LANES)
    low, high = padded.min(axis=1), padded.max(axis=1)
    at = np.arange(n)
    # a value meets the words from its own on; earlier lanes have met it already
    spans = (last - 1) // LANES - at // LANES + 1
    spans[last - first < 2] = 0
    done = 0
    while done < n:
        upto = max(done + 1, int(np.searchsorted(np.cumsum(spans[done:]), work)) + done)
        query = np.repeat(at[done:upto], spans[done:upto])
        step = np.arange(len(query)) - np.repeat(np.cumsum(spans[done:upto]) - spans[done:upto], spans[done:upto])
        word = query // LANES + step
        mixed = (low[word] != star[query]) | (high[word] != star[query])
        query, word = query[mixed], word[mixed]
        for i in range(0, len(query), work // 4):
            q, w = query[i:i + work // 4], word[i:i + work // 4]
            lanes_below = np.clip(last[q] - w * LANES, 0, LANES).astype(np.uint64)
            lanes_from = np.clip(q + 1 - w * LANES, 0, LANES).astype(np.uint64)
            full = np.uint64(0xFFFFFFFFFFFFFFFF)
            below = np.where(lanes_below >= 64, full, (np.uint64(1) << (lanes_below % np.uint64(64))) - np.uint64(1))
            since = np.where(lanes_from >= 64, full, (np.uint64(1) << (lanes_from % np.uint64(64))) - np.uint64(1))
            for a, b in lanes_within(planes, values, q, w, below & ~since, radius):
                local = _merge(local, a, b)
        done = upto
    out = np.empty(n, np.int64)
    out[order] = order[local]
    return out


def link_fingerprints(distinct: DataFrame, name: str, radius: int = 4, tile: int = 65536) -> DataFrame:
    """Links (a, b) between distinct fingerprints: a spanning set per key, none lost.

    ``distinct`` holds each fingerprint once (a null one is not allowed).
    """
    if not 0 <= radius <= 7:
        raise ValueError("radius must be 0..7 (three counter planes)")
    bounds = block_bounds(radius + 2)
    value = F.col(name)

    def cut(first: int, width: int):
        return F.shiftrightunsigned(value, first).bitwiseAND(F.lit((1 << width) - 1))

    keys = [F.struct(F.lit(t).cast("int").alias("t"),
                     (F.shiftleft(cut(*bounds[i]), 32) + cut(*bounds[j])).alias("k"))
            for t, (i, j) in enumerate(combinations(range(radius + 2), 2))]
    keyed = distinct.select(value.alias("v"), F.explode(F.array(*keys)).alias("key")).select("v", "key.t", "key.k")
    # keys held by more than a tile: their members meet tile by tile
    big = (keyed.groupBy("t", "k").count().where(F.col("count") > tile)
           .select("t", "k", F.ceil(F.col("count") / tile).cast("int").alias("tiles")))
    own = F.pmod(F.xxhash64("v"), F.coalesce("tiles", F.lit(1))).cast("int")
    met = F.explode(F.sequence(F.lit(0), F.coalesce("tiles", F.lit(1)) - 1))
    dealt = (keyed.join(big, ["t", "k"], "left").withColumn("own", own).select("v", "t", "k", "own", met.alias("other"))
             .select("v", "t", "k", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
            cols = [table.column(c).to_numpy() for c in ("t", "k", "x", "y")]
            v = table.column("v").to_numpy().view(np.uint64)
            if not len(v):
                return
            change = np.zeros(len(v), bool)
            for col in cols:
                change[1:] |= col[1:] != col[:-1]
            least = link_runs(v, np.cumsum(change), radius)
            own = least != np.arange(len(v))
            if own.any():
                pairs = np.unique(np.c_[v[own].view(np.int64), v[least[own]].view(np.int64)], axis=0)
                yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        def last_key(b: pa.RecordBatch, i: int) -> tuple:
            return tuple(b.column(c)[i].as_py() for c in ("t", "k", "x", "y"))

        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            # whole keys only: hold back the rows of the key that may go on
            if rows > 200_000 and last_key(held[-1], held[-1].num_rows - 1) != last_key(batch, 0):
                yield from flush(pa.Table.from_batches(held))
                held, rows = [], 0
            held.append(batch)
            rows += batch.num_rows
        if held:
            yield from flush(pa.Table.from_batches(held))

    return (dealt.repartition("t", "k", "x", "y").sortWithinPartitions("t", "k", "x", "y")
            .select("v", "t", "k", "x", "y").mapInArrow(link, "a long, b long").distinct())


def near_duplicates(tagged: DataFrame, name: str, member: str, radius: int = 4) -> DataFrame:
    """(fingerprint, group, first) per distinct fingerprint of ``tagged``.

    ``group`` is the least fingerprint reached; ``first`` is the least non-null
    ``member`` value among all rows of the group (null when it has none).
    """
    distinct = materialise(tagged.groupBy(name).agg(F.min(member).alias("first")), "fingerprints")
    roots = connected_components(link_fingerprints(distinct, name, radius), "a", "b")
    grouped = materialise(
        distinct.join(roots, F.col(name) == F.col("node"), "left")
        .select(name, F.coalesce("root", name).alias("group"), "first"), "groups")
    firsts = grouped.groupBy("group").agg(F.min("first").alias("first"))
    return grouped.drop("first").join(firsts, "group").select(name, "group", "first")


def component_table(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``.

    Null text counts as empty (fingerprint zero, linked like any other).
    Repeated rows come back repeated. component_id is null only for a group
    all of whose doc_ids are null. An empty table gives an empty result.
    """
    tagged = materialise(fingerprints(docs.select("doc_id", "text"), "fp", shingle).select("doc_id", "fp"), "simhash")
    groups = near_duplicates(tagged, "fp", "doc_id", radius)
    return tagged.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first").alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``docs`` less near-duplicates: of each group the row with the
    least doc_id stays (a null id counts last; of equal ids, one)."""
    from tarmac.llm.common import UID, with_row_ids

    tagged = with_row_ids(fingerprints(docs, "__fp", shingle), "simhash")
    narrow = tagged.select("__fp", F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"),
                                            F.col(UID).alias("u")).alias("who"))
    groups = near_duplicates(narrow, "__fp", "who", radius)
    kept = groups.select(F.col("first.u").alias(UID)).distinct()
    return tagged.join(kept, UID, "left_semi").select(*docs.columns)
