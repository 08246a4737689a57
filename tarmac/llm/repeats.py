"""Repeated passages across a corpus: exact, by a prefix-free style parsing.

Rolling-hash triggers cut each text into phrases: a window of ``length`` bytes
is governed by the least rolling hash of a k-gram inside it (leftmost of
equals), and the windows of one trigger position form a phrase. The rule looks
at the window's bytes only, so equal windows have equal triggers at equal
places, in whatever document they stand, and every window lies in just one
phrase. Consequences, all exact:

* a trigger value seen once in the corpus governs no repeated window;
* a phrase seen twice is repeated as a whole;
* all other repeats lie between different phrases of one trigger value. These
  phrases form the dictionary. They are aligned at their trigger and sorted by
  what follows it and by what precedes it (suffix arrays with common prefix
  lengths); both orders together tell which windows are equal to another's.

The texts are parsed three times rather than stored: counts of trigger values,
then the parse of phrases with a shared trigger, then the dictionary's bytes.
Fixed-size Bloom filters carry "is shared" and "is needed" back to the texts;
a false positive only costs time. Triggers of more than ``hot`` dictionary
phrases (a passage that very many documents share) are settled by counting
window hashes instead, combined map-side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import text_or_empty
from tarmac.plans.layers import materialise

LENGTH = 200
GRAM = 32
HOT = 20_000
BLOOM_BITS = 1 << 27
#: bytes parsed at once; the arrays over them take about 100 times as much
BATCH_BYTES = 1 << 19
_ODD = 0x9E3779B97F4A7C15
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
_U = np.uint64


def _codes() -> np.ndarray:
    return np.random.default_rng(7).integers(0, 2**63, 256, dtype=np.uint64) | _U(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(29))
    h = h * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


def gram_hashes(flat: np.ndarray, gram: int) -> np.ndarray:
    """Rolling hash of every ``gram`` bytes (by doubling), mixed."""
    h, width, rest, done = _codes()[flat], 1, gram, None
    done_width = 0
    while rest:
        if rest & 1:
            if done is None:
                done, done_width = h, width
            else:
                n = len(flat) - done_width - width + 1
                done = done[:n] * _U(pow(_ODD, width, 1 << 64)) + h[done_width:done_width + n]
                done_width += width
        rest >>= 1
        if rest:
            h = h[:-width] * _U(pow(_ODD, width, 1 << 64)) + h[width:]
            width *= 2
    return _mixed(done)


def parse(texts: list[bytes], length: int, gram: int) -> pd.DataFrame:
    """Phrases of the texts: text number, start, windows n, trigger place in the phrase, trigger value m."""
    span = length - gram + 1
    parts = []
    at, total = 0, len(texts)
    while at < total:
        upto, size = at, 0
        while upto < total and (upto == at or size + len(texts[upto]) <= BATCH_BYTES):
            size += len(texts[upto])
            upto += 1
        long_enough = [i for i in range(at, upto) if len(texts[i]) >= length]
        at = upto
        if not long_enough:
            continue
        sizes = np.array([len(texts[i]) for i in long_enough], np.int64)
        begins = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(texts[i] for i in long_enough), np.uint8)
        h = gram_hashes(flat, gram)
        # (hash, place) in one number: its minimum is the least hash, leftmost of equals
        low = _U(max(24, int(len(h)).bit_length()))
        key = (h << low) | np.arange(len(h), dtype=np.uint64)
        n = len(key)
        blocks = np.concatenate([key, np.full(-n % span, _FULL)]).reshape(-1, span)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        place = (np.minimum(back[:n - span + 1], ahead[span - 1:n]) & ((_U(1) << low) - _U(1))).astype(np.int64)
        owner = np.repeat(np.arange(len(sizes)), sizes)[:len(place)]
        inside = np.arange(len(place)) - begins[owner] <= sizes[owner] - length
        window = np.flatnonzero(inside)
        new = np.r_[True, (place[window][1:] != place[window][:-1]) | (np.diff(window) != 1)]
        first = window[new]
        count = np.diff(np.r_[np.flatnonzero(new), len(window)])
        parts.append(pd.DataFrame({"doc": np.array(long_enough)[owner[first]], "start": first - begins[owner[first]], "n": count,
                                   "anchor": place[first] - first, "m": h[place[first]].view(np.int64)}))
    return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(
        {c: np.zeros(0, np.int64) for c in ("doc", "start", "n", "anchor", "m")})


def bloom_of(values: DataFrame, column: str) -> np.ndarray:
    """Fixed-size Bloom filter (two bits a value) of a long column: BLOOM_BITS / 8 bytes whatever the table."""
    spots = [F.xxhash64(column, F.lit(s)).bitwiseAND(F.lit(BLOOM_BITS - 1)) for s in (1, 2)]
    words = (values.select(F.explode(F.array(*spots)).alias("bit"))
             .groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(F.lit(63)).cast("int"))).alias("bits")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:  # few large values instead of many rows
        for batch in batches:
            yield pa.record_batch([pa.array([batch.column(0).to_numpy().astype("<u4").tobytes()], pa.binary()),
                                   pa.array([batch.column(1).to_numpy().astype("<i8").tobytes()], pa.binary())], names=["word", "bits"])

    table = np.zeros(BLOOM_BITS // 64, np.int64)
    for word, bits in words.mapInArrow(pack, "word binary, bits binary").collect():
        table[np.frombuffer(word, "<u4")] = np.frombuffer(bits, "<i8")
    return table.view(np.uint64)


def _bits_of(values: np.ndarray, seed: int) -> np.ndarray:
    """The same spot as Spark's xxhash64(value, seed) over two values, in numpy (unsigned)."""
    def one(v: np.ndarray, start: np.ndarray) -> np.ndarray:
        p1, p2, p3 = _U(0x9E3779B185EBCA87), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)
        p4, p5 = _U(0x85EBCA77C2B2AE63), _U(0x27D4EB2F165667C5)

        def turn(x, r):
            return (x << _U(r)) | (x >> _U(64 - r))

        h = start + p5 + _U(8)
        h = h ^ (turn(v * p2, 31) * p1)
        h = turn(h, 27) * p1 + p4
        h = (h ^ (h >> _U(33))) * p2
        h = (h ^ (h >> _U(29))) * p3
        return h ^ (h >> _U(32))

    def one_int(v: int, start: np.ndarray) -> np.ndarray:
        p1, p2, p3, p5 = _U(0x9E3779B185EBCA87), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9), _U(0x27D4EB2F165667C5)
        h = start + p5 + _U(4)
        h = h ^ (_U(v) * p1)
        h = ((h << _U(23)) | (h >> _U(41))) * p2 + p3
        h = (h ^ (h >> _U(33))) * p2
        h = (h ^ (h >> _U(29))) * p3
        return h ^ (h >> _U(32))

    with np.errstate(over="ignore"):
        return one_int(seed, one(values.view(np.uint64), np.full(len(values), 42, np.uint64))) & _U(BLOOM_BITS - 1)


def maybe_in(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    found = np.ones(len(values), bool)
    for seed in (1, 2):
        bit = _bits_of(values, seed)
        found &= (table[(bit >> _U(6)).astype(np.int64)] >> (bit & _U(63))) & _U(1) == 1
    return found


def text_key(text: Column) -> list[Column]:
    """Texts are told apart by a 64-bit hash and their length; copies share a key."""
    return [F.xxhash64(text).alias("k"), F.octet_length(text).alias("n_bytes")]


def _id(m: np.ndarray, f: np.ndarray, k: np.ndarray) -> np.ndarray:
    """One number for (trigger, phrase, text): all three are hashes already."""
    return m ^ f ^ k


def _phrases(texts: DataFrame, length: int, gram: int, stage: str, filters: list) -> DataFrame:
    """Parse (k, n_bytes, text) rows. Stage "triggers": counts per task; "shared": phrases whose
    trigger is in the filter; "needed": dictionary phrases with their bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in range(0, batch.num_rows, 1000):
                part = batch.slice(cut, 1000)
                raw = [t.encode("utf-8", "surrogatepass") for t in part.column(2).to_pylist()]
                found = parse(raw, length, gram)
                m = found["m"].to_numpy()
                if stage == "triggers":
                    values, counts = np.unique(m, return_counts=True)
                    yield pa.record_batch([pa.array(values), pa.array(counts)], names=["m", "c"])
                    continue
                found = found[maybe_in(filters[0].value, m)]
                doc, start, n = (found[c].to_numpy() for c in ("doc", "start", "n"))
                cuts = [raw[d][s:s + w + length - 1] for d, s, w in zip(doc.tolist(), start.tolist(), n.tolist(), strict=True)]
                f = np.array([xxhash.xxh3_64_intdigest(c) for c in cuts], np.uint64).view(np.int64)
                m, anchor = found["m"].to_numpy(), found["anchor"].to_numpy()
                k = part.column(0).to_numpy(zero_copy_only=False)[doc]
                size = part.column(1).to_numpy(zero_copy_only=False)[doc]
                arrays = {"k": k, "n_bytes": size.astype(np.int32), "start": start.astype(np.int32), "n": n.astype(np.int32), "m": m, "f": f}
                if stage == "needed":
                    use = maybe_in(filters[1].value, _id(m, f, k))
                    arrays = {c: v[use] for c, v in arrays.items()} | {"anchor": anchor[use].astype(np.int32)}
                    cols = [pa.array(v) for v in arrays.values()] + [pa.array([c for c, u in zip(cuts, use, strict=True) if u], pa.binary())]
                    yield pa.record_batch(cols, names=[*arrays, "phrase"])
                else:
                    yield pa.record_batch([pa.array(v) for v in arrays.values()], names=list(arrays))

    schema = {"triggers": "m long, c long", "shared": "k long, n_bytes int, start int, n int, m long, f long",
              "needed": "k long, n_bytes int, start int, n int, m long, f long, anchor int, phrase binary"}[stage]
    return texts.mapInArrow(run, schema)


def _sorted_lcp(context: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of equally long contexts inside their groups, and the common prefix with the row before."""
    wide = np.ascontiguousarray(np.pad(context, ((0, 0), (0, -context.shape[1] % 8)))).view(">u8").astype(np.uint64)
    order = np.lexsort([*wide.T[::-1], group])
    rows = context[order]
    differs = rows[1:] != rows[:-1]
    lcp = np.where(differs.any(axis=1), differs.argmax(axis=1), context.shape[1])
    lcp[group[order][1:] != group[order][:-1]] = -1
    return order, np.r_[-1, lcp]


def repeated_windows(phrases: list[bytes], anchor: np.ndarray, n: np.ndarray, group: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """(phrase, from, to): runs of windows that stand in another phrase of the group too.

    Windows can only be equal at the same distance o before their trigger, so
    window (phrase, o) is in the class of its o bytes before the trigger, and of
    its ``length`` - o bytes from there on.
    """
    rows = len(phrases)
    before, after = np.zeros((rows, length), np.uint8), np.zeros((rows, length), np.uint8)
    for i, p in enumerate(phrases):
        raw = np.frombuffer(p, np.uint8)
        left, right = raw[:anchor[i]][::-1], raw[anchor[i]:][:length]
        before[i, :len(left)] = left
        after[i, :len(right)] = right
    by_before, lcp_before = _sorted_lcp(before, group)
    by_after, lcp_after = _sorted_lcp(after, group)
    hit = np.zeros((rows, length + 1), bool)
    class_before, class_after = np.empty(rows, np.int64), np.empty(rows, np.int64)
    least, most = anchor - n + 1, anchor  # o of the last and of the first window
    for o in range(int(max(least.min(), 0)), int(most.max()) + 1):
        has = np.flatnonzero((least <= o) & (o <= most))
        if len(has) < 2:
            continue
        class_before[by_before] = np.cumsum(lcp_before < o)
        class_after[by_after] = np.cumsum(lcp_after < length - o)
        both = class_before[has] * (rows + 1) + class_after[has]
        order = np.argsort(both, kind="stable")
        same = both[order][1:] == both[order][:-1]
        twice = np.zeros(len(has), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit[has[twice], o] = True
    for i in np.flatnonzero(hit.any(axis=1)).tolist():
        flags = hit[i, least[i]:most[i] + 1][::-1]  # by window: the first has the largest o
        edge = np.flatnonzero(np.diff(np.r_[False, flags, False]))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            yield i, a, b


def _compare(dictionary: DataFrame, length: int, flush_rows: int = 12_000) -> DataFrame:
    """Spans (k, n_bytes, a, b) of dictionary phrases with a window elsewhere; sorted by trigger inside tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held)
            m = t.column("m").to_numpy()
            group = np.cumsum(np.r_[False, m[1:] != m[:-1]])
            keep = np.flatnonzero(np.bincount(group)[group] > 1)
            if not len(keep):
                return
            t = t.take(pa.array(keep))
            start = t.column("start").to_numpy().astype(np.int64)
            runs = list(repeated_windows(t.column("phrase").to_pylist(), t.column("anchor").to_numpy().astype(np.int64),
                                         t.column("n").to_numpy().astype(np.int64), group[keep], length))
            if runs:
                i, a, b = (np.array(x) for x in zip(*runs, strict=True))
                out = t.select(["k", "n_bytes"]).take(pa.array(i))
                yield pa.record_batch([out.column(0).combine_chunks(), out.column(1).combine_chunks(),
                                       pa.array((start[i] + a).astype(np.int32)), pa.array((start[i] + b + length - 1).astype(np.int32))],
                                      names=["k", "n_bytes", "a", "b"])

        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            for cut in range(0, batch.num_rows, 2000):
                part = batch.slice(cut, 2000)
                m = part.column(part.schema.get_field_index("m")).to_numpy()
                if rows >= flush_rows:  # close after the last whole trigger
                    last = held[-1].column(held[-1].schema.get_field_index("m"))[-1].as_py()
                    more = int((m == last).sum()) if m[0] == last else 0
                    if more < len(m):
                        held.append(part.slice(0, more))
                        yield from settle(held)
                        held, rows, part = [], 0, part.slice(more)
                held.append(part)
                rows += part.num_rows
        if rows:
            yield from settle(held)

    return (dictionary.repartition("m").sortWithinPartitions("m")
            .mapInArrow(run, "k long, n_bytes int, a int, b int"))


def _compare_hot(dictionary: DataFrame, length: int) -> DataFrame:
    """The same for triggers of very many phrases: windows are counted by hash, combined map-side."""
    window = F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i")
    cut = F.expr(f"substring(phrase, i + 1, {length})")
    rows = dictionary.select("k", "n_bytes", "start", "m", "phrase", window).select(
        "k", "n_bytes", (F.col("start") + F.col("i")).alias("a"), F.xxhash64(cut).alias("h"), F.xxhash64(cut, F.lit(3)).alias("h2"))
    rows = materialise(rows, "windows")
    twice = rows.groupBy("h", "h2").count().where("count > 1").select("h", "h2")
    return rows.join(twice, ["h", "h2"], "left_semi").select("k", "n_bytes", "a", (F.col("a") + length).cast("int").alias("b"))


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(k, n_bytes, spans): per distinct text, byte spans covered by a repeated window (unmerged).

    ``texts`` has k, n_bytes, text (``text_key``), copies included.
    """
    spark = texts.sparkSession
    long_texts = texts.where(F.col("n_bytes") >= length)
    triggers = _phrases(long_texts, length, gram, "triggers", []).groupBy("m").agg(F.sum("c").alias("c")).where("c > 1")
    filters = [spark.sparkContext.broadcast(bloom_of(triggers.select("m"), "m"))]
    parsed = materialise(_phrases(long_texts, length, gram, "shared", filters), "parse")
    entries = materialise(parsed.groupBy("m", "f").agg(F.count(F.lit(1)).alias("c"), F.min("k").alias("k")), "phrases")
    # a trigger needs its dictionary when it has two phrases, one of them seen once
    open_m = entries.groupBy("m").agg(F.count(F.lit(1)).alias("kinds"), F.min("c").alias("least")).where("kinds > 1 and least = 1")
    whole = (parsed.join(entries.where("c > 1").select("m", "f"), ["m", "f"], "left_semi")
             .select("k", "n_bytes", F.col("start").alias("a"), (F.col("start") + F.col("n") + length - 1).cast("int").alias("b")))
    needed = entries.join(open_m.select("m", "kinds"), "m").select("m", "f", "k", "kinds")
    needed = materialise(needed.withColumn("id", F.col("m").bitwiseXOR(F.col("f")).bitwiseXOR(F.col("k"))), "needed")
    filters.append(spark.sparkContext.broadcast(bloom_of(needed.select("id"), "id")))
    dictionary = _phrases(long_texts, length, gram, "needed", filters)
    hot_m = needed.where(F.col("kinds") > hot).select("m").distinct()
    dictionary = materialise(dictionary, "dictionary")
    cold = _compare(dictionary.join(hot_m, "m", "left_anti"), length)
    warm = _compare_hot(dictionary.join(hot_m, "m", "left_semi"), length)
    spans = whole.unionByName(cold).unionByName(warm)
    return spans.distinct().groupBy("k", "n_bytes").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans"))


def merged(spans: list) -> list[tuple[int, int]]:
    """Sorted (a, b) spans, overlapping or touching ones joined."""
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, kept (binary), n_removed, n_spans per row of ``docs``.

    A byte goes when it is covered by a ``length``-byte string that starts
    anywhere else too, copies of the document included. Null text is empty;
    texts shorter than ``length`` are kept whole; an empty table gives an empty result.
    """
    if not 1 <= gram <= length:
        raise ValueError("gram must be 1..length")
    text = text_or_empty()
    texts = docs.select("doc_id", *text_key(text), text.alias("text"))
    spans = materialise(repeated_spans(texts.select("k", "n_bytes", "text"), length, gram, hot), "spans")
    joined = (texts.where(F.col("n_bytes") >= length).join(spans, ["k", "n_bytes"], "left").select("doc_id", "n_bytes", "text", "spans"))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed, count = [], [], []
            for t, found in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                raw = t.encode("utf-8", "surrogatepass")
                gaps = merged([(s["a"], s["b"]) for s in found or []])
                edges = [0, *(x for g in gaps for x in g), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                removed.append(sum(b - a for a, b in gaps))
                count.append(len(gaps))
            yield pa.record_batch([batch.column(0), batch.column(1).cast(pa.int64()), pa.array(kept, pa.binary()),
                                   pa.array(removed, pa.int64()), pa.array(count, pa.int64())],
                                  names=["doc_id", "n_bytes", "kept", "n_removed", "n_spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = joined.mapInArrow(strip, f"doc_id {kind}, n_bytes long, kept binary, n_removed long, n_spans long")
    short = texts.where(F.col("n_bytes") < length).select(
        "doc_id", F.col("n_bytes").cast("long").alias("n_bytes"), F.col("text").cast("binary").alias("kept"),
        F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"))
    return out.unionByName(short)


def repeat_table(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row of ``docs``."""
    return remove_repeats(docs, length).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
