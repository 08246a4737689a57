"""Best-fit packing of tokenised documents, certified by dual-feasible bounds.

``pieces`` tokenises (Arrow batches, whole texts) and cuts only documents
longer than a sequence. ``pack`` places the pieces: groups of bounded size
run best-fit decreasing on lengths alone, and a lower bound from
dual-feasible functions certifies each group's number of bins. Groups whose
bins exceed their bound exchange documents (all their pieces are dealt anew)
and are packed again, as long as that saves bins.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import UID, in_parts, text_or_empty, with_row_ids
from tarmac.plans.layers import materialise

CAPACITY = 2048
GROUP_ROWS = 32_768
MAX_ROUNDS = 8
END_ID = 0
#: texts whose pieces a worker holds at once
PART_TEXTS = 500
#: encoded chunks a worker keeps (about 200 bytes each); the cache starts afresh beyond it
CACHE_CHUNKS = 500_000

# Fixed value: the pattern of byte-level BPE that splits text before merging.
BPE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level BPE files use for the 256 bytes."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class Encoder:
    """Token ids (little-endian uint32 bytes) of whole texts.

    A single space between two non-space characters always begins a new
    pre-token, so a text falls into chunks there whose ids do not depend on
    their neighbours; each distinct chunk is encoded once per worker. The file's
    added tokens are found first, as the tokenizers library does, and the text
    between them is encoded by itself.
    """

    def __init__(self, path: str):
        import re

        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model, added = told["model"], told.get("added_tokens", [])
        self.added = {a["content"]: np.array([a["id"]], "<u4").tobytes() for a in added}
        self._added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None
        bent = any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        vocab, alphabet = model["vocab"], _byte_alphabet()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        order = [vocab[a + b] for a, b in pairs]
        self.known: dict[str, bytes] = {}
        self._apart = re.compile(r"(?<=\S) (?=\S)")
        self._odd = re.compile(r"\s\s|^\s|\s$")
        if all(x < y for x, y in zip(order, order[1:], strict=False)) and not bent:
            import tiktoken

            made = set(order)
            ranks = {bytes(alphabet[c] for c in t): i for t, i in vocab.items() if len(t) == 1 or i in made}
            inner = tiktoken.Encoding("chunks", pat_str=BPE_PATTERN, mergeable_ranks=ranks, special_tokens={})
            self._ids = inner.encode_ordinary
        else:  # ids that do not follow the merges: the general tokenizer
            from tokenizers import Tokenizer

            inner = Tokenizer.from_file(path)
            self._ids = lambda s: inner.encode(s, add_special_tokens=False).ids

    def _chunk(self, chunk: str) -> bytes:
        if len(self.known) >= CACHE_CHUNKS:
            self.known.clear()
        ids = self.known[chunk] = np.array(self._ids(chunk), "<u4").tobytes()
        return ids

    def encode(self, text: str) -> bytes:
        if self._added is not None and self._added.search(text):
            return b"".join(self.added.get(part) or self._plain(part) for part in self._added.split(text))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        parts = (self._apart.split(text) if self._odd.search(text) else text.split(" "))
        known = self.known
        out = [known.get(parts[0]) or self._chunk(parts[0])]
        for part in parts[1:]:
            part = " " + part
            out.append(known.get(part) or self._chunk(part))
        return b"".join(out)


def _encoder(path: str) -> Encoder:
    """One encoder per worker process and file, kept between tasks."""
    import sys

    kept = sys.modules.setdefault("__kept_encoders", type(sys)("__kept_encoders")).__dict__
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else full pieces after a first remainder."""
    count = -(-total // capacity)
    first = total - (count - 1) * capacity
    return [(0, first)] + [(first + i * capacity, capacity) for i in range(count - 1)]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids).

    A null text is empty: its only id is the end id 0. Every row of ``docs``
    gives at least one piece; repeated rows give repeated pieces.
    """
    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in in_parts(batches, PART_TEXTS):
            rows: list[tuple] = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = encoder.encode(text) + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    part = ids[4 * start:4 * (start + length)]
                    rows.append((i, k, start, length, zlib.crc32(part), np.frombuffer(part, "<i4") if with_ids else None))
            if not rows:
                continue
            at, *cols = zip(*rows, strict=True)
            arrays = [batch.column(0).take(pa.array(at)), *(pa.array(c, t) for c, t in zip(
                cols[:4], (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(cols[4], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.record_batch(arrays, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(tokenise, schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) per item, and the number of bins; items are placed longest first."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    free = 0  # bit r is set when a bin with r left is open
    count = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fitting = free >> need
        if fitting:
            left = need + (fitting & -fitting).bit_length() - 1
            at = open_bins[left].pop()
            if not open_bins[left]:
                free ^= 1 << left
        else:
            left, at, count = capacity, count, count + 1
        bins[i], offsets[i] = at, capacity - left
        left -= need
        if left:
            if not open_bins[left]:
                free |= 1 << left
            open_bins[left].append(at)
    return bins, offsets, count


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Fewest bins any packing needs, by two families of dual-feasible functions."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    best = -(-int((count * size).sum()) // capacity)
    # f_e: sizes above capacity - e count as whole bins, sizes under e as nothing
    items, words = np.cumsum(count[::-1])[::-1], np.cumsum((count * size)[::-1])[::-1]  # of sizes >= s
    for e in range(1, capacity // 2 + 1):
        whole = items[capacity - e + 1]
        best = max(best, int(whole) + -(-int(words[e] - words[capacity - e + 1]) // capacity))
    # u_k: sizes rounded down to multiples of 1/k, exact multiples of 1/(k+1) kept
    for k in range(1, 100):
        share = np.where((k + 1) * size % capacity == 0, size * k, (k + 1) * size // capacity * capacity)
        best = max(best, -(-int((count * share).sum()) // (capacity * k)))
    # both: large items as bins of their own and the rest of their bins filled by the small ones
    half = items[capacity // 2 + 1]
    for e in range(1, capacity // 2 + 1):
        middle = items[capacity // 2 + 1] - items[capacity - e + 1]
        room = middle * capacity - (words[capacity // 2 + 1] - words[capacity - e + 1])
        small = words[e] - words[capacity // 2 + 1]
        best = max(best, int(half) + max(0, -(-int(small - room) // capacity)))
    return best


def _pack_groups(dealt: DataFrame, capacity: int, round_no: int) -> DataFrame:
    """Best-fit decreasing per group: row id, sequence, offset, group, its bins and bound."""
    def pack_group(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(UID)
        lengths = frame["length"].to_numpy()
        bins, offsets, count = best_fit_decreasing(lengths, capacity)
        group = int(frame["g"].iloc[0])
        return pd.DataFrame({UID: frame[UID], "length": lengths, "offset": offsets,
                             "sequence_id": (round_no << 56) + (group << 28) + bins,
                             "g": group, "bins": count, "bound": lower_bound(lengths, capacity)})

    return dealt.groupBy("g").applyInPandas(
        pack_group, f"{UID} long, length long, offset long, sequence_id long, g long, bins long, bound long")


def _deal(rows: DataFrame, count: int, round_no: int, group_rows: int) -> DataFrame:
    groups = max(1, -(-count // group_rows))
    return rows.select(UID, "length", F.pmod(F.xxhash64(UID, F.lit(round_no)), groups).alias("g"))


def pack(tagged: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """sequence_id, offset, bins and bound for rows (row id, length) of ``with_row_ids``.

    Lengths are 1..capacity. A full piece is a sequence by itself. No group
    holds many more than ``group_rows`` lengths, whatever the input. ``bins``
    is the number of sequences of the row's group and ``bound`` the fewest any
    packing of it needs: the certificate, and what is left open where the
    exchange no longer saved a sequence.
    """
    one = F.lit(1).cast("long")
    full = tagged.where(F.col("length") == capacity).select(
        UID, (-F.col(UID) - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), one.alias("bins"), one.alias("bound"))
    open_rows = tagged.where(F.col("length") < capacity)
    totals = {"rows": F.count(F.lit(1))}
    placed, seen = materialise(_pack_groups(_deal(open_rows, open_rows.count(), 0, group_rows), capacity, 0), "packed", totals)
    done: list[DataFrame] = []
    for round_no in range(1, MAX_ROUNDS + 1):
        loose = placed.where("bins > bound")
        state = loose.select("g", "bins").distinct().agg(F.count(F.lit(1)), F.sum("bins")).first()
        if state[0] < 2:
            break
        again, _ = materialise(_pack_groups(_deal(loose, loose.count(), round_no, group_rows), capacity, round_no),
                               "packed", totals)
        fewer = again.select("g", "bins").distinct().agg(F.sum("bins")).first()[0]
        if fewer >= state[1]:
            break
        done.append(placed.where("bins = bound"))
        placed = again
    for part in done:
        placed = placed.unionByName(part)
    return full.unionByName(placed.select(UID, "sequence_id", "offset", "bins", "bound"))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS,
                   with_ids: bool = False, certificate: bool = False) -> DataFrame:
    """The pieces of ``docs`` with sequence_id and offset (gapless from 0 in a sequence).

    Empty tables give an empty result; null ids stay null; ties in length go by
    row; a very long text is encoded by itself and cut into full pieces. ``with_ids`` keeps the token ids of each piece, ``certificate`` the bins
    and bound of its group (see ``pack``).
    """
    tagged = with_row_ids(pieces(docs, tokenizer, capacity, with_ids), "pieces")
    placed = pack(tagged, capacity, group_rows)
    return tagged.join(placed if certificate else placed.drop("bins", "bound"), UID).drop(UID)
