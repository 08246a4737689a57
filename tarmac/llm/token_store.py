"""Token-id files: one zstandard frame per document under a shared dictionary.

``write_store`` tokenises documents and writes a folder that Spark's Parquet
reader and writer carry on any file system:

* ``dictionary``: one row: the dictionary's bytes and hash, the end id, the
  tokenizer's file name. It is trained on serialised id arrays of a bounded
  sample of distinct texts (``SAMPLE_TEXTS``, ``SAMPLE_BYTES``); it changes
  sizes only, never ids.
* ``blocks``: rows of about ``BLOCK_BYTES``, ordered by (part, block), which is
  ascending doc_id order over the whole store. ``data`` is a self-contained
  binary block: magic, dictionary hash, number of documents, an offset index
  (a 64-bit place per document, and the end), then the frames. ``doc_ids`` and
  ``n_tokens`` repeat what an index needs in columns of their own, so that no
  index scan reads the frames.

``read_store`` decodes every document; ``lookup`` decodes single ones: it takes
the block from the id columns, the frame's place from the block's offset index,
and decompresses that frame alone.

Ids are stored as little-endian 16-bit numbers (32-bit where the vocabulary
is larger) and given back as little-endian 32-bit ones.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tarmac.llm.common import UID, text_or_empty, with_row_ids
from tarmac.session import work_dir

MAGIC = b"TOKZ0001"
#: magic, dictionary hash, width of an id in bytes, number of documents
HEAD_BYTES = 8 + 8 + 4 + 4
BLOCK_BYTES = 1 << 20
DICT_BYTES = 64 << 10
SAMPLE_TEXTS = 2_000
SAMPLE_BYTES = 8 << 20
LEVEL = 3
#: parts whose ids a worker keeps (about 150 bytes each); beyond it the cache starts afresh, of pre-tokens
#: with the full one beside it
CACHE_WORDS = 400_000

# ASCII white space: the tokenizer's pattern drops it, so no token reaches across.
APART = re.compile(r"[^ \t\n\r\x0b\x0c]+")


# Fixed value: the pattern by which word-level BPE files cut lower-cased text into pre-tokens.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# The same cuts for texts of printable ASCII, ASCII white space and the letters (and two signs) of
# U+00C0 to U+00FF, where normal forms change nothing and lower case is one to one.
PLAIN = re.compile(r"[\t\n\x0b\x0c\r -~\xc0-\xff]*")
# The line feed stands behind each word.
WORD_PARTS = re.compile(r"[a-z\xdf-\xf6\xf8-\xff]+|\n|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\t\n\x0b\x0c\r a-z0-9\xdf-\xf6\xf8-\xff]+")


class Encoder:
    """Serialised ids of whole texts for a tokenizer whose pre-tokens never hold white space.

    Texts fall apart at ASCII white space, the words of plain ones further into
    pre-tokens; each distinct part is encoded once per worker by the tokenizers
    library (its special tokens included), and the parts' ids are joined. New
    pre-tokens are encoded together, as one text with spaces between them, and
    their ids told apart by the end-of-word mark that closes each. Of plain
    texts only the distinct words of a call are cut, and only their distinct
    pre-tokens looked up.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.inner = Tokenizer.from_file(path)
        self.width = id_width(path)
        self.tokens: dict[str, bytes] = {"\n": b""}  # ends a word, see _plain()
        self.older: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        suffix = told["model"].get("end_of_word_suffix")
        self.cuts = bool(suffix) and f'"{PRE_TOKENS}"' in json.dumps(told["pre_tokenizer"]).replace("\\\\", "\\")
        vocabulary = self.inner.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values()) + 1, np.bool_)
        self.closes[[i for w, i in vocabulary.items() if suffix and w.endswith(suffix)]] = True

    def _new_chunks(self, parts: list[str]) -> None:
        kind = f"<u{self.width}"
        for at in range(0, len(parts), 10_000):
            some = parts[at:at + 10_000]
            for part, got in zip(some, self.inner.encode_batch_fast(some, add_special_tokens=False), strict=True):
                self.chunks[part] = np.array(got.ids, kind).tobytes()

    def _new_tokens(self, parts: list[str]) -> None:
        kind = f"<u{self.width}"
        for at in range(0, len(parts), 10_000):
            some = parts[at:at + 10_000]
            ids = np.array(self.inner.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.int64)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(some) or ends[-1] != len(ids):
                raise ValueError("pre-tokens and end-of-word marks do not agree")
            told, places = ids.astype(kind).tobytes(), (ends * self.width).tolist()
            self.tokens.update(zip(some, map(lambda a, b: told[a:b], [0, *places[:-1]], places), strict=True))

    def _known(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct pre-tokens; those met again move on when the cache starts afresh."""
        if len(self.tokens) > CACHE_WORDS:
            self.older, self.tokens = self.tokens, {"\n": b""}
        new = [w for w in parts if w not in self.tokens]
        again = [w for w in new if w in self.older]
        self.tokens.update((w, self.older[w]) for w in again)
        self._new_tokens([w for w in new if w not in self.older] if again else new)
        return list(map(self.tokens.__getitem__, parts))

    def _plain(self, texts: list[str]) -> list[bytes]:
        lists = pc.ascii_split_whitespace(pa.array([t.lower() for t in texts], pa.string()))
        words = pc.dictionary_encode(lists.flatten())
        # white space at the ends gives empty words, which have no pre-token
        listed = pc.binary_join(pa.ListArray.from_arrays([0, len(words.dictionary)], words.dictionary), "\n")[0].as_py() + "\n"
        parts = pc.dictionary_encode(pa.array(WORD_PARTS.findall(listed), pa.string()))
        distinct = parts.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist() takes five times as long
        told = self._known(distinct)
        size = np.fromiter(map(len, told), np.int64, len(told)) // self.width
        part = parts.indices.to_numpy()
        ids, upto = gathered(np.frombuffer(b"".join(told), f"<u{self.width}"), size, part)
        ids, upto = gathered(ids, np.diff(upto[part == distinct.index("\n")], prepend=0), words.indices.to_numpy())
        edges = np.r_[0, upto].take(lists.offsets.to_numpy()).tolist()
        return [ids[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        plain = [i for i, t in enumerate(texts) if self.cuts and PLAIN.fullmatch(t) and "<|" not in t]
        if plain:
            for i, ids in zip(plain, self._plain([texts[i] for i in plain]), strict=True):
                out[i] = ids
        other = sorted(set(range(len(texts))).difference(plain))
        if len(self.chunks) > CACHE_WORDS:
            self.chunks.clear()
        parts = [APART.findall(texts[i]) for i in other]
        self._new_chunks([w for w in set().union(*parts) if w not in self.chunks])
        for i, words in zip(other, parts, strict=True):
            out[i] = b"".join(map(self.chunks.__getitem__, words))
        return out


def gathered(flat: np.ndarray, size: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat``, which have these sizes, in that order; and the end of each in what is returned."""
    n = size.take(order)
    upto = np.cumsum(n)
    at = np.repeat((np.cumsum(size) - size).take(order) - (upto - n), n)
    at += np.arange(len(at))
    return flat.take(at), upto


def id_width(path: str) -> int:
    """Bytes of a stored id: 2 if every id of the vocabulary fits, else 4."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def _kept(name: str, make):
    """One object per worker process and name, kept between tasks."""
    import sys

    kept = sys.modules.setdefault("__kept_token_store", type(sys)("__kept_token_store")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


def _slices(texts: list[str], most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` characters at most (a longer text is a run of its own)."""
    start = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > most:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def _train(samples: list[bytes], size: int) -> bytes:
    """Dictionary bytes; too few samples to train on: their own bytes as plain history."""
    import zstandard

    size = min(size, sum(map(len, samples)) // 8)
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes() if size >= 256 else b""
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def dictionary_hash(dictionary: bytes) -> bytes:
    import hashlib

    return hashlib.sha256(dictionary).digest()[:8]


def train_dictionary(texts: DataFrame, tokenizer: str, end_id: int, size: int = DICT_BYTES) -> DataFrame:
    """One row (dictionary), trained in one task from a bounded sample.

    The sample: the ``SAMPLE_TEXTS`` distinct texts of the least hash, as far
    as they stay within ``SAMPLE_BYTES`` (a longer text is left out of the
    sample); copies count once.
    """
    hashed = texts.where(F.octet_length("text").between(1, SAMPLE_BYTES // 8)).select(
        F.xxhash64("text", F.lit(13)).alias("h"), "text")
    least = hashed.select("h").distinct().orderBy("h").limit(SAMPLE_TEXTS)
    sample = hashed.join(F.broadcast(least), "h").groupBy("h").agg(F.first("text").alias("text"))
    within = W.orderBy("h").rowsBetween(W.unboundedPreceding, W.currentRow)
    sample = sample.withColumn("upto", F.sum(F.octet_length("text")).over(within)).where(F.col("upto") <= SAMPLE_BYTES)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _kept(tokenizer, lambda: Encoder(tokenizer))
        end = np.array([end_id], f"<u{encoder.width}").tobytes()
        rows = sorted((r["h"], r["text"]) for b in batches for r in b.to_pylist())
        made = _train([ids + end for ids in encoder.encode([t for _, t in rows])], size)
        yield pa.record_batch([pa.array([made], pa.binary())], names=["dictionary"])

    return sample.select("h", "text").coalesce(1).mapInArrow(train, "dictionary binary")


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int, block_bytes: int = BLOCK_BYTES) -> str:
    """Write every row of ``docs`` (doc_id, text) to a new folder ``path``; returns the path.

    Order: doc_id ascending, null first; rows of one doc_id by the hash of
    their text, then the text's length (rows equal in all of these are
    interchangeable). A null text is empty: its only id is ``end_id``. An
    empty table gives a store without blocks.
    """
    spark = docs.sparkSession
    width = id_width(tokenizer)
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    trained = train_dictionary(rows, tokenizer, end_id).first()  # at most DICT_BYTES; no row for an empty table
    dictionary = bytes(trained["dictionary"]) if trained else b""
    spark.createDataFrame([(dictionary, dictionary_hash(dictionary), end_id, width, os.path.basename(tokenizer))],
                          "dictionary binary, dict_hash binary, end_id int, id_width int, tokenizer string",
                          ).write.parquet(f"{path}/dictionary")
    shared = spark.sparkContext.broadcast(dictionary)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encoder = _kept(tokenizer, lambda: Encoder(tokenizer))
        known = zstandard.ZstdCompressionDict(shared.value)
        if len(shared.value):
            known.precompute_compress(level=LEVEL)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True).compress
        end = np.array([end_id], f"<u{encoder.width}").tobytes()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _slices(texts):
                ids = [got + end for got in encoder.encode(texts[a:b])]
                yield pa.record_batch([
                    batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a),
                    pa.array([len(x) // encoder.width for x in ids], pa.int64()), pa.array(map(press, ids), pa.binary())],
                    names=["doc_id", "h", "n_tokens", "frame"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    frames = with_row_ids(rows.withColumn("h", F.xxhash64("text")).mapInArrow(
        pack, f"doc_id {kind}, h long, n_tokens long, frame binary"), "frames")
    order = [F.col("doc_id").asc_nulls_first(), F.col("h"), F.col("n_tokens"), F.col(UID)]
    dict_hash = dictionary_hash(dictionary)

    def block(part: int, no: int, held: list[tuple], ids_type: pa.DataType) -> pa.RecordBatch:
        doc_ids, counts, parts = zip(*held, strict=True)
        offsets = np.cumsum([HEAD_BYTES + 8 * (len(held) + 1), *map(len, parts)], dtype="<u8")
        head = MAGIC + dict_hash + np.array([width, len(held)], "<u4").tobytes() + offsets.tobytes()
        return pa.record_batch([
            pa.array([part], pa.int32()), pa.array([no], pa.int32()), pa.array([sum(counts)], pa.int64()),
            pa.array([list(doc_ids)], pa.list_(ids_type)), pa.array([list(counts)], pa.list_(pa.int64())),
            pa.array([head + b"".join(parts)], pa.binary())],
            names=["part", "block", "block_tokens", "doc_ids", "n_tokens", "data"])

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = no = part = 0
        ids_type = pa.null()
        for batch in batches:
            ids_type = batch.column(0).type
            for part, *row in zip(*[batch.column(i).to_pylist() for i in (3, 0, 1, 2)], strict=True):
                if held and size + len(row[2]) > block_bytes:
                    yield block(part, no, held, ids_type)
                    held, size, no = [], 0, no + 1
                held.append(tuple(row))
                size += len(row[2])
        if held:
            yield block(part, no, held, ids_type)

    ordered = frames.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "doc_id", "n_tokens", "frame", F.spark_partition_id().alias("part"))
    ordered.mapInArrow(to_blocks, f"part int, block int, block_tokens long, doc_ids array<{kind}>, n_tokens array<bigint>, data binary",
                       ).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    return path


def block_starts(spark: SparkSession, path: str) -> DataFrame:
    """part, block and ``before``: ids of all documents in earlier blocks.

    Running sums in two levels: within a part, and over one row per part.
    """
    blocks = spark.read.parquet(f"{path}/blocks").select("part", "block", "block_tokens")
    parts = blocks.groupBy("part").agg(F.sum("block_tokens").alias("t"))
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("part_before"))
    within = W.partitionBy("part").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    return blocks.withColumn("in_part", F.coalesce(F.sum("block_tokens").over(within), F.lit(0))).join(parts, "part").select(
        "part", "block", (F.col("part_before") + F.col("in_part")).alias("before"))


def _read_dictionary(spark: SparkSession, path: str):
    row = spark.read.parquet(f"{path}/dictionary").first()
    if dictionary_hash(bytes(row["dictionary"])) != bytes(row["dict_hash"]):
        raise ValueError(f"{path}: the dictionary does not have the hash written beside it")
    return row, spark.sparkContext.broadcast(bytes(row["dictionary"]))


def offsets_of(data: bytes, dict_hash: bytes) -> tuple[int, np.ndarray]:
    """(id width, offset index) of a block, after checks of its magic and dictionary hash."""
    if bytes(data[:8]) != MAGIC or bytes(data[8:16]) != dict_hash:
        raise ValueError("not a token block of this store's dictionary")
    width, count = np.frombuffer(data, "<u4", 2, 16).tolist()
    return width, np.frombuffer(data, "<u8", count + 1, HEAD_BYTES)


def read_store(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Every document of the store: doc_id, start (ids before it), n_tokens, ids_crc32 (and ids),
    computed from the decompressed ids."""
    row, shared = _read_dictionary(spark, path)
    dict_hash = bytes(row["dict_hash"])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        open_frame = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(shared.value)).decompress
        for batch in batches:
            for i in range(batch.num_rows):
                data, doc_ids = batch.column(3)[i].as_py(), batch.column(2).slice(i, 1).flatten()
                width, offsets = offsets_of(data, dict_hash)
                places, counts, sums, ids = offsets.tolist(), [], [], []
                for a, b in zip(places, places[1:], strict=False):
                    wide = np.frombuffer(open_frame(data[a:b]), f"<u{width}").astype("<u4")
                    counts.append(len(wide))
                    sums.append(zlib.crc32(wide.tobytes()))
                    if with_ids:
                        ids.append(wide.view("<i4"))
                counts = np.array(counts, np.int64)
                arrays = [pa.array(np.full(len(counts), batch.column(0)[i].as_py(), np.int32)),
                          pa.array(np.full(len(counts), batch.column(1)[i].as_py(), np.int32)), doc_ids,
                          pa.array(np.cumsum(counts) - counts), pa.array(counts), pa.array(sums, pa.int64())]
                names = ["part", "block", "doc_id", "in_block", "n_tokens", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.record_batch(arrays, names=names)

    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    docs = blocks.select("part", "block", "doc_ids", "data").mapInArrow(
        decode, f"part int, block int, doc_id {kind}, in_block long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)
    return docs.join(block_starts(spark, path), ["part", "block"]).select(
        "doc_id", (F.col("before") + F.col("in_block")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id -> part, block, place in the block, n_tokens; the frames are not read."""
    return spark.read.parquet(f"{path}/blocks").select(
        "part", "block", F.posexplode(F.arrays_zip("doc_ids", "n_tokens")).alias("place", "doc")).select(
        F.col("doc.doc_ids").alias("doc_id"), "part", "block", "place", F.col("doc.n_tokens").alias("n_tokens"))


def lookup(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The ids of the documents whose doc_id is in ``wanted`` (doc_id), a bounded set of queries.

    The index columns give (part, block, place); of a block's data only the
    offset index and the wanted frame are looked at.
    """
    row, shared = _read_dictionary(spark, path)
    dict_hash = bytes(row["dict_hash"])
    found = index(spark, path).join(wanted.select("doc_id").distinct(), "doc_id")
    asked = found.groupBy("part", "block").agg(F.collect_list(F.struct("place", "doc_id")).alias("asked"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        open_frame = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(shared.value)).decompress
        for batch in batches:
            for i in range(batch.num_rows):
                data, rows = batch.column(1)[i].as_py(), batch.column(0).slice(i, 1).flatten()
                width, offsets = offsets_of(data, dict_hash)
                ids = [np.frombuffer(open_frame(data[int(offsets[p]):int(offsets[p + 1])]), f"<u{width}").astype("<i4")
                       for p in rows.field(0).to_pylist()]
                yield pa.record_batch([rows.field(1), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    return blocks.select("part", "block", "data").join(asked, ["part", "block"]).select("asked", "data").mapInArrow(
        decode, f"doc_id {kind}, ids array<int>")


def token_table(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Writes ``docs`` as a token store in the shared work folder and returns what its files say:
    doc_id, start, n_tokens, ids_crc32.

    Nulls, order of equal ids, empty tables: see ``write_store``. Very long
    texts are one frame each; a block then holds that frame alone. Columns of
    ``docs`` besides doc_id and text are not read.
    """
    spark = docs.sparkSession
    return read_store(spark, write_store(docs, work_dir(spark, "token-store"), tokenizer, end_id))
