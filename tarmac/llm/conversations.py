"""Conversation structure repair: the cheapest edits that make the roles well formed.

The roles' initials of a conversation must match ``(s?(ua)+)?``. Every row may
be kept, given another role or deleted, and empty user or assistant rows may
be inserted (costs: fixed values below). Blank and repeated rows must go.

A conversation is reduced to its signature, one symbol per row (role initial
and fault). The signatures of all conversations form one suffix-shared
automaton: sorted from their ends, each suffix that several conversations share
is one node, reached once. A node holds, per grammar state, the cost to go and
the first letter of the best audit (the rest is the audit of the node it leads
to); suffixes whose costs differ by a constant only are one minimised node.
Conversations then look up their audit, and their rows stream past it.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.plans.layers import materialise

# The costs of the edits, and what a truncated row adds unless deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

# Fixed value: ASCII white space of the contracts.
SPACE = " \t\n\x0b\x0c\r"

# Grammar states: 0 nothing yet, 1 after s, 2 after u, 3 after a. An inserted or
# rerolled row is the user where one may stand, else the assistant.
ENDS = (True, False, False, True)
GIVEN = (2, 2, 3, 2)
ROLE = ("user", "user", "assistant", "user")
KEPT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "o": (None, None, None, None)}

# Symbols: s u a o (any other initial), in capitals when truncated; w x y z when the row must go.
LIVE, CUT, DEAD = "suao", "SUAO", "wxyz"
GONE = "x"


def _batch(rows: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.types, strict=True)], schema=kinds)


def prepared(conversations: DataFrame) -> DataFrame:
    """key, conv_id, turn, role, text, d: nulls of role and text as one space; ``key`` is never null, ``d`` is the text's md5."""
    return conversations.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key"), "conv_id",
        F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))


def damaged(rows: DataFrame) -> DataFrame:
    """``prepared`` rows with seeded faults: by crc32 of ``conv_id:turn`` modulo 20 a row is dropped (0), emptied (1),
    loses its sentence ends (2), is repeated (3) or becomes the user's (4)."""
    told = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    h = F.crc32(told.cast("binary")) % 20
    times = F.when(h == 0, 0).when(h == 3, 2).otherwise(1)
    return rows.select(
        "key", "conv_id", "turn", F.when(h == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(h == 1, F.lit("")).when(h == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).drop("copy")


def _faults(rows: DataFrame) -> DataFrame:
    """One narrow row per (conversation, turn, role, text): how often, its faults, its symbols.

    Equal rows are counted in each task before the shuffle. A run is late if
    the same role and text stand at an earlier turn; otherwise only its
    first row is no duplicate.
    """
    said = F.rtrim(F.col("text"), F.lit(SPACE))
    marked = rows.select(
        "key", "turn", "role", F.md5("text").alias("d"), (said == "").alias("blank"),
        (~F.right(said, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    runs = marked.groupBy("key", "turn", "role", "d").agg(
        F.count(F.lit(1)).alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    again = runs.groupBy("key", "role", "d").agg(F.min(F.struct("turn")).alias("t0"), F.count(F.lit(1)).alias("c")).where("c > 1")
    late = F.col("t0").isNotNull() & ~F.col("turn").eqNullSafe(F.col("t0.turn"))
    judged = runs.join(again.drop("c"), ["key", "role", "d"], "left").withColumn("late", late)
    place = F.coalesce(F.nullif(F.position(F.substring("role", 1, 1), F.lit("sua")), F.lit(0)), F.lit(4))
    place = F.when(F.col("role") == "", F.lit(4)).otherwise(place)
    one = lambda letters: F.substring(F.lit(letters), place, F.lit(1))
    must_go = F.col("blank") | F.col("late")
    symbols = F.when(must_go, F.repeat(one(DEAD), F.col("n").cast("int"))).otherwise(F.concat(
        F.when(F.col("cut"), one(CUT)).otherwise(one(LIVE)), F.repeat(one(DEAD), (F.col("n") - 1).cast("int"))))
    return judged.select("key", "turn", "role", "d", "n", "blank", "late", "cut", symbols.alias("symbols"))


def _signatures(faults: DataFrame) -> DataFrame:
    """key, signature: the rows' symbols by turn (null first), role, md5 of the text.

    Rows are range-partitioned in that order, so a conversation of any length is
    read in pieces by several tasks; only its symbols come together.
    """
    order = ["key", F.col("turn").asc_nulls_first(), "role", "d"]
    ordered = faults.repartitionByRange(*order).sortWithinPartitions(*order).select("key", F.spark_partition_id().alias("part"), "symbols")

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, part, held, done = None, 0, [], []
        for batch in batches:
            for k, part, symbols in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if k != key:
                    if held:
                        done.append((key, part, "".join(held)))
                    key, held = k, []
                held.append(symbols)
            if len(done) > 10_000:
                yield _batch(done, kinds)
                done = []
        if held:
            done.append((key, part, "".join(held)))
        if done:
            yield _batch(done, kinds)

    kinds = pa.schema([("key", pa.string()), ("part", pa.int32()), ("piece", pa.string())])
    pieces = ordered.mapInArrow(join_up, "key string, part int, piece string")
    whole = F.array_sort(F.collect_list(F.struct("part", "piece")))
    return pieces.groupBy("key").agg(F.array_join(F.transform(whole, lambda p: p["piece"]), "").alias("signature"))


class Automaton:
    """Minimised nodes: (costs to go per grammar state above the least, first letter of the best audit per state)."""

    def __init__(self):
        self.nodes: list[tuple[tuple[int, ...], tuple[str, ...]]] = []
        self.ids: dict[tuple, int] = {}
        self.steps: dict[tuple[str, int], tuple[int, int]] = {}
        self.end_cost, self.end = self._node([{"": 0} if ok else {} for ok in ENDS])

    def _node(self, options: list[dict[str, int]]) -> tuple[int, int]:
        """(least cost, node) for the letters possible in each state and their costs; an insertion leads
        to another state of the same node."""
        best = [min(some.values(), default=1 << 60) for some in options]
        for _ in ENDS:
            best = [min(best[q], INSERT + best[GIVEN[q]]) for q in range(len(ENDS))]
        letters = tuple(min(x for x, cost in {**some, "I": INSERT + best[GIVEN[q]]}.items() if cost == best[q])
                        for q, some in enumerate(options))
        least = min(best)
        made = (tuple(c - least for c in best), letters)
        if made not in self.ids:
            self.ids[made] = len(self.nodes)
            self.nodes.append(made)
        return least, self.ids[made]

    def step(self, symbol: str, rest: int) -> tuple[int, int]:
        """The node of ``symbol`` followed by what node ``rest`` stands for, and what it adds to the cost."""
        if (symbol, rest) not in self.steps:
            costs = self.nodes[rest][0]
            options = []
            for q in range(len(ENDS)):
                some = {"D": DELETE + costs[q]}
                if symbol != GONE:
                    extra = TRUNCATED if symbol in CUT else 0
                    some["R"] = REROLE + extra + costs[GIVEN[q]]
                    if (kept := KEPT[symbol.lower()][q]) is not None:
                        some["K"] = KEEP + extra + costs[kept]
                options.append(some)
            self.steps[symbol, rest] = self._node(options)
        return self.steps[symbol, rest]

    def after(self, symbol: str, letter: str, q: int) -> int:
        """The grammar state after an edit of a row."""
        return q if letter == "D" else GIVEN[q] if letter in "RI" else KEPT[symbol.lower()][q]


def plan_signatures(signatures: DataFrame) -> DataFrame:
    """signature, cost, audit for distinct (reduced) signatures.

    Sorted from their ends, signatures visit each shared suffix once: the path
    of nodes of the last signature is kept, and the next one starts where
    its end still agrees. Only partition borders visit a suffix twice.
    """
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton()
        path, costs, last = array("q", [automaton.end]), array("q", [automaton.end_cost]), ""
        for batch in batches:
            out = []
            for backward in batch.column(0).to_pylist():
                shared = len(os.path.commonprefix([last, backward]))
                del path[shared + 1:], costs[shared + 1:]
                for symbol in backward[shared:]:
                    more, node = automaton.step(symbol, path[-1])
                    path.append(node)
                    costs.append(costs[-1] + more)
                last = backward
                audit, q, at = [], 0, len(backward)
                while letter := automaton.nodes[path[at]][1][q]:
                    audit.append(letter)
                    q = automaton.after(backward[at - 1] if at else "", letter, q)
                    at -= letter != "I"
                out.append((backward[::-1], costs[-1] + automaton.nodes[path[-1]][0][0], "".join(audit)))
            if out:
                yield _batch(out, kinds)

    kinds = pa.schema([("signature", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])
    backward = signatures.select(F.reverse("signature").alias("b")).distinct()
    return backward.repartitionByRange("b").sortWithinPartitions("b").mapInArrow(walk, "signature string, cost long, audit string")


def judge(rows: DataFrame) -> DataFrame:
    """Per conversation with rows: key, gaps, blank, duplicate, truncated, illegal, cost, audit (written to the shared folder)."""
    faults = materialise(_faults(rows), "faults")
    fresh = ~F.col("blank") & ~F.col("late")
    counts = faults.groupBy("key").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).when(F.col("late"), F.col("n")).otherwise(F.col("n") - 1)).alias("duplicate"),
        F.count_if(fresh & F.col("cut")).alias("truncated"))
    roles = F.translate("signature", CUT + DEAD, LIVE + LIVE)
    legal = F.regexp_count(roles, F.lit("(?=su|ua|au)"))
    signed = materialise(_signatures(faults).select(
        "key", F.translate("signature", DEAD, GONE * len(DEAD)).alias("signature"),
        (F.length("signature") - 1 - legal).cast("long").alias("illegal")), "signatures")
    planned = signed.join(plan_signatures(signed), "signature").select("key", "illegal", "cost", "audit")
    return materialise(counts.join(planned, "key"), "judged")


def _apply(rows: DataFrame, judged: DataFrame) -> DataFrame:
    """key, conv_id, place, edit, role, text of the repaired rows; a conversation's rows lie together and in order."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    late = rows.select("key", F.lit(1).alias("kind"), "turn", "role", F.md5("text").alias("d"), "conv_id", "text")
    first = judged.select("key", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                          F.lit("").alias("d"), F.lit(None).cast(kind).alias("conv_id"), F.col("audit").alias("text"))
    order = ["key", "kind", F.col("turn").asc_nulls_first(), "role", "d"]
    streamed = first.unionByName(late).repartition("key").sortWithinPartitions(*order).select("key", "kind", "conv_id", "role", "text")

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, q, place, key, conv_id, out = "", 0, 0, 0, None, None, []

        def emit(letter: str, role: str, text: str) -> None:
            nonlocal place
            out.append((key, conv_id, place, letter, role, text))
            place += 1

        def inserted() -> None:
            nonlocal at, q
            while at < len(audit) and audit[at] == "I":
                emit("I", ROLE[q], "")
                q, at = GIVEN[q], at + 1

        for batch in batches:
            kinds = pa.schema([("key", pa.string()), ("conv_id", batch.column(2).type), ("place", pa.int64()), ("edit", pa.string()),
                               ("role", pa.string()), ("text", pa.string())])
            for k, is_row, conv, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if not is_row:
                    inserted()
                    audit, at, q, place, key = text, 0, 0, 0, k
                    continue
                conv_id = conv
                inserted()
                letter, at = audit[at], at + 1
                if letter == "R":
                    emit("R", ROLE[q], text)
                    q = GIVEN[q]
                elif letter == "K":
                    emit("K", role, text)
                    q = KEPT[role[0]][q]
            if len(out) >= 1_000:
                yield _batch(out, kinds)
                out.clear()
        inserted()
        if out:
            yield _batch(out, kinds)

    return streamed.mapInArrow(edit, f"key string, conv_id {kind}, place long, edit string, role string, text string")


def repaired_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), edit (K, R or I), role, text: the repaired conversations.

    Rows count by turn, null first; rows of one turn by role and md5 of the
    text. Nulls of role and text are one space (an initial that is none of s,
    u, a; a blank text); a null conv_id is a conversation. A role without
    characters has no legal initial. A conversation without rows left gives none.
    """
    rows = prepared(conversations)
    return _apply(rows, judge(rows)).drop("key")


def _digests(repaired: DataFrame) -> DataFrame:
    """key, repaired_sha256 over ``role:text`` lines; rows of a key must lie together and in order."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []
        for batch in batches:
            for k, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if state is None or k != key:
                    if state is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if len(done) >= 10_000:
                yield _batch(done, kinds)
                done = []
        if state is not None:
            done.append((key, state.hexdigest()))
            yield _batch(done, kinds)

    kinds = pa.schema([("key", pa.string()), ("repaired_sha256", pa.string())])
    return repaired.select("key", "role", "text").mapInArrow(digest, "key string, repaired_sha256 string")


def repair_table(conversations: DataFrame, with_damage: bool = False) -> DataFrame:
    """One row per original conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``with_damage`` seeds faults first (see ``damaged``). A conversation
    without rows has zeros, an empty audit and the hash of nothing; an empty table gives
    no rows. A very long conversation is read in pieces up to its signature of
    one symbol a row; its audit and hash are made as its rows stream by. Only
    the four columns are read. See ``repaired_rows`` for nulls and ties.
    """
    whole = prepared(conversations)
    ids = whole.groupBy("key").agg(F.first("conv_id").alias("conv_id"))
    rows = damaged(whole) if with_damage else whole
    judged = judge(rows)
    out = ids.join(judged, "key", "left").join(_digests(_apply(rows, judged)), "key", "left")
    longs = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *longs, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
