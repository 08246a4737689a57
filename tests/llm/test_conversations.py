"""Conversation repair against plain Python: faults, costs, audits, repaired texts."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tarmac.llm import conversations as C

WS = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, key string, d string, symbols string, kind int, n long, audit string"
FORM = re.compile(r"(s?(ua)+)?")


def damage(rows):
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h == 1:
            text = ""
        if h == 2:
            text = re.sub("[.!?]", "", text)
        if h == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).hexdigest()))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        said = text.strip(WS)
        out.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """(cost, audit, repaired lines) by best-first search over (row, roles so far as a state)."""
    def step(state, letter):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, letter))

    queue = [(0, "", 0, "", ())]
    done = set()
    while queue:
        cost, audit, i, state, lines = heapq.heappop(queue)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, list(lines)
        if (i, state) in done:
            continue
        done.add((i, state))
        for name in ("user", "assistant"):
            if to := step(state, name[0]):
                heapq.heappush(queue, (cost + 5, audit + "I", i, to, (*lines, f"{name}:")))
        if i < len(rows):
            _, _, role, text = rows[i]
            heapq.heappush(queue, (cost + 2, audit + "D", i + 1, state, lines))
            if found[i] not in ("blank", "duplicate"):
                more = 5 if found[i] == "truncated" else 0
                if to := step(state, role[:1]):
                    heapq.heappush(queue, (cost + more, audit + "K", i + 1, to, (*lines, f"{role}:{text}")))
                for name in ("user", "assistant"):
                    if to := step(state, name[0]):
                        heapq.heappush(queue, (cost + more + 1, audit + "R", i + 1, to, (*lines, f"{name}:{text}")))
    raise AssertionError


def brute(rows, with_damage=True):
    ids = {r[0] for r in rows}
    kept = list(damage(rows)) if with_damage else [(a, b, " " if c is None else c, " " if d is None else d) for a, b, c, d in rows]
    out = {}
    for conv in ids:
        mine = in_order([r for r in kept if r[0] == conv])
        found = faults(mine)
        cost, audit, lines = cheapest(mine, found)
        turns = [r[1] for r in mine if r[1] is not None]
        starts = [r[2][:1] for r in mine]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, found.count("blank"), found.count("duplicate"),
                     found.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(starts)),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def found(df):
    return {r[0]: tuple(r)[1:] for r in df.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", "d", "s", 1, 2, "a") for r in rows], SCHEMA)


def talk(seed: int, conversations: int, longest: int):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "User", "", "u", None]
    texts = ["Yes.", "No!", "Well", "ok?  \n", " \t", "", None, "Well.", "a b. c", "end.\u0085", "¿no? ", "."]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(0, longest)):
            at = rng.choice([turn, turn, turn, turn // 2, None, turn + 3, -turn])
            rows.append((conv, at, rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"line {rng.randint(0, 50)}."))
    return rows


def exhaustive(roles: str, dead: list[bool], cut: list[bool]):
    """Least (cost, audit) over every edit of every row and up to two insertions before each row and at the end."""
    best = None
    inserts = ["", "u", "a", "ua", "au"]
    choices = [["D"] if dead[i] else ["D", "K", "Ru", "Ra"] for i in range(len(roles))]
    for edits in itertools.product(*choices):
        for gaps in itertools.product(inserts, repeat=len(roles) + 1):
            made, audit, cost = "", "", 0
            for i, e in enumerate(edits):
                made += gaps[i] + (roles[i] if e == "K" else "" if e == "D" else e[1])
                audit += "I" * len(gaps[i]) + e[0]
                cost += 5 * len(gaps[i]) + {"D": 2, "K": 0, "R": 1}[e[0]] + 5 * (cut[i] and e != "D")
            made, audit, cost = made + gaps[-1], audit + "I" * len(gaps[-1]), cost + 5 * len(gaps[-1])
            if FORM.fullmatch(made) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def planned(symbols: str):
    automaton = C.Automaton()
    path, cost = [automaton.end], automaton.end_cost
    for s in reversed(symbols):
        more, node = automaton.step(s, path[-1])
        path.append(node)
        cost += more
    audit, q, at = "", 0, len(symbols)
    while letter := automaton.nodes[path[at]][1][q]:
        audit += letter
        q = automaton.after(symbols[len(symbols) - at] if at else "", letter, q)
        at -= letter != "I"
    return cost + automaton.nodes[path[-1]][0][0], audit


def test_plans_are_the_cheapest_of_all_edits():
    rng = random.Random(3)
    words = ["".join(w) for n in (0, 1, 2) for w in itertools.product("suaoSUAOx", repeat=n)]
    words += ["".join(rng.choices("suaoSUAOx", k=3)) for _ in range(60)] + ["ssua", "oUaS"]
    for word in words:
        assert planned(word) == exhaustive(word.lower(), [s == "x" for s in word], [s in "SUAO" for s in word]), word


def test_the_automaton_is_small():
    automaton = C.Automaton()
    rng = random.Random(5)
    for _ in range(300):
        node = automaton.end
        for _ in range(60):
            node = automaton.step(rng.choice("suaoSUAOx"), node)[1]
    assert len(automaton.nodes) < 200


@pytest.mark.parametrize("with_damage", [True, False])
def test_equals_brute_force(spark, with_damage):
    rows = talk(1, 150, 9) + talk(2, 3, 60) + [(None, 1, "user", "Hi."), (None, None, None, None), (900, None, "user", "a."), (900, None, "assistant", "b.")]
    rows = [(r[0], *r[1:]) for r in rows]
    df = frame(spark, rows).repartition(5)
    assert found(C.repair_table(df, with_damage)) == brute(rows, with_damage)


def test_conversations_split_over_parts(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = talk(7, 1, 400) * 2 + [(1, i, "user" if i % 2 == 0 else "assistant", f"t{i}.") for i in range(1000)] + [(2, 0, "user", "same.")] * 500
        df = frame(spark, rows).repartition(4)
        assert found(C.repair_table(df)) == brute(rows, False)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hello?"), (1, 2, "user", "Hello?"), (1, 3, "tool", "Hi."), (2, 5, "assistant", "cut"),
            (3, 0, "user", "long. " * 50_000)]
    got = C.repaired_rows(frame(spark, rows)).orderBy("conv_id", "place").collect()
    assert [tuple(r) for r in got if r.conv_id < 3] == [
        (1, 0, "K", "system", "Be kind."), (1, 1, "K", "user", "Hello?"), (1, 2, "R", "assistant", "Hi.")]
    assert [(r.place, r.edit, r.role) for r in got if r.conv_id == 3] == []  # deleting one row is cheaper than an answer
    for conv, roles in frame(spark, talk(4, 80, 8)).transform(C.repaired_rows).groupBy("conv_id").agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "role"))), lambda x: F.left(x["role"], F.lit(1))), "")).collect():
        assert FORM.fullmatch(roles), (conv, roles)


def test_empty_table_and_nothing_left(spark):
    assert C.repair_table(frame(spark, []), True).collect() == []
    dropped = [(c, 0, "user", "x.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    got = found(C.repair_table(frame(spark, dropped), True))
    assert len(got) > 3 and set(got.values()) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
