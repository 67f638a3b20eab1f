"""Conversation repair against an exhaustive search over edits."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from hourpanel.llm import conversations as C


def brute_force(rows):
    """{conv_id: columns} by a search over (cost, audit) from the first row on."""
    after = defaultdict(list)
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        after[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        after[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, own in after.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults, seen = [], set()
        for _, role, text in own:
            body = text.strip(" \t\n\v\f\r")
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, said = search(own, faults)
        count = [faults.count(x) for x in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def search(own, faults):
    """Dijkstra over (cost, audit): the first end that is taken out is the cheapest with the least audit."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, roles, said = heapq.heappop(heap)
        state = C.STATES[0] if not roles else {"s": 1, "u": 2, "a": 3}[roles]
        if (at, state) in done:
            continue
        if at == len(own) and state in (0, 3):
            return cost, audit, said
        # a longer audit of equal cost may come later, so a state counts as done when it is taken out
        done.add((at, state))
        want = "a" if state == 2 else "u"
        name = {"a": "assistant", "u": "user"}[want]
        heapq.heappush(heap, (cost + 5, audit + "I", at, want, (*said, f"{name}:")))
        if at == len(own):
            continue
        _, role, text = own[at]
        heapq.heappush(heap, (cost + 2, audit + "D", at + 1, roles, said))
        if faults[at] in ("blank", "duplicate"):
            continue
        extra = 5 * (faults[at] == "truncated")
        heapq.heappush(heap, (cost + 1 + extra, audit + "R", at + 1, want, (*said, f"{name}:{text}")))
        if role[:1] == want or (role[:1] == "s" and state == 0):
            heapq.heappush(heap, (cost + extra, audit + "K", at + 1, role[:1], (*said, f"{role}:{text}")))


def conversation(rng, conv, turns, wild):
    rows = []
    for turn in range(turns):
        role = rng.choice(["system", "user", "assistant", "tool", None, "", "super"]) if rng.random() < wild else ("user", "assistant")[turn % 2]
        text = rng.choice(["Yes.", "no", "", " \n", "What?", None, f"word {turn}!", "ends. \n", "a. ", "x\u0085."])
        rows.append((conv, turn if rng.random() > 0.05 else rng.choice([None, turn + 3, turn - 1]), role, text))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def check(spark, rows, tasks=3):
    got = {r[0]: tuple(r)[1:] for r in C.repair(spark.createDataFrame(rows, SCHEMA).repartition(tasks)).collect()}
    want = brute_force(rows)
    assert set(got) == set(want)
    for conv in want:
        assert got[conv] == want[conv], conv


def test_conversations_equal_a_search(spark):
    rng = random.Random(4)
    rows = [r for conv in range(400) for r in conversation(rng, conv, rng.randint(1, 12), rng.choice([0.1, 0.5, 1]))]
    rows += conversation(rng, None, 9, 0.5) + [(500, 0, "system", "Only."), (501, None, None, None), (502, 4, "user", "Hi."), (502, 4, "user", "Hi.")]
    check(spark, rows)


def test_long_conversations_are_put_together(spark, monkeypatch):
    rng = random.Random(6)
    rows = [r for conv in range(25) for r in conversation(rng, conv, rng.randint(15, 160), rng.choice([0.1, 0.9]))]
    rows += [(77, 3, "user", "Same.")] * 50 + [(77, 4, "assistant", "End.")]
    check(spark, rows)


@pytest.mark.parametrize("length", [1, 2, 3])
def test_short_segments_give_the_same(spark, monkeypatch, length):
    monkeypatch.setattr(C, "SEGMENT", length)
    rng = random.Random(8)
    check(spark, [r for conv in range(60) for r in conversation(rng, conv, rng.randint(1, 9), 0.7)])


def test_nodes_are_shared(spark):
    segments = spark.createDataFrame([("uaua", "end"), ("aua", "end"), ("suaua", "end")], "letters string, tail string")
    nodes = {r.suffix: r for r in C.automaton(segments).collect()}
    assert set(nodes) == {"a", "ua", "aua", "uaua", "suaua"}
    assert tuple(nodes["suaua"].to_0) == (0, "KKKKK") and tuple(nodes["aua"].to_0) == (2, "DKK") and tuple(nodes["a"].to_2) == (0, "K")


def test_empty_and_clashing(spark, clashing):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.repair(empty).collect() == []
    rows = [(i, t, "user", "Hello.") for i in range(30) for t in range(3)]
    plain = sorted(map(tuple, C.repair(spark.createDataFrame(rows, SCHEMA)).collect()))
    extra = spark.createDataFrame(rows, SCHEMA)
    for name in ("at", "part", "times", "blank", "said", "cost", "audit", "suffix", "letters", "first_at"):
        extra = extra.withColumn(name, __import__("pyspark").sql.functions.lit("clash"))
    assert sorted(map(tuple, C.repair(extra).collect())) == plain
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    row = C.repair(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)).first()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
