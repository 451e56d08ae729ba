"""Conversation repair against a plain shortest path over all edits."""

from __future__ import annotations

import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from llm_cases import SF, sha
from logtrail.llm import dialogue_repair, queries

SCHEMA = "conv_id long, turn long, role string, text string, key string, seq long, gone boolean, audit string"
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NAMES = {"u": "user", "a": "assistant"}


def damage(rows):
    for conv, turn, role, text in rows:
        show = [" " if x is None else x for x in (conv, turn, role, text)]
        hit = zlib.crc32(f"{show[0]}:{show[1]}".encode()) % 20
        role, text = show[2], show[3]
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        for _ in range(2 if hit == 3 else 1):
            yield conv, turn, "user" if hit == 4 else role, text


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Dijkstra over (cost, audit): the first end that leaves the queue is the least."""
    queue, done = [(0, "", 0, 0, ())], set()
    while queue:
        cost, audit, i, state, lines = heapq.heappop(queue)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in (0, 3):
            return cost, audit, lines
        for role in "ua":
            if (state, role) in NEXT:
                heapq.heappush(queue, (cost + 3, audit + "I", i, NEXT[state, role], lines + (f"{NAMES[role]}:",)))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(queue, (cost + 4, audit + "D", i + 1, state, lines))
            if faults[i] not in ("blank", "duplicate"):
                extra = 3 if faults[i] == "truncated" else 0
                if (state, role[:1]) in NEXT:
                    heapq.heappush(queue, (cost + extra, audit + "K", i + 1, NEXT[state, role[:1]], lines + (f"{role}:{text}",)))
                for new in "ua":
                    if (state, new) in NEXT:
                        heapq.heappush(queue, (cost + 3 + extra, audit + "R", i + 1, NEXT[state, new], lines + (f"{NAMES[new]}:{text}",)))


def brute(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in damage(rows):
        groups[conv].append((turn, role, text))
    out = []
    for conv in {row[0] for row in rows}:
        own = sorted(groups[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults = faults_of(own)
        turns = {r[0] for r in own if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        cost, audit, lines = cheapest(own, faults)
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha("\n".join(lines).encode())))
    return Counter(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, True, "a") for r in rows], SCHEMA)


def talks(seed, conversations, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["system", "user", "assistant", "assistant", "user", "tool", "", "unknown"])
            rows.append((conv, turn + rng.randrange(3), role, rng.choice(["Yes.", "No", "why? ", "", " \t", f"t{turn}.", "é!\n", "日"])))
    return rows


def edge_rows():
    return talks(1, 60, 9) + [
        (None, 1, "user", "a."), (None, None, "assistant", "b."), (None, None, None, None), (200, None, "user", "x."), (200, None, "user", "x."),
        (201, None, None, None), (202, 5, "system", "only."), (203, 10**15, "user", "far."), (203, -(10**15), "system", "near."),
        (204, 0, "user", "w" * 200_000 + "."), (204, 1, "assistant", ("line\n" * 3000) + "end"), *[(205, 3, "user", "same.")] * 40,
        *[(206, t, "s", "a.") for t in range(30)],
    ]


def collected(df):
    return Counter(map(tuple, df.collect()))


def test_op13_on_the_tables(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    assert collected(queries.REGISTRY["op13_dialogue_repair"](spark, SF)) == brute(rows)


@pytest.mark.parametrize("segment", [2048, 3, 1])
def test_op13_edges(spark, monkeypatch, segment):
    """Small segments send every conversation through the states between segments."""
    monkeypatch.setattr(dialogue_repair, "SEGMENT", segment)
    rows = edge_rows()
    assert collected(dialogue_repair.op13_dialogue_repair(frame(spark, rows))) == brute(rows)


def test_no_rows(spark):
    assert dialogue_repair.op13_dialogue_repair(frame(spark, [])).collect() == []


def test_one_conversation_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(dialogue_repair, "SEGMENT", 50)
    rng = random.Random(3)
    rows = [(7, t, rng.choice(["system", "user", "assistant"]), rng.choice([f"t{t}.", "again.", "cut", ""])) for t in range(900)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = dialogue_repair.op13_dialogue_repair(frame(spark, rows + talks(4, 5, 6)))
        assert collected(made) == brute(rows + talks(4, 5, 6))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_search_finds_the_least():
    rng = random.Random(5)
    for _ in range(400):
        rows = [(t, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b.", "c", "", f"{t}."])) for t in range(rng.randrange(9))]
        faults = faults_of(rows)
        code = {"blank": 2, "duplicate": 2, "truncated": 1, "": 0}
        cost, audit, _ = cheapest(rows, faults)
        assert dialogue_repair.search([(r[1][:1], code[f]) for r, f in zip(rows, faults)], 0, dialogue_repair.FINAL, True) == (cost, audit)


def test_the_bound_keeps_the_search_short():
    """A long conversation of bad turns: nodes stay near the number of rows."""
    calls = 0
    original = dialogue_repair.moves

    def counted(*args):
        nonlocal calls
        calls += 1
        return original(*args)

    dialogue_repair.moves = counted
    try:
        dialogue_repair.search([("u", 0), ("u", 1), ("s", 0), ("a", 2)] * 1000, 0, dialogue_repair.FINAL, True)
    finally:
        dialogue_repair.moves = original
    assert calls < 3 * 4000
