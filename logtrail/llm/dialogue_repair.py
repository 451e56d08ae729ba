"""Cheapest repair of conversations by depth-first branch and bound.

A conversation is legal if the initials of its roles read `(s?(ua)+)?`. Its rows
may be kept, given the other role, deleted, or have empty turns put between them;
the search finds the cheapest edits and, of equally cheap ones, those whose
letters (Delete, Insert, Keep, Rerole) come first in ASCII order. It runs over an
explicit stack. A node is (rows done, state of the pattern); it is left when the
prefix's cost plus a lower bound of the suffix cannot beat the incumbent (cost,
audit), or when the table of its node holds a prefix at least as good.

Rows are dealt by range of (conversation, turn, role, text), so that a long
conversation lies in many ranges. One that lies inside a range is repaired there.
The others (the first and last of each range, and those of more than SEGMENT rows)
are cut into segments of at most SEGMENT rows; each segment is searched for all
pairs of states before and after it. The segments' costs and the order of their
audits (none of which is a prefix of another) then decide the states between them,
one small record a segment. Repaired lines are hashed as a sorted stream: the
digest of a conversation is one chain over its text, so one task reads it, but
never holds it.

Defined cases: rows are ordered by turn (nulls first), then role, then text; null
roles and texts are one space, and rows with a null id are one conversation. A
conversation all of whose rows are `gone` is empty. Repeated rows are duplicates
unless blank; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from logtrail.llm.common import batches, prepare
from logtrail.session import write_stage

SEGMENT = 2048
# Bytes of text that a range keeps for its sort order beyond the role.
ORDER_CHARS = 64
SPACE = " \t\n\x0b\x0c\r"
COST = {"D": 4, "I": 3, "K": 0, "R": 3}
TRUNCATED_COST = 3
FINE, TRUNCATED, REMOVED = 0, 1, 2
ROLES = {"u": "user", "a": "assistant"}
# States of the pattern: nothing yet, after s, after u, after a; the role each waits for; the legal pairs.
WAITS, AFTER = "uuau", {"u": 2, "a": 3}
STATES, FINAL = range(4), (0, 3)
LEGAL_PAIRS = {"su", "ua", "au"}
FAR = 1 << 60

# --- search ----------------------------------------------------------------------


def moves(initial: str, fault: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of one row."""
    found = [("D", COST["D"], state)]
    if fault != REMOVED:
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        wanted = WAITS[state]
        if initial == wanted:
            found.append(("K", extra, AFTER[wanted]))
        else:
            if initial == "s" and state == 0:
                found.append(("K", extra, 1))
            found.append(("R", COST["R"] + extra, AFTER[wanted]))
    return found


def inserted(state: int) -> int:
    return AFTER[WAITS[state]]


def suffix_bounds(rows: list[tuple[str, int]], ends, closing: bool) -> list[list[int]]:
    """Lower bound of the cost from (rows done, state) to an end state, audits left aside."""

    def with_inserts(costs: list[int]) -> list[int]:
        pair = [min(costs[2], COST["I"] + costs[3]), min(costs[3], COST["I"] + costs[2])]
        return [min(costs[0], COST["I"] + pair[0]), min(costs[1], COST["I"] + pair[0]), *pair]

    last = [0 if state in ends else FAR for state in STATES]
    bounds = [with_inserts(last) if closing else last]
    known: dict = {}
    for row in reversed(rows):
        if row not in known:
            known[row] = [moves(*row, state) for state in STATES]
        after = bounds[-1]
        bounds.append(with_inserts([min(cost + after[to] for _, cost, to in own) for own in known[row]]))
    bounds.reverse()
    return bounds


def search(rows: list[tuple[str, int]], start: int, ends, closing: bool, bounds=None) -> tuple[int, str] | None:
    """The least (cost, audit) that leads from `start` to one of `ends`; `closing` allows inserts behind the last row."""
    bounds = bounds or suffix_bounds(rows, ends, closing)
    if bounds[0][start] >= FAR:
        return None
    count = len(rows)
    best: tuple[int, str] | None = None
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, 0, start, "")]
    while stack:
        cost, done, state, audit = stack.pop()
        total = cost + bounds[done][state]
        if best is not None and (total > best[0] or (total == best[0] and audit >= best[1][: len(audit)])):
            continue
        node = (done, state)
        if node in reached and reached[node] <= (cost, audit):
            continue
        reached[node] = (cost, audit)
        if done == count and state in ends:
            best = (cost, audit)
            continue
        branches = []
        if done < count or closing:
            to = inserted(state)
            branches.append((cost + COST["I"] + bounds[done][to], "I", cost + COST["I"], done, to))
        if done < count:
            for letter, price, to in moves(*rows[done], state):
                branches.append((cost + price + bounds[done + 1][to], letter, cost + price, done + 1, to))
        # The most hopeful branch is pushed last, hence taken first.
        branches.sort(reverse=True)
        stack.extend((price, at, to, audit + letter) for expected, letter, price, at, to in branches if expected < FAR)
    return best


def edits(audit: str) -> tuple[list[str], str]:
    """The audit cut into the letters of each row (inserts before it, then its own), and the inserts behind the last."""
    own, held = [], ""
    for letter in audit:
        held += letter
        if letter != "I":
            own.append(held)
            held = ""
    return own, held


def lines_of(letters: str, state: int, role: str, text: str) -> tuple[list[str], int]:
    """Repaired lines that the letters of one row give, and the state behind them."""
    lines = []
    for letter in letters:
        if letter == "D":
            continue
        wanted = WAITS[state]
        if letter == "K":
            lines.append(f"{role}:{text}")
            state = 1 if state == 0 and role[:1] == "s" else AFTER[wanted]
        else:
            lines.append(f"{ROLES[wanted]}:{text if letter == 'R' else ''}")
            state = AFTER[wanted]
    return lines, state


def state_after(letters: str, state: int, initial: str) -> int:
    for letter in letters:
        if letter == "K" and state == 0 and initial == "s":
            state = 1
        elif letter != "D":
            state = inserted(state)
    return state


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:]))


def repaired(rows: list[tuple]) -> tuple:
    """gaps, blank, duplicate, truncated, illegal, cost, audit, digest of (turn, role, text, blank, cut) rows in order."""
    seen: set[tuple[str, str]] = set()
    faults, counts = [], [0, 0, 0]
    for _, role, text, blank, cut in rows:
        repeated = (role, text) in seen
        seen.add((role, text))
        if blank or repeated:
            faults.append(REMOVED)
            counts[0 if blank else 1] += 1
        else:
            faults.append(TRUNCATED if cut else FINE)
            counts[2] += cut
    turns = {row[0] for row in rows if row[0] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [row[1][:1] for row in rows]
    cost, audit = search(list(zip(initials, faults)), 0, FINAL, True)
    own, tail = edits(audit)
    lines, state = [], 0
    for letters, row in zip(own, rows):
        new, state = lines_of(letters, state, row[1], row[2])
        lines += new
    lines += lines_of(tail, state, "", "")[0]
    return (gaps, *counts, illegal_pairs(initials), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


# --- ranges ----------------------------------------------------------------------

_ROW = ["turn", "role", "text", "blank", "cut"]
_COUNTS = ["gaps", "blanks", "duplicates", "truncations", "illegal", "cost"]
_DONE = [*_COUNTS, "audit", "digest"]


def _ranged(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations inside the range repaired; rows of the others numbered and handed on."""
    part = TaskContext.get().partitionId()
    lot: list[tuple] = []
    kind = None

    def take() -> pa.RecordBatch:
        columns = list(zip(*lot))
        names = ["key", "conv", "part", "seq", "gone", *_ROW, *_DONE]
        types = [pa.string(), kind, pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_(),
                 *[pa.int64()] * 6, pa.string(), pa.string()]
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
        lot.clear()
        return made

    key, conv, held, handed, first = None, None, [], 0, True

    def hand_on() -> None:
        nonlocal handed
        for row in held:
            lot.append((key, conv, part, handed, row[5], *row[:5], *[None] * 8))
            handed += 1
        held.clear()

    def close() -> None:
        if first or handed:
            hand_on()
        else:
            lot.append((key, conv, part, None, None, *[None] * 5, *repaired([row[:5] for row in held if not row[5]])))
            held.clear()

    for batch in batches(source):
        kind = batch.column("conv").type
        columns = [batch.column(name).to_pylist() for name in ("key", "conv", *_ROW, "gone")]
        for new, new_conv, *row in zip(*columns):
            if new != key:
                if key is not None:
                    close()
                    first = False
                key, conv, handed = new, new_conv, 0
            held.append(row)
            if len(held) >= SEGMENT:
                hand_on()
        if lot:
            yield take()
    if key is not None:
        hand_on()  # the last conversation may go on in the next range
        yield take()


# --- segments --------------------------------------------------------------------


def _searched(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each segment for all states before and after it: cost and audit, and the rank of each audit among those from one state."""
    for batch in batches(source):
        found = []
        for codes in batch.column("codes").to_pylist():
            rows = [(code["initial"], code["fault"]) for code in codes]
            costs, audits, ranks = [FAR] * 16, [""] * 16, [0] * 16
            for end in STATES:
                bounds = suffix_bounds(rows, (end,), False)
                for start in STATES:
                    best = search(rows, start, (end,), False, bounds)
                    if best:
                        costs[4 * start + end], audits[4 * start + end] = best
            for start in STATES:
                for rank, place in enumerate(sorted(range(4 * start, 4 * start + 4), key=audits.__getitem__)):
                    ranks[place] = rank
            found.append((costs, audits, ranks, illegal_pairs([row[0] for row in rows]), rows[0][0], rows[-1][0]))
        columns = list(zip(*found))
        types = [pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(name) for name in ("key", "part", "segment", "codes")] + [pa.array(c, t) for c, t in zip(columns, types)],
            ["key", "part", "segment", "codes", "costs", "audits", "ranks", "illegal", "head", "tail"],
        )


def _joined(frame: pd.DataFrame) -> pd.DataFrame:
    """States between the segments of one conversation: least cost, then least audit."""
    frame = frame.sort_values(["part", "segment"])
    togo = [[0, 2 * COST["I"], COST["I"], 0]]
    costs = frame["costs"].tolist()
    for own in reversed(costs):
        togo.append([min(own[4 * s + t] + togo[-1][t] for t in STATES) for s in STATES])
    togo.reverse()
    state, chosen = 0, []
    for own, ranks, here, after in zip(costs, frame["ranks"], togo, togo[1:]):
        to = min((t for t in STATES if own[4 * state + t] + after[t] == here[state]), key=lambda t: ranks[4 * state + t])
        chosen.append((state, to))
        state = to
    heads, tails = frame["head"].tolist(), frame["tail"].tolist()
    borders = [int(a + b not in LEGAL_PAIRS) for a, b in zip(tails, heads[1:])] + [0]
    out = frame[["key", "part", "segment"]].copy()
    out["start"], out["finish"] = zip(*chosen)
    out["cost"], out["illegal"] = togo[0][0], frame["illegal"].to_numpy() + np.array(borders)
    out["closing"] = ["I" * (togo[-1][state] // COST["I"]) if i == len(chosen) - 1 else "" for i in range(len(chosen))]
    return out


def _edited(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Letters and state of each row of a segment, and of the inserts behind the last."""
    for batch in batches(source):
        names = ("key", "part", "codes", "start", "audit", "closing")
        for key, part, codes, state, audit, closing in zip(*(batch.column(name).to_pylist() for name in names)):
            own, _ = edits(audit)
            rows = []
            for letters, code in zip(own, codes):
                rows.append((key, part, code["seq"], letters, state))
                state = state_after(letters, state, code["initial"])
            if closing:
                rows.append((key, np.iinfo(np.int64).max, 0, closing, state))
            types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["key", "part", "seq", "letters", "state"])


def _lines(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(source):
        names = ("letters", "state", "role", "text")
        made = [lines_of(letters, state, role or "", text or "")[0] for letters, state, role, text in zip(*(batch.column(n).to_pylist() for n in names))]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(name) for name in ("key", "part", "seq")], pa.array(["\n".join(m) if m else None for m in made], pa.string())],
            ["key", "part", "seq", "lines"],
        )


def _digests(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, from rows in order."""
    key, chain, begun = None, None, False
    for batch in batches(source):
        done = []
        rows = zip(batch.column("key").to_pylist(), batch.column("lines").to_pylist())
        for own, group in groupby(rows, itemgetter(0)):
            if own != key:
                if key is not None:
                    done.append((key, chain.hexdigest()))
                key, chain, begun = own, hashlib.sha256(), False
            for _, lines in group:
                if lines is not None:
                    chain.update(("\n" if begun else "").encode() + lines.encode())
                    begun = True
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["key", "digest"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([chain.hexdigest()])], ["key", "digest"])


def _across(rows: DataFrame) -> DataFrame:
    """key and the results of the conversations that were handed on as numbered rows."""
    present = rows.where("NOT gone").withColumn("mark", F.md5(F.concat_ws(":", F.length("role"), "role", "text")))
    # Where each repeated text stands first; written, so that a hot key of the join can be split.
    place = F.struct("part", "seq")
    repeats = present.where("NOT blank").groupBy("key", "mark").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    repeats = write_stage(repeats.where("n > 1").select("key", "mark", "first"), "repeated-turns")
    marked = present.select("key", "part", "seq", "mark", "blank", "cut", F.substring("role", 1, 1).alias("initial")).join(repeats, ["key", "mark"], "left")
    again = F.col("first").isNotNull() & (F.col("first") != place) & ~F.col("blank")
    fault = F.when(F.col("blank") | again, REMOVED).when(F.col("cut"), TRUNCATED).otherwise(FINE)
    coded = marked.select("key", "part", "seq", F.floor(F.col("seq") / SEGMENT).alias("segment"), "initial", fault.alias("fault"), "blank", again.alias("again"))
    whole = F.array_sort(F.collect_list(F.struct("seq", "initial", "fault")))
    segments = coded.groupBy("key", "part", "segment").agg(whole.alias("codes"))
    schema = (
        "key string, part long, segment long, codes array<struct<seq: long, initial: string, fault: int>>, costs array<long>, "
        "audits array<string>, ranks array<long>, illegal long, head string, tail string"
    )
    searched = write_stage(segments.mapInArrow(_searched, schema), "dialogue-segments")
    joined = searched.select("key", "part", "segment", "costs", "ranks", "illegal", "head", "tail").groupBy("key").applyInPandas(
        _joined, "key string, part long, segment long, start int, finish int, cost long, illegal long, closing string"
    )
    joined = write_stage(joined, "dialogue-states")
    audit = F.element_at("audits", F.col("start") * 4 + F.col("finish") + 1)
    chosen = searched.select("key", "part", "segment", "codes", "audits").join(joined, ["key", "part", "segment"]).withColumn("audit", audit)
    letters = chosen.select("key", "part", "codes", "start", "audit", "closing").mapInArrow(
        _edited, "key string, part long, seq long, letters string, state int"
    )
    lines = letters.join(present.select("key", "part", "seq", "role", "text"), ["key", "part", "seq"], "left").mapInArrow(
        _lines, "key string, part long, seq long, lines string"
    )
    digests = lines.repartition("key").sortWithinPartitions("key", "part", "seq").mapInArrow(_digests, "key string, digest string")
    full = F.array_sort(F.collect_list(F.struct("part", "segment", F.concat("audit", "closing").alias("audit"))))
    audits = chosen.groupBy("key").agg(
        F.max("cost").alias("cost"), F.sum("illegal").alias("illegal"), F.array_join(F.transform(full, lambda x: x["audit"]), "").alias("audit")
    )
    counts = coded.groupBy("key").agg(
        F.count_if("blank").alias("blanks"), F.count_if("again").alias("duplicates"), F.count_if(F.col("fault") == TRUNCATED).alias("truncations")
    )
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    spans = rows.withColumn("turn", F.expr("IF(gone, NULL, turn)")).groupBy("key").agg(
        F.first("conv", ignorenulls=True).alias("conv"), F.coalesce(span, F.lit(0)).alias("gaps")
    )
    empty = hashlib.sha256().hexdigest()
    found = spans.join(counts, "key", "left").join(audits, "key", "left").join(digests, "key", "left")
    zeros = [F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in _COUNTS]
    return found.select("key", "conv", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("digest", F.lit(empty)).alias("digest"))


def repair(rows: DataFrame, key: str = "conv_id", gone: Column | None = None) -> DataFrame:
    """key, gaps, blanks, duplicates, truncations, illegal, cost, audit, digest of each conversation.

    `rows` has the columns key, turn, role, text. Rows where `gone` holds are no
    longer part of their conversation, but it is listed.
    """
    prepare(rows.sparkSession)
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("role", "text"))
    taken = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")).alias("key"), F.col(key).alias("conv"),
        F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), (F.lit(False) if gone is None else gone).alias("gone"),
    )
    order = ["key", F.asc_nulls_first("turn"), "role"]
    dealt = taken.repartitionByRange(*order, F.substring("text", 1, ORDER_CHARS)).sortWithinPartitions(*order, "text")
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    faults = dealt.select(
        "*", (trimmed == "").alias("blank"), ((trimmed != "") & ~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("cut")
    )
    kind = taken.schema["conv"].dataType.simpleString()
    schema = (
        f"key string, conv {kind}, part long, seq long, gone boolean, turn long, role string, text string, blank boolean, cut boolean, "
        + ", ".join(f"{name} long" for name in _COUNTS) + ", audit string, digest string"
    )
    ranged = write_stage(faults.mapInArrow(_ranged, schema), "dialogues")
    done = ranged.where("seq IS NULL").select("key", "conv", *_DONE)
    whole = done.unionByName(_across(ranged.where("seq IS NOT NULL")))
    return whole.select(F.col("conv").alias(key), *_DONE)


def damaged(rows: DataFrame) -> DataFrame:
    """A repeatable damage of a fifth to a quarter of the rows; dropped ones stay, marked in `lost`."""
    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    hit = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    text = F.when(hit == 1, "").when(hit == 2, F.regexp_replace(text_of("text"), "[.!?]", "")).otherwise(text_of("text"))
    copies = F.explode(F.when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select(
        "conv_id", "turn", F.when(hit == 4, "user").otherwise(text_of("role")).alias("role"), text.alias("text"), (hit == 0).alias("lost"), copies.alias("copy")
    ).drop("copy")


def op13_dialogue_repair(conversations: DataFrame) -> DataFrame:
    found = repair(damaged(conversations), gone=F.col("lost"))
    return found.select(
        "conv_id", "gaps", F.col("blanks").alias("blank"), F.col("duplicates").alias("duplicate"), F.col("truncations").alias("truncated"),
        "illegal", "cost", "audit", F.col("digest").alias("repaired_sha256"),
    )
