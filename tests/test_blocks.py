"""Executions: the cases of the rules, and random lines against a plain state machine."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from logtrail.operators import carry
from logtrail.operators.blocks import assign_starts, build_blocks, cut_streams, line_columns, log_lines
from logtrail.operators.dedup import dedup_events
from logtrail.schemas import BLOCK_COLUMNS

BASE = datetime(2024, 5, 1, 10, 59, 58, tzinfo=timezone.utc)
SCHEMA = "event_id string, log_stream string, log_group string, timestamp_utc timestamp, message string"


def lines(spark, *rows):
    """rows: (event_id, stream, seconds, message)"""
    data = [(e, s, "g", None if at is None else BASE + timedelta(seconds=at), m) for e, s, at, m in rows]
    return spark.createDataFrame(data, SCHEMA)


def blocks_of(spark, *rows):
    found = build_blocks(dedup_events(lines(spark, *rows)))
    assert found.columns == BLOCK_COLUMNS
    return sorted(found.collect(), key=lambda b: (b.log_stream, b.start_ts))


def test_complete_execution(spark):
    (block,) = blocks_of(
        spark,
        ("1", "s", 0, "START RequestId: a Version: 1"),
        ("2", "s", 1, "middle"),
        ("3", "s", 5, "END RequestId: a"),
        ("4", "s", 6, "REPORT RequestId: a"),
    )
    assert (block.request_id, block.log_group, block.block_closed) == ("a", "g", True)
    assert block.block_text == "START RequestId: a Version: 1\nmiddle\nEND RequestId: a"
    assert (block.end_ts - block.start_ts).total_seconds() == 5


def test_no_end_leaves_open(spark):
    (block,) = blocks_of(spark, ("1", "s", 0, "START RequestId: a"), ("2", "s", 1, "x"))
    assert block.block_closed is False and block.end_ts is None and block.block_text.endswith("\nx")


def test_start_closes_the_one_before(spark):
    first, second = blocks_of(
        spark,
        ("1", "s", 0, "START RequestId: a"),
        ("2", "s", 1, "x"),
        ("3", "s", 2, "START RequestId: b"),
        ("4", "s", 3, "END RequestId: b"),
    )
    assert (first.request_id, first.block_closed) == ("a", False)
    assert (second.request_id, second.block_closed) == ("b", True)


def test_streams_are_independent(spark):
    found = blocks_of(
        spark,
        ("1", "s1", 0, "START RequestId: a"),
        ("2", "s2", 0, "START RequestId: b"),
        ("3", "s1", 1, "END RequestId: b"),
        ("4", "s2", 1, "END RequestId: b"),
    )
    assert [(b.request_id, b.block_closed) for b in found] == [("a", False), ("b", True)]


def test_foreign_end_is_a_plain_line(spark):
    (block,) = blocks_of(
        spark,
        ("1", "s", 0, "START RequestId: a"),
        ("2", "s", 1, "END RequestId: other"),
        ("3", "s", 2, "END RequestId: a"),
    )
    assert block.block_closed and "END RequestId: other" in block.block_text


def test_lines_without_start_and_streamless_lines_are_left_out(spark):
    assert blocks_of(spark, ("1", "s", 0, "x"), ("2", None, 1, "START RequestId: a")) == []


def test_line_with_both_marks_is_a_start(spark):
    (block,) = blocks_of(spark, ("1", "s", 0, "START RequestId: a END RequestId: a"), ("2", "s", 1, "x"))
    assert block.block_closed is False and block.block_text.endswith("x")


def test_null_time_sorts_last_and_null_message_is_empty(spark):
    (block,) = blocks_of(
        spark, ("1", "s", None, "late"), ("2", "s", 0, "START RequestId: a"), ("3", "s", 1, None)
    )
    assert block.block_text == "START RequestId: a\n\nlate"


def test_execution_over_chunk_borders(spark):
    """Hours of silence inside one execution; the tail after END lies in another chunk."""
    (block,) = blocks_of(
        spark,
        ("1", "s", 0, "START RequestId: a"),
        ("2", "s", 4000, "x"),
        ("3", "s", 9000, "END RequestId: a"),
        ("4", "s", 13000, "tail"),
    )
    assert block.block_closed and block.block_text == "START RequestId: a\nx\nEND RequestId: a"


@pytest.mark.parametrize("rows", [10**6, 40])
def test_lines_behind_an_end_go_before_the_group(spark, rows, monkeypatch):
    """A day of lines behind one END, in many ranges, and an END in a range without its START."""
    monkeypatch.setattr(carry, "SAMPLES", 4)
    noise = [(f"n{i:04d}", "s", 5000 + 97 * i, "noise") for i in range(900)]
    data = [("a", "s", 0, "START RequestId: r"), ("b", "s", 4900, "END RequestId: r"), *noise,
            ("y", "s", 95000, "START RequestId: q"), ("z", "s", 95001, "x")]
    events = lines(spark, *data)
    marked = assign_starts(log_lines(events), cut_streams(events, rows=rows))
    assert sorted(r.event_id for r in marked.collect()) == ["a", "b", "y", "z"]


def test_copies_keep_one(spark):
    rows = [("1", "s", 0, "START RequestId: a"), ("2", "s", 1, "x"), ("3", "s", 2, "END RequestId: a")]
    assert blocks_of(spark, *rows, *rows) == blocks_of(spark, *rows)


def test_later_copy_wins(spark):
    kept = dedup_events(lines(spark, ("1", "s", 0, "old"), ("1", "s", 1, "new"), ("2", "s", 0, "x")))
    assert {r.event_id: r.message for r in kept.collect()} == {"1": "new", "2": "x"}


def machine(rows):
    """One pass per stream with an open execution as the only state."""
    out, by_stream = [], {}
    for row in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        by_stream.setdefault(row[1], []).append(row)
    for stream, items in by_stream.items():
        current = None
        for event_id, _, at, message in items:
            start = re.search(r"START RequestId:\s*(\S+)", message)
            end = re.search(r"END RequestId:\s*(\S+)", message)
            if start:
                if current:
                    out.append(current)
                current = [stream, start.group(1), [message], False]
            elif current:
                current[2].append(message)
                if end and end.group(1) == current[1]:
                    current[3] = True
                    out.append(current)
                    current = None
        if current:
            out.append(current)
    return sorted((s, rid, "\n".join(text), closed) for s, rid, text, closed in out)


@pytest.mark.parametrize("chunk, rows", [("1 second", 10**6), ("7 seconds", 10**6), ("1 hour", 10**6), ("1 hour", 70), ("7 seconds", 5)])
def test_random_lines_equal_state_machine(spark, chunk, rows, monkeypatch):
    monkeypatch.setattr(carry, "SAMPLES", 4)
    size = rows
    rng = random.Random(7)
    rows = []
    for i in range(1200):
        rid = f"r{rng.randrange(6)}"
        message = rng.choice(
            [f"START RequestId: {rid}", f"END RequestId: {rid}", f"END RequestId: {rid}", "text", f"REPORT {rid}"]
        )
        rows.append((f"{i:05d}", f"s{rng.randrange(3)}", rng.randrange(300), f"{message} #{i}"))
    found = build_blocks(lines(spark, *rows), chunk, size).collect()
    assert sorted((b.log_stream, b.request_id, b.block_text, b.block_closed) for b in found) == machine(rows)


def test_iso_text_times(spark):
    """Text times without a fraction are used as well as those with one."""
    data = [("1", "s", "2024-05-01T10:00:00+00:00", "START RequestId: a"),
            ("2", "s", "2024-05-01T10:00:00.500000+00:00", "x"), ("3", "s", "bad", "y")]
    df = spark.createDataFrame(data, "event_id string, log_stream string, timestamp_utc string, message string")
    (block,) = build_blocks(dedup_events(df)).select("*", F.unix_millis("start_ts").alias("ms")).collect()
    assert block.block_text == "START RequestId: a\nx\ny" and block.ms % 1000 == 0 and block.log_group == ""


def test_one_time_column_stands_for_both(spark):
    """Milliseconds first, the text where they are missing; the text form does not enter the deduplication."""
    data = [("1", "s", 0, "bad", "START RequestId: a", "c1"), ("2", "s", None, "1970-01-01T00:00:01+00:00", "x", "c1"),
            ("3", "s", 2000, None, "END of RequestId: a", "c1"), ("4", "s", None, None, "END RequestId: a", "c1"),
            ("4", "s", 3000, None, "END RequestId:a", "c2"), (None, None, 4000, "", "y", None)]
    bronze = spark.createDataFrame(data, "event_id string, log_stream string, timestamp_ms long, timestamp_utc string, message string, collection_id string")
    narrow = line_columns(bronze)
    assert dict(narrow.dtypes) == {
        "event_id": "string", "log_stream": "string", "message": "string", "collection_id": "string", "timestamp_utc": "timestamp"
    }
    assert build_blocks(dedup_events(narrow)).collect() == build_blocks(dedup_events(bronze)).collect()
    (block,) = build_blocks(dedup_events(narrow)).collect()
    assert block.block_text == "START RequestId: a\nx\nEND of RequestId: a\nEND RequestId: a"
