"""Fill-in-the-middle against a plain version over code points."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from llm_cases import SF, edge_texts, frame, sha
from logtrail.llm import fill_middle, queries
from pyspark.sql import functions as F


def brute(texts, rate=100, spm=50):
    out = []
    for i, t in texts:
        t = t or ""
        lines = re.findall(r"[^\n]*\n|[^\n]+", t)
        n = len(lines)
        digest = hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
        h = [int(digest[8 * j : 8 * j + 8], 16) for j in range(4)]
        if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
            out.append((i, n, "plain", None, None, sha(t.encode()), sha(t.encode())))
            continue
        a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
        form = "spm" if h[3] % 100 < spm else "psm"
        output = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
        out.append((i, n, form, len(p), len(m), sha(output.encode()), sha(t.encode())))
    return Counter(out)


def texts():
    line = "añ b\r日本 <P <S\n"
    return edge_texts() + [
        (20, "\n"), (21, "\n\n\n"), (22, "a"), (23, "a\n"), (24, "a\nb"), (25, "x <M> y\nz"), (26, "<P>"), (27, "<\nP>\n<S"),
        (28, "z" * 9000 + "\n" + "\n" * 5000 + "end"), (29, line * 4000), (30, ("q" * 2047 + "\n") * 7), (31, ("é" * 1024 + "\n") * 9),
        *[(100 + i, line * (i % 13)) for i in range(60)], (24, "a\nb"),
    ]


def test_op12_on_the_tables(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert Counter(map(tuple, queries.REGISTRY["op12_fill_middle"](spark, SF).collect())) == brute(rows)


@pytest.mark.parametrize("block", [2048, 3])
def test_op12_edges(spark, monkeypatch, block):
    monkeypatch.setattr(fill_middle, "BLOCK", block)
    assert Counter(map(tuple, fill_middle.op12_fill_middle(frame(spark, texts())).collect())) == brute(texts())


def test_no_rows_and_other_plans(spark):
    assert fill_middle.op12_fill_middle(frame(spark, [])).collect() == []
    plan = fill_middle.Plan(rate=40, spm_share=0)
    made = fill_middle.fill_in_middle(frame(spark, texts()), plan)
    made = made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256),
                       F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256))
    assert Counter(map(tuple, made.collect())) == brute(texts(), 40, 0)


def test_large_outputs_leave_in_lots(spark, monkeypatch):
    monkeypatch.setattr(fill_middle, "LOT_BYTES", 500)
    assert Counter(map(tuple, fill_middle.op12_fill_middle(frame(spark, texts())).collect())) == brute(texts())


def test_every_cut(monkeypatch):
    """The descent finds each boundary, whatever the blocks."""
    text = "ab\nç\n\n日本語の\nx" * 9
    data = np.frombuffer(text.encode(), np.uint8)
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    for block in (1, 2, 5, 64):
        monkeypatch.setattr(fill_middle, "BLOCK", block)
        sums = fill_middle.BlockSums(data)
        assert sums.units == len(lines)
        for k in range(len(lines) + 1):
            head = "".join(lines[:k])
            assert sums.cut(k) == (len(head.encode()), len(head))
