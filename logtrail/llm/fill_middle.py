"""Fill-in-the-middle form of texts, cut between lines with a Fenwick tree.

A text is cut into units (lines with their end). Its UTF-8 bytes are looked at in
blocks of BLOCK bytes, and one Fenwick tree over the blocks holds two sums each:
unit ends and code points. A cut after `k` units is found by a binary-lifting
descent to the block that holds the k-th unit end, then by a search inside that
one block; the same descent yields the code points before the block. The output
carries the three parts with their markers; taking it apart again is an
expression of built-in functions.

Defined cases: a null or empty text is plain, with no units; a text that holds a
marker stays as it is. A null id is hashed like an empty one. Each row is treated
by itself, so repeated rows give repeated results; other columns are ignored.
Texts of any length are held once as bytes, next to sums of one entry per block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from logtrail.llm.common import batches, prepare, utf8

BLOCK = 2048
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Bytes of texts given back in one Arrow batch.
LOT_BYTES = 1 << 26
RESULT = "n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass(frozen=True)
class Plan:
    """Which texts are rearranged, and how: shares in percent, drawn from a hash of seed and id."""

    seed: int = 7
    rate: int = 100
    spm_share: int = 50


class BlockSums:
    """Fenwick tree over the blocks of one text: unit ends and code points of each."""

    def __init__(self, data: np.ndarray):
        self.data = data
        size = -(-len(data) // BLOCK)
        edges = np.arange(size) * BLOCK
        ends = np.add.reduceat(data == 10, edges, dtype=np.int64)
        points = np.add.reduceat((data & 0xC0) != 0x80, edges, dtype=np.int64)
        # Node i sums the blocks (i - lowest bit of i, i]; running sums make all nodes at once.
        node = np.arange(1, size + 1)
        below = node - (node & -node)
        running = np.zeros((size + 1, 2), np.int64)
        np.cumsum(np.stack([ends, points], axis=1), axis=0, out=running[1:])
        self.tree = (running[node] - running[below]).tolist()
        self.ends, self.points = running[-1].tolist()
        self.units = self.ends + (0 if data[-1] == 10 else 1)
        self.top = 1 << (size.bit_length() - 1)

    def cut(self, k: int) -> tuple[int, int]:
        """Bytes and code points of the first k units."""
        if k == 0:
            return 0, 0
        if k > self.ends:
            return len(self.data), self.points
        block, step, left, points = 0, self.top, k, 0
        while step:
            beyond = block + step
            if beyond <= len(self.tree) and self.tree[beyond - 1][0] < left:
                block = beyond
                left -= self.tree[beyond - 1][0]
                points += self.tree[beyond - 1][1]
            step >>= 1
        inside = self.data[block * BLOCK : (block + 1) * BLOCK]
        place = int(np.flatnonzero(inside == 10)[left - 1]) + 1
        return block * BLOCK + place, points + int(np.count_nonzero((inside[:place] & 0xC0) != 0x80))


def rearrange(data: np.ndarray, draws: tuple[int, int, int, int], plan: Plan) -> tuple:
    """n, form, prefix_chars, middle_chars, output of one text; draws are four numbers below 2^32."""
    raw = data.tobytes()
    if not raw:
        return 0, "plain", None, None, raw
    sums = BlockSums(data)
    if draws[2] % 100 >= plan.rate or any(mark.encode() in raw for mark in (PREFIX, SUFFIX, MIDDLE)):
        return sums.units, "plain", None, None, raw
    first, second = sorted(draw % (sums.units + 1) for draw in draws[:2])
    (a, a_points), (b, b_points) = sums.cut(first), sums.cut(second)
    parts = {PREFIX: raw[:a], MIDDLE: raw[a:b], SUFFIX: raw[b:]}
    form, order = ("spm", (SUFFIX, PREFIX, MIDDLE)) if draws[3] % 100 < plan.spm_share else ("psm", (PREFIX, SUFFIX, MIDDLE))
    output = b"".join(mark.encode() + parts[mark] for mark in order)
    return sums.units, form, a_points, b_points - a_points, output


def _draws(key: Column, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i}") for i in range(4)]


def fill_in_middle(docs: DataFrame, plan: Plan = Plan(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n, form, prefix_chars, middle_chars, output of each row."""
    prepare(docs.sparkSession)

    def flush(keys, rows):
        n, form, prefix, middle, output = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays(keys), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()),
             pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
            ["key", "n", "form", "prefix_chars", "middle_chars", "output"],
        )

    def run(source):
        for batch in batches(source):
            data, bounds = utf8(batch.column("text"))
            draws = list(zip(*(batch.column(f"h{i}").to_pylist() for i in range(4))))
            keys, rows, held = [], [], 0
            for i, own in enumerate(draws):
                rows.append(rearrange(data[bounds[i] : bounds[i + 1]], own, plan))
                keys.append(batch.column("key").slice(i, 1))
                held += len(rows[-1][-1])
                if held > LOT_BYTES:
                    yield flush(keys, rows)
                    keys, rows, held = [], [], 0
            if rows:
                yield flush(keys, rows)

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), *_draws(F.col(key), plan.seed))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, {RESULT}").withColumnRenamed("key", key)


def restored(output: Column, form: Column) -> Column:
    """The text again: no part holds a marker, so each marker stands once."""
    def after(mark: str) -> Column:
        return F.split_part(output, F.lit(mark), F.lit(2))

    def upto(rest: Column, mark: str) -> Column:
        return F.split_part(rest, F.lit(mark), F.lit(1))

    psm = F.concat(upto(after(PREFIX), SUFFIX), after(MIDDLE), upto(after(SUFFIX), MIDDLE))
    spm = F.concat(upto(after(PREFIX), MIDDLE), after(MIDDLE), upto(after(SUFFIX), PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_fill_middle(documents: DataFrame) -> DataFrame:
    made = fill_in_middle(documents)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )
