"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Vectors are scaled to length 1; at distance d, their projections on a random
direction differ by a normal variable of deviation d. A block of vectors is
sorted along each of PROJECTIONS directions; a pair collides in a direction if
one lies in the window around the other (the query), and pairs that collide at
least COUNT times are verified by their cosine in double precision. Window and
count come from the least similarity: of pairs at just that similarity, at most
MISS have fewer collisions (a binomial tail); closer pairs collide more often.

Equal vectors are folded into one class first. Classes that may be linked (equal
label and length) are compared as one block if there are few. Otherwise each is
dealt to a cell in each of several tables: a cell is a run of equal steps of
`depth` further projections. The depth follows from the number of classes, so that
cells of unlike vectors hold about CELL_ROWS, and the number of tables from the
depth, so that a pair at the least similarity shares no cell with chance MISS. A
pair is counted in the first table whose cell it shares. Cells that are larger all
the same (many near copies) are cut into lots, and each pair of lots is a task of
its own. A block returns one row for each vector: its links inside, and the head
of its component inside. Nothing is emitted for a pair.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite
components, and rows without an id or a label link with nothing and are their own
component; a row without an id has none, and is kept. Vectors of different length
link with nothing. Rows that repeat an id are vectors of their own with that id.
Other columns are ignored. Results are exact but for the missed pairs.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb, erf, exp, log, pi, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logtrail.llm.common import batches, prepare
from logtrail.llm.components import components
from logtrail.session import write_stage

PROJECTIONS = 24
# Half a window in deviations of a pair at the least similarity.
WINDOW = 1.5
MISS = 1e-3
# Step of a cell, in deviations of a unit vector's projection.
STEP = 2.0
CELL_ROWS = 2048
SEED = 20
# Queries compared with a block at a time, and pairs verified at a time.
TILE, PAIRS = 512, 1 << 15


# --- calibration ------------------------------------------------------------------


def distance(least: float) -> float:
    """Of unit vectors with this cosine."""
    return sqrt(2 - 2 * least)


def collision_chance(gap: float, half: float) -> float:
    """That projections of vectors `gap` apart differ by no more than `half`."""
    return erf(half / gap / sqrt(2))


def count_for(chance: float, miss: float = MISS, projections: int = PROJECTIONS) -> int:
    """The largest count that a pair with this chance fails to reach with probability `miss` at most."""
    below, count = 0.0, 0
    while count < projections:
        below += comb(projections, count) * chance**count * (1 - chance) ** (projections - count)
        if below > miss:
            break
        count += 1
    return count


def shared_step(gap: float, step: float = STEP) -> float:
    """That projections of vectors `gap` apart fall into one step with a random offset."""
    wide = step / gap
    return erf(wide / sqrt(2)) - 2 / (sqrt(2 * pi) * wide) * (1 - exp(-wide * wide / 2))


def layout(rows: int, least: float) -> tuple[int, int]:
    """Depth and number of tables for so many vectors: unlike ones are taken as orthogonal."""
    if rows <= CELL_ROWS:
        return 0, 1
    depth = int(np.ceil(log(rows / CELL_ROWS) / -log(shared_step(sqrt(2.0)))))
    return depth, int(np.ceil(log(MISS) / log(1 - shared_step(distance(least)) ** depth)))


@lru_cache(maxsize=64)
def directions(width: int, first: int, count: int, kind: int) -> np.ndarray:
    """Directions first .. first + count of a fixed sequence (kind 0: counted, 1: cells), one per column."""
    return np.stack([np.random.default_rng((SEED, kind, i)).standard_normal(width) for i in range(first, first + count)], axis=1)


@lru_cache(maxsize=64)
def offsets(first: int, count: int) -> np.ndarray:
    return np.array([np.random.default_rng((SEED, 2, i)).random() for i in range(first, first + count)])


def cells(units: np.ndarray, table: int, depth: int) -> list[bytes]:
    """The steps of each vector along the directions of a table."""
    if not depth:
        return [b""] * len(units)
    first = table * depth
    steps = np.floor(units @ directions(units.shape[1], first, depth, 1) / STEP + offsets(first, depth)).astype(np.int16)
    return [row.tobytes() for row in steps]


# --- one block ----------------------------------------------------------------------


def unit_rows(vectors: list) -> np.ndarray:
    """Rows scaled to length 1; the largest component first, so that no square leaves the range of a double."""
    points = np.array(vectors, np.float64)
    points /= np.abs(points).max(axis=1, keepdims=True)
    return points / np.sqrt((points * points).sum(axis=1, keepdims=True))


def candidate_pairs(left: np.ndarray, right: np.ndarray, least: float, same: bool):
    """Index pairs with enough collisions, tile by tile; `same`: each unordered pair of one block once."""
    gap = distance(least)
    half = WINDOW * gap
    count = count_for(collision_chance(gap, half))
    width = left.shape[1]
    axes = directions(width, 0, PROJECTIONS, 0)
    queries, data = left @ axes, right @ axes
    ordered = np.sort(data, axis=0)
    # Windows and data as places in the sorted order of each direction.
    place = np.stack([np.searchsorted(ordered[:, j], data[:, j]) for j in range(PROJECTIONS)]).astype(np.uint32)
    low = np.stack([np.searchsorted(ordered[:, j], queries[:, j] - half, "left") for j in range(PROJECTIONS)]).astype(np.uint32)
    high = np.stack([np.searchsorted(ordered[:, j], queries[:, j] + half, "right") for j in range(PROJECTIONS)]).astype(np.uint32)
    span = high - low
    for begin in range(0, len(left), TILE):
        end = min(begin + TILE, len(left))
        after = begin if same else 0
        counts = np.zeros((end - begin, len(right) - after), np.uint8)
        for j in range(PROJECTIONS):
            # Below the window the difference wraps round and is larger than any span.
            counts += (place[j, None, after:] - low[j, begin:end, None]) < span[j, begin:end, None]
        a, b = np.nonzero(counts >= count)
        a, b = a + begin, b + after
        if same:
            a, b = a[a < b], b[a < b]
        for cut in range(0, len(a), PAIRS):
            yield a[cut : cut + PAIRS], b[cut : cut + PAIRS]


class Heads:
    """Components of one block: every member points towards the smallest index of its component."""

    def __init__(self, size: int):
        self.head = np.arange(size)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.head[a], self.head[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.head, np.maximum(a, b), np.minimum(a, b))
            self.settle()

    def settle(self) -> None:
        while True:
            further = self.head[self.head]
            if (further == self.head).all():
                return
            self.head = further


def block_links(frame: pd.DataFrame, least: float) -> pd.DataFrame:
    """node, links, head of the classes in one block (of one lot, or of two)."""
    table, depth = int(frame["table"].iloc[0]), int(frame["depth"].iloc[0])
    frame = frame.sort_values(["side", "node"]).reset_index(drop=True)
    units, copies = unit_rows(frame["v"].tolist()), frame["copies"].to_numpy()
    split = int((frame["side"] == 0).sum())
    same = split == len(frame)
    earlier = [np.unique(np.array(cells(units, t, depth), dtype=object), return_inverse=True)[1] for t in range(table)]
    links, heads = np.zeros(len(frame), np.int64), Heads(len(frame))
    left, right = (units, units) if same else (units[:split], units[split:])
    for a, b in candidate_pairs(left, right, least, same):
        if not same:
            b = b + split
        near = np.einsum("ij,ij->i", units[a], units[b]) >= least
        for shared in earlier:
            near &= shared[a] != shared[b]
        a, b = a[near], b[near]
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        heads.link(a, b)
    heads.settle()
    found = pd.DataFrame({"node": frame["node"], "links": links, "head": frame["node"].to_numpy()[heads.head]})
    return found[found["links"] > 0]


# --- Spark --------------------------------------------------------------------------


def _dealt(classes: DataFrame, least: float) -> DataFrame:
    """A row for each class and table: table, depth, cell."""

    def deal(source):
        for batch in batches(source):
            vectors, sizes = batch.column("v").to_pylist(), batch.column("n").to_pylist()
            for width in sorted(set(map(len, vectors))):
                at = [i for i, v in enumerate(vectors) if len(v) == width]
                units = unit_rows([vectors[i] for i in at])
                # Rows of one width differ in depth only by label.
                plans = [layout(sizes[i], least) for i in at]
                for depth, tables in sorted(set(plans)):
                    own = [j for j, plan in enumerate(plans) if plan == (depth, tables)]
                    rows = batch.take(pa.array([at[j] for j in own]))
                    for table in range(tables):
                        yield pa.RecordBatch.from_arrays(
                            [*rows.columns, pa.array([table] * len(own), pa.int32()), pa.array([depth] * len(own), pa.int32()),
                             pa.array(cells(units[own], table, depth), pa.binary())],
                            [*rows.schema.names, "table", "depth", "cell"],
                        )

    kind = classes.schema["label"].dataType.simpleString()
    element = classes.schema["v"].dataType.simpleString()
    return classes.mapInArrow(deal, f"node string, label {kind}, v {element}, copies long, n long, table int, depth int, cell binary")


def _blocks(dealt: DataFrame) -> DataFrame:
    """block, side: a cell is one block, a large one a block for each pair of its lots."""
    cell = F.md5(F.concat_ws("|", F.col("label").cast("string"), F.size("v"), "table", F.hex("cell")))
    placed = dealt.withColumn("place", cell)
    sizes = write_stage(placed.groupBy("place").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 2 * CELL_ROWS), "large-cells")
    lots = F.coalesce(F.ceil(F.col("rows") / CELL_ROWS), F.lit(1)).cast("int")
    cut = placed.join(sizes, "place", "left").withColumn("lots", lots).withColumn("lot", F.pmod(F.xxhash64("node"), F.col("lots")).cast("int"))
    # Lot x meets y <= x as the second side, y >= x as the first; x with itself has one side.
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("lots") - 1),
        lambda y: F.struct(F.least("lot", y).alias("low"), F.greatest("lot", y).alias("high"), (y < F.col("lot")).cast("int").alias("side")),
    )
    return cut.select("node", "v", "copies", "table", "depth", "place", F.inline(pairs)).select(
        F.concat_ws("|", "place", "low", "high").alias("block"), "side", "node", "v", "copies", "table", "depth"
    )


def near_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.98) -> DataFrame:
    """key, n_links, component_id of each row; vectors link at a cosine of `least` or more."""
    prepare(rows.sparkSession)
    v = F.col(vector)
    whole = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(whole & F.exists(v, lambda x: x != 0) & F.col(key).isNotNull() & F.col(label).isNotNull(), F.lit(False))
    # Two hashes of label and vector name a class: 128 bits.
    name = F.concat_ws("-", F.hex(F.xxhash64(F.col(label), v)), F.hex(F.xxhash64(v, F.lit("class"), F.col(label))))
    named = rows.select(F.col(key).alias("id"), F.when(usable, name).alias("node"), F.col(label).alias("label"), v.alias("v"))
    classes = write_stage(
        named.where(F.col("node").isNotNull()).groupBy("node").agg(
            F.first("label").alias("label"), F.first("v").alias("v"), F.min("id").alias("least"), F.count(F.lit(1)).alias("copies")
        ), "vector-classes",
    )
    sizes = write_stage(classes.groupBy("label", F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("n")), "label-sizes")
    sized = classes.join(sizes, (classes["label"] == sizes["label"]) & (F.size("v") == F.col("width"))).select(
        "node", classes["label"], "v", "copies", "n"
    )
    dealt = _dealt(sized.where("n > 1"), least)
    found = write_stage(
        _blocks(dealt).groupBy("block").applyInPandas(lambda frame: block_links(frame, least), "node string, links long, head string"), "vector-links"
    )
    groups = components(found.where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")))
    grouped = classes.select("node", "least", "copies").join(groups, "node", "left").withColumn("group", F.coalesce("component", "node"))
    # Written, so that the join can split a component of very many classes.
    heads = write_stage(grouped.groupBy("group").agg(F.min("least").alias("component_id")), "vector-components")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    result = write_stage(
        grouped.join(heads, "group").join(links, "node", "left").select(
            "node", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
        ), "vector-results",
    )
    # Rows outside of all classes get keys of their own, so they do not meet in one task.
    probe = F.coalesce("node", F.concat(F.lit("none-"), F.coalesce(F.col("id").cast("string"), F.rand(SEED).cast("string"))))
    joined = named.select("id", probe.alias("node")).join(result, "node", "left")
    return joined.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))


def op11_collision_join(embeddings: DataFrame) -> DataFrame:
    found = near_vectors(embeddings)
    return found.select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )
