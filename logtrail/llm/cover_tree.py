"""Exact top-k inner products by dual-tree search over cover trees.

Vectors are turned into integers, equal vectors are folded into one with the
smallest ids that can still be of use (k + 1 of them), and dealt to shards by
their nearest pivot, salted so that no shard outgrows SHARD_ROWS by plan. Every
shard becomes one row of an index table: its points and a cover tree (centre,
covering radius and children of each node). Queries are indexed the same way,
in the same space, as groups.

Round one joins each query group with the shards of the nearest pivots and
gives every query a k-th score to beat. Round two joins it with every other
shard whose bound can still beat the worst of these: for nodes with centres c, d
and radii r, s no pair scores more than c.d + |c| s + |d| r + r s. Inside a pair
of trees, the same bound prunes pairs of nodes against the worst k-th score of
the query node. Queries x shards are compared by centre and radius, never row by
row, and results keep k rows for each query and task before they are merged.

Scores are exact. Where a pair's norms stay below 2^53, float64 holds every partial
sum; beyond, float64 finds the hopeful candidates, with a margin for its rounding,
and Python integers score these. Bounds carry the same relative margin.

Defined cases: vectors that are null, empty, or hold a null or a non-finite component
take no part; nor do null ids. Vectors of several lengths have shards of their own,
and the shorter of two counts as padded with zeros. Of repeated ids each row is a
candidate, and a query never meets its own id. Fewer than k candidates give fewer
rows. A component of 2^46 or more, and a score in the result that no long holds, end
the query with an error that names the row. Other columns are ignored.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from logtrail.llm.common import batches, prepare
from logtrail.llm.wordhash import records
from logtrail.session import write_stage

PIVOTS = 32
PIVOT_SAMPLE = 4096
SHARD_ROWS = 4096
GROUP_ROWS = 512
LEAF = 256
LANES = 64
NEAREST_PIVOTS = 2
EXACT = 2.0**53
LARGEST = 2.0**46  # 64 times this, squared and summed over 2^22 components, fits a decimal of 38 digits
SHARD = "shard long, pivot int, centre binary, radius double, points binary, ids binary, counts binary, tree binary"


# --- trees ---------------------------------------------------------------------


class Tree:
    """A cover tree: nodes hold a range of the (reordered) points, a centre among them and a radius.

    A node's children cover its points with at most half its radius where that
    is possible; a node of LEAF points or radius 0 has none.
    """

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.first, self.last, self.centre, self.radius, self.children = [], [], [], [], []
        self.points = points
        self._grow(0, len(points), 0)

    def _grow(self, first: int, last: int, centre: int) -> int:
        stack = [(first, last, centre, -1)]
        while stack:
            first, last, centre, parent = stack.pop()
            members = self.order[first:last]
            away = _distances(self.points[members], self.points[centre])
            node = len(self.first)
            radius = float(away.max())
            for held, value in zip((self.first, self.last, self.centre, self.radius, self.children), (first, last, centre, radius, [])):
                held.append(value)
            if parent >= 0:
                self.children[parent].append(node)
            if last - first <= LEAF or radius == 0:
                continue
            centres, owner, nearest = [centre], np.zeros(len(members), np.int64), away
            while nearest.max() > radius / 2 and len(centres) < 16:
                new = int(members[nearest.argmax()])
                gap = _distances(self.points[members], self.points[new])
                closer = gap < nearest
                owner[closer], nearest = len(centres), np.minimum(nearest, gap)
                centres.append(new)
            by_owner = np.argsort(owner, kind="stable")
            self.order[first:last] = members[by_owner]
            ends = np.cumsum(np.bincount(owner, minlength=len(centres)))
            for k, own in enumerate(centres):
                low = first + (int(ends[k - 1]) if k else 0)
                if low < first + int(ends[k]):
                    stack.append((low, first + int(ends[k]), own, node))
        return 0

    def packed(self) -> bytes:
        """first, last, centre, radius, parent of each node."""
        parent = np.full(len(self.first), -1)
        for node, children in enumerate(self.children):
            parent[children] = node
        return np.array([self.first, self.last, self.centre, self.radius, parent], np.float64).T.tobytes()


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    gap = points.astype(np.float64) - centre
    return np.sqrt((gap * gap).sum(axis=1))


class Side:
    """One shard or query group, unpacked: points in tree order and the nodes."""

    def __init__(self, row: dict):
        nodes = np.frombuffer(row["tree"], np.float64).reshape(-1, 5)
        self.first, self.last = nodes[:, 0].astype(np.int64), nodes[:, 1].astype(np.int64)
        self.radius = nodes[:, 3]
        self.counts = np.frombuffer(row["counts"], np.int64)
        self.points = np.frombuffer(row["points"], np.float64).reshape(len(self.counts), -1)
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.counts)])
        self.centre = self.points[nodes[:, 2].astype(np.int64)]
        self.norm = np.sqrt((self.centre**2).sum(axis=1))
        self.length = np.sqrt((self.points**2).sum(axis=1))
        self.children: list[list[int]] = [[] for _ in nodes]
        for node, parent in enumerate(nodes[:, 4].astype(np.int64)):
            if parent >= 0:
                self.children[parent].append(node)


def pack(shard: int, pivot: int, points: np.ndarray, ids: list[np.ndarray]) -> dict:
    """Index row of the points; the tree's order is applied to points and ids."""
    tree = Tree(points)
    place = np.empty(len(points), np.int64)
    place[tree.order] = np.arange(len(points))
    tree.centre = [int(place[c]) for c in tree.centre]
    own = [ids[i] for i in tree.order]
    return {
        "shard": shard, "pivot": pivot, "centre": points[tree.order[tree.centre[0]]].astype(np.float64).tobytes(),
        "radius": tree.radius[0], "points": points[tree.order].astype(np.float64).tobytes(),
        "ids": np.concatenate(own).astype(np.int64).tobytes(), "counts": np.array([len(i) for i in own], np.int64).tobytes(),
        "tree": tree.packed(),
    }


class Best:
    """The k best (score, id) of each query of a group so far; scores are Python integers where float64 is not exact."""

    def __init__(self, queries: int, k: int, exact: bool = True):
        self.k = k
        self.scores = np.full((queries, k), -np.inf, np.float64 if exact else object)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)

    def worst(self, rows: slice) -> float:
        return float(self.scores[rows, -1].min())

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, margin: float = 0.0, exactly=None) -> None:
        """Merge candidates (rows x n) with ids (n); `exactly(place, column)` scores those within the margin."""
        hopes = np.isfinite(scores) & (scores + margin >= self.scores[rows, -1].astype(np.float64)[:, None])
        for place in np.flatnonzero(hopes.any(axis=1)):
            row, own, hopeful = rows[place], scores[place], np.flatnonzero(hopes[place])
            all_ids = np.concatenate([self.ids[row], ids[hopeful]])
            if exactly:
                all_scores = np.array([*self.scores[row], *(exactly(place, column) for column in hopeful)], object)
                keep = sorted(range(len(all_ids)), key=lambda i: (-all_scores[i], all_ids[i]))[: self.k]
            else:
                all_scores = np.concatenate([self.scores[row], own[hopeful]])
                keep = np.lexsort((all_ids, -all_scores))[: self.k]
            self.scores[row], self.ids[row] = all_scores[keep], all_ids[keep]


def _margin(width: int) -> float:
    """Rounding of an inner product of this many components, relative to the product of the norms."""
    return (width + 16) * 2.0**-51


def search(queries: Side, data: Side, best: Best) -> None:
    """Dual-tree search: pairs of nodes by falling bound, pruned against the query node's worst k-th score."""
    query_ids = queries.ids[queries.at[:-1]]
    width = min(queries.points.shape[1], data.points.shape[1])
    q_points, d_points = queries.points[:, :width], data.points[:, :width]
    q_centre, d_centre = queries.centre[:, :width], data.centre[:, :width]
    rounding = _margin(width)

    def bound(q: int, d: int) -> float:
        r, s = queries.radius[q], data.radius[d]
        return float(
            q_centre[q] @ d_centre[d] + queries.norm[q] * s + data.norm[d] * r + r * s
            + rounding * (queries.norm[q] + r) * (data.norm[d] + s)
        )

    stack = [(bound(0, 0), 0, 0)]
    while stack:
        most, q, d = stack.pop()
        rows = slice(queries.first[q], queries.last[q])
        if most < best.worst(rows):
            continue
        below_q, below_d = queries.children[q], data.children[d]
        if not below_d and not below_q:
            place = slice(data.first[d], data.last[d])
            scores = q_points[rows] @ d_points[place].T
            counts = data.counts[place]
            ids = data.ids[data.at[data.first[d]] : data.at[data.last[d]]]
            wide = np.repeat(scores, counts, axis=1)
            wide[query_ids[rows][:, None] == ids[None, :]] = -np.inf
            own = np.arange(queries.first[q], queries.last[q])
            if best.scores.dtype == object:
                point = np.repeat(np.arange(data.first[d], data.last[d]), counts)
                margin = rounding * float(queries.length[rows].max() * data.length[place].max())

                def exactly(row: int, column: int) -> int:
                    return sum(int(x) * int(y) for x, y in zip(q_points[own[row]], d_points[point[column]]))

                best.offer(own, wide, ids, margin, exactly)
            else:
                best.offer(own, wide, ids)
            continue
        if below_d and (not below_q or data.radius[d] >= queries.radius[q]):
            pairs = [(bound(q, child), q, child) for child in below_d]
        else:
            pairs = [(bound(child, d), child, d) for child in below_q]
        stack += sorted(pairs)


# --- Spark ---------------------------------------------------------------------


def integer_vectors(rows: DataFrame, key: str, vector: str, scale: int = 64) -> DataFrame:
    """id, v (floor of scale times each component) of the rows with a whole, finite vector."""
    kept = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    )
    whole = F.transform("v", lambda x: F.floor(x * scale).cast("long"))
    too_large = F.raise_error(F.concat(F.lit("a component of 2^46 or more in vector "), F.col("id").cast("string")))
    return kept.select("id", F.when(F.exists("v", lambda x: F.abs(x) >= F.lit(LARGEST)), too_large).otherwise(whole).alias("v"))


def _folded(vectors: DataFrame, k: int) -> DataFrame:
    """v, ids: equal vectors as one, with its k + 1 smallest ids; Spark cuts each group before the shuffle."""
    order = Window.partitionBy("v").orderBy("id")
    first = vectors.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    return first.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def _padded(vectors: list) -> np.ndarray:
    """One row per vector, zeros behind the shorter ones."""
    if len({len(v) for v in vectors}) < 2:
        return np.array(vectors, np.float64)
    out = np.zeros((len(vectors), max(map(len, vectors))))
    for row, vector in zip(out, vectors):
        row[: len(vector)] = vector
    return out


def _pivots(folded: DataFrame) -> np.ndarray:
    """Far-apart vectors of a bounded sample: the upper level of the cover tree."""
    sample = _padded([r.v for r in folded.orderBy(F.xxhash64("v"), "v").select("v").limit(PIVOT_SAMPLE).collect()])
    if not len(sample):
        return np.zeros((0, 0))
    chosen, away = [0], _distances(sample, sample[0])
    while len(chosen) < PIVOTS and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, _distances(sample, sample[chosen[-1]]))
    return sample[chosen]


def _with_pivot(folded: DataFrame, pivots: np.ndarray) -> DataFrame:
    """v, ids, pivot; the pivots are at most PIVOTS vectors."""
    squares = (pivots**2).sum(axis=1)

    def nearest(source):
        for batch in batches(source):
            points = _padded(batch.column("v").to_pylist())
            width = min(points.shape[1], pivots.shape[1])
            pivot = (squares - 2 * points[:, :width] @ pivots[:, :width].T).argmin(axis=1).astype(np.int32)
            yield records("v ids pivot", batch.column("v"), batch.column("ids"), pivot)

    return folded.mapInArrow(nearest, "v array<long>, ids array<long>, pivot int")


def _index(placed: DataFrame, rows_in_shard: int) -> DataFrame:
    """One row per shard, of one length of vectors. The number of salts of a pivot and length follows its count."""
    placed = placed.withColumn("width", F.size("v"))
    counts = placed.groupBy("pivot", "width").agg(F.count(F.lit(1)).alias("n"))
    salts = F.ceil(F.col("n") / rows_in_shard).cast("long")
    dealt = placed.join(counts, ["pivot", "width"]).withColumn("salt", F.pmod(F.xxhash64("v", F.col("ids")[0]), salts))
    dealt = dealt.withColumn("shard", F.xxhash64("pivot", "width", "salt")).select("shard", "pivot", "v", "ids")

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        points = np.array(frame["v"].tolist(), np.float64)
        return pd.DataFrame([pack(int(frame["shard"].iloc[0]), int(frame["pivot"].iloc[0]), points, frame["ids"].tolist())])

    return dealt.groupBy("shard").applyInPandas(build, SHARD)


def _bounds(groups: DataFrame, shards: DataFrame) -> DataFrame:
    """Upper bound of the scores of each query group with each shard, from centres and radii alone."""
    def packed(side: DataFrame, name: str) -> DataFrame:
        return side.select(F.col("shard").alias(name), F.col("centre").alias(f"{name}_centre"), F.col("radius").alias(f"{name}_radius"))

    def bound(source):
        for batch in batches(source):
            def points(name):
                return _padded([np.frombuffer(x, np.float64) for x in batch.column(name).to_pylist()])

            c, d = points("g_centre"), points("s_centre")
            width = max(c.shape[1], d.shape[1])
            c, d = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (c, d))
            r, s = batch.column("g_radius").to_numpy(), batch.column("s_radius").to_numpy()
            c_norm, d_norm = np.sqrt((c * c).sum(axis=1)), np.sqrt((d * d).sum(axis=1))
            most = (c * d).sum(axis=1) + c_norm * s + d_norm * r + r * s + _margin(width) * (c_norm + r) * (d_norm + s)
            gap = np.sqrt(((c - d) ** 2).sum(axis=1))
            yield records("g s most gap", batch.column("g"), batch.column("s"), most, gap)

    # Every group meets every shard, by centre and radius alone; lanes spread these pairs over tasks.
    lanes = F.explode(F.sequence(F.lit(0), F.lit(LANES - 1)))
    pairs = packed(groups, "g").withColumn("lane", lanes).join(
        packed(shards, "s").withColumn("lane", F.pmod(F.xxhash64("s"), F.lit(LANES)).cast("int")), "lane")
    return pairs.mapInArrow(bound, "g long, s long, most double, gap double")


def _searched(pairs: DataFrame, groups: DataFrame, shards: DataFrame, k: int, score: str) -> DataFrame:
    """query_id, vec_id, score (of the SQL type named): the k best of each query within each pair (g, s, floor)."""
    left = groups.select(F.col("shard").alias("g"), *[F.col(c).alias(f"g_{c}") for c in ("points", "ids", "counts", "tree")])
    right = shards.select(F.col("shard").alias("s"), *[F.col(c).alias(f"s_{c}") for c in ("points", "ids", "counts", "tree")])

    def run(source):
        for batch in batches(source):
            for row in batch.to_pylist():
                queries = Side({c: row[f"g_{c}"] for c in ("points", "ids", "counts", "tree")})
                data = Side({c: row[f"s_{c}"] for c in ("points", "ids", "counts", "tree")})
                best = Best(len(queries.counts), k, exact=queries.length.max() * data.length.max() < EXACT)
                best.scores[:] = row["floor"]
                search(queries, data, best)
                found, column = np.nonzero(best.ids < np.iinfo(np.int64).max)
                scores = [int(x) for x in best.scores[found, column]]
                held = pa.array(scores, pa.int64()) if score == "long" else pa.array(map(Decimal, scores), pa.decimal128(38, 0))
                yield records("query_id vec_id score", queries.ids[queries.at[found]], best.ids[found, column], held)

    return pairs.join(left, "g").join(right, "s").mapInArrow(run, f"query_id long, vec_id long, score {score}")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(rows: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all rows for each row that is_query (a condition on `id`) takes."""
    spark = prepare(rows.sparkSession)
    vectors = integer_vectors(rows, key, vector)
    folded = write_stage(_folded(vectors, k), "folded")
    # No score passes the largest square of a length; beyond a long, scores travel as decimals.
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    largest = folded.agg(F.max(square)).head()[0]
    score = "long" if (largest or 0.0) < 2.0**62 else "decimal(38,0)"
    pivots = _pivots(folded)
    if not len(pivots):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    shards = write_stage(_index(_with_pivot(folded, pivots), SHARD_ROWS), "shards")
    asked = vectors.where(is_query(F.col("id"))).distinct().select("v", F.array("id").alias("ids"))
    groups = write_stage(_index(_with_pivot(asked, pivots), GROUP_ROWS), "groups")
    bounds = write_stage(_bounds(groups, shards), "bounds")
    nearest = Window.partitionBy("g").orderBy("gap", "s")
    first = bounds.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= NEAREST_PIVOTS)
    near = write_stage(_best(_searched(first.select("g", "s", F.lit(float("-inf")).alias("floor")), groups, shards, k, score), k), "near")
    # The worst k-th score of each group; a query with fewer than k so far has none to beat.
    of_query = groups.select(F.col("shard").alias("g"), "ids").mapInArrow(_members, "g long, query_id long")
    # As a double it is rounded down, so that no score equal to it is lost.
    kth_score = F.col("score").cast("double") - F.abs(F.col("score").cast("double")) * 2.0**-50
    kth = of_query.join(near.where(F.col("rank") == k).select("query_id", kth_score.alias("score")), "query_id", "left").groupBy("g").agg(
        F.min(F.coalesce("score", F.lit(float("-inf")))).alias("floor"))
    rest = bounds.join(first.select("g", "s"), ["g", "s"], "left_anti").join(kth, "g").where("most >= floor").select("g", "s", "floor")
    found = _searched(rest, groups, shards, k, score)
    merged = _best(near.drop("rank").unionByName(found), k)
    if score != "long":
        no_long = F.raise_error(F.concat(F.lit("no long holds the score of query "), F.col("query_id").cast("string")))
        fits = F.col("score").between(F.lit(-(2**63)).cast(score), F.lit(2**63 - 1).cast(score))
        merged = merged.withColumn("score", F.when(fits, F.col("score").cast("long")).otherwise(no_long.cast("long")))
    return merged.select("query_id", "rank", "vec_id", "score")


def _members(source):
    for batch in batches(source):
        for shard, ids in zip(batch.column("g").to_pylist(), batch.column("ids").to_pylist()):
            own = np.frombuffer(ids, np.int64)
            yield records("g query_id", np.full(len(own), shard), own)


def op7_cover_tree(embeddings: DataFrame) -> DataFrame:
    return top_k(embeddings, lambda key: F.pmod(key, F.lit(20)) == 0)
