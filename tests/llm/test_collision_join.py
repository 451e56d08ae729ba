"""Near-duplicate vectors against all pairs."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_cases import SF
from logtrail.llm import collision_join, queries

SCHEMA = "vec_id long, embedding array<float>, label int, node string, links long, side int"


def usable(row):
    i, v, label = row
    return i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, least=0.98):
    """n_links and component of each row, and the number of linked pairs."""
    head = list(range(len(rows)))

    def find(x):
        while head[x] != x:
            head[x] = head[head[x]]
            x = head[x]
        return x

    groups, links = defaultdict(list), Counter()
    for at, row in enumerate(rows):
        if usable(row):
            groups[row[2], len(row[1])].append(at)
    for members in groups.values():
        units = np.array([rows[at][1] for at in members], np.float64)
        units /= np.abs(units).max(axis=1, keepdims=True)
        units /= np.linalg.norm(units, axis=1, keepdims=True)
        for x, at in enumerate(members):
            for y in np.flatnonzero(units[:x] @ units[x] >= least - 1e-15):
                links[at] += 1
                links[members[y]] += 1
                head[find(at)] = find(members[y])
    smallest = {}
    for at, row in enumerate(rows):
        if row[0] is not None:
            smallest[find(at)] = min(row[0], smallest.get(find(at), row[0]))
    return Counter((row[0], links[at], smallest.get(find(at)), row[0] is None or smallest[find(at)] == row[0]) for at, row in enumerate(rows))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "n", 1, 0) for r in rows], SCHEMA)


def collected(df):
    return Counter(map(tuple, df.collect()))


def single(v):
    return [float(np.float32(x)) for x in v]


def clustered(seed, clusters, size, width=24, spread=0.05):
    """Clusters whose members lie around the least similarity, chains included."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(clusters):
        centre = rng.normal(size=width)
        centre /= np.linalg.norm(centre)
        for _ in range(size):
            noise = rng.normal(size=width)
            rows.append((len(rows), single((centre + spread * rng.random() * 3 * noise / np.linalg.norm(noise)) * rng.uniform(0.1, 9)), int(c % 3)))
    return rows


def edge_rows():
    base = single(np.random.default_rng(0).normal(size=24))
    return clustered(1, 12, 15) + [
        (None, base, 1), (None, None, None), (900, None, 1), (901, [], 1), (902, [0.0] * 24, 1), (903, base[:-1] + [float("nan")], 1),
        (904, base[:-1] + [float("inf")], 1), (905, base[:-1] + [None], 1), (906, base, None), (907, base, 1), (908, base, 1), (909, base, 2),
        (910, [2 * x for x in base], 1), (911, [-x for x in base], 1), (912, base[:7], 1), (913, base[:7], 1), (907, base, 1), (914, [1e-30] * 24, 0),
        (915, [3e38] * 24, 0),
    ]


def test_op11_on_the_tables(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert collected(queries.REGISTRY["op11_collision_join"](spark, SF)) == brute(rows)


def test_op11_edges(spark):
    assert collected(collision_join.op11_collision_join(frame(spark, edge_rows()))) == brute(edge_rows())
    assert collision_join.op11_collision_join(frame(spark, [])).collect() == []


@pytest.mark.parametrize("size", [8, 40])
def test_many_tables_and_lots(spark, monkeypatch, size):
    """Small cells: several tables, cells of near copies cut into lots, each pair counted once."""
    monkeypatch.setattr(collision_join, "CELL_ROWS", size)
    monkeypatch.setattr(collision_join, "MISS", 1e-7)
    assert collision_join.layout(120, 0.98)[1] > 1
    rows = edge_rows()
    assert collected(collision_join.op11_collision_join(frame(spark, rows))) == brute(rows)


def test_a_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(collision_join, "CELL_ROWS", 100)
    monkeypatch.setattr(collision_join, "MISS", 1e-7)
    rows = clustered(5, 1, 700, spread=0.02) + [(1000 + i, single(np.eye(24)[i % 24]), 0) for i in range(60)]
    assert collected(collision_join.op11_collision_join(frame(spark, rows))) == brute(rows)


def test_recall_at_the_least_similarity():
    """Pairs at exactly the least cosine: the count misses no more than it says, far pairs rarely pass."""
    rng = np.random.default_rng(8)
    a = rng.normal(size=(400, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=(400, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    near = 0.98 * a + np.sqrt(1 - 0.98**2) * b
    found = {(int(x), int(y)) for xs, ys in collision_join.candidate_pairs(a, near, 0.98, False) for x, y in zip(xs, ys)}
    assert sum((i, i) in found for i in range(400)) >= 397
    assert len(found) < 1.1 * 400


def test_calibration():
    gap = collision_join.distance(0.98)
    chance = collision_join.collision_chance(gap, collision_join.WINDOW * gap)
    rng = np.random.default_rng(3)
    hits = rng.binomial(collision_join.PROJECTIONS, chance, 200_000)
    assert (hits < collision_join.count_for(chance)).mean() <= 1.3e-3
    assert (hits < collision_join.count_for(chance) + 1).mean() > 1e-3
    x, y = rng.normal(size=100_000) * 0.2, rng.random(100_000)
    assert abs((np.floor(y) == np.floor(x / 2 + y)).mean() - collision_join.shared_step(0.2)) < 0.01
    depth, tables = collision_join.layout(10**8, 0.98)
    assert (1 - collision_join.shared_step(gap) ** depth) ** tables <= 1e-3 and tables < 40
