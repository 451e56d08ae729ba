"""Exact search and the corpus pipeline."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from llm_cases import SF, frame, near_brute, prose, sha
from logtrail.llm import bpe, cover_tree, decontaminate, language, queries, surrogates
from pyspark.sql import functions as F


def search_brute(rows, k=20, step=20):
    rows = [(i, np.floor(64 * np.array(v, np.float64)).astype(np.int64)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for i, v in rows:
        if i % step == 0:
            best = sorted((-int(v @ w), j) for j, w in rows if j != i)[:k]
            out |= {(i, rank + 1, j, -s) for rank, (s, j) in enumerate(best)}
    return out


def test_op7_on_the_tables(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert {tuple(r) for r in queries.REGISTRY["op7_cover_tree"](spark, SF).collect()} == search_brute(rows)


@pytest.mark.parametrize("n", [0, 5, 300])
def test_op7_edges(spark, n):
    """Nulls, non-finite components, many equal vectors, fewer rows than k."""
    rng = np.random.default_rng(n)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(n)]
    if n == 300:
        rows += [(1000 + i, [0.5, 0.25, 0.0, 1.0]) for i in range(90)]
        rows += [(None, [1.0, 1.0, 1.0, 1.0]), (2000, None), (2020, [1.0, None, 1.0, 1.0]), (2040, [float("nan")] * 4), (2060, [float("inf"), 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "vec_id long, embedding array<float>, score int, rank string")
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert {tuple(r) for r in cover_tree.op7_cover_tree(df).collect()} == search_brute(rows)


def test_small_shards_and_groups(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "SHARD_ROWS", 16)
    monkeypatch.setattr(cover_tree, "GROUP_ROWS", 4)
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 3)]) for i in range(260)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert {tuple(r) for r in cover_tree.op7_cover_tree(df).collect()} == search_brute(rows)


def exact_brute(rows, k=20, step=20):
    """Python integers throughout; the shorter of two vectors is padded with zeros."""
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    out = set()
    for i, v in whole:
        if i % step == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in whole if j != i)[:k]
            out |= {(i, rank + 1, j, -s) for rank, (s, j) in enumerate(best)}
    return out


@pytest.mark.parametrize("large", [2.0**22 + 1 / 64, 2.0**33, 2.0**41])
def test_op7_scores_beyond_doubles(spark, monkeypatch, large):
    """Large components, several lengths, scores that differ only behind the 53rd bit: no vector is left out, no bit lost."""
    monkeypatch.setattr(cover_tree, "SHARD_ROWS", 32)
    monkeypatch.setattr(cover_tree, "GROUP_ROWS", 4)
    monkeypatch.setattr(cover_tree, "LEAF", 8)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) / 64 for x in rng.integers(-9, 10, 3 + i % 3)]) for i in range(200)]
    for n in range(40):  # one side large: products up to 2^58, a unit apart
        rows.append((300 + n, [0.0, large + n / 64, 1.0 + n // 2 / 64][: 2 + n % 2]))
    if large < 2.0**23:
        rows.append((400, [large, large, 1.0]))
    rows.append((500, [-3.0, 5.0, 1 / 64, 2.0]))
    rows = [(i, v) for i, v in rows if large < 2.0**23 or i not in range(300, 400, 20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in cover_tree.op7_cover_tree(df).collect()} == exact_brute(rows)


def test_op7_ends_where_no_long_holds_a_score(spark):
    for rows, what in (([(0, [2.0**40]), (1, [2.0**40])], "no long holds the score of query 0"), ([(0, [1.0]), (7, [2.0**46])], "in vector 7")):
        with pytest.raises(Exception, match=what):
            cover_tree.op7_cover_tree(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()


def test_trees_cover_their_points():
    points = np.random.default_rng(2).integers(-9, 9, (500, 5)).astype(np.float64)
    tree = cover_tree.Tree(points)
    assert sorted(tree.order) == list(range(500))
    for first, last, centre, radius in zip(tree.first, tree.last, tree.centre, tree.radius):
        assert np.linalg.norm(points[tree.order[first:last]] - points[centre], axis=1).max() <= radius + 1e-9


def test_pipeline_against_stage_by_stage_brute_force(spark):
    """Languages and tokens by their operators in one process, the rest by brute force."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in language.keep_known(docs, language.fit(docs)).collect()]
    kept = {k[0] for k in near_brute(rows, 5, 80) if k[3]}
    rows = [(i, t) for i, t in rows if i in kept]
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    held = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r.text.lower()) for r in bench.collect()]
    leaks = {r.doc_id for r in decontaminate.op4_decontaminate(docs, bench).collect()}
    spaced = {i: " " + " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())) + " " for i, t in rows}
    verbatim = {i for i, t in spaced.items() if any(f" {' '.join(w)} " in t for w in held)}
    assert verbatim <= leaks
    rows = [(i, t) for i, t in rows if i not in leaks]
    import public_tokenizers

    own = bpe.Codec(*(lambda s: (s.tokens, s.model, s.pattern))(bpe.SharedCodec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)))
    expected = Counter()
    for i, t in rows:
        text, _ = surrogates.replaced(t, surrogates.DEMONSTRATION_KEY, {})
        ids = own.encode(text)
        expected[i, len(ids) // 4, sha(ids), sha(text.encode())] += 1
    found = driver.queries()["pipeline"](spark, SF)
    assert Counter(tuple(r) for r in found.collect()) == expected


def test_near_duplicates_are_dropped_by_row(spark):
    """Ids with several texts, rows that repeat, null ids."""
    a, b, c, d, e = (prose(160, 30 + n) for n in range(5))
    near = f"{a} more"
    texts = [
        (1, a), (2, near), (2, b), (3, c), (3, c), (3, c), (4, c), (None, c), (None, d), (None, d), (None, f"{d} more"), (5, e), (5, f"{e} more"),
        (6, ""), (6, ""), (7, ""), (None, None), (8, None), (None, e),
    ]
    found = Counter((r.doc_id, r.text) for r in corpus_pipeline.distinct_texts(spark, frame(spark, texts), SF).collect())
    either = [[(None, d), (None, f"{d} more")], [(5, e), (5, f"{e} more")]]
    for pair in either:
        assert sum(found.pop(row, 0) for row in pair) == 1
    assert found == Counter([(1, a), (2, b), (3, c), (6, ""), (7, ""), (None, None), (8, None)])


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.where(F.lit(False)), SF).count() == 0


def test_all_operators_are_registered():
    names = driver.queries()
    assert {n.split("_")[0] for n in names if re.match(r"op\d+_", n)} == {f"op{n}" for n in range(1, 14)} and "pipeline" in names
