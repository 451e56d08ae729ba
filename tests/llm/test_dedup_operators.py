"""Substring and near-duplicate operators against brute force, edge cases included."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pytest

from llm_cases import SF, cover_brute, edge_texts, frame, near_brute, prose, sha, suffix_brute
from logtrail.llm import components, cover_dedup, odd_sketch, queries, suffix_dedup


def texts_of(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def digest(df, *columns):
    return Counter((r[0], *[r[c] for c in columns], sha(bytes(r["kept"]))) for r in df.collect())


def test_cover_takes_every_difference():
    cover, n = cover_dedup.COVER, cover_dedup.PERIOD
    assert {(a - b) % n for a in cover for b in cover} == set(range(n))


def test_op10_on_the_tables(spark):
    assert rows(queries.REGISTRY["op10_cover_dedup"](spark, SF)) == cover_brute(texts_of(spark), 50)


def test_op10_edges(spark):
    texts = edge_texts()
    found = cover_dedup.remove_repeats(frame(spark, texts))
    assert digest(found, "n_words", "n_removed") == cover_brute(texts, 50)
    assert cover_dedup.op10_cover_dedup(frame(spark, [])).count() == 0


def test_op10_ids_with_several_texts(spark):
    """A text that repeats a smaller document under an id that carries another text too."""
    a, b, c, d = (prose(60 + n, 20 + n) for n in range(4))
    texts = [(3, a), (5, a), (5, b), (7, b), (8, c), (8, d), (9, c), (9, a), (9, "few words"), (10, d), (10, d), (11, c), (None, a), (12, b), (12, "few words")]
    found = cover_dedup.remove_repeats(frame(spark, texts))
    assert digest(found, "n_words", "n_removed") == cover_brute(texts, 50)


def test_op3_on_the_tables(spark):
    assert rows(queries.REGISTRY["op3_suffix_dedup"](spark, SF)) == suffix_brute(texts_of(spark), 400)


@pytest.mark.parametrize("shard_bytes", [1 << 20, 2000])
def test_op3_edges_and_split_anchors(spark, shard_bytes):
    """Small shards deal one anchor to several, so that they are merged across."""
    line = prose(12, 40)
    texts = edge_texts() + [(100 + i, f"{prose(9, 50 + i)} {line} {prose(9, 90 + i)}") for i in range(40)]
    found = suffix_dedup.remove_repeats(frame(spark, texts), length=60, gram=16, shard_bytes=shard_bytes)
    got = Counter((r[0], r.n_bytes, r.n_removed, len(r.removed), sha(bytes(r.kept))) for r in found.collect())
    assert got == suffix_brute(texts, 60)
    assert suffix_dedup.op3_suffix_dedup(frame(spark, [])).count() == 0


def test_op3_merge_takes_a_hot_string_once_a_shard():
    """5,000 contexts of one anchor hold one string: each shard hands it on once, and only shards that hold it once ask for a verdict."""
    rng = np.random.default_rng(8)
    hot = rng.integers(97, 123, 60, dtype=np.uint8).tobytes()
    own = [rng.integers(97, 123, 12, dtype=np.uint8).tobytes() + hot + rng.integers(97, 123, 12, dtype=np.uint8).tobytes() for _ in range(5001)]
    strings = [[text[at : at + 60] for at in range(25)] for text in own]
    everywhere = Counter(string for each in strings for string in each)
    shards, distinct = [], []
    for number, (low, high) in enumerate(((0, 3000), (3000, 5000), (5000, 5001))):
        frame = pd.DataFrame({"anchor": 1, "context": range(low, high), "n": 1, "ranges": 2, "shard": number, "bytes": own[low:high]})
        shards.append(suffix_dedup._shard(frame, 60))
        distinct.append(Counter(string for each in strings[low:high] for string in each))
    handed = pd.concat(shards)
    decided, handed = handed[handed["keys"].isnull()], handed[handed["keys"].notnull()]
    for number, own_strings in enumerate(distinct):
        ranges = handed[handed["shard"] == number]
        assert sum(map(len, ranges["keys"])) // 8 == len(own_strings)
        asked = sum((np.frombuffer(places, np.int32) >= 0).sum() for places in ranges["places"])
        assert asked == sum(n == 1 for n in own_strings.values())
    merged = pd.concat([suffix_dedup._merge(group) for _, group in handed.groupby("split_range")])
    found = {(context, at) for context, firsts, lasts in pd.concat([decided, merged])[["context", "firsts", "lasts"]].values
             for first, last in zip(firsts, lasts) for at in range(first, last + 1)}
    assert found == {(context, at) for context, each in enumerate(strings) for at, string in enumerate(each) if everywhere[string] > 1}


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(3)
    contexts = [bytes(rng.integers(97, 99, 80, dtype=np.uint8)) for _ in range(6)]
    sizes = np.array([len(c) for c in contexts])
    stops = np.cumsum(sizes)
    text = np.frombuffer(b"".join(contexts), np.uint8)
    own = [text[i : stops[i // 80]].tobytes() for i in range(len(text))]
    order, _ = suffix_dedup.suffix_array(text, np.repeat(stops, sizes), 80)
    assert [own[i] for i in order] == sorted(own)
    common = suffix_dedup.common_prefixes(text, stops - sizes, stops, order, 80)
    for a, b in zip(order, order[1:]):
        assert common[b] == next((k for k, (x, y) in enumerate(zip(own[a], own[b])) if x != y), min(len(own[a]), len(own[b])))


def test_op8_on_the_tables(spark):
    assert rows(queries.REGISTRY["op8_odd_sketch"](spark, SF)) == near_brute(texts_of(spark), 4, 80)


def test_op8_edges(spark):
    texts = edge_texts()
    assert rows(odd_sketch.near_duplicates(frame(spark, texts), size=4)) == near_brute(texts, 4, 80)
    assert odd_sketch.op8_odd_sketch(frame(spark, [])).count() == 0


def test_op8_contested_groups(spark):
    """Copies far from each other in one bucket: leaders do not settle them, blocks do."""
    words = prose(90, 11).split()
    texts = []
    rng = np.random.default_rng(5)
    for i in range(120):
        own = list(words)
        for place in rng.choice(90, int(rng.integers(0, 9)), replace=False):
            own[place] = f"other{rng.integers(1000)}"
        texts.append((i, " ".join(own)))
    assert rows(odd_sketch.near_duplicates(frame(spark, texts), size=4)) == near_brute(texts, 4, 80)


def test_odd_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(1, 1 << 62, 900, dtype=np.uint64)
    sets = [np.unique(base[:800]), np.unique(base[100:900]), np.unique(rng.integers(1, 1 << 62, 800, dtype=np.uint64))]
    sketches = odd_sketch.odd_sketches(odd_sketch.minhashes(sets)).view(np.uint64)
    bits = [int(np.bitwise_count(sketches[0] ^ sketches[k]).sum()) for k in (1, 2)]
    assert bits[0] <= odd_sketch.most_differing_bits() < bits[1]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7)]
    found = {r.node: r.component for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}


def test_op8_boilerplate_makes_no_cluster(spark, monkeypatch):
    """2,000 texts that share a third of their shingles, and some near copies: comparisons stay near linear, no chained cluster."""
    shared = prose(103, 900, 10**6)
    texts = [(i, f"{shared} {prose(100, 1000 + i, 10**6)}") for i in range(2000)]
    texts += [(3000 + i, texts[i][1].replace(" ", " extra ", 1)) for i in range(5)]
    stages = {}

    def spied(df, name):
        stages[name] = write(df, name)
        return stages[name]

    write = odd_sketch.write_stage
    monkeypatch.setattr(odd_sketch, "write_stage", spied)
    found = {r.doc_id: r.component_id for r in odd_sketch.near_duplicates(frame(spark, texts), size=4).collect()}
    assert found == {i: i - 3000 if i >= 3000 else i for i, _ in texts}
    compared = stages["near-blocks"].selectExpr("sum(size(own) * size(own))").head()[0] or 0
    assert compared < 150 * len(texts)
    assert stages["contested-links-blocks"].selectExpr("coalesce(max(size(own)), 0)").head()[0] < 5
