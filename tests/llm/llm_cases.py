"""Rows and brute-force versions shared by the tests of the corpus operators."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

SF = "/root/testdata/sf0.001"
# Extra columns carry names that the operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, mark string, score string, key string, node string"
LOWER = {i: i + 32 for i in range(65, 91)}


def rows_of(texts):
    return [(i, t, "en", "s", len(t or ""), "m", "x", "k", "n") for i, t in texts]


def frame(spark, texts):
    return spark.createDataFrame(rows_of(texts), SCHEMA)


def prose(n, seed=0, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def edge_texts():
    """Null and empty texts, null and repeated ids, exact and near copies, shared passages, ties, one long text."""
    base, passage = prose(160, 1), prose(70, 2)
    near = base.split()
    near[40] = "changed"
    return [
        (1, base), (2, base), (3, " ".join(near)), (4, f"{prose(30, 3)} {passage} {prose(20, 4)}"),
        (5, f"{prose(11, 5)} {passage}"), (6, None), (7, ""), (8, "   \n\t "), (9, "one"), (10, "one"), (11, "One Two"),
        (None, base), (None, None), (12, prose(200, 6)), (12, prose(200, 6)), (13, "ab " * 300), (14, "é日本 " * 200),
        (15, prose(9000, 7, 5000)), (16, f"{prose(40, 8)} {prose(9000, 7, 5000)[2000:9000]}"), (17, passage),
    ]


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def cover_brute(texts, length):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in texts]
    first = {}
    for i, w in sorted((x for x in words if x[0] is not None), key=lambda x: x[0]):
        for p in range(len(w) - length + 1):
            first.setdefault(tuple(w[p : p + length]), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        if i is not None:
            for p in range(len(w) - length + 1):
                if first[tuple(w[p : p + length])] < i:
                    gone[p : p + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), sha(kept.encode())))
    return Counter(out)


def suffix_brute(texts, length):
    data = [(i, (t or "").encode()) for i, t in texts]
    seen = Counter(b[p : p + length] for _, b in data for p in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return Counter(out)


def near_brute(texts, size, percent):
    sets = []
    for _, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    head = list(range(len(texts)))

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and texts[a][0] is not None and texts[b][0] is not None:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    head[find(a)] = find(b)
    least = defaultdict(lambda: 1 << 62)
    for a, (i, _) in enumerate(texts):
        if i is not None:
            least[find(a)] = min(least[find(a)], i)
    return Counter((i, len(sets[a]), None if i is None else least[find(a)], i is None or least[find(a)] == i) for a, (i, _) in enumerate(texts))
