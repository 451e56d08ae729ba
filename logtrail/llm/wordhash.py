"""Words of whole Arrow batches as flat arrays: spans, 64-bit hashes, hashes of word runs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from logtrail.llm.common import utf8

BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)  # A-Z only
LOWER[ord("A") : ord("Z") + 1] += 32
_LONGEST = 256
_POWERS = [
    np.array([pow(base, k + 1, 1 << 64) for k in range(_LONGEST)], np.uint64) for base in (0x100000001B3, 0xD6E8FEB86659FD93)
]
ROLL = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F]


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each word of all texts, and the n + 1 bounds between texts."""
    inside = ~BLANKS[data]
    before = np.concatenate([[False], inside[:-1]])
    before[bounds[:-1][bounds[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.concatenate([inside[1:], [False]])
    after[bounds[1:-1][(bounds[1:-1] > 0)] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(chars: np.ndarray, lengths: np.ndarray, count: int = 2) -> list[np.ndarray]:
    """One or two independent 64-bit hashes of each word, from the words' bytes end to end."""
    if not len(lengths):
        return [np.zeros(0, np.uint64)] * count
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(len(chars)) - np.repeat(firsts, lengths)
    lap = place // _LONGEST if lengths.max() > _LONGEST else None  # of words beyond the table
    place %= _LONGEST
    wide = chars.astype(np.uint64) + np.uint64(1)
    out = []
    for powers in _POWERS[:count]:
        terms = wide * powers[place]
        if lap is not None:
            laps = lap.astype(np.uint64)
            terms *= laps * laps * np.uint64(0x9FB21C651E98DF25) + laps * np.uint64(2) + np.uint64(1)
        out.append(mix(np.add.reduceat(terms, firsts) + lengths.astype(np.uint64)))
    return out


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def run_hashes(words: np.ndarray, count: int, base: int) -> np.ndarray:
    """Hash of `count` words from each place on, for all places where they fit; by doubling."""
    total, done, out, power = len(words) - count + 1, 0, None, base
    if total <= 0:
        return np.zeros(0, np.uint64)
    block, size, rest = words, 1, count
    while rest:
        if rest & 1:
            part = block[done : done + total] if size <= count else block
            factor = np.uint64(pow(base, done, 1 << 64))
            out = part * factor if out is None else out + part * factor
            done += size
        rest >>= 1
        if rest:
            block = block[: len(block) - size] + block[size:] * np.uint64(pow(base, size, 1 << 64))
            size *= 2
    return mix(out)


class Words:
    """The words of one batch of texts."""

    def __init__(self, texts: pa.Array, lower: bool = False, hashes: int = 2):
        self.data, bounds = utf8(texts)
        if lower:
            self.data = LOWER[self.data]
        self.starts, self.ends, self.bounds = word_spans(self.data, bounds)
        self.hashes = word_hashes(self.data[~BLANKS[self.data]], self.ends - self.starts, hashes)

    def count(self, row: int) -> int:
        return int(self.bounds[row + 1] - self.bounds[row])

    def hashes_of(self, row: int) -> list[np.ndarray]:
        part = slice(self.bounds[row], self.bounds[row + 1])
        return [words[part] for words in self.hashes]

    def joined(self, row: int, keep: np.ndarray | None = None) -> bytes:
        """The row's words, or those to keep, joined by one space."""
        part = slice(self.bounds[row], self.bounds[row + 1])
        starts, ends = self.starts[part], self.ends[part]
        if keep is not None:
            starts, ends = starts[keep], ends[keep]
        if not len(starts):
            return b""
        lengths = ends - starts + 1  # with the space behind
        firsts = np.cumsum(lengths) - lengths
        at = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths) + np.repeat(starts, lengths)
        out = self.data[np.minimum(at, len(self.data) - 1)]
        out[firsts + lengths - 1] = 0x20
        return out[:-1].tobytes()

    def identity(self, row: int, which: int = 0) -> int:
        """64-bit hash of the whole word sequence, from the words' hashes of that number."""
        words = self.hashes_of(row)[which]
        return int(run_hashes(words, len(words), ROLL[1 - which]).view(np.int64)[0]) if len(words) else 0


def records(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names.split())
