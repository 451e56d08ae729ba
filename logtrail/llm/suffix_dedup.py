"""Removal of byte strings of LENGTH that start more than once, by suffix arrays.

A byte goes if a string of LENGTH bytes that covers it also starts anywhere else
in the corpus; strings stay inside one text and are judged on the input.

Routing. Each start of a string belongs to the run of its anchor: the smallest hash
among the GRAM-byte grams inside the string. Equal strings have equal anchors at
equal places, so only anchors met at least twice can hold a repeat, and all starts
of equal strings lie in runs of one anchor. The text of a run (its starts and
LENGTH - 1 bytes more) is a context; equal contexts of an anchor are one context
with a count, so a group of copies is one entry however large it is.

Shards. Contexts are dealt to shards of about SHARD_BYTES by anchor. A shard builds
the suffix array of its contexts by Larsson-Sadakane refinement (groups of equal
prefixes are split by the rank of what follows, doubling the depth up to the
longest context), and Kasai's rule gives the common prefix of each suffix with its neighbour, all
contexts side by side. A start is repeated if a neighbour shares LENGTH bytes, or
if its context stands more than once.

Cross-shard merging. An anchor with more contexts than a shard holds is dealt to
several shards. These hand on each distinct string once, as a 64-bit key, in order
and cut into ranges by binary search; each range is merged by binary search of
every shard's keys among those of all. A string that a shard holds several times
is decided there and handed on without its places, so the hottest string is one
entry of each shard.

Defined cases: null and empty texts have no bytes; texts shorter than LENGTH lose
nothing. Rows that repeat, with or without an id, are separate occurrences. Other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logtrail.llm.common import batches, prepare, utf8
from logtrail.llm.wordhash import mix, records
from logtrail.session import write_stage

LENGTH = 400
GRAM = 64
SHARD_BYTES = 1 << 20
RANGE_KEYS = 1 << 16
# Bytes hashed at once; a longer text is taken in pieces that overlap.
PIECE = 1 << 20
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_GRAM_BASE, _TEXT_BASE = 0x100000001B3, 0xD6E8FEB86659FD93


class Prefixes:
    """Hashes of any stretch of a byte array in one step, from prefix sums modulo 2^64."""

    def __init__(self, data: np.ndarray, base: int):
        powers = np.full(len(data) + 1, base, np.uint64)
        inverse = np.full(len(data) + 1, pow(base, -1, 1 << 64), np.uint64)
        powers[0] = inverse[0] = 1
        self.inverse = np.cumprod(inverse)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTES[data] * np.cumprod(powers)[:-1])])

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mix((self.sums[stops] - self.sums[starts]) * self.inverse[starts] + (stops - starts).astype(np.uint64))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each stretch of `width`, by block prefixes and suffixes."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def runs(data: np.ndarray, bounds: np.ndarray, length: int, gram: int):
    """anchor hash, context hash, text number, first start, last start (within the text) of each run."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none
    grams = Prefixes(data, _GRAM_BASE)
    at = np.arange(len(data) - gram + 1)
    hashes = grams.of(at, at + gram)
    # The place in the low bits makes the leftmost of equal grams the least.
    ranked = (hashes & ~np.uint64((1 << 22) - 1)) | at.astype(np.uint64)
    anchors = (sliding_least(ranked, length - gram + 1) & np.uint64((1 << 22) - 1)).astype(np.int64)
    starts = np.arange(len(anchors))
    owner = np.searchsorted(bounds, starts, "right") - 1
    whole = starts + length <= bounds[owner + 1]
    new = np.ones(len(starts), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1])
    firsts = np.flatnonzero(new & whole)
    ends = np.flatnonzero(whole & np.append(new[1:] | ~whole[1:], True))
    texts = Prefixes(data, _TEXT_BASE).of(firsts, ends + length)
    base = bounds[owner[firsts]]
    return hashes[anchors[firsts]].view(np.int64), texts.view(np.int64), owner[firsts], firsts - base, ends - base


def pieces(data: np.ndarray, bounds: np.ndarray, length: int):
    """(data, bounds, number of the first text, offset in it) of lots of at most about PIECE bytes."""
    first = 0
    while first < len(bounds) - 1:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + PIECE, "right")) - 1)
        low, high = int(bounds[first]), int(bounds[last])
        if high - low <= 2 * PIECE:
            yield data[low:high], bounds[first : last + 1] - low, first, 0
        else:
            for offset in range(0, high - low, PIECE):
                part = data[low + offset : min(high, low + offset + PIECE + length - 1)]
                yield part, np.array([0, len(part)]), first, offset
        first = last


def _runs(rows: DataFrame, length: int, gram: int) -> DataFrame:
    def find(source):
        for batch in batches(source):
            data, bounds = utf8(batch.column("text"))
            marks = batch.column("mark").to_numpy()
            for part, own, first, offset in pieces(data, bounds, length):
                anchors, texts, owner, start, last = runs(part, own, length, gram)
                yield records("anchor context mark start last", anchors, texts, marks[first + owner], start + offset, last + offset)

    return rows.mapInArrow(find, "anchor long, context long, mark long, start long, last long")


# --- one shard --------------------------------------------------------------------


def suffix_array(text: np.ndarray, stops: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first `depth` bytes (what lies behind stops[i] counts as lowest), and their ranks.

    Larsson-Sadakane: a rank is the last place of the group of equal prefixes;
    groups of one are done, the others are split by the rank `size` further on.
    """
    n = len(text)
    at = np.arange(n)
    ahead = np.lib.stride_tricks.sliding_window_view(np.concatenate([text, np.zeros(8, np.uint8)]), 8)[:n]
    keys = np.ascontiguousarray(ahead).view(">u8").ravel().astype(np.uint64)
    # Seven bytes, none from behind the stop, and how many of them are inside.
    inside = np.minimum(stops - at, 7).astype(np.uint64)
    keys &= ~np.uint64(0) << (np.uint64(64) - np.uint64(8) * inside)
    keys |= inside
    order = np.argsort(keys)
    sorted_keys = keys[order]
    ends = np.append(sorted_keys[1:] != sorted_keys[:-1], True)
    rank = np.empty(n, np.int64)
    last = _last_place(ends)
    rank[order] = last
    size = 7
    while size < depth:
        single = ends & np.concatenate([[True], ends[:-1]])
        places = np.flatnonzero(~single)
        if not len(places):
            break
        own = order[places]
        follow = own + size
        beyond = np.where(follow < stops[own], rank[np.minimum(follow, n - 1)] + 1, 0)
        by = np.argsort((rank[own].astype(np.uint64) << np.uint64(32)) | beyond.astype(np.uint64))
        own, group, beyond = own[by], rank[own][by], beyond[by]
        order[places] = own
        cut = np.append((group[1:] != group[:-1]) | (beyond[1:] != beyond[:-1]), True)
        ends[places] = cut
        last = _last_place(ends)
        rank[own] = last[places]
        size *= 2
    # Kasai's rule needs equal suffixes in order of their places.
    places = np.flatnonzero(~(ends & np.concatenate([[True], ends[:-1]])))
    own = order[places]
    order[places] = own[np.argsort((rank[own].astype(np.uint64) << np.uint64(32)) | own.astype(np.uint64))]
    return order, rank


def _last_place(ends: np.ndarray) -> np.ndarray:
    """For each place the last place of its group."""
    stops = np.flatnonzero(ends)
    return np.repeat(stops, np.diff(np.concatenate([[-1], stops])))


def common_prefixes(text: np.ndarray, firsts: np.ndarray, stops: np.ndarray, order: np.ndarray, most: int, least: int = 1) -> np.ndarray:
    """Common prefix (at most `most`) of each suffix of at least `least` bytes with the one before it in order.

    Kasai: the prefix of suffix i + 1 is at least that of i, less one. All
    contexts go forward side by side, each from its own first suffix.
    """
    n = len(text)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    stop_of = np.repeat(stops, stops - firsts)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    out = np.zeros(n, np.int64)
    lanes, held = np.argsort(firsts - stops, kind="stable"), np.zeros(len(firsts), np.int64)
    lengths = (stops - firsts)[lanes]
    for step in range(max(0, int(lengths[0]) - least + 1) if len(lengths) else 0):
        live = lanes[: np.searchsorted(-lengths, -(step + least - 1), "left")]
        here = firsts[live] + step
        other = before[here]
        known = np.maximum(held[live] - 1, 0)
        limit = np.where(other < 0, 0, np.minimum(np.minimum(stops[live] - here, stop_of[np.maximum(other, 0)] - other), most))
        known = np.minimum(known, limit)
        active = np.flatnonzero(known < limit)
        while len(active):
            same = words[here[active] + known[active]] == words[other[active] + known[active]]
            alike = np.where(same.all(axis=1), 8, same.argmin(axis=1))
            known[active] = np.minimum(known[active] + alike, limit[active])
            active = active[(alike == 8) & (known[active] < limit[active])]
        held[live] = known
        out[here] = known
    return out


def repeated_starts(contexts: list[bytes], counts: np.ndarray, length: int) -> list[np.ndarray]:
    """For each context, which of its starts begin a string that occurs again."""
    sizes = np.array([len(c) for c in contexts])
    stops = np.cumsum(sizes)
    firsts = stops - sizes
    text = np.frombuffer(b"".join(contexts), np.uint8)
    order, _ = suffix_array(text, np.repeat(stops, sizes), int(sizes.max()))
    shared = common_prefixes(text, firsts, stops, order, length, least=length) >= length
    again = shared.copy()
    places = np.flatnonzero(shared[order])
    again[order[places - 1]] = True
    again |= np.repeat(counts > 1, sizes)
    return [again[a : a + max(0, size - length + 1)] for a, size in zip(firsts, sizes)]


def stretches(flags: np.ndarray) -> tuple[list[int], list[int]]:
    """First and last place of each run of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2].tolist(), (edges[1::2] - 1).tolist()


_FOUND = "anchor long, context long, firsts array<int>, lasts array<int>, split_range int, shard long, keys binary, contexts binary, places binary"


def _shard(frame: pd.DataFrame, length: int) -> pd.DataFrame:
    contexts = frame["bytes"].tolist()
    again = repeated_starts(contexts, frame["n"].to_numpy(), length)
    out = []
    for anchor, context, flags in zip(frame["anchor"], frame["context"], again):
        if flags.any():
            firsts, lasts = stretches(flags)
            out.append((anchor, context, firsts, lasts, None, None, None, None, None))
    split = frame[frame["ranges"] > 0]
    for anchor, own in split.groupby("anchor"):
        keys, ids, places = [], [], []
        for context, n, text in zip(own["context"], own["n"], own["bytes"]):
            data = np.frombuffer(text, np.uint8)
            at = np.arange(len(data) - length + 1)
            keys.append(Prefixes(data, _TEXT_BASE).of(at, at + length))
            ids.append(np.full(len(at), context))
            places.append(at if n == 1 else np.full(len(at), -1))
        keys, first, n = np.unique(np.concatenate(keys), return_index=True, return_counts=True)
        ids = np.concatenate(ids)[first]
        places = np.where(n == 1, np.concatenate(places)[first], -1).astype(np.int32)
        ranges = int(own["ranges"].iloc[0])
        borders = [-(-(k << 64) // ranges) for k in range(ranges)]
        cuts = [*np.searchsorted(keys, np.array(borders, np.uint64)), len(keys)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if b > a:
                out.append((anchor, None, None, None, k, int(own["shard"].iloc[0]), keys[a:b].tobytes(), ids[a:b].tobytes(), places[a:b].tobytes()))
    return pd.DataFrame(out, columns=[part.split()[0] for part in _FOUND.split(", ")], dtype=object)


def _merge(frame: pd.DataFrame) -> pd.DataFrame:
    """Starts of one anchor and key range whose key stands in another shard too and that no shard has decided."""
    keys = [np.frombuffer(k, np.uint64) for k in frame["keys"]]
    everything = np.sort(np.concatenate(keys), kind="stable")
    out = []
    for own, ids, places in zip(keys, frame["contexts"], frame["places"]):
        ids, places = np.frombuffer(ids, np.int64), np.frombuffer(places, np.int32)
        elsewhere = np.searchsorted(everything, own, "right") - np.searchsorted(everything, own, "left") > 1
        again = np.flatnonzero(elsewhere & (places >= 0))
        again = again[np.lexsort((places[again], ids[again]))]
        contexts, at = ids[again], places[again]
        cuts = np.flatnonzero(contexts[1:] != contexts[:-1]) + 1
        for context, starts in zip(contexts[np.append(0, cuts)] if len(at) else (), np.split(at, cuts)):
            out.append((int(frame["anchor"].iloc[0]), int(context), starts.tolist(), starts.tolist()))
    return pd.DataFrame(out, columns=["anchor", "context", "firsts", "lasts"], dtype=object)


# --- Spark ------------------------------------------------------------------------


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """mark, spans (first and last start of repeated strings) for rows (mark, text)."""
    found = _runs(docs, length, gram)
    often = write_stage(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "anchors")
    places = write_stage(found.join(often.hint("shuffle_hash"), "anchor", "left_semi"), "runs")
    contexts = places.groupBy("anchor", "context").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("mark", "start", "last")).alias("at")
    )
    contexts = write_stage(contexts.select("anchor", "context", "n", "at.*"), "contexts")
    size = F.sum(F.col("last") - F.col("start") + length)
    total = contexts.agg(size.alias("bytes")).head()["bytes"] or 0
    shards = max(1, -(-total // shard_bytes))
    of_anchor = contexts.groupBy("anchor").agg(size.alias("bytes"), F.sum(F.col("last") - F.col("start") + 1).alias("starts"))
    large = write_stage(of_anchor.where(F.col("bytes") > shard_bytes).select(
        "anchor", F.ceil(F.col("bytes") / shard_bytes).alias("salts"), F.ceil(F.col("starts") / RANGE_KEYS).cast("int").alias("ranges")), "large")
    dealt = contexts.join(large, "anchor", "left").withColumn("salt", F.pmod("context", F.coalesce("salts", F.lit(1))))
    wanted = dealt.groupBy("mark").agg(F.collect_list(F.struct(
        "anchor", "context", "n", "start", "last", F.coalesce("ranges", F.lit(0)).alias("ranges"),
        F.pmod(F.xxhash64("anchor", "salt"), F.lit(shards)).alias("shard"),
    )).alias("wanted"))

    def fetch(source):
        for batch in batches(source):
            batch = batch.filter(batch.column("wanted").is_valid())
            data, bounds = utf8(batch.column("text"))
            columns = {name: [] for name in ("shard", "anchor", "context", "n", "ranges", "bytes")}
            for low, wishes in zip(bounds[:-1], batch.column("wanted").to_pylist()):
                for wish in wishes:
                    for name in ("shard", "anchor", "context", "n", "ranges"):
                        columns[name].append(wish[name])
                    columns["bytes"].append(data[low + wish["start"] : low + wish["last"] + length].tobytes())
            yield records(" ".join(columns), *[pa.array(v, k) for v, k in zip(columns.values(), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))])

    texts = docs.join(wanted, "mark", "left").mapInArrow(fetch, "shard long, anchor long, context long, n long, ranges int, bytes binary")
    out = write_stage(texts.groupBy("shard").applyInPandas(lambda frame: _shard(frame, length), _FOUND), "shards")
    across = out.where("keys IS NOT NULL").groupBy("anchor", "split_range").applyInPandas(
        _merge, "anchor long, context long, firsts array<int>, lasts array<int>")
    verdicts = out.where("keys IS NULL").select("anchor", "context", "firsts", "lasts").union(across)
    verdicts = write_stage(verdicts, "verdicts")
    hit = places.join(verdicts, ["anchor", "context"]).select("mark", "start", F.explode(F.arrays_zip("firsts", "lasts")).alias("part"))
    # A text's own spans: fewer than it has bytes.
    return hit.groupBy("mark").agg(F.collect_set(F.struct(
        (F.col("start") + F.col("part.firsts")).alias("first"), (F.col("start") + F.col("part.lasts")).alias("last"))).alias("spans"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """key, n_bytes, n_removed, removed (first byte and end of each removed run), kept (bytes) of each row."""
    prepare(docs.sparkSession)
    rows = docs.select(F.xxhash64(F.col(key), F.col(text)).alias("mark"), F.col(text).alias("text"), F.col(key).alias("key"))
    marked = rows.select("mark", "text", "key")
    spans = repeated_spans(rows.select("mark", "text", "key"), length, gram, shard_bytes)

    def cut(source):
        for batch in batches(source):
            data, bounds = utf8(batch.column("text"))
            sizes, gone, removed, kept = [], [], [], []
            for low, high, spans in zip(bounds[:-1], bounds[1:], batch.column("spans").to_pylist()):
                own = data[low:high]
                change = np.zeros(len(own) + 1, np.int64)
                for span in spans or ():
                    change[span["first"]] += 1
                    change[span["last"] + length] -= 1
                out = np.cumsum(change)[:-1] > 0
                firsts, lasts = stretches(out)
                sizes.append(len(own))
                gone.append(int(out.sum()))
                removed.append([{"first": a, "stop": b + 1} for a, b in zip(firsts, lasts)])
                kept.append(own[~out].tobytes())
            kind = pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))
            yield records("key n_bytes n_removed removed kept", batch.column("key"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary()))

    kind = rows.schema["key"].dataType.simpleString()
    out = marked.join(spans, "mark", "left").mapInArrow(cut, f"key {kind}, n_bytes long, n_removed long, removed array<struct<first:long,stop:long>>, kept binary")
    return out.withColumnRenamed("key", key)


def op3_suffix_dedup(documents: DataFrame) -> DataFrame:
    return remove_repeats(documents).select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
