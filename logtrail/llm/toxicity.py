"""Toxicity: a convolutional text classifier in numpy.

Words are hashed to embeddings; filters of several widths slide over them, each
filter keeps its maximum over the whole text, and a logistic unit weighs the
maxima. Up to FIT_ROWS labelled rows are learned from on the driver. Of more, a
part of that size only gives the network its start: the known words are counted
over all rows, then every row is learned from ROUNDS times, each task passing over
its rows once a round, and Spark averages the tasks' changes by parameter. Every fifth row is not
learned from: all of these calibrate the output (Platt) and give each language the
threshold with the best F1. Thresholds decide `flagged` only: neither language,
source, id nor label is an input of the score. What reaches the driver has a size
of its own, whatever the number of rows: the start, sums by parameter (at most
KNOWN words), counts of outputs by step and language. The network is broadcast.

Defined cases: an empty, null or wordless text is scored from empty maxima. Rows
without both labels give their share of toxic rows as every score.
Repeated rows are scored one by one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from logtrail.llm.common import batches, bounded_sample, fold, maybe_in, prepare, utf8
from logtrail.session import write_stage

BITS = 20
DIM = 12
WIDTHS = (1, 2, 3)
FILTERS = 12
FIT_ROWS = 14_000
EPOCHS = 6
LOTS = 64
# Beyond FIT_ROWS: times that every row is learned from, the most words with an embedding of
# their own (the most frequent), the width of a step of the output, and the most languages
# (the most frequent) with a threshold of their own.
ROUNDS = 2
KNOWN = 1 << 17
STEP = 0.01
LANGUAGES = 1000
# A bucket met in fewer labelled texts than this shares row 0, the embedding of rare words, which stays 0.
LEAST_TEXTS = 6
RARE = 0
LEAST_LANGUAGE_ROWS = 40
ANY_LANGUAGE = ""
# Words scored at once within a batch.
WORDS_AT_ONCE = 200_000
# Bytes cut into words at once.
BYTES_AT_ONCE = 2_000_000


def _byte_classes() -> np.ndarray:
    """Lower-case letter, digit or non-ASCII byte; 0 for what separates words."""
    table = np.arange(256, dtype=np.uint8)
    keep = np.array([chr(b).isalnum() or b >= 0x80 for b in range(256)])
    upper = (table >= 65) & (table <= 90)
    return np.where(keep, np.where(upper, table + 32, table), 0).astype(np.uint8)


CLASSES = _byte_classes()
LONGEST = 64  # bytes of a word beyond this share one factor
POWERS = np.array([pow(0x100000001B3, k + 1, 1 << 64) for k in range(LONGEST)], np.uint64)


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word of all texts end to end, and the n + 1 bounds between texts."""
    data, bounds = utf8(texts)
    lots, first = [], 0
    while first < len(texts):  # texts in lots of a bounded number of bytes
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + BYTES_AT_ONCE, "right")) - 1)
        lots.append(_words(data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]))
        first = last
    if not lots:
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    return np.concatenate([ids for ids, _ in lots]), np.concatenate([[0], np.cumsum(np.concatenate([np.diff(b) for _, b in lots]))])


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    chars = np.append(CLASSES[data], np.uint8(0))
    inside = chars != 0
    before = np.concatenate([[False], inside[:-1]])
    before[bounds[:-1]] = False
    starts = np.flatnonzero(inside & ~before)
    counts = np.searchsorted(starts, bounds)
    if not len(starts):
        return np.zeros(0, np.int32), counts
    lengths = np.diff(np.append(starts, len(chars)))
    place = np.arange(starts[0], len(chars)) - np.repeat(starts, lengths)
    terms = chars[starts[0]:].astype(np.uint64) * POWERS[np.minimum(place, LONGEST - 1)]
    hashed = np.add.reduceat(terms, starts - starts[0])
    hashed ^= hashed >> np.uint64(29)
    return ((hashed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int32), counts


class Network(NamedTuple):
    rows: np.ndarray  # row of `embedding` for each bucket
    embedding: np.ndarray  # rows x DIM
    filters: list[np.ndarray]  # per width: (width * DIM) x FILTERS
    offsets: np.ndarray  # one per filter
    weights: np.ndarray  # one per filter
    bias: float
    slope: float = 1.0  # calibration: logit = slope * output + shift
    shift: float = 0.0


def frequent(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Buckets met in at least LEAST_TEXTS texts."""
    texts = np.zeros(1 << BITS, np.int32)
    for first, last in zip(bounds[:-1], bounds[1:]):
        texts[np.unique(ids[first:last])] += 1
    return texts >= LEAST_TEXTS


class ToxicityModel(NamedTuple):
    network: Network | None
    share: float
    thresholds: dict[str, float]


def _maxima(net: Network, ids: np.ndarray, bounds: np.ndarray, places: bool = False):
    """Per text and filter the largest output (0 if none is positive), and where it is."""
    n = len(bounds) - 1
    best = np.zeros((n, len(net.offsets)), np.float32)
    where = np.full((n, len(net.offsets)), -1, np.int64)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if not len(full):
        return best, where
    vectors = net.embedding[net.rows[ids]]
    ends = bounds[1:][full] - 1
    for k, (width, kernel) in enumerate(zip(WIDTHS, net.filters)):
        columns = slice(k * FILTERS, (k + 1) * FILTERS)
        out = vectors @ kernel[:DIM]
        for step in range(1, width):
            part = vectors[step:] @ kernel[step * DIM : (step + 1) * DIM]
            # a window does not reach into the next text
            for back in range(step):
                crossing = ends - back - step + 1
                part[crossing[(crossing >= 0) & (crossing < len(part))]] = 0
            out[:-step] += part
        best[full, columns] = np.maximum.reduceat(out, bounds[:-1][full], axis=0)
        if places:
            for row in full:
                where[row, columns] = out[bounds[row] : bounds[row + 1]].argmax(axis=0) + bounds[row]
    best[full] += net.offsets
    return np.maximum(best, 0), where


def _output(net: Network, best: np.ndarray) -> np.ndarray:
    return best @ net.weights + net.bias


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _rows(known: np.ndarray) -> np.ndarray:
    return np.where(known, np.cumsum(known), RARE).astype(np.int32)


def _start(rng: np.random.Generator, known: np.ndarray) -> Network:
    rows = _rows(known)
    embedding = rng.normal(0, 0.1, (int(known.sum()) + 1, DIM)).astype(np.float32)
    embedding[RARE] = 0
    return Network(
        rows,
        embedding,
        [rng.normal(0, (width * DIM) ** -0.5, (width * DIM, FILTERS)).astype(np.float32) for width in WIDTHS],
        np.zeros(len(WIDTHS) * FILTERS, np.float32),
        rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32),
        0.0,
    )


class _Adagrad:
    """Adagrad steps; `at` limits a step to some rows."""

    def __init__(self, rate: float, sums: dict[str, np.ndarray] | None = None):
        self.rate, self.sums = rate, {} if sums is None else sums

    def step(self, name: str, value: np.ndarray, gradient: np.ndarray, at=slice(None)) -> None:
        held = self.sums.setdefault(name, np.full(value.shape, 1e-4, np.float32))
        held[at] += gradient**2
        value[at] -= self.rate * gradient / np.sqrt(held[at])


def train(ids: np.ndarray, bounds: np.ndarray, labels: np.ndarray, seed: int = 7, known: np.ndarray | None = None) -> tuple[Network, _Adagrad]:
    """Fit the network; `known` are the buckets with an embedding, if not those frequent here."""
    rng = np.random.default_rng(seed)
    net = _start(rng, frequent(ids, bounds) if known is None else known)
    steps = _Adagrad(0.06)
    return descend(net, steps, rng, ids, bounds, labels, float(labels.mean()), EPOCHS), steps


def descend(
    net: Network, steps: _Adagrad, rng: np.random.Generator, ids: np.ndarray, bounds: np.ndarray, labels: np.ndarray, share: float, epochs: int
) -> Network:
    """Steps over all texts, `epochs` times; the arrays of `net` change in place. A gradient flows only through the place of each maximum."""
    bias = np.array([net.bias], np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for first in range(0, len(order), LOTS):
            lot = order[first : first + LOTS]
            lengths = bounds[lot + 1] - bounds[lot]
            own_bounds = np.concatenate([[0], np.cumsum(lengths)])
            own = np.concatenate([ids[bounds[i] : bounds[i + 1]] for i in lot])
            best, where = _maxima(net, own, own_bounds, places=True)
            kept = (rng.random(best.shape) > 0.25) / np.float32(0.75)
            error = (_sigmoid((best * kept) @ net.weights + bias[0]) - labels[lot]) / len(lot)
            error *= np.where(labels[lot] > 0, min(4.0, 0.5 / share), 1.0)
            to_best = (error[:, None] * net.weights[None, :] * kept) * (best > 0) * (where >= 0)
            steps.step("weights", net.weights, (best * kept).T @ error + 1e-4 * net.weights)
            steps.step("bias", bias, np.array([error.sum()], np.float32))
            steps.step("offsets", net.offsets, to_best.sum(axis=0))
            rows, columns = np.nonzero(to_best)
            flow = to_best[rows, columns].astype(np.float32)
            at = where[rows, columns]
            touched, changes = [], []
            for k, width in enumerate(WIDTHS):
                mine = (columns >= k * FILTERS) & (columns < (k + 1) * FILTERS)
                gradient = np.zeros_like(net.filters[k])
                for step in range(width):
                    fits = mine & (at + step < own_bounds[rows + 1])
                    words_at = net.rows[own[at[fits] + step]]
                    columns_at = columns[fits] - k * FILTERS
                    part = slice(step * DIM, (step + 1) * DIM)
                    vectors = net.embedding[words_at] * flow[fits, None]
                    block = np.zeros((FILTERS, DIM), np.float32)
                    np.add.at(block, columns_at, vectors)
                    gradient[part] = block.T
                    touched.append(words_at)
                    changes.append(net.filters[k][part].T[columns_at] * flow[fits, None])
                steps.step(f"filters{k}", net.filters[k], gradient)
            if touched:
                words_of, inverse = np.unique(np.concatenate(touched), return_inverse=True)
                summed = np.zeros((len(words_of), DIM), np.float32)
                np.add.at(summed, inverse, np.concatenate(changes))
                summed[words_of == RARE] = 0
                steps.step("embedding", net.embedding, summed, words_of)
    return net._replace(bias=float(bias[0]))


def calibrate(net: Network, output: np.ndarray, labels: np.ndarray, times: np.ndarray | None = None) -> Network:
    """Platt scaling: the logistic fit of label on output, by Newton steps with targets kept off 0 and 1. `times`: how often each row stands."""
    positive, rows = (labels.sum(), len(labels)) if times is None else ((times * labels).sum(), times.sum())
    times = 1.0 if times is None else times
    target = np.where(labels > 0, (positive + 1) / (positive + 2), 1 / (rows - positive + 2))
    x = np.stack([output, np.ones_like(output)], axis=1).astype(np.float64)
    fit = np.array([1.0, 0.0])
    for _ in range(50):
        chance = _sigmoid(x @ fit)
        gradient = x.T @ (times * (chance - target)) + 1e-3 * (fit - [1.0, 0.0])
        curve = (x * (times * chance * (1 - chance))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(curve, gradient)
        fit -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return net._replace(slope=float(max(fit[0], 1e-3)), shift=float(fit[1]))


def best_threshold(scores: np.ndarray, labels: np.ndarray, times: np.ndarray | None = None) -> float:
    """The score from which on calling a text toxic has the best F1; the middle of the gap below it."""
    order = np.argsort(-scores, kind="stable")
    toxic = labels if times is None else times * labels
    called = np.arange(1, len(order) + 1) if times is None else np.cumsum(times[order])
    f1 = 2 * np.cumsum(toxic[order]) / (called + max(toxic.sum(), 1))
    last = np.append(scores[order][1:] < scores[order][:-1], True)
    place = int(np.where(last, f1, -1).argmax())
    below = scores[order][place + 1] if place + 1 < len(order) else 0.0
    return float((scores[order][place] + below) / 2)


def outputs(net: Network, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Output of each text, in lots of a bounded number of words; a longer text makes a lot of its own."""
    out, first, n = [np.zeros(0)], 0, len(bounds) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + WORDS_AT_ONCE, "right")) - 1)
        out.append(_output(net, _maxima(net, ids[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first])[0]))
        first = last
    return np.concatenate(out)


def score_words(model: ToxicityModel, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    if model.network is None:
        return np.full(len(bounds) - 1, model.share)
    return calibrated(model.network, outputs(model.network, ids, bounds))


def calibrated(net: Network, output: np.ndarray) -> np.ndarray:
    return _sigmoid(net.slope * output.astype(np.float64) + net.shift)


def fit(labelled: DataFrame, text: str = "text", label: str = "toxic", lang: str = "lang", key: str = "doc_id", fit_rows: int = FIT_ROWS) -> ToxicityModel:
    """Learn from all labelled rows; up to fit_rows of them at once, more in Spark's tasks.

    The rows are written once, in an order that the ids do not rule, so what joins
    texts and labels runs once and each pass reads its own columns.
    """
    rows = labelled.where(F.col(label).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).cast("int").alias("label"),
        F.coalesce(F.col(lang).cast("string"), F.lit(ANY_LANGUAGE)).alias("lang"),
    )
    rows = write_stage(rows.sortWithinPartitions(F.xxhash64(F.col("key").cast("string"), "text")), "labelled")
    sizes = {row["label"]: row["count"] for row in rows.groupBy("label").count().collect()}
    if sum(sizes.values()) > fit_rows and len(sizes) > 1:
        return fit_spread(rows, sum(y * n for y, n in sizes.items()) / sum(sizes.values()), fit_rows)
    if len(sizes) < 2:
        return ToxicityModel(None, float(next(iter(sizes), 0)), {ANY_LANGUAGE: 0.5})
    found = rows.toArrow().sort_by("key")
    labels = np.array(found["label"].to_pylist(), np.float32)
    ids, bounds = words(found["text"])
    checks = np.arange(len(labels)) % 5 == 4
    if len(set(labels[checks])) < 2 or len(set(labels[~checks])) < 2:
        checks[:] = False
    learn = np.flatnonzero(~checks)
    net, _ = train(*chosen(ids, bounds, learn), labels[learn])
    held = checks if checks.any() else ~checks
    langs = np.array(found["lang"].to_pylist(), object)[held]
    return judged(net, outputs(net, ids, bounds)[held], labels[held], langs, float(labels.mean()))


def chosen(ids: np.ndarray, bounds: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of some texts end to end, and the bounds between them."""
    own = [np.zeros(0, ids.dtype), *[ids[bounds[i] : bounds[i + 1]] for i in texts]]
    return np.concatenate(own), np.concatenate([[0], np.cumsum(np.diff(bounds)[texts])])


def judged(
    net: Network, output: np.ndarray, labels: np.ndarray, langs: np.ndarray, share: float, times: np.ndarray | None = None
) -> ToxicityModel:
    """Calibration and thresholds from the outputs of rows that were not learned from."""
    net = calibrate(net, output, labels, times)
    scores = calibrated(net, output)
    thresholds = {ANY_LANGUAGE: best_threshold(scores, labels, times)}
    for name in sorted(set(langs)):
        mine = langs == name
        own = None if times is None else times[mine]
        if (mine.sum() if own is None else own.sum()) >= LEAST_LANGUAGE_ROWS and len(set(labels[mine])) == 2:
            thresholds[name] = best_threshold(scores[mine], labels[mine], own)
    return ToxicityModel(net, share, thresholds)


# --- more rows than one task learns from ------------------------------------------


def _every_fifth() -> Column:
    return F.pmod(F.xxhash64(F.col("key").cast("string"), F.lit("check")), F.lit(5)) == 4


def fit_spread(rows: DataFrame, share: float, fit_rows: int) -> ToxicityModel:
    """Every row is learned from, or, one in five, calibrates; the labels differ."""
    split = rows.withColumn("held", _every_fifth()).groupBy("held", "label").count().collect()
    both = {held: {row["label"] for row in split if row["held"] == held} for held in (False, True)}
    whole = any(len(labels) < 2 for labels in both.values())  # too few of one label: all rows serve both ends
    learn, check = (rows, rows) if whole else (rows.where(~_every_fifth()), rows.where(_every_fifth()))
    known = np.zeros(1 << BITS, bool)
    known[frequent_words(learn)] = True
    first = bounded_sample(learn, "key", fit_rows).toArrow().sort_by([("key", "ascending"), ("text", "ascending")])
    net, steps = train(*words(first["text"]), np.array(first["label"].to_pylist(), np.float32), known=known)
    for number in range(ROUNDS):
        net = averaged(net, changes_of(learn, net, steps, share, number))
    steps_of = output_steps(check, net).toArrow()
    langs = np.array(steps_of["lang"].to_pylist(), object)
    output = np.array(steps_of["step"].to_pylist(), np.float64) * STEP
    return judged(net, output, np.array(steps_of["label"].to_pylist(), np.float32), langs, share, np.array(steps_of["times"].to_pylist(), np.float64))


def frequent_words(rows: DataFrame) -> np.ndarray:
    """Buckets met in at least LEAST_TEXTS of the texts, the KNOWN most frequent of them."""

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = np.zeros(1 << BITS, np.int64)
        for batch in batches(source):
            ids, bounds = words(batch.column("text"))
            owner = np.repeat(np.arange(len(bounds) - 1, dtype=np.int64), np.diff(bounds))
            texts += np.bincount(np.unique((owner << BITS) | ids) & ((1 << BITS) - 1), minlength=1 << BITS)
        met = np.flatnonzero(texts)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(texts[met])], ["bucket", "texts"])

    counted = rows.select("text").mapInArrow(count, "bucket int, texts long").groupBy("bucket").agg(F.sum("texts").alias("texts"))
    most = counted.where(F.col("texts") >= LEAST_TEXTS).orderBy(F.col("texts").desc(), "bucket").limit(KNOWN)
    return np.array(most.select("bucket").toArrow()["bucket"].to_pylist(), np.int64)


def _tables(net: Network) -> dict[str, np.ndarray]:
    """The parameters as rows of DIM numbers: embeddings, filters, offsets, weights and the bias."""
    last = np.concatenate([net.offsets, net.weights, [net.bias], np.zeros(DIM - 1)]).astype(np.float32)
    return {"embedding": net.embedding, **{f"filters{k}": kernel for k, kernel in enumerate(net.filters)}, "rest": last.reshape(-1, DIM)}


def _network(net: Network, tables: dict[str, np.ndarray]) -> Network:
    rest, many = tables["rest"].reshape(-1), len(net.offsets)
    filters = [tables[f"filters{k}"] for k in range(len(net.filters))]
    return net._replace(embedding=tables["embedding"], filters=filters, offsets=rest[:many].copy(), weights=rest[many : 2 * many].copy(), bias=float(rest[2 * many]))


NUMBERS = [f"d{k}" for k in range(DIM)]


def changes_of(rows: DataFrame, net: Network, steps: _Adagrad, share: float, number: int) -> DataFrame:
    """Mean change of each row of parameters over the tasks that touched it, from one pass over all rows.

    A task learns from its rows batch by batch, from the same network on; its texts are not held.
    """
    shared = rows.sparkSession.sparkContext.broadcast((net, steps.sums))

    def learn(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, sums = shared.value
        own = _network(start, {name: values.copy() for name, values in _tables(start).items()})
        rng = np.random.default_rng([number, TaskContext.get().partitionId()])
        adagrad = _Adagrad(rate, {name: values.copy() for name, values in sums.items()})
        for batch in batches(source):
            ids, bounds = words(batch.column("text"))
            own = descend(own, adagrad, rng, ids, bounds, np.array(batch.column("label").to_pylist(), np.float32), share, 1)
        before = _tables(start)
        for name, values in _tables(own).items():
            moved = (values - before[name]).astype(np.float64)
            touched = np.flatnonzero(moved.any(axis=1))
            columns = [pa.array([name] * len(touched), pa.string()), pa.array(touched.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(moved[touched, k]) for k in range(DIM)]], ["name", "row", *NUMBERS])

    rate = steps.rate
    schema = ", ".join(["name string, row int", *[f"{name} double" for name in NUMBERS]])
    return rows.select("text", "label").mapInArrow(learn, schema).groupBy("name", "row").agg(*[F.avg(name).alias(name) for name in NUMBERS])


def averaged(net: Network, changes: DataFrame) -> Network:
    found = changes.toArrow()
    names, at = np.array(found["name"].to_pylist(), object), np.array(found["row"].to_pylist(), np.int64)
    moved = np.stack([found[name].to_numpy() for name in NUMBERS], axis=1)
    tables = {name: values.copy() for name, values in _tables(net).items()}
    for name, values in tables.items():
        mine = names == name
        values[at[mine]] += moved[mine].astype(np.float32)
    return _network(net, tables)


def output_steps(rows: DataFrame, net: Network) -> DataFrame:
    """step, label, lang, times: how many rows have an output in each step of STEP; outputs beyond 30 count as 30."""
    shared = rows.sparkSession.sparkContext.broadcast(net)

    def place(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            found = np.clip(outputs(shared.value, *words(batch.column("text"))), -30, 30)
            yield pa.RecordBatch.from_arrays([pa.array(np.rint(found / STEP).astype(np.int32)), batch.column("label"), batch.column("lang")], ["step", "label", "lang"])

    placed = rows.select("text", "label", "lang").mapInArrow(place, "step int, label int, lang string")
    counted = write_stage(placed.groupBy("step", "label", "lang").agg(F.count(F.lit(1)).alias("times")), "output-steps")
    most = counted.groupBy(F.col("lang").alias("_lang")).agg(F.sum("times").alias("_n")).orderBy(F.col("_n").desc(), "_lang").limit(LANGUAGES)
    own = F.when(F.col("_lang").isNotNull(), F.col("lang")).otherwise(ANY_LANGUAGE).alias("lang")
    joined = counted.join(most, F.col("lang") == F.col("_lang"), "left").select("step", "label", own, "times")
    return joined.groupBy("step", "label", "lang").agg(F.sum("times").alias("times")).orderBy("step", "label", "lang")


def predict(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """key, score, threshold of the row's language, flagged."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast(model)

    def score(source):
        own = shared.value
        for batch in batches(source):
            scores = score_words(own, *words(batch.column("text")))
            limits = np.array([own.thresholds.get(name, own.thresholds[ANY_LANGUAGE]) for name in batch.column("lang").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(scores, pa.float64()), pa.array(limits, pa.float64()), pa.array(scores >= limits)],
                ["key", "score", "threshold", "flagged"],
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(score, f"key {kind}, score double, threshold double, flagged boolean").withColumnRenamed("key", key)


def is_held_out():
    return F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))


def op1_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents, learned from the two thirds of the labels that are not held out."""
    known = labels.where(~is_held_out()).select("doc_id", "toxic")
    # Texts without a label do not enter the join's shuffle; a hash tells ids apart by type, so only equal types are compared by it.
    alike = documents.schema["doc_id"].dataType == known.schema["doc_id"].dataType
    model = fit((maybe_in(documents, "doc_id", known) if alike else documents).join(known, "doc_id"))
    return predict(documents, model).select(
        "doc_id", is_held_out().alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"), "threshold", "flagged",
    )
