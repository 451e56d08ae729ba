"""Language identification: multinomial naive Bayes over hashed character n-grams.

The n-gram counts of each language are summed by Spark over a bounded sample of
labelled texts. The log-probability matrix (languages x buckets) is broadcast,
and every batch of texts is scored in numpy: one gather and one segmented sum
per language and n-gram length.

Defined cases: a null text, an empty text or one without a letter is `und` with
score 0. Without any labelled text every document is `und`. Ties go to the
language that sorts first. Repeated rows are scored one by one; other columns
are ignored.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logtrail.llm.common import batches, bounded_sample, fold, prepare, utf8

UNKNOWN = "und"
ORDERS = 4
BITS = 16
# Bucket of what counts for no language: n-grams of blanks, or across two texts.
NOTHING = 1 << BITS
FIT_ROWS = 6000
BLANK = 32


class LanguageModel(NamedTuple):
    labels: list[str]
    prior: np.ndarray  # log share of each label
    weights: np.ndarray  # label x (buckets + 1), log probabilities

    def empty(self) -> bool:
        return not self.labels


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """Lower-case code point of each letter, a blank for everything else."""
    table = np.full(0x110000, BLANK, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            lower = char.lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    return table


def letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Letters (else blanks) of all texts end to end, and the bounds between texts."""
    data, bounds = utf8(texts)
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    opens = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
    return letter_table()[codes], opens[bounds]


def ngram_buckets(codes: np.ndarray, ends: np.ndarray):
    """Bucket of the n-gram at each place, for each length in turn."""
    total = len(codes)
    rolled = np.zeros(total, np.uint32)
    blanks = 0
    for n in range(1, ORDERS + 1):
        rolled = rolled * np.uint32(0x01000193)
        blanks = (blanks * 0x01000193 + BLANK) & 0xFFFFFFFF
        if total >= n:
            rolled[: total - n + 1] += codes[n - 1 :]
        buckets = _mix(rolled, n)
        buckets[buckets == int(_mix(np.array([blanks], np.uint32), n)[0])] = NOTHING
        for back in range(1, n):
            across = ends - back
            buckets[across[across >= 0]] = NOTHING
        yield buckets


def _mix(rolled: np.ndarray, n: int) -> np.ndarray:
    mixed = (rolled ^ np.uint32(0x9E3779B9 * n & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
    mixed ^= mixed >> np.uint32(15)
    return ((mixed * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS)).astype(np.int32)


def fit(labelled: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", fit_rows: int = FIT_ROWS) -> LanguageModel:
    """Learn from at most fit_rows rows that have a label."""
    prepare(labelled.sparkSession)
    rows = labelled.where(F.col(label).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).cast("string").alias("label")
    )
    sample = bounded_sample(rows, "key", fit_rows)

    def count(source):
        sums: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        for batch in batches(source):
            labels = np.array(batch.column("label").to_pylist(), object)
            for name in set(labels):
                codes, bounds = letters(batch.column("text").filter(pa.array(labels == name)))
                held = sums.setdefault(name, np.zeros(NOTHING + 1, np.int64))
                texts[name] = texts.get(name, 0) + int((labels == name).sum())
                for buckets in ngram_buckets(codes, bounds[1:]):
                    held += np.bincount(buckets, minlength=NOTHING + 1)
        for name, held in sums.items():
            at = np.flatnonzero(held[:NOTHING])
            yield pa.RecordBatch.from_pydict({
                "label": [name] * (len(at) + 1),
                "bucket": np.append(at, -1).astype(np.int32),
                "n": np.append(held[at], texts[name]).astype(np.int64),
            })

    counts = sample.mapInArrow(count, "label string, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    found = counts.toPandas()  # at most languages x (buckets + 1) rows
    names = sorted(found["label"].unique())
    sums = np.zeros((len(names), NOTHING), np.float64)
    seen = np.ones(len(names))
    for place, name in enumerate(names):
        own = found[found["label"] == name]
        seen[place] = own.loc[own["bucket"] < 0, "n"].sum()
        own = own[own["bucket"] >= 0]
        sums[place, own["bucket"].to_numpy()] = own["n"].to_numpy()
    smooth = sums + 0.5
    weights = np.zeros((len(names), NOTHING + 1))
    weights[:, :NOTHING] = np.log(smooth / smooth.sum(axis=1, keepdims=True)) if names else 0
    return LanguageModel(names, np.log(seen / seen.sum()) if names else seen, weights)


def score_texts(model: LanguageModel, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Label and its posterior probability for each text."""
    predicted, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if not len(texts) or model.empty():
        return predicted, scores
    codes, bounds = letters(texts)
    starts, ends = bounds[:-1], bounds[1:]
    full = np.flatnonzero(ends > starts)
    if not len(full):
        return predicted, scores
    total = np.zeros((len(full), len(model.labels))) + model.prior
    for buckets in ngram_buckets(codes, ends):
        for place, weights in enumerate(model.weights):
            total[:, place] += np.add.reduceat(weights[buckets], starts[full])
    with_letter = np.add.reduceat(codes != BLANK, starts[full], dtype=np.int64) > 0
    best = total.argmax(axis=1)
    posterior = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    for row, label, sure, known in zip(full, best, posterior, with_letter):
        if known:
            predicted[row], scores[row] = model.labels[label], sure
    return predicted, scores


def predict(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred, score for each row."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast(model)

    def score(source):
        for batch in batches(source):
            labels, scores = score_texts(shared.value, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                ["key", "lang_pred", "score"],
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(score, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)


def keep_known(docs: DataFrame, model: LanguageModel, text: str = "text", least: float = 0.0) -> DataFrame:
    """The rows, all columns as they are, whose text is in a learned language with at least that score.

    Where no language was learned (no labelled row), nothing can be rejected: all rows stay.
    """
    if model.empty():
        return docs
    shared = prepare(docs.sparkSession).sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def keep(source):
        for batch in batches(source):
            labels, scores = score_texts(shared.value, batch.column(place))
            known = np.array([label != UNKNOWN for label in labels]) & (scores >= least)
            yield batch.filter(pa.array(known))

    return docs.mapInArrow(keep, docs.schema)


def is_held_out():
    return F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))


def op6_language_id(documents: DataFrame) -> DataFrame:
    """Languages of all documents, learned from the three quarters that are not held out."""
    model = fit(documents.where(~is_held_out()))
    found = predict(documents, model)
    return found.select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score")
