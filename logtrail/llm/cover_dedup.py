"""Substring dedup by words with difference-cover anchors.

A window is `length` consecutive words of one text. Its words are removed if the
same word sequence also starts in a document with a smaller id.

Anchors: the positions whose number modulo PERIOD lies in a difference cover.
For any two positions i and j there is a shift below PERIOD that brings both to
cover positions, so two equal windows share an equal sub-window of
length - PERIOD + 1 words at anchors of both. Therefore only anchors are hashed
for the whole corpus, and windows only where an anchor occurs in two documents.
Extension: each window around such an anchor is hashed whole (128 bits), and its
smallest document is found by one aggregation. Hot passages cost one row for
each task and hash, because both aggregations are partial before the shuffle;
joins on hashes are plain joins that Spark can split.

Exact copies are settled first: a text with an equal word sequence in a smaller
document goes as a whole, and only the first copy takes part further on. An id
that carries several texts takes part with all of them.

Defined cases: null and empty texts have no words; of rows that repeat an id all
words count as that document's, and each row is returned; a null id is no
document that others can repeat, and its own rows keep their words. Other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logtrail.llm.common import batches, prepare
from logtrail.llm.wordhash import ROLL, Words, records, run_hashes
from logtrail.session import write_stage

LENGTH = 50
PERIOD = 31
# {1, 5, 11, 24, 25, 27} takes every difference modulo 31.
COVER = (1, 5, 11, 24, 25, 27)


def window_hashes(hashed: list[np.ndarray], length: int) -> list[np.ndarray]:
    """Two independent 64-bit hashes of the window at each word."""
    return [run_hashes(words, length, base) for words, base in zip(hashed, ROLL)]


def anchor_places(n_words: int, length: int) -> np.ndarray:
    """Cover positions whose sub-window lies inside a text of n_words words."""
    places = np.arange(max(0, n_words - (length - PERIOD)))
    return places[np.isin(places % PERIOD, COVER)]


def starts_near(anchors: np.ndarray, n_words: int, length: int) -> np.ndarray:
    """Starts of the windows that hold a sub-window beginning at one of the anchors."""
    change = np.zeros(n_words + 2, np.int64)
    anchors = anchors[anchors < n_words]
    np.add.at(change, np.maximum(anchors - PERIOD + 1, 0), 1)
    np.add.at(change, anchors + 1, -1)
    return np.flatnonzero(np.cumsum(change)[: max(0, n_words - length + 1)] > 0)


def covered(starts: np.ndarray, n_words: int, length: int) -> np.ndarray:
    """For each word whether a window at one of the starts covers it."""
    change = np.zeros(n_words + length + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + length, -1)
    return np.cumsum(change)[:n_words] > 0


def _later_copies(rows: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Documents whose word sequence stands whole in a smaller document; ids with several texts, which are none."""

    def describe(source):
        for batch in batches(source):
            own = Words(batch.column("text"))
            held = [i for i in range(batch.num_rows) if own.count(i) >= length]
            yield records(
                "doc one two", batch.column("doc").take(pa.array(held, pa.int64())),
                *[pa.array([own.identity(i, which) for i in held], pa.int64()) for which in (0, 1)],
            )

    marks = write_stage(rows.mapInArrow(describe, "doc long, one long, two long"), "marks").select("doc", F.struct("one", "two").alias("mark"))
    firsts = marks.groupBy("mark").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    # Written, so that the join stands apart from the aggregation and Spark can split the mark of a text with very many copies.
    firsts = write_stage(firsts.select("mark", "first"), "first-copies")
    of_doc = marks.groupBy("doc").agg(F.min("mark").alias("mark"), F.max("mark").alias("other"))
    copies = of_doc.where("mark = other").join(firsts, "mark").where("doc > first").select("doc")
    return write_stage(copies, "copies"), write_stage(of_doc.where("mark <> other").select("doc"), "several")


def _anchors(rows: DataFrame, length: int) -> DataFrame:
    """hash, identity of the text, doc, place of each anchor. Equal hashes of 48 bits only make candidates."""

    def anchors(source):
        for batch in batches(source):
            own = Words(batch.column("text"), hashes=1)
            docs = batch.column("doc").to_pylist()
            found = [[np.zeros(0, np.int64)] * 4]
            for row in range(batch.num_rows):
                if own.count(row) < length:
                    continue
                hashes = run_hashes(own.hashes_of(row)[0], length - PERIOD + 1, ROLL[0]) >> np.uint64(16)
                places = anchor_places(own.count(row), length)
                found.append([hashes[places].astype(np.int64), np.full(len(places), own.identity(row)), np.full(len(places), docs[row]), places])
            hashes, marks, doc, places = map(np.concatenate, zip(*found))
            yield records("hash mark doc place", hashes, marks, doc, places.astype(np.int32))

    return rows.mapInArrow(anchors, "hash long, mark long, doc long, place int")


def repeated_windows(rows: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """(doc, hashes of its windows that start in a smaller document too), (doc) of later copies; rows: doc, text."""
    if length <= PERIOD:
        raise ValueError(f"windows need more than {PERIOD} words")
    known = rows.where("doc IS NOT NULL")
    copies, several = _later_copies(known, length)
    anchors = _anchors(known, length)
    # One text stands for all its copies, but an id with several texts is no copy: its anchors count for themselves.
    own = anchors.join(several.withColumn("several", F.lit(True)), "doc", "left")
    own = own.select("hash", F.when(F.col("several"), F.xxhash64("mark", "doc")).otherwise(F.col("mark")).alias("mark"))
    shared = own.groupBy("hash").agg(F.min("mark").alias("least"), F.max("mark").alias("most")).where("least < most").select("hash")
    # Written, so that the joins below stand apart from the aggregations and Spark can split hot hashes.
    shared = write_stage(shared, "shared")
    places = anchors.select("hash", "doc", "place").join(shared.hint("shuffle_hash"), "hash", "left_semi")
    # A document's own anchors: as many as it has words at most.
    near = write_stage(places.groupBy("doc").agg(F.collect_set("place").alias("places")).join(copies, "doc", "left_anti"), "near")

    def windows(source):
        for batch in batches(source):
            batch = batch.filter(batch.column("places").is_valid())
            own = Words(batch.column("text"))
            docs_of, lists = batch.column("doc").to_pylist(), batch.column("places")
            found = [[np.zeros(0, np.int64)] * 3]
            for row in range(batch.num_rows):
                starts = starts_near(lists[row].values.to_numpy().astype(np.int64), own.count(row), length)
                if len(starts):
                    one, two = (hashes[starts].view(np.int64) for hashes in window_hashes(own.hashes_of(row), length))
                    found.append([one, two >> 32, np.full(len(starts), docs_of[row])])
            one, two, doc = map(np.concatenate, zip(*found))
            yield records("one two doc", one, two.astype(np.int32), doc)

    # A left join, as in remove_repeats, so that Spark shuffles the texts once for both.
    found = rows.join(near, "doc", "left").mapInArrow(windows, "one long, two int, doc long")
    firsts = found.groupBy("one", "two").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    firsts = write_stage(firsts.select("one", "two", "first"), "firsts")
    later = found.join(firsts.hint("shuffle_hash"), ["one", "two"]).where("doc > first")
    return later.groupBy("doc").agg(F.collect_set("one").alias("windows")), copies


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """key, n_words, n_removed, kept (the words that stay, joined by one space) of each row."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    windows, copies = repeated_windows(rows, length)
    marked = rows.join(windows, "doc", "left").join(copies.withColumn("copy", F.lit(True)), "doc", "left")

    def cut(source):
        for batch in batches(source):
            own = Words(batch.column("text"))
            kept, counts, gone = [], [], []
            for row, (windows, copy) in enumerate(zip(batch.column("windows"), batch.column("copy"))):
                n = own.count(row)
                out = None
                if windows.is_valid:
                    hashes = window_hashes(own.hashes_of(row), length)[0].view(np.int64)
                    out = covered(np.flatnonzero(np.isin(hashes, windows.values.to_numpy())), n, length)
                if copy.is_valid and n >= length:
                    out = np.ones(n, bool)
                counts.append(n)
                gone.append(0 if out is None else int(out.sum()))
                kept.append(own.joined(row, None if out is None else ~out))
            yield records("doc n_words n_removed kept", batch.column("doc"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()))

    return marked.mapInArrow(cut, "doc long, n_words long, n_removed long, kept binary").withColumnRenamed("doc", key)


def op10_cover_dedup(documents: DataFrame) -> DataFrame:
    return remove_repeats(documents).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
