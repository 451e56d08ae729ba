"""Benchmark decontamination with DataFrame functions only.

Texts are lower-case words; a shingle is five words. A window is as many words as
a benchmark item has, aligned with the item on a shingle that both hold. Each
window and each item get a 64-bit SimHash of their shingles, weighted by how often
they occur. Multi-index Hamming search: the 64 bits are cut into five blocks; two
fingerprints within RADIUS = 19 bits differ in at most three bits of some block, so
each item is filed under every block value within three bits (1,811 entries) and each
window looks up its five block values. No pair within the radius is missed. What is
found is confirmed by the exact weighted Jaccard similarity of the shingles,
sum of smaller counts over sum of larger counts, at 0.8 or more.

A window at the limit of 0.8 has about 10 differing bits of 64; in simulations with
random bits 6 to 8 of 10,000 lie beyond 19 and are lost, 1 to 2 at 0.83. Verbatim
passages have none.

Shingles of the benchmark are broadcast only after counting them (at most
BROADCAST_SHINGLES); beyond, Spark shuffles both sides.

Defined cases: null and empty texts hold nothing; an item or document of fewer than
five words has its whole word sequence as its only shingle, met only by documents
of exactly these words. Null ids are kept in results as null. Repeated rows are
found once each per distinct text. Other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from logtrail.llm.common import prepare
from logtrail.llm.licenses import spaced_words
from logtrail.session import write_stage

SIZE = 5
PERCENT = 80
RADIUS = 19
# (first bit, bits) of the blocks; block radius 3, so 5 * 4 - 1 = 19 bits are found for certain.
BLOCKS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]
BLOCK_RADIUS = 3
BROADCAST_SHINGLES = 1_000_000


def words_of(text: Column) -> Column:
    """Lower-case words (letters, digits, non-ASCII)."""
    return F.filter(F.split(spaced_words(text), " "), lambda word: word != "")


def shingles_of(words: Column, size: int = SIZE) -> Column:
    """Hash of each run of `size` words in order; of the whole sequence if it is shorter."""
    whole = F.when(F.size(words) > 0, F.array(F.xxhash64(F.size(words), words))).otherwise(F.array().cast("array<long>"))
    runs = F.transform(
        F.sequence(F.lit(1), F.size(words) - size + 1),
        lambda first: F.xxhash64(*[F.element_at(words, first + k) for k in range(size)]),
    )
    return F.when(F.size(words) >= size, runs).otherwise(whole)


def simhash(shingles: Column) -> Column:
    """64-bit SimHash; every occurrence of a shingle has weight one. A bit is set where most of them have it."""
    def bit(place: Column) -> Column:
        ones = F.aggregate(shingles, F.lit(0), lambda n, h: n + F.getbit(h, place).cast("int"))
        return F.when(2 * ones > F.size(shingles), F.call_function("shiftleft", F.lit(1).cast("long"), place)).otherwise(F.lit(0).cast("long"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda state, place: state.bitwiseOR(bit(place)))


def _block(fingerprint: Column, first: int, bits: int) -> Column:
    return F.shiftrightunsigned(fingerprint, first).bitwiseAND(F.lit((1 << bits) - 1))


def _key(number: int, value: Column) -> Column:
    return value.bitwiseOR(F.lit(number << 16))


def block_keys(fingerprint: Column) -> Column:
    """The five index keys of a fingerprint."""
    return F.array(*[_key(n, _block(fingerprint, first, bits)) for n, (first, bits) in enumerate(BLOCKS)])


def block_neighbours(fingerprint: Column) -> Column:
    """The index keys of every block value within BLOCK_RADIUS bits."""
    def near(number: int, first: int, bits: int) -> Column:
        masks = [sum(1 << place for place in places) for size in range(BLOCK_RADIUS + 1) for places in combinations(range(bits), size)]
        value = _block(fingerprint, first, bits)
        return F.transform(F.array(*[F.lit(mask).cast("long") for mask in masks]), lambda mask: _key(number, value.bitwiseXOR(mask)))

    return F.concat(*[near(number, first, bits) for number, (first, bits) in enumerate(BLOCKS)])


def weighted_similarity(one: Column, two: Column) -> Column:
    """Sum of the smaller counts over sum of the larger counts of the shingles."""
    def count(shingles: Column, x: Column) -> Column:
        return F.size(F.filter(shingles, lambda y: y == x))

    common = F.aggregate(F.array_intersect(one, two), F.lit(0), lambda n, x: n + F.least(count(one, x), count(two, x)))
    return common / (F.size(one) + F.size(two) - common)


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """mark (hash of id and text), doc, text."""
    return docs.select(F.xxhash64(F.col(key), F.col(text)).alias("mark"), F.col(key).alias("doc"), F.col(text).alias("text"))


def _windows(rows: DataFrame, items: DataFrame) -> DataFrame:
    """mark, doc, start, shingles of each window aligned with an item on a shared shingle."""
    aligned = items.select("n", F.posexplode("shingles").alias("offset", "shingle")).distinct()
    known = write_stage(aligned, "aligned")
    if known.count() <= BROADCAST_SHINGLES:
        known = F.broadcast(known)
    words = rows.select("mark", words_of(F.col("text")).alias("words"))
    shingles = words.select("mark", F.size("words").alias("n_doc"), shingles_of(F.col("words")).alias("shingles"))
    # Outer forms: the plain ones make Spark filter on the size of the arrays, and so compute them once more.
    hits = shingles.select("mark", "n_doc", F.posexplode_outer("shingles").alias("place", "shingle")).join(known, "shingle")
    last = F.greatest(F.col("n_doc") - F.col("n"), F.lit(0))
    starts = hits.select("mark", F.struct(F.least(F.greatest(F.col("place") - F.col("offset"), F.lit(0)), last).alias("start"), "n").alias("window")).distinct()
    # A text's own windows: as many as it has words, times the item sizes.
    of_text = starts.groupBy("mark").agg(F.collect_list("window").alias("windows"))
    found = rows.dropDuplicates(["mark"]).join(of_text, "mark").select("mark", "doc", "windows", words_of(F.col("text")).alias("words"))
    found = found.select("mark", "doc", "windows", shingles_of(F.col("words")).alias("all"))
    return found.select("mark", "doc", F.explode_outer(F.transform(
        "windows", lambda w: F.struct(w["start"].alias("start"), w["n"].alias("n"), F.slice("all", w["start"] + 1, F.greatest(w["n"] - (SIZE - 1), F.lit(1))).alias("shingles"))
    )).alias("w")).select("mark", "doc", "w.start", "w.n", "w.shingles")


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """mark, doc, item, start, n_words, hamming, similarity: the best window of each document and item it holds."""
    prepare(docs.sparkSession)
    items = benchmark.select(F.col(item).alias("item"), words_of(F.col(item_text)).alias("words")).where(F.size("words") > 0)
    items = items.select("item", F.size("words").alias("n"), shingles_of(F.col("words")).alias("shingles"))
    items = write_stage(items.withColumn("print", simhash(F.col("shingles"))), "items")
    windows = write_stage(_windows(_rows(docs, key, text), items).withColumn("print", simhash(F.col("shingles"))), "windows")

    index = items.select("item", F.col("print").alias("item_print"), F.explode(block_neighbours(F.col("print"))).alias("key"))
    asked = windows.select("print", F.explode(block_keys(F.col("print"))).alias("key")).distinct()
    hamming = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    near = asked.join(index, "key").withColumn("hamming", hamming).where(F.col("hamming") <= RADIUS).select("print", "item", "hamming").distinct()
    both = windows.join(near, "print").join(items.select("item", F.col("shingles").alias("item_shingles")).where("item IS NOT NULL"), "item")
    sure = both.withColumn("similarity", weighted_similarity(F.col("shingles"), F.col("item_shingles"))).where(F.col("similarity") * 100 >= PERCENT)
    best = sure.groupBy("mark", "item").agg(F.first("doc").alias("doc"), F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n", "hamming")).alias("best"))
    return best.select("mark", "doc", "item", (-F.col("best.back")).alias("start"), F.col("best.n").alias("n_words"), F.col("best.hamming").alias("hamming"), F.col("best.similarity").alias("similarity"))


def without_benchmark(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, all columns as they are, that hold no item."""
    leaks = write_stage(matches(docs, benchmark, key, text).select("mark").distinct(), "leaks")
    return docs.join(leaks, F.xxhash64(docs[key], docs[text]) == leaks["mark"], "left_anti")


def op4_decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every (document, benchmark item) with a window of at least 0.8 weighted similarity."""
    return matches(documents, benchmark).select(
        F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), F.col("start").cast("long").alias("window_start"),
        F.col("n_words").cast("long").alias("n_words"), F.col("hamming").cast("int").alias("hamming"), "similarity",
    )
