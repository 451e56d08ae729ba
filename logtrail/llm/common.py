"""Shared pieces of the corpus operators: tables, bounded samples, text as flat arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Rows of one Arrow batch: whole texts reach a Python worker in small lots.
BATCH_ROWS = 512
# Words of 64 bits in a bitmap of keys.
BITMAP_WORDS = 1 << 20


def prepare(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's text modulo parts; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def bounded_sample(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most `most` rows, those with the smallest hash of the key.

    Two passes: the first reads only the key and yields one number, so texts
    are read for the chosen rows alone.
    """
    place = F.xxhash64(F.col(key).cast("string"))
    chosen = rows.select(place.alias("place")).orderBy("place").limit(most)
    cut = chosen.agg(F.max("place")).head()[0]
    if cut is None:
        return rows.limit(0)
    return rows.where(place <= F.lit(cut)).limit(most)


def maybe_in(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose key may be among the keys of `wanted`; those that certainly are not go before a join shuffles them.

    The wanted keys set one bit each in a bitmap of BITMAP_WORDS words, which is
    broadcast: at most that many pairs of numbers, however many keys there are.
    """
    place = F.xxhash64(key)
    word = F.pmod(F.shiftright(place, 6), F.lit(BITMAP_WORDS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63).cast("long")).cast("int"))
    bitmap = wanted.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    marked = rows.withColumns({"_word": word, "_bit": bit}).join(F.broadcast(bitmap), "_word")
    return marked.where(F.col("_bits").bitwiseAND(F.col("_bit")) != 0).select(*rows.columns)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes end to end and the n + 1 bounds between them; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    first = int(bounds[0]) if len(bounds) else 0
    return data[first : int(bounds[-1]) if len(bounds) else 0], (bounds - first)


def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (batch for batch in source if batch.num_rows)
