"""From raw documents to token ids: language, near duplicates, benchmark leaks, personal data, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from logtrail.llm import bpe, decontaminate, language, odd_sketch, surrogates
from logtrail.llm.common import prepare, table
from logtrail.session import configure, write_stage

# No SQL: the first stage is a trained model, the fourth a keyed cipher, the last a tokenizer.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; texts without a letter go."""
    return language.keep_known(docs, language.fit(docs))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates; five words, 0.8.

    Rows are known by id and text, so of an id with several texts only those go
    that repeat. The row with the smallest id stays, one without an id only if no
    other has one; rows that repeat id and text are one, the smallest by its other columns.
    Texts without words are near nothing.
    """
    mark = "row_mark"
    while mark in docs.columns:
        mark += "_"
    marked = docs.withColumn(mark, F.xxhash64("doc_id", "text"))
    rows = write_stage(marked.groupBy(F.col(mark).alias("mark")).agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("n")), "rows")
    groups = odd_sketch.near_duplicates(marked.select(F.col(mark).alias("mark"), "text"), key="mark", size=5, percent=80)
    groups = write_stage(groups.select("mark", "component_id").distinct().join(rows, "mark"), "groups")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark"))
    kept = groups.groupBy("component_id").agg(first.alias("first")).select(F.col("first.mark").alias("mark"))
    dropped = write_stage(rows.join(kept, "mark", "left_anti").select(F.col("mark").alias(mark)), "dropped")
    left = marked.join(dropped, mark, "left_anti")
    again = write_stage(rows.where("n > 1").select(F.col("mark").alias(mark)), "again")
    if not again.limit(1).count():
        return left.select(docs.columns)
    once = left.join(again, mark, "left_semi").groupBy(mark).agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return left.join(again, mark, "left_anti").select(docs.columns).union(once)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with surrogates in place of personal data; n_chars follows the text."""
    return surrogates.replace_in(docs, surrogates.DEMONSTRATION_KEY).withColumn("n_chars", F.length("text").cast("long"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number and digests of the token ids and of the decoded text."""
    return bpe.op9_byte_bpe(docs)


STAGES = [
    ("language ID", known_language),
    ("near duplicates", distinct_texts),
    ("benchmark decontamination", without_benchmark),
    ("PII surrogates", without_personal_data),
    ("byte-level BPE", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each written as Parquet and read again."""
    prepare(configure(spark))
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_stage(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
