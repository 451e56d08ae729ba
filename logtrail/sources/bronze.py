"""Bronze table: append-only Parquet by event date and collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from logtrail.functions.timeparts import date_parts, event_time
from logtrail.schemas import BRONZE_REQUIRED, BRONZE_SCHEMA, DATE_PARTITIONS, require_columns
from logtrail.sources.paths import read_parquet_or_empty

# Partition values are text: a month is '06', not 6.
_PATH_FIELDS = [T.StructField(name, T.StringType()) for name in DATE_PARTITIONS]
BRONZE_PARTITIONS = [*DATE_PARTITIONS, "collection_id"]
BRONZE_TABLE_SCHEMA = T.StructType(BRONZE_SCHEMA.fields + _PATH_FIELDS)


def undated(bronze: DataFrame) -> DataFrame:
    """Rows without a usable event time; they have no date partition."""
    return bronze.where(event_time(bronze).isNull())


def write_bronze(bronze: DataFrame, base: str, reject_base: str | None = None) -> None:
    """Partition by the date of each event and by collection.

    A repeated run of one collection replaces only its own partitions. Rows
    without an event time go to `reject_base`. The rebalance hint lets the
    adaptive planner split a hot day and merge small ones.
    """
    moment = event_time(bronze)
    dated = bronze.where(moment.isNotNull()).select("*", *date_parts(moment))
    (
        dated.hint("rebalance", *DATE_PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*BRONZE_PARTITIONS)
        .parquet(base)
    )
    if reject_base is not None:
        (
            undated(bronze)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "snappy")
            .partitionBy("collection_id")
            .parquet(reject_base)
        )


def read_rejected(spark: SparkSession, reject_base: str) -> DataFrame:
    """Rows without an event time; empty when none were ever rejected."""
    return read_parquet_or_empty(spark, reject_base, BRONZE_TABLE_SCHEMA)


def read_bronze(
    spark: SparkSession,
    base: str,
    paths: list[str] | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """The whole table or some of its files.

    The fixed schema needs no footer pass and leaves absent columns null. With
    merge_schema the column union of foreign files is discovered and checked.
    """
    reader = spark.read.option("basePath", base)
    if merge_schema:
        found = reader.option("mergeSchema", "true").parquet(*(paths or [base]))
        return require_columns(found, BRONZE_REQUIRED, "Bronze")
    return reader.schema(BRONZE_TABLE_SCHEMA).parquet(*(paths or [base]))
