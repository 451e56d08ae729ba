"""Silver table: one row per request_id, partitioned by the date of the access."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from logtrail.functions.timeparts import date_parts, parse_utc
from logtrail.operators.dedup import keep_first
from logtrail.schemas import DATE_PARTITIONS, OBSOLETE_COLUMNS, SILVER_COLUMNS, SILVER_SCHEMA, conform
from logtrail.session import write_stage
from logtrail.sources.paths import delete_path, path_exists
from logtrail.sources.registers import add_ids, stored_ids

SILVER_TABLE_SCHEMA = T.StructType(
    SILVER_SCHEMA.fields + [T.StructField(name, T.StringType()) for name in DATE_PARTITIONS]
)


def silver_rows(records: DataFrame) -> DataFrame:
    """The 72 columns in order; technical and obsolete columns go, a missing one is an error."""
    return conform(records.drop(*OBSOLETE_COLUMNS), SILVER_COLUMNS, "Silver")


def read_silver(spark: SparkSession, base: str) -> DataFrame:
    if not path_exists(spark, base):
        return spark.createDataFrame([], SILVER_TABLE_SCHEMA)
    return spark.read.schema(SILVER_TABLE_SCHEMA).parquet(base)


def _day_key() -> Column:
    """'2024-03-01' of the partition columns; '' for rows without a time."""
    return F.concat_ws("-", *DATE_PARTITIONS)


def day_of(moment: Column) -> Column:
    return F.coalesce(F.date_format(moment, "yyyy-MM-dd"), F.lit(""))


def days_of(rows: DataFrame, day: Column | None = None) -> set[str]:
    """Partitions of the rows: one short text per day of data."""
    return {row[0] for row in rows.select(_day_key() if day is None else day).distinct().collect()}


def silver_days(spark: SparkSession, base: str) -> set[str]:
    """The days that Silver has partitions for, from the names of its folders."""
    if not path_exists(spark, base):
        return set()
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/year=*/month=*/day=*")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [status.getPath().toString() for status in files.globStatus(pattern)]
    parts = [[part.split("=", 1)[1] for part in path.split("/")[-3:]] for path in found]
    return {"" if "__HIVE_DEFAULT_PARTITION__" in names else "-".join(names) for names in parts}


def read_days(spark: SparkSession, base: str, days: set[str]) -> DataFrame:
    """The rows of some days; the other partitions are not listed in the scan."""
    return read_silver(spark, base).where(_day_key().isin(sorted(days)))


def _known_ids(spark: SparkSession, base: str) -> DataFrame:
    """The id register; filled from Silver once where Silver is older than the register."""
    known = stored_ids(spark, base)
    if path_exists(spark, base) and not known.limit(1).count():
        add_ids(read_silver(spark, base).select("request_id", _day_key().alias("day")), base)
        known = stored_ids(spark, base)
    return known


def merge_silver(
    records: DataFrame,
    base: str,
    amend: Callable[[DataFrame], DataFrame] | None = None,
    amended_days: set[str] | None = None,
    observe: Callable[[DataFrame], DataFrame] | None = None,
    replace: bool = False,
) -> DataFrame:
    """Merge new rows by request_id; returns request_id and day of the new rows that are now stored.

    The days of stored copies come from the register of ids, wherever they lie,
    also without a date; only these days and those of the new rows are read and
    rewritten. A complete execution goes before a cut one, then as in one batch the
    last stream and the later time; of cut ones the new row. With `replace` the new
    rows stand for the stored ones of their request and stream in any case. `amend` rewrites columns of stored rows (marked `_new = 0`) in
    `amended_days` besides. Without a table format this is read, merge, overwrite:
    Spark writes merged partitions to a folder of its own beside the table, and they
    replace their files when all are written. What is stored where (ids and days) is
    settled before, from the narrow columns that decide between copies.
    """
    spark = records.sparkSession
    moment = parse_utc(F.col("timestamp_utc"))
    new = write_stage(silver_rows(records).select("*", *date_parts(moment)), "silver-new")
    copies = _known_ids(spark, base).join(new.select("request_id").distinct(), "request_id", "left_semi")
    there = silver_days(spark, base)
    left = (days_of(copies, F.col("day")) | (amended_days or set())) & there
    entered = days_of(new)
    old = read_days(spark, base, (left | entered) & there)
    if replace:
        old = old.join(new.select("request_id", "log_stream").distinct(), ["request_id", "log_stream"], "left_anti")
    both = new.withColumn("_new", F.lit(1)).unionByName(old.select(*new.columns).withColumn("_new", F.lit(0)))
    closed = F.when(F.col("block_closed"), moment)
    order = [F.col("block_closed").desc(), F.col("log_stream").desc_nulls_last(), closed.desc_nulls_last(), F.col("_new").desc(), moment.desc_nulls_last()]
    deciding = both.select("request_id", "block_closed", "log_stream", "timestamp_utc", "_new", *DATE_PARTITIONS)
    places = keep_first(deciding, ["request_id"], order).select("request_id", _day_key().alias("day"), "_new")
    places = write_stage(places, "silver-places")
    kept = places.where("_new = 1").drop("_new")
    add_ids(kept, base)
    emptied = left - days_of(places, F.col("day"))
    merged = keep_first(both, ["request_id"], order)
    merged = amend(merged) if amend is not None else merged
    merged = observe(merged) if observe is not None else merged
    (
        merged.drop("_new")
        .hint("rebalance", *DATE_PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*DATE_PARTITIONS)
        .parquet(base)
    )
    for day in sorted(emptied):  # every row of it has moved
        delete_path(spark, f"{base}/{_partition_path(day)}")
    return kept


def _partition_path(day: str) -> str:
    values = day.split("-") if day else ["__HIVE_DEFAULT_PARTITION__"] * len(DATE_PARTITIONS)
    return "/".join(f"{name}={value}" for name, value in zip(DATE_PARTITIONS, values))
