"""Control records: which files a stage has processed, and the last run of a stage.

Every record is appended after the data it speaks of has been written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from logtrail.sources.bronze import BRONZE_PARTITIONS
from logtrail.sources.paths import path_exists, read_parquet_or_empty

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("stage", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("updated_at_utc", T.StringType()),
    ]
)
STATE_SCHEMA = T.StructType(
    [
        T.StructField("stage", T.StringType()),
        T.StructField("last_successful_window_start", T.StringType()),
        T.StructField("last_successful_window_end", T.StringType()),
        T.StructField("last_collection_id", T.StringType()),
        T.StructField("last_output_paths", T.ArrayType(T.StringType())),
        T.StructField("last_events_count", T.LongType()),
        T.StructField("updated_at_utc", T.StringType()),
    ]
)


def parquet_files(spark: SparkSession, base: str) -> DataFrame:
    """Paths of the Parquet files under `base`; the files' content is not read."""
    if not path_exists(spark, base):
        return spark.createDataFrame([], "path string")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(base)
        .select("path")
    )


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    return read_parquet_or_empty(spark, ledger, LEDGER_SCHEMA)


def pending_files(files: DataFrame, ledger: DataFrame, stage: str) -> DataFrame:
    """Files the stage has not committed, wherever their path sorts."""
    return files.join(ledger.where(F.col("stage") == stage).select("path"), "path", "left_anti")


def partitions_of(files: DataFrame) -> DataFrame:
    """The Bronze partitions of the files, from the folder names in their paths.

    The condition also tells the planner that this side is selective, so that a
    scan joined with it is pruned when it runs.
    """
    values = [F.regexp_extract("path", f"/{name}=([^/]+)/", 1).alias(name) for name in BRONZE_PARTITIONS]
    return files.select(*values).where(F.col(BRONZE_PARTITIONS[-1]) != "").distinct()


def files_after(files: DataFrame, last_path: str | None) -> DataFrame:
    """The path rule: only files whose path sorts after the last one; all when there is none."""
    return files if not last_path else files.where(F.col("path") > last_path)


def last_path(ledger: DataFrame, stage: str) -> DataFrame:
    """One row with the greatest committed path of the stage."""
    return ledger.where(F.col("stage") == stage).agg(F.max("path").alias("last_path"))


def commit_files(files: DataFrame, ledger: str, stage: str, run_id: str, updated_at_utc: str) -> None:
    rows = files.select(
        F.lit(stage).alias("stage"),
        "path",
        F.lit(run_id).alias("run_id"),
        F.lit(updated_at_utc).alias("updated_at_utc"),
    )
    rows.coalesce(1).write.mode("append").parquet(ledger)


def load_state(spark: SparkSession, path: str, stage: str) -> dict:
    """The last run of a stage; {} before the first."""
    if not path_exists(spark, path):
        return {}
    rows = spark.read.schema(STATE_SCHEMA).json(path).where(F.col("stage") == stage)
    latest = rows.orderBy(F.col("updated_at_utc").desc()).limit(1).collect()
    return latest[0].asDict() if latest else {}


def save_state(spark: SparkSession, path: str, state: dict) -> None:
    spark.createDataFrame([state], STATE_SCHEMA).coalesce(1).write.mode("append").json(path)
