"""Geo tables: network blocks, and the cache of looked-up addresses, one folder per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from logtrail.schemas import GEO_RECORD_SCHEMA
from logtrail.sources.registers import read_runs, write_run

CITY_BLOCK_SCHEMA = T.StructType(
    [
        T.StructField("network", T.StringType()),
        *[f for f in GEO_RECORD_SCHEMA.fields if f.name not in ("ip", "org")],
    ]
)
ASN_BLOCK_SCHEMA = T.StructType(
    [
        T.StructField("network", T.StringType()),
        T.StructField("asn_number", T.IntegerType()),
        T.StructField("asn_name", T.StringType()),
    ]
)


def read_network_blocks(spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet") -> DataFrame:
    """Network blocks as Parquet or CSV with a header."""
    reader = spark.read.schema(schema)
    return reader.csv(path, header=True) if file_format == "csv" else reader.parquet(path)


def read_geo_cache(spark: SparkSession, base: str, before: str | None = None) -> DataFrame:
    """Records of all runs, or of all but `before`, which may be a repeated one."""
    return read_runs(spark, base, GEO_RECORD_SCHEMA, before)


def append_geo_cache(fresh: DataFrame, base: str, run_id: str) -> None:
    """Add the addresses of a run; those of earlier runs stay where they are."""
    write_run(fresh.select(*GEO_RECORD_SCHEMA.fieldNames()), base, run_id)
