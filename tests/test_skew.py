"""A hot key must not put its rows into one task."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from logtrail.operators.blocks import assign_starts, build_blocks, cut_streams, log_lines
from logtrail.operators.carry import cut
from logtrail.operators.dedup import dedup_accesses
from logtrail.operators.geo import attach_geo
from logtrail.operators.sessions import TIES, assign_sessions, time_key
from logtrail.operators.visitors import propagate_visitors
from logtrail.session import write_stage

# Stands for a cluster whose partitions exceed the thresholds at their real sizes.
SMALL_THRESHOLDS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10KB",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def small_thresholds(spark):
    before = {name: spark.conf.get(name, None) for name in SMALL_THRESHOLDS}
    for name, value in SMALL_THRESHOLDS.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def hot_records(spark):
    """20,000 accesses; half share one address and one bucket, in many map tasks."""
    hot = F.col("id") % 2 == 0
    return write_stage(
        spark.range(0, 20000, numPartitions=16).select(
            F.concat(F.lit("r"), F.col("id")).alias("request_id"),
            F.timestamp_seconds(F.col("id")).alias("event_ts"),
            F.timestamp_seconds(F.col("id")).alias("start_ts"),
            F.concat(F.lit("s"), F.col("id") % 5).alias("log_stream"),
            F.when(hot, "10.0.0.1").otherwise(F.concat(F.lit("10.1.0."), F.col("id") % 97)).alias("ip"),
            F.when(hot, "b").otherwise(F.concat(F.lit("b"), F.col("id") % 97)).alias("bucket_name"),
            (F.col("id") % 4 == 0).alias("disparou_destroy"),
            F.lit("").alias("estado_resposta"),
            F.lit(True).alias("block_closed"),
            F.sha2(F.col("id").cast("string"), 256).alias("visitor_id"),
        ),
        "hot",
    )


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_address_and_hot_bucket_are_split(small_thresholds):
    records = hot_records(small_thresholds)
    dimension = records.select("ip").distinct().withColumn("geo_city", F.col("ip"))
    located = attach_geo(records, dimension)
    assert "skew=true" in final_plan(located)
    assert located.where("geo_city = ip").count() == 20000
    inherited = dedup_accesses(propagate_visitors(records, source=records))
    assert "skew=true" in final_plan(inherited)
    assert inherited.count() == 20000


def hot_lines(spark, seconds):
    """50,000 lines of one stream at the given times."""
    return spark.range(0, 50000, numPartitions=8).select(
        F.format_string("%08d", "id").alias("event_id"),
        F.lit("hot").alias("log_stream"),
        F.expr(seconds).alias("timestamp_utc"),
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("START RequestId: r"), F.col("id"))).otherwise("x").alias("message"),
    )


@pytest.mark.parametrize("seconds", ["timestamp_seconds(id)", "timestamp_seconds(7)", "cast(NULL AS timestamp)"])
def test_hot_stream_is_cut_into_ranges_of_rows(spark, seconds):
    lines = hot_lines(spark, seconds)
    ranges = cut_streams(lines, rows=1000)
    sizes = [row["count"] for row in ranges.number(log_lines(lines)).groupBy(*ranges.grouping).count().collect()]
    assert sum(sizes) == 50000 and max(sizes) < 1700 and len(sizes) >= 40
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = assign_starts(log_lines(lines), ranges).groupBy(F.spark_partition_id().alias("p")).count()
        tasks = [row["count"] for row in spread.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(tasks) == 50000 and len(tasks) == 4 and max(tasks) < 20000
    if "id" not in seconds:
        assert build_blocks(lines, rows=1000).count() == 5000


def test_sessions_of_one_crowded_second(spark):
    """All records of a site in one second: the scan still runs in ranges."""
    records = spark.range(0, 20000, numPartitions=8).select(
        F.format_string("%08d", "id").alias("request_id"), F.timestamp_seconds(F.lit(5)).alias("event_ts"), F.lit("s").alias("log_stream"),
        F.timestamp_seconds(F.lit(5)).alias("start_ts"), (F.col("id") % 100 == 0).alias("disparou_apply"), (F.col("id") % 100 == 49).alias("disparou_destroy"),
    )
    ranges = cut(records.withColumn("_t", time_key()), [], "_t", TIES, rows=1000)
    sizes = [r["count"] for r in ranges.number(records.withColumn("_t", time_key())).groupBy(*ranges.grouping).count().collect()]
    assert max(sizes) < 1700
    found = assign_sessions(records, rows=1000)
    assert found.groupBy("site_session_id").count().where("count = 50").count() == 200
    assert found.select("site_session_id").distinct().count() == 200 + 200 * 50


def test_few_rows_need_no_borders(spark):
    assert cut_streams(hot_lines(spark, "timestamp_seconds(id)")).borders is None
    assert cut_streams(hot_lines(spark, "timestamp_seconds(id)").limit(0)).borders is None
