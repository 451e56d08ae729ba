"""Queries over what the jobs leave behind: collections, tables, ledgers, increments, streams.

Every job runs over the whole events table, writes under the application's shared
folder once, and the queries read its tables back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from logtrail.functions.timeparts import collection_id, parse_utc
from logtrail.operators.visitors import is_destroy_event
from logtrail.plans.bronze_job import STAGE as COLLECT_STAGE, collect_bronze
from logtrail.plans.silver import STAGE as SILVER_STAGE, GeoInputs, run_silver
from logtrail.operators.geo import second_source_records
from logtrail.schemas import BRONZE_COLUMNS, DATE_PARTITIONS, SILVER_COLUMNS
from logtrail.session import application_path, write_stage
from logtrail.sources import ledger
from logtrail.sources.bronze import BRONZE_PARTITIONS, read_bronze, read_rejected, write_bronze
from logtrail.sources.geo_tables import ASN_BLOCK_SCHEMA, append_geo_cache, read_geo_cache, read_network_blocks
from logtrail.sources.silver import read_silver
from logtrail.streaming.bronze_stream import bronze_stream, raw_event_stream, start_bronze_stream
from logtrail.streaming.execution_stream import ENDED, FOLLOWED, ORPHAN, RANGE_SCHEMA, execution_ranges, executions_in, start_taking
from logtrail.streaming.late_lines import join_late_lines, late_candidates
from logtrail.streaming.silver_stream import start_silver_stream
from testbed import fixture
from testbed.queries import query

# Runs of the increments in the order they are made: name, first and last day of January.
RUNS = [("run-1", 11, 20), ("run-2", 1, 10), ("run-3", 21, 31)]
DELAY, STALE = "10 minutes", "1 day"


def once(job: Callable[[SparkSession, str], dict]) -> Callable[[SparkSession, str], dict]:
    """A job runs once per application and data set."""

    @cache
    def kept(application: str, spark: SparkSession, sf_dir: str) -> dict:
        return job(spark, sf_dir)

    return lambda spark, sf_dir: kept(spark.sparkContext.applicationId, spark, sf_dir)


@once
def bronze_lines(spark: SparkSession, sf_dir: str) -> dict:
    lines = write_stage(fixture.bronze(spark, sf_dir), "bronze-lines")
    return {"lines": lines, "day": F.dayofmonth(F.timestamp_millis("timestamp_ms"))}


# --- collection -----------------------------------------------------------------


@once
def collections(spark: SparkSession, sf_dir: str) -> dict:
    """Two runs with an overlap, a manual one over a day of its own, and undated events."""
    base = application_path(spark, "collections")
    raw = fixture.raw_lines(spark, sf_dir).where("collection_id = 'collect-1'").drop("collection_id")
    undated = F.col("eventId").rlike("50-7$")
    raw.withColumn("timestamp", F.when(~undated, F.col("timestamp"))).write.option("compression", "gzip").json(f"{base}/raw")
    paths = dict(raw_path=f"{base}/raw", bronze_base=f"{base}/bronze", state_path=f"{base}/state")
    collect_bronze(spark, **paths, now="2024-01-08T00:00:00", log_group=fixture.LOG_GROUP)
    collect_bronze(spark, **paths, now="2024-01-08T12:00:00", log_group=fixture.LOG_GROUP)
    collect_bronze(
        spark, **paths, now="2024-01-09T00:00:00", window_start="2024-01-02", window_end="2024-01-03", log_group=fixture.LOG_GROUP
    )
    return {"base": base}


@query
def collection_runs(spark, sf_dir):
    table = read_bronze(spark, f"{collections(spark, sf_dir)['base']}/bronze")
    names = ["collection_id", "collection_type", "collection_window_start", "collection_window_end"]
    return table.groupBy(*names, collection_id(parse_utc(F.col("collected_at_utc"))).alias("derived_id")).agg(
        F.count(F.lit(1)).alias("lines"), F.min("timestamp_ms").alias("first_ms"), F.max("timestamp_ms").alias("last_ms")
    )


@query
def collection_state(spark, sf_dir):
    state = ledger.load_state(spark, f"{collections(spark, sf_dir)['base']}/state", COLLECT_STAGE)
    kept = spark.createDataFrame([state], ledger.STATE_SCHEMA)
    days = F.transform("last_output_paths", lambda path: F.regexp_extract(path, "day=(..)", 1))
    return kept.select(
        "last_collection_id", "last_successful_window_start", "last_successful_window_end", "last_events_count", F.concat_ws(",", days).alias("days")
    )


@query
def rejected_events(spark, sf_dir):
    table = read_rejected(spark, f"{collections(spark, sf_dir)['base']}/bronze-rejected")
    return table.select("event_id", "log_stream", "message", "collection_id")


@query
def stream_bronze(spark, sf_dir):
    """Raw files as a stream -> Bronze."""
    base, raw = application_path(spark, "raw-stream"), f"{collections(spark, sf_dir)['base']}/raw"
    events = raw_event_stream(spark, raw, maxFilesPerTrigger="3")
    start_bronze_stream(events, fixture.RUN, f"{base}/bronze", f"{base}/checkpoint", f"{base}/rejected").awaitTermination()
    table = read_bronze(spark, f"{base}/bronze")
    return table.select("event_id", "timestamp_ms", "log_stream", "message", *DATE_PARTITIONS)


@query
def network_tables(spark, sf_dir):
    path = application_path(spark, "asn")
    fixture.asn_blocks(spark, sf_dir).write.csv(path, header=True)
    return read_network_blocks(spark, path, ASN_BLOCK_SCHEMA, "csv")


# --- increments -----------------------------------------------------------------


@once
def increments(spark: SparkSession, sf_dir: str) -> dict:
    """Silver from three runs that come out of order; the borders cut executions and cycles."""
    base, bronze = application_path(spark, "increments"), bronze_lines(spark, sf_dir)
    append_geo_cache(fixture.geo_cache(spark, sf_dir), f"{base}/control/geo_cache", "seed")
    for number, (name, first, last) in enumerate(RUNS):
        write_bronze(bronze["lines"].where(bronze["day"].between(first, last)), f"{base}/bronze")
        run_silver(
            spark, f"{base}/bronze", f"{base}/silver", f"{base}/control", fixture.city_blocks(spark, sf_dir), fixture.asn_blocks(spark, sf_dir),
            fixture.second_responses(spark, sf_dir), name, f"2024-02-0{number + 1}T00:00:00Z",
        )
    return {"base": base, "bronze": f"{base}/bronze", "control": f"{base}/control", "silver": read_silver(spark, f"{base}/silver")}


@query
def bronze_table(spark, sf_dir):
    return read_bronze(spark, increments(spark, sf_dir)["bronze"], merge_schema=True).select(*BRONZE_COLUMNS)


@query
def silver_merge(spark, sf_dir):
    return increments(spark, sf_dir)["silver"].select(*SILVER_COLUMNS).withColumn("geo_distance_km", F.round("geo_distance_km", 3))


@query
def silver_by_day(spark, sf_dir):
    return increments(spark, sf_dir)["silver"].groupBy(*DATE_PARTITIONS).agg(F.count(F.lit(1)).alias("records"))


@query
def destroy_visitor_increments(spark, sf_dir):
    return increments(spark, sf_dir)["silver"].where(is_destroy_event()).select("request_id", "bucket_name", "visitor_id")


@query
def sessions_increments(spark, sf_dir):
    return increments(spark, sf_dir)["silver"].select("request_id", "timestamp_utc", "site_session_id")


@query
def geo_cache_runs(spark, sf_dir):
    return read_geo_cache(spark, f"{increments(spark, sf_dir)['control']}/geo_cache").select("ip", "country_code", "city", "latitude", "org")


@query
def file_ledger(spark, sf_dir):
    files = ledger.read_ledger(spark, f"{increments(spark, sf_dir)['control']}/files").where(F.col("stage") == SILVER_STAGE)
    return files.groupBy("run_id", "updated_at_utc").agg(F.count_distinct(*[F.regexp_extract("path", f"/{n}=([^/]+)/", 1) for n in BRONZE_PARTITIONS]).alias("partitions"))


@query
def pending_partitions(spark, sf_dir):
    """What the second run would have found pending after the first."""
    job = increments(spark, sf_dir)
    done = ledger.read_ledger(spark, f"{job['control']}/files").where("run_id = 'run-1'")
    return ledger.partitions_of(ledger.pending_files(ledger.parquet_files(spark, job["bronze"]), done, SILVER_STAGE))


@query
def path_rule(spark, sf_dir):
    """The alternative rule: only paths behind the last one of the first run."""
    job = increments(spark, sf_dir)
    last = ledger.last_path(ledger.read_ledger(spark, f"{job['control']}/files").where("run_id = 'run-1'"), SILVER_STAGE).first()["last_path"]
    return ledger.partitions_of(ledger.files_after(ledger.parquet_files(spark, job["bronze"]), last))


@query
def run_counts(spark, sf_dir):
    """Counts observed by one run over all lines."""
    base = application_path(spark, "counts")
    write_bronze(bronze_lines(spark, sf_dir)["lines"], f"{base}/bronze")
    append_geo_cache(fixture.geo_cache(spark, sf_dir), f"{base}/control/geo_cache", "seed")
    counts = run_silver(
        spark, f"{base}/bronze", f"{base}/silver", f"{base}/control", fixture.city_blocks(spark, sf_dir), fixture.asn_blocks(spark, sf_dir),
        fixture.second_responses(spark, sf_dir), "run-1", "2024-02-01T00:00:00Z",
    )
    return spark.createDataFrame([(name, value) for name, value in counts.items() if name != "files"], "count_name string, rows long")


# --- streams ----------------------------------------------------------------------


@once
def streams(spark: SparkSession, sf_dir: str) -> dict:
    """The streaming jobs over all lines but some, then over these, which are late by then.

    A START far behind all others moves the watermark past every line.
    """
    base, lines = application_path(spark, "streams"), bronze_lines(spark, sf_dir)["lines"]
    late = F.col("event_id").rlike("[05]7-5$")
    horizon = lines.limit(1).select(
        F.lit("horizon").alias("event_id"), (F.unix_millis(F.lit("2024-03-01").cast("timestamp"))).alias("timestamp_ms"), F.lit(None).cast("string").alias("timestamp_utc"),
        F.lit("horizon").alias("log_stream"), F.lit("START RequestId: horizon").alias("message"), F.lit("collect-9").alias("collection_id"),
    )
    inputs = GeoInputs(
        fixture.city_blocks(spark, sf_dir), fixture.asn_blocks(spark, sf_dir), fixture.geo_cache(spark, sf_dir),
        second_source_records(fixture.second_responses(spark, sf_dir)),
    )

    def run(number: int, added: DataFrame) -> None:
        write_bronze(added, f"{base}/bronze")
        candidates = late_candidates(spark, f"{base}/bronze", f"{base}/control")
        start_taking(bronze_stream(spark, f"{base}/bronze"), f"{base}/lines", f"{base}/checkpoint-lines", DELAY).awaitTermination()
        ranges = execution_ranges(spark, f"{base}/lines", DELAY, STALE)
        start_silver_stream(ranges, f"{base}/bronze", f"{base}/ranges", f"{base}/silver", lambda: inputs, f"{base}/checkpoint-silver").awaitTermination()
        join_late_lines(
            spark, candidates, f"{base}/bronze", f"{base}/lines", f"{base}/ranges", f"{base}/late", f"{base}/silver", f"{base}/control",
            inputs, f"late-{number}", "2024-03-01T00:00:00Z",
        )

    run(1, lines.where(~late).unionByName(horizon, allowMissingColumns=True))
    run(2, lines.where(late).withColumn("collection_id", F.concat(F.lit("late-"), "collection_id")))
    return {"base": base}


@query
def stream_dedup(spark, sf_dir):
    """Lines the stream has taken, once each."""
    taken = spark.read.parquet(f"{streams(spark, sf_dir)['base']}/lines").where("log_stream <> 'horizon'")
    return taken.select("event_id", "log_stream", (F.col("t") / 1000).cast("long").alias("timestamp_ms"), "start_id", "end_id")


@query
def stream_blocks(spark, sf_dir):
    """Executions at the places that the state function has yielded, with the lines known in the end."""
    base = streams(spark, sf_dir)["base"]
    ranges = spark.read.schema(RANGE_SCHEMA).parquet(f"{base}/ranges").where(F.col("kind") != ORPHAN)
    order = F.when(F.col("kind") == ENDED, 0).when(F.col("kind") == FOLLOWED, 1).otherwise(2)
    final = F.min_by(F.struct("until_t", "until_event_id", "kind"), order).alias("final")
    ranges = ranges.groupBy("log_stream", "start_t", "start_event_id").agg(final).select("log_stream", "start_t", "start_event_id", "final.*")
    found = executions_in(read_bronze(spark, f"{base}/bronze"), write_stage(ranges, "final-ranges")).where("log_stream <> 'horizon'")
    return found.withColumns({name: F.unix_micros(name) for name in ("start_ts", "end_ts")})


@query
def late_lines(spark, sf_dir):
    table = spark.read.parquet(f"{streams(spark, sf_dir)['base']}/late")
    return table.select("event_id", "log_stream", "timestamp_ms", "message")


@query
def stream_silver(spark, sf_dir):
    """Silver of the stream, with the late lines joined."""
    table = read_silver(spark, f"{streams(spark, sf_dir)['base']}/silver").select(*SILVER_COLUMNS).where("log_stream <> 'horizon'")
    return table.withColumn("geo_distance_km", F.round("geo_distance_km", 3))
