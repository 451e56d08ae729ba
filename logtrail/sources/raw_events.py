"""Raw log events: exported event files, the collection window, Bronze rows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logtrail.functions.timeparts import millis_to_iso
from logtrail.schemas import BRONZE_COLUMNS, RAW_EVENT_SCHEMA, conform

# First look-back, overlap between runs, source name, run types.
FIRST_LOOK_BACK = timedelta(hours=25)
DEFAULT_OVERLAP_MINUTES = 5
SOURCE_SERVICE = "cloudwatch_logs"
INCREMENTAL = "incremental"
MANUAL = "manual_reprocess"


def utc(value: str | datetime) -> datetime:
    """ISO text or datetime -> aware UTC; a naive value is UTC."""
    moment = datetime.fromisoformat(value) if isinstance(value, str) else value
    return moment.replace(tzinfo=timezone.utc) if moment.tzinfo is None else moment.astimezone(timezone.utc)


def to_millis(moment: datetime) -> int:
    return int(moment.timestamp() * 1000)


@dataclass(frozen=True)
class Collection:
    """Parameters of one collection run; one `now` serves the whole run."""

    now: datetime
    window_start: datetime
    window_end: datetime
    collection_type: str = INCREMENTAL
    log_group: str = ""
    aws_region: str = "us-east-2"

    @property
    def collection_id(self) -> str:
        return self.now.strftime("%Y%m%dT%H%M%SZ")

    @property
    def moves_state(self) -> bool:
        return self.collection_type == INCREMENTAL


def resolve_collection(
    now: str | datetime,
    last_window_end: str | None = None,
    window_start: str | None = None,
    window_end: str | None = None,
    overlap_minutes: int = DEFAULT_OVERLAP_MINUTES,
    **labels: str,
) -> Collection:
    """A manual window wins; else the last end minus the overlap; else the first look-back."""
    now = utc(now)
    if window_start and window_end:
        return Collection(now, utc(window_start), utc(window_end), MANUAL, **labels)
    if last_window_end:
        return Collection(now, utc(last_window_end) - timedelta(minutes=overlap_minutes), now, **labels)
    return Collection(now, now - FIRST_LOOK_BACK, now, **labels)


def read_raw_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_EVENT_SCHEMA).json(path)


def in_window(events: DataFrame, run: Collection, undated: bool = False) -> DataFrame:
    """Events with start <= timestamp <= end, in milliseconds; with `undated` also those without a time.

    One condition, not a union of two scans: the raw text is parsed once.
    """
    inside = F.col("timestamp").between(to_millis(run.window_start), to_millis(run.window_end))
    return events.where(inside | F.col("timestamp").isNull() if undated else inside)


def bronze_rows(
    events: DataFrame,
    run: Collection,
    collection_id: Column | None = None,
) -> DataFrame:
    """Raw events -> the 16 Bronze columns; the message stays as it is."""

    def iso(moment: datetime) -> Column:
        return F.lit(moment.isoformat())

    message_size = F.coalesce(F.octet_length("message"), F.lit(0))
    rows = events.select(
        F.col("eventId").alias("event_id"),
        F.col("timestamp").alias("timestamp_ms"),
        millis_to_iso(F.col("timestamp")).alias("timestamp_utc"),
        F.col("ingestionTime").alias("ingestion_time_ms"),
        millis_to_iso(F.col("ingestionTime")).alias("ingestion_time"),
        F.lit(run.log_group).alias("log_group"),
        F.col("logStreamName").alias("log_stream"),
        "message",
        message_size.alias("message_size"),
        F.lit(SOURCE_SERVICE).alias("source_service"),
        F.lit(run.aws_region).alias("aws_region"),
        iso(run.now).alias("collected_at_utc"),
        (F.lit(run.collection_id) if collection_id is None else collection_id).alias("collection_id"),
        F.lit(run.collection_type).alias("collection_type"),
        iso(run.window_start).alias("collection_window_start"),
        iso(run.window_end).alias("collection_window_end"),
    )
    return conform(rows, BRONZE_COLUMNS, "Bronze")
