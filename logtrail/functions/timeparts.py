"""Times: epoch milliseconds, ISO text, path parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

MICROS_PER_SECOND = 1_000_000
# Milliseconds of 0001-01-01 and 9999-12-31T23:59:59.999, the range a calendar date can show.
MIN_EPOCH_MS = -62_135_596_800_000
MAX_EPOCH_MS = 253_402_300_799_999


def iso_text(ts: Column, zone: str) -> Column:
    """ISO 8601 text in UTC; the fraction appears only when it is not zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.when(F.unix_micros(ts) % MICROS_PER_SECOND != 0, F.date_format(ts, ".SSSSSS")).otherwise("")
    return F.concat(whole, fraction, F.lit(zone))


def iso_offset(ts: Column) -> Column:
    return iso_text(ts, "+00:00")


def iso_zulu(ts: Column) -> Column:
    return iso_text(ts, "Z")


def millis_to_iso(ms: Column) -> Column:
    return iso_offset(F.timestamp_millis(ms))


def parse_utc(value: Column) -> Column:
    """Text to timestamp; text without a zone is UTC, bad text is null."""
    return F.try_to_timestamp(value)


def collection_id(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")


def date_parts(ts: Column) -> list[Column]:
    """Zero-padded path parts year, month, day."""
    return [
        F.date_format(ts, "yyyy").alias("year"),
        F.date_format(ts, "MM").alias("month"),
        F.date_format(ts, "dd").alias("day"),
    ]


def event_time(df: DataFrame) -> Column:
    """Event time of a log line: epoch milliseconds where present, else the text.

    The text form drops its fraction at whole seconds, so it is only the fallback.
    """
    text = F.col("timestamp_utc")
    if isinstance(df.schema["timestamp_utc"].dataType, T.StringType):
        text = parse_utc(text)
    else:
        text = text.cast("timestamp")
    if "timestamp_ms" in df.columns:
        return F.coalesce(F.timestamp_millis(F.col("timestamp_ms")), text)
    return text
