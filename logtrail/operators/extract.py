"""Execution text -> 30 access columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logtrail.functions.jsontext import balanced_object, parse_json, quick_object, text_from, value_text
from logtrail.functions.timeparts import MAX_EPOCH_MS, MIN_EPOCH_MS, iso_zulu
from logtrail.operators.once import compute_once

# The marker before the request JSON, the error texts, the status values.
MARKER = "Evento recebido:"
NO_MARKER = "Evento recebido não encontrado"
NO_JSON = "JSON não encontrado após Evento recebido"
INCOMPLETE_JSON = "JSON incompleto"
BAD_JSON = "json_decode_error"
STATUS_OK = "ok"
STATUS_ERROR = "erro"

# Silver column -> request header.
HEADER_COLUMNS = {
    "host": "host",
    "ip": "cf-connecting-ip",
    "pais_cf": "cf-ipcountry",
    "cf_ray": "cf-ray",
    "x_forwarded_for": "x-forwarded-for",
    "user_agent": "user-agent",
    "referer": "referer",
    "accept_language": "accept-language",
    "accept": "accept",
    "accept_encoding": "accept-encoding",
    "range": "range",
    "sec_ch_ua": "sec-ch-ua",
    "sec_ch_ua_mobile": "sec-ch-ua-mobile",
    "sec_ch_ua_platform": "sec-ch-ua-platform",
    "sec_fetch_dest": "sec-fetch-dest",
    "sec_fetch_mode": "sec-fetch-mode",
    "sec_fetch_site": "sec-fetch-site",
    "sec_fetch_user": "sec-fetch-user",
}
REFERER_FALLBACK = "referrer"


def with_event_json(blocks: DataFrame) -> DataFrame:
    """Add `event` (variant, null when unusable) and `parse_error` ('' when fine).

    Each step is its own projection so the text is scanned once.
    """
    text = F.coalesce("block_text", F.lit(""))
    marker_at, brace_at = F.col("_marker_at"), F.col("_brace_at")
    return (
        blocks.withColumn("_marker_at", F.locate(MARKER, text))
        .withColumn("_brace_at", F.when(marker_at > 0, F.position(F.lit("{"), text, marker_at + len(MARKER))))
        .withColumn("_raw", F.when(brace_at > 0, text_from(text, brace_at)))
        .withColumn("_quick", quick_object(F.col("_raw")))
        .withColumn("_json", balanced_object(F.col("_raw"), F.col("_quick")))
        .withColumn("event", parse_json(F.nullif(F.col("_json"), F.lit(""))))
        .withColumn(
            "parse_error",
            F.when(marker_at == 0, NO_MARKER)
            .when(F.col("_raw").isNull(), NO_JSON)
            .when(F.col("_json") == "", INCOMPLETE_JSON)
            .when(F.col("event").isNull(), BAD_JSON)
            .otherwise(""),
        )
        .drop("_marker_at", "_brace_at", "_raw", "_quick", "_json")
    )


def access_time(event: Column, start_ts: Column) -> Column:
    """The request's own epoch when it is a usable number, else the start of the execution."""
    shown = F.to_json(F.try_variant_get(event, "$.requestContext.timeEpoch", "variant"))
    epoch_ms = F.when(shown.rlike(r"^-?\d"), shown.try_cast("double"))
    usable = (epoch_ms != 0) & epoch_ms.between(MIN_EPOCH_MS, MAX_EPOCH_MS)
    return F.coalesce(F.when(usable, F.timestamp_micros(F.rint(epoch_ms * 1000).cast("bigint"))), start_ts)


def extract_accesses(blocks: DataFrame) -> DataFrame:
    """The 30 access columns, plus the technical event_ts, start_ts and block_text.

    `block_closed` may also be called `closed`; without either it is false.
    """
    closed = next((F.col(name) for name in ("block_closed", "closed") if name in blocks.columns), F.lit(False))

    def text_column(name: str) -> Column:
        return F.coalesce(name, F.lit("")) if name in blocks.columns else F.lit("")

    def header(name: str) -> Column:
        return F.col("_headers")[name]

    headers = {column: F.coalesce(header(name), F.lit("")) for column, name in HEADER_COLUMNS.items()}
    headers["referer"] = F.when(
        F.map_contains_key("_headers", HEADER_COLUMNS["referer"]), headers["referer"]
    ).otherwise(F.coalesce(header(REFERER_FALLBACK), F.lit("")))
    event = F.col("event")

    parsed = with_event_json(blocks).withColumns(
        {
            "_headers": F.try_variant_get(event, "$.headers", "map<string,string>"),
            "_http": F.try_variant_get(event, "$.requestContext.http", "map<string,string>"),
            "event_ts": access_time(event, F.col("start_ts").cast("timestamp")),
        }
    ).transform(compute_once, ["event", "parse_error", "_headers", "_http", "event_ts"])
    http = F.col("_http")
    return parsed.select(
        "request_id",
        iso_zulu(F.col("event_ts")).alias("timestamp_utc"),
        F.coalesce(http["method"], F.lit("")).alias("method"),
        F.coalesce(value_text(event, "$.rawPath"), F.lit("")).alias("raw_path"),
        F.coalesce(value_text(event, "$.rawQueryString"), F.lit("")).alias("raw_query_string"),
        *[value.alias(name) for name, value in headers.items() if name in ("host", "ip", "pais_cf", "cf_ray", "x_forwarded_for")],
        F.coalesce(http["sourceIp"], F.lit("")).alias("source_ip_cloudflare"),
        *[value.alias(name) for name, value in headers.items() if name not in ("host", "ip", "pais_cf", "cf_ray", "x_forwarded_for")],
        text_column("log_group").alias("log_group"),
        text_column("log_stream").alias("log_stream"),
        F.coalesce(closed.cast("boolean"), F.lit(False)).alias("block_closed"),
        F.coalesce((F.size("_headers") > 0) & (F.size("_http") > 0), F.lit(False)).alias("is_http_event"),
        F.when(F.col("parse_error") == "", STATUS_OK).otherwise(STATUS_ERROR).alias("parse_status"),
        "parse_error",
        "event_ts",
        F.col("start_ts").cast("timestamp").alias("start_ts"),
        F.coalesce("block_text", F.lit("")).alias("block_text"),
    )
