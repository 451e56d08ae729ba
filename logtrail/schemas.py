"""Fixed schemas and column orders of the layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

RAW_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("eventId", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("ingestionTime", T.LongType()),
        T.StructField("logStreamName", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("timestamp_ms", T.LongType()),
        T.StructField("timestamp_utc", T.StringType()),
        T.StructField("ingestion_time_ms", T.LongType()),
        T.StructField("ingestion_time", T.StringType()),
        T.StructField("log_group", T.StringType()),
        T.StructField("log_stream", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("message_size", T.IntegerType()),
        T.StructField("source_service", T.StringType()),
        T.StructField("aws_region", T.StringType()),
        T.StructField("collected_at_utc", T.StringType()),
        T.StructField("collection_id", T.StringType()),
        T.StructField("collection_type", T.StringType()),
        T.StructField("collection_window_start", T.StringType()),
        T.StructField("collection_window_end", T.StringType()),
    ]
)
BRONZE_COLUMNS = BRONZE_SCHEMA.fieldNames()
BRONZE_REQUIRED = ["event_id", "timestamp_utc", "log_stream", "message"]
DATE_PARTITIONS = ["year", "month", "day"]

BLOCK_COLUMNS = ["request_id", "log_group", "log_stream", "start_ts", "end_ts", "block_closed", "block_text"]

# Silver columns by the stage that writes them.
EXTRACT_COLUMNS = [
    "request_id", "timestamp_utc", "method", "raw_path", "raw_query_string", "host",
    "ip", "pais_cf", "cf_ray", "x_forwarded_for", "source_ip_cloudflare",
    "user_agent", "referer", "accept_language", "accept", "accept_encoding", "range",
    "sec_ch_ua", "sec_ch_ua_mobile", "sec_ch_ua_platform",
    "sec_fetch_dest", "sec_fetch_mode", "sec_fetch_site", "sec_fetch_user",
    "log_group", "log_stream", "block_closed", "is_http_event", "parse_status", "parse_error",
]
CLASSIFY_COLUMNS = [
    "event_type", "origem_eventbridge", "status_confianca", "motivo_confianca", "decision_user_agent",
    "disparou_apply", "disparou_destroy", "bucket_name", "last_accessed_at", "expiration_time",
    "active_site_untrusted_access", "serviu_site", "aguardando_criacao", "renovou_timeout",
    "deploy_avoided", "estado_resposta", "manter_para_analise", "motivo_analise",
]
VISITOR_COLUMNS = [
    "network_prefix", "browser_family", "device_type", "is_scanner_user_agent",
    "is_social_preview", "visitor_type", "visitor_id", "site_session_id",
]
GEO_COLUMNS = [
    "geo_country_code", "geo_country_name", "geo_city", "geo_region", "geo_postal_code",
    "geo_latitude", "geo_longitude", "geo_timezone", "geo_asn", "geo_provider",
    "is_cloud_provider", "is_known_scanner_network", "network_type",
]
DIVERGENCE_COLUMNS = ["geo_distance_km", "geo_divergence_severity", "geo_sources_divergent"]
SILVER_COLUMNS = EXTRACT_COLUMNS + CLASSIFY_COLUMNS + VISITOR_COLUMNS + GEO_COLUMNS + DIVERGENCE_COLUMNS

BOOLEAN_COLUMNS = {
    "block_closed", "is_http_event", "origem_eventbridge", "disparou_apply", "disparou_destroy",
    "active_site_untrusted_access", "serviu_site", "aguardando_criacao", "renovou_timeout",
    "deploy_avoided", "manter_para_analise", "is_scanner_user_agent", "is_social_preview",
    "is_cloud_provider", "is_known_scanner_network", "geo_sources_divergent",
}
DOUBLE_COLUMNS = {"geo_latitude", "geo_longitude", "geo_distance_km"}


def _silver_type(name: str) -> T.DataType:
    if name in BOOLEAN_COLUMNS:
        return T.BooleanType()
    return T.DoubleType() if name in DOUBLE_COLUMNS else T.StringType()


SILVER_SCHEMA = T.StructType([T.StructField(name, _silver_type(name)) for name in SILVER_COLUMNS])

# Columns that live between the stages and are dropped before Silver is written.
TECHNICAL_COLUMNS = ["block_text", "start_ts", "end_ts", "event_ts", "geo_org"]
OBSOLETE_COLUMNS = ["acordou_ambiente", "ambiente_ativo", "carregou_site"]

GEO_RECORD_SCHEMA = T.StructType(
    [
        T.StructField("ip", T.StringType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("country_name", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("postal_code", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("org", T.StringType()),
    ]
)
GEO_FIELDS = GEO_RECORD_SCHEMA.fieldNames()[1:]

# The 37 columns of the analytic layer.
GOLD_COLUMNS = [
    "request_id", "timestamp_utc", "method", "raw_path", "raw_query_string", "host", "ip", "pais_cf",
    "cf_ray", "x_forwarded_for", "user_agent", "referer", "accept_language", "range",
    "sec_fetch_site", "sec_fetch_user",
    "bucket_name", "status_confianca", "motivo_confianca", "disparou_apply", "disparou_destroy",
    "network_prefix", "browser_family", "device_type", "is_scanner_user_agent", "is_social_preview",
    "visitor_type", "visitor_id", "site_session_id",
    "geo_country_code", "geo_city", "geo_region", "geo_asn", "geo_provider",
    "is_cloud_provider", "is_known_scanner_network", "network_type",
]


def require_columns(df: DataFrame, required: list[str], layer: str) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns in {layer}: {missing}")
    return df


def conform(df: DataFrame, columns: list[str], layer: str) -> DataFrame:
    """Canonical column order; a missing column is an error, never filled."""
    return require_columns(df, columns, layer).select(*columns)
