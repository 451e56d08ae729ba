"""Silver -> Gold: the analytic projection, scores and grouped reports.

Every report is one grouped aggregation with partial aggregation before its
shuffle, so a hot visitor, network or session sends one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logtrail.functions import scores
from logtrail.functions.timeparts import iso_zulu, parse_utc
from logtrail.schemas import GOLD_COLUMNS, conform


def with_time(silver: DataFrame) -> DataFrame:
    return silver.withColumn("event_ts", parse_utc(F.col("timestamp_utc")))


def gold_projection(silver: DataFrame) -> DataFrame:
    """The 37 columns of the rows kept for analysis."""
    return conform(silver.where("manter_para_analise"), GOLD_COLUMNS, "Gold")


def scored(silver: DataFrame, site_host: str) -> DataFrame:
    """HTTP accesses with both scores beside the Gold columns."""
    kept = silver.where(F.col("manter_para_analise") & F.col("is_http_event"))
    return kept.select(
        *GOLD_COLUMNS,
        scores.suspicion_score(site_host).alias("suspicion_score"),
        scores.human_probability().alias("human_probability"),
    )


def visitor_recurrence(silver: DataFrame) -> DataFrame:
    return with_time(silver).groupBy("visitor_id").agg(
        F.count(F.lit(1)).alias("accesses"),
        iso_zulu(F.min("event_ts")).alias("first_seen"),
        iso_zulu(F.max("event_ts")).alias("last_seen"),
        F.count_distinct("site_session_id").alias("sessions"),
        (F.count(F.lit(1)) > 1).alias("is_recurrent"),
    )


def session_metrics(silver: DataFrame) -> DataFrame:
    timed = with_time(silver)
    return timed.groupBy("site_session_id").agg(
        F.count(F.lit(1)).alias("accesses"),
        iso_zulu(F.min("event_ts")).alias("started"),
        iso_zulu(F.max("event_ts")).alias("ended"),
        (F.unix_millis(F.max("event_ts")) - F.unix_millis(F.min("event_ts"))).alias("duration_ms"),
        F.count_distinct("visitor_id").alias("visitors"),
        F.count_if("aguardando_criacao").alias("refresh_count"),
        F.coalesce(F.bool_or("disparou_apply"), F.lit(False)).alias("provisioned"),
        F.coalesce(F.bool_or("disparou_destroy"), F.lit(False)).alias("destroyed"),
    )


def isolated_sessions(silver: DataFrame) -> DataFrame:
    """Sessions of one access, counted by visitor type."""
    single = silver.groupBy("site_session_id").agg(
        F.count(F.lit(1)).alias("accesses"), F.max("visitor_type").alias("visitor_type")
    )
    return single.where("accesses = 1").groupBy("visitor_type").agg(F.count(F.lit(1)).alias("isolated_sessions"))


def country_check(silver: DataFrame) -> DataFrame:
    """Edge country against geo country."""
    known = (F.col("pais_cf") != "") & (F.col("geo_country_code") != "")
    return (
        silver.where("is_http_event")
        .groupBy("pais_cf", "geo_country_code")
        .agg(
            F.count(F.lit(1)).alias("accesses"),
            F.count_if(known & (F.col("pais_cf") != F.col("geo_country_code"))).alias("mismatches"),
        )
    )


def forwarded_check(silver: DataFrame) -> DataFrame:
    forwarded = F.col("x_forwarded_for")
    return silver.where("is_http_event").select(
        "request_id",
        "ip",
        "x_forwarded_for",
        scores.forwarded_count(forwarded).alias("forwarded_count"),
        scores.forwarded_mismatch(forwarded, F.col("ip")).alias("forwarded_mismatch"),
    )


def request_flags(silver: DataFrame, site_host: str) -> DataFrame:
    return silver.where("is_http_event").select(
        "request_id",
        (F.col("host") != site_host).alias("wrong_host"),
        (F.col("method") != "GET").alias("other_method"),
        scores.is_scanner_path(F.col("raw_path")).alias("scanner_path"),
        scores.odd_query(F.col("raw_query_string")).alias("odd_query"),
        scores.fetch_site_meaning(F.col("sec_fetch_site")).alias("fetch_site_meaning"),
    )


def fetch_site_breakdown(silver: DataFrame) -> DataFrame:
    return (
        silver.where("is_http_event")
        .groupBy("sec_fetch_site", scores.fetch_site_meaning(F.col("sec_fetch_site")).alias("meaning"))
        .agg(F.count(F.lit(1)).alias("accesses"))
    )


def daily_lifecycle(silver: DataFrame) -> DataFrame:
    return silver.groupBy(F.col("timestamp_utc").substr(1, 10).alias("day")).agg(
        F.count(F.lit(1)).alias("executions"),
        F.count_if("disparou_apply").alias("provisioned"),
        F.count_if("disparou_destroy").alias("destroyed"),
        F.count_if("deploy_avoided").alias("deploys_avoided"),
        F.count_if("renovou_timeout").alias("timeouts_renewed"),
    )


def timeout_respected(silver: DataFrame) -> DataFrame:
    """Destroys with their expiration, and whether it had passed."""
    expiration = parse_utc(F.col("expiration_time"))
    return with_time(silver).where("disparou_destroy").select(
        "request_id",
        "bucket_name",
        "timestamp_utc",
        "expiration_time",
        (F.col("event_ts") >= expiration).alias("timeout_respected"),
    )


def network_breakdown(silver: DataFrame) -> DataFrame:
    return silver.groupBy("network_type", "geo_provider", "geo_asn").agg(
        F.count(F.lit(1)).alias("accesses"),
        F.count_distinct("visitor_id").alias("visitors"),
        F.count_if("is_cloud_provider").alias("cloud"),
        F.count_if("is_known_scanner_network").alias("scanner_network"),
    )


def browser_breakdown(silver: DataFrame) -> DataFrame:
    return silver.groupBy("browser_family", "device_type", "visitor_type").agg(
        F.count(F.lit(1)).alias("accesses"),
        F.count_if("is_scanner_user_agent").alias("scanners"),
        F.count_if("is_social_preview").alias("previews"),
    )


def divergence_summary(silver: DataFrame) -> DataFrame:
    return silver.groupBy("geo_divergence_severity").agg(
        F.count(F.lit(1)).alias("accesses"), F.count_if("geo_sources_divergent").alias("divergent")
    )
