"""One query per operator over the log lines derived from the events table."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from logtrail.functions import addresses, identity, jsontext, timeparts, useragents
from logtrail.operators import blocks, classify, dedup, extract, geo, sessions, visitors
from logtrail.plans import gold, silver
from logtrail.schemas import GEO_COLUMNS, GEO_RECORD_SCHEMA
from logtrail.session import configure, write_stage
from testbed import fixture

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query, name: str | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), str(sf_dir).rstrip("/"))

    REGISTRY[name or function.__name__] = run
    return function


# --- stages -----------------------------------------------------------------


def events_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_events(fixture.bronze(spark, sf_dir))


def executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = fixture.bronze(spark, sf_dir)
    return blocks.build_blocks(dedup.dedup_events(blocks.line_columns(bronze)), measured=bronze)


def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_accesses(executions(spark, sf_dir))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.classify_accesses(extracted(spark, sf_dir))


def visited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visitors.enrich_visitors(classified(spark, sf_dir)).drop("block_text")


def addresses_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.distinct_ips(extracted(spark, sf_dir))


def geo_inputs(spark: SparkSession, sf_dir: str) -> silver.GeoInputs:
    return silver.GeoInputs(
        fixture.city_blocks(spark, sf_dir),
        fixture.asn_blocks(spark, sf_dir),
        fixture.geo_cache(spark, sf_dir),
        geo.second_source_records(fixture.second_responses(spark, sf_dir)),
    )


@cache
def _silver_table(application: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = write_stage(fixture.bronze(spark, sf_dir), "bronze")
    return write_stage(silver.build_silver(bronze, geo_inputs(spark, sf_dir)).rows, "silver")


def silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Silver table. Reports read a table, as after a Silver run; it is built
    from the events once per application and kept in the shared folder."""
    return _silver_table(spark.sparkContext.applicationId, spark, sf_dir)


# --- Bronze -----------------------------------------------------------------


@query
def bronze_rows(spark, sf_dir):
    return fixture.bronze(spark, sf_dir)


@query
def bronze_by_date(spark, sf_dir):
    bronze = fixture.bronze(spark, sf_dir)
    parts = timeparts.date_parts(timeparts.event_time(bronze))
    return bronze.groupBy(*parts, "collection_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("message_size").alias("message_bytes"),
        F.min("timestamp_ms").alias("first_ms"),
        F.max("timestamp_ms").alias("last_ms"),
    )


@query
def dedup_events(spark, sf_dir):
    return events_once(spark, sf_dir).select("event_id", "timestamp_ms", "log_stream", "collection_id", "message")


# --- executions -------------------------------------------------------------


def block_rows(spark, sf_dir):
    micros = {name: F.unix_micros(name) for name in ("start_ts", "end_ts")}
    return executions(spark, sf_dir).withColumns(micros)


query(block_rows, "blocks")


@query
def blocks_closed_share(spark, sf_dir):
    return executions(spark, sf_dir).groupBy("log_stream").agg(
        F.count(F.lit(1)).alias("executions"),
        F.count_if("block_closed").alias("closed"),
        F.round(F.count_if("block_closed") / F.count(F.lit(1)), 4).alias("closed_share"),
    )


@query
def event_json_fields(spark, sf_dir):
    return extracted(spark, sf_dir).drop("block_text", "event_ts", "start_ts")


@query
def parse_errors(spark, sf_dir):
    return extracted(spark, sf_dir).groupBy("parse_status", "parse_error").agg(F.count(F.lit(1)).alias("executions"))


@query
def op_events(spark, sf_dir):
    ops = classify.with_operational_events(executions(spark, sf_dir))
    return (
        ops.select("request_id", F.posexplode("ops").alias("position", "op"))
        .select(
            "request_id",
            "position",
            F.col("op.event").alias("event"),
            F.coalesce(jsontext.value_text(F.col("op.doc"), "$.bucket"), F.lit("")).alias("bucket"),
            F.coalesce(jsontext.value_text(F.col("op.doc"), "$.reason"), F.lit("")).alias("reason"),
        )
    )


@query
def classified_accesses(spark, sf_dir):
    return classified(spark, sf_dir).select(
        "request_id", "status_confianca", "motivo_confianca", "decision_user_agent", "bucket_name",
        "last_accessed_at", "expiration_time", "serviu_site", "aguardando_criacao", "renovou_timeout",
        "disparou_apply", "disparou_destroy", "origem_eventbridge", "active_site_untrusted_access",
        "estado_resposta", "manter_para_analise", "motivo_analise",
    )


@query
def estado_resposta(spark, sf_dir):
    return classified(spark, sf_dir).groupBy("estado_resposta", "motivo_analise", "block_closed").agg(
        F.count(F.lit(1)).alias("executions")
    )


@query
def event_type_priority(spark, sf_dir):
    return classified(spark, sf_dir).groupBy("event_type").agg(F.count(F.lit(1)).alias("executions"))


@query
def deploy_avoided(spark, sf_dir):
    avoided = classified(spark, sf_dir).where("deploy_avoided")
    return avoided.groupBy("motivo_confianca").agg(F.count(F.lit(1)).alias("deploys_avoided"))


# --- visitors ---------------------------------------------------------------


@query
def network_prefix(spark, sf_dir):
    return addresses_seen(spark, sf_dir).select(
        "ip", addresses.network_prefix(F.col("ip")).alias("network_prefix")
    )


@query
def browser_device(spark, sf_dir):
    agent = F.col("user_agent")
    return (
        extracted(spark, sf_dir)
        .groupBy(
            "user_agent",
            useragents.browser_family(agent).alias("browser_family"),
            useragents.device_type(agent).alias("device_type"),
        )
        .agg(F.count(F.lit(1)).alias("accesses"))
    )


@query
def ua_flags(spark, sf_dir):
    agent, range_header = F.col("user_agent"), F.col("range")
    return extracted(spark, sf_dir).select(
        "request_id",
        useragents.is_scanner_user_agent(agent).alias("is_scanner_user_agent"),
        useragents.is_social_preview(agent, range_header).alias("is_social_preview"),
    )


@query
def visitor_id(spark, sf_dir):
    return visited(spark, sf_dir).select("request_id", "network_prefix", "visitor_id")


@query
def visitor_type(spark, sf_dir):
    return visited(spark, sf_dir).groupBy("motivo_confianca", "visitor_type").agg(F.count(F.lit(1)).alias("accesses"))


@query
def destroy_visitor(spark, sf_dir):
    core = write_stage(visited(spark, sf_dir), "access-core")
    ends = visitors.propagate_visitors(core, source=core).where(visitors.is_destroy_event())
    return ends.select("request_id", "bucket_name", "visitor_id")


@query
def destroy_visitor_as_of(spark, sf_dir):
    core = write_stage(visited(spark, sf_dir), "access-core")
    ends = visitors.propagate_visitors_as_of(core).where(visitors.is_destroy_event())
    return ends.select("request_id", "bucket_name", "visitor_id")


@query
def site_sessions(spark, sf_dir):
    core = write_stage(visited(spark, sf_dir), "access-core")
    return sessions.assign_sessions(core, source=core).select("request_id", "timestamp_utc", "site_session_id")


# --- geo --------------------------------------------------------------------


@query
def distinct_ips(spark, sf_dir):
    return addresses_seen(spark, sf_dir)


@query
def first_seen_ips(spark, sf_dir):
    ordered = geo.distinct_ips_in_order(extracted(spark, sf_dir))
    return ordered.select("ip", F.col("position_key.request_id").alias("first_request_id"))


@query
def uncached_ips(spark, sf_dir):
    return geo.uncached_ips(addresses_seen(spark, sf_dir), fixture.geo_cache(spark, sf_dir))


@query
def geo_range_join(spark, sf_dir):
    return geo.lookup_networks(
        addresses_seen(spark, sf_dir), fixture.city_blocks(spark, sf_dir), fixture.asn_blocks(spark, sf_dir)
    )


@query
def geo_cache_upsert(spark, sf_dir):
    inputs = geo_inputs(spark, sf_dir)
    grown = geo.extend_cache(addresses_seen(spark, sf_dir), inputs.cache, inputs.city_blocks, inputs.asn_blocks)
    has_geo = F.coalesce(*[F.when(F.col(f.name).isNotNull(), True) for f in GEO_RECORD_SCHEMA.fields[1:]], F.lit(False))
    return grown.select("ip", "country_code", "city", "org", has_geo.alias("has_geo"))


@query
def second_source(spark, sf_dir):
    records = geo.second_source_records(fixture.second_responses(spark, sf_dir))
    return records.select("ip", "country_code", "city", "latitude", "longitude")


@query
def geo_enrich(spark, sf_dir):
    return silver_table(spark, sf_dir).select("request_id", "ip", *GEO_COLUMNS)


@query
def geo_divergence(spark, sf_dir):
    return silver_table(spark, sf_dir).select(
        "request_id", F.round("geo_distance_km", 3).alias("geo_distance_km"),
        "geo_divergence_severity", "geo_sources_divergent",
    )


@query
def silver_dedup(spark, sf_dir):
    return silver_table(spark, sf_dir).withColumn("geo_distance_km", F.round("geo_distance_km", 3))


# --- Gold -------------------------------------------------------------------


@query
def gold_projection(spark, sf_dir):
    return gold.gold_projection(silver_table(spark, sf_dir))


@query
def suspicion_score(spark, sf_dir):
    return gold.scored(silver_table(spark, sf_dir), fixture.SITE_HOST).select("request_id", "suspicion_score")


@query
def human_probability(spark, sf_dir):
    return gold.scored(silver_table(spark, sf_dir), fixture.SITE_HOST).select("request_id", "human_probability")


def _report(name: str, report: Callable[[DataFrame], DataFrame]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report(silver_table(spark, sf_dir))

    query(run, name)


_report("visitor_recurrence", gold.visitor_recurrence)
_report("session_metrics", gold.session_metrics)
_report("isolated_sessions", gold.isolated_sessions)
_report("country_check", gold.country_check)
_report("xff_check", gold.forwarded_check)
_report("request_flags", lambda table: gold.request_flags(table, fixture.SITE_HOST))
_report("fetch_site_breakdown", gold.fetch_site_breakdown)
_report("daily_lifecycle", gold.daily_lifecycle)
_report("timeout_respected", gold.timeout_respected)
_report("network_breakdown", gold.network_breakdown)
_report("browser_breakdown", gold.browser_breakdown)
_report("divergence_summary", gold.divergence_summary)
