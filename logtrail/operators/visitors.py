"""Visitor columns and the visitor a destroy event inherits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logtrail.functions import addresses, identity, useragents
from logtrail.operators.carry import RANGE_ROWS, WIDTH, Mark, cut, running_last
from logtrail.operators.dedup import keep_first
from logtrail.operators.once import join_key

# Placeholder bucket name, states of the scheduled check.
PLACEHOLDER_BUCKET = "TEMPORARIO"
TIMEOUT_STATES = ["eventbridge_timeout", "eventbridge_destroy"]

# A time before all others, for accesses without one.
BEFORE_ALL = -(2**63)


def _text(df: DataFrame, name: str) -> Column:
    return F.coalesce(name, F.lit("")) if name in df.columns else F.lit("")


def enrich_visitors(records: DataFrame) -> DataFrame:
    agent = _text(records, "user_agent")
    return records.withColumn("network_prefix", addresses.network_prefix(_text(records, "ip"))).withColumns(
        {
            "browser_family": useragents.browser_family(agent),
            "device_type": useragents.device_type(agent),
            "is_scanner_user_agent": useragents.is_scanner_user_agent(agent),
            "is_social_preview": useragents.is_social_preview(agent, _text(records, "range")),
            "visitor_type": identity.visitor_type(_text(records, "motivo_confianca")),
            "visitor_id": identity.visitor_id(F.col("network_prefix"), agent),
        }
    )


def is_real_bucket(bucket: Column) -> Column:
    return F.coalesce((bucket != "") & (bucket != PLACEHOLDER_BUCKET), F.lit(False))


def is_destroy_event() -> Column:
    ends = F.coalesce("disparou_destroy", F.lit(False)) | F.coalesce(
        F.col("estado_resposta").isin(TIMEOUT_STATES), F.lit(False)
    )
    return is_real_bucket(F.col("bucket_name")) & ends


def latest_visitors(records: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """The latest visitor of each real bucket, of the records and of earlier runs; equal
    times go to the first record.

    Top-1 per bucket with a map-side limit, so a hot bucket sends one row per map task.
    """
    candidates = records.where(
        is_real_bucket(F.col("bucket_name")) & ~is_destroy_event() & (F.coalesce("visitor_id", F.lit("")) != "")
    ).select("bucket_name", "visitor_id", "event_ts", "log_stream", "start_ts", "request_id")
    if history is not None:
        candidates = candidates.unionByName(history.select(*candidates.columns))
    return last_of_buckets(candidates)


def last_of_buckets(candidates: DataFrame) -> DataFrame:
    order = [F.col("event_ts").desc_nulls_last(), F.col("log_stream"), F.col("start_ts"), F.col("request_id")]
    return keep_first(candidates, ["bucket_name"], order)


def bucket_visitors(records: DataFrame, history: DataFrame | None = None) -> DataFrame:
    return latest_visitors(records, history).select(
        join_key("bucket_name").alias("_bucket"), F.col("visitor_id").alias("_bucket_visitor")
    )


def propagate_visitors(
    records: DataFrame, source: DataFrame | None = None, history: DataFrame | None = None
) -> DataFrame:
    """Destroy and timeout events take the latest visitor of their bucket in the
    whole batch or in `history` (latest_visitors of earlier runs); without a
    candidate they keep their own.

    `records` is read twice: only the events that inherit are joined, the others
    pass as they are. `source` may be a written stage with the same rows, so the
    argmax pass reads only its six columns.
    """
    latest = bucket_visitors(source if source is not None else records, history)
    ends = records.where(is_destroy_event()).join(latest, F.col("bucket_name") == F.col("_bucket"), "left")
    inherited = ends.withColumn("visitor_id", F.coalesce("_bucket_visitor", "visitor_id")).select(records.columns)
    return records.where(~is_destroy_event()).unionByName(inherited)


def propagate_visitors_as_of(records: DataFrame, chunk: str = WIDTH, rows: int = RANGE_ROWS) -> DataFrame:
    """Variant: only visitors at or before the destroy itself count (as-of per bucket)."""
    source = ~is_destroy_event() & is_real_bucket(F.col("bucket_name"))
    # Only real buckets are searched; other rows spread over keys of their own.
    keyed = records.withColumn(
        "_t", F.coalesce(F.unix_micros("event_ts"), F.lit(BEFORE_ALL))
    ).withColumn(
        "_bucket_key",
        F.when(is_real_bucket(F.col("bucket_name")), F.col("bucket_name")).otherwise(
            F.concat(F.lit("\u0000"), F.coalesce("request_id", F.lit("")))
        ),
    )
    seen = Mark("_seen", source, [F.col("visitor_id").alias("visitor_id")])
    marked = running_last(keyed, cut(keyed, ["_bucket_key"], "_t", ["log_stream", "start_ts", "request_id"], chunk, rows), [seen])
    inherits = is_destroy_event() & F.col("_seen").isNotNull()
    return marked.withColumn(
        "visitor_id", F.when(inherits, F.col("_seen.visitor_id")).otherwise(F.col("visitor_id"))
    ).drop("_t", "_bucket_key", "_seen")
