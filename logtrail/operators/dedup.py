"""Keep-last deduplication.

row_number() = 1 is planned with a group limit on both sides of the shuffle:
each map task sends at most one row per key, so a key with very many copies
never gathers in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from logtrail.functions.timeparts import event_time, parse_utc

_RANK = "_rank"


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def dedup_events(bronze: DataFrame) -> DataFrame:
    """One row per event_id: the last by stream, time and collection; nulls sort last."""
    order = [F.col("log_stream").desc_nulls_first(), event_time(bronze).desc_nulls_first()]
    if "collection_id" in bronze.columns:
        order.append(F.col("collection_id").desc_nulls_last())
    return keep_first(bronze, ["event_id"], order)


def dedup_accesses(records: DataFrame) -> DataFrame:
    """One row per request_id: a complete execution before a cut one, then the latest."""
    order = [
        F.col("block_closed").desc(),
        F.col("log_stream").desc_nulls_last(),
        F.col("start_ts").desc_nulls_first() if "start_ts" in records.columns else parse_utc(F.col("timestamp_utc")).desc_nulls_last(),
    ]
    return keep_first(records, ["request_id"], order)
