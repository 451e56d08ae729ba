"""Life cycles of the environment: apply .. destroy -> site_session_id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logtrail.functions.identity import session_hash
from logtrail.operators.carry import RANGE_ROWS, WIDTH, Mark, cut, running_last
from logtrail.operators.visitors import BEFORE_ALL

# Order of the records of a site; `_t` is the time in microseconds.
TIES = ["log_stream", "start_ts", "request_id"]
BOUNDARY_COLUMNS = ["request_id", "event_ts", "log_stream", "start_ts", "disparou_apply", "disparou_destroy"]


def opens() -> Column:
    return F.coalesce("disparou_apply", F.lit(False))


def closes() -> Column:
    return F.coalesce("disparou_destroy", F.lit(False))


def time_key() -> Column:
    return F.coalesce(F.unix_micros("event_ts"), F.lit(BEFORE_ALL))


def boundaries(records: DataFrame) -> DataFrame:
    """The rows that open or close a cycle."""
    return records.where(opens() | closes()).select(*BOUNDARY_COLUMNS)


def assign_sessions(
    records: DataFrame,
    chunk: str = WIDTH,
    source: DataFrame | None = None,
    history: DataFrame | None = None,
    rows: int = RANGE_ROWS,
) -> DataFrame:
    """A row belongs to the last apply at or before it, unless a destroy lies
    strictly before the row and at or after that apply; else to itself.

    The order is over all records of the site, so the scan runs in ranges of rows
    (see carry.py). `source` may be a written stage with the same rows. `history`
    holds boundary rows of earlier runs; they open and close cycles but are not
    returned.
    """

    def keyed(df: DataFrame, is_new: bool) -> DataFrame:
        return df.withColumn("_t", time_key()).withColumn("_new", F.lit(is_new))

    def with_history(df: DataFrame) -> DataFrame:
        if history is None:
            return keyed(df, True)
        return keyed(df, True).unionByName(keyed(history, False), allowMissingColumns=True)

    measured = with_history(source if source is not None else records)
    marks = [Mark("_apply", opens(), []), Mark("_destroy", closes(), [], include_current=False)]
    marked = running_last(
        with_history(records), cut(measured, [], "_t", TIES, chunk, rows), marks,
        summary_source=measured if source is not None else None,
    )
    in_cycle = F.col("_apply").isNotNull() & (
        F.col("_destroy").isNull() | (F.col("_apply") > F.col("_destroy"))
    )
    owner = F.when(in_cycle, F.col("_apply.request_id")).otherwise(F.col("request_id"))
    return (
        marked.where("_new").withColumn("site_session_id", session_hash(owner)).drop("_t", "_new", "_apply", "_destroy")
    )
