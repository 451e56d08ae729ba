"""Log lines -> one row per execution (START .. END)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from logtrail.functions.timeparts import event_time
from logtrail.operators.carry import RANGE_ROWS, WIDTH, Ranges, carry_back, cut
from logtrail.operators.once import compute_once
from logtrail.schemas import BLOCK_COLUMNS

# The marks that delimit an execution, and the id behind a mark.
START_MARK = "START RequestId:"
END_MARK = "END RequestId:"
# In both marks, so a line without it needs no search for either.
IN_BOTH_MARKS = " RequestId:"
ID_AFTER_MARK = r"\s*(\S+)"

# Lines without a time sort after all others of their stream.
NO_TIME = 2**63 - 1


def request_id_after(mark: str, message: Column) -> Column:
    """The id behind the mark, '' without one. Most lines lack the mark and skip the regex."""
    return F.when(message.contains(mark), F.regexp_extract(message, mark + ID_AFTER_MARK, 1)).otherwise("")


def line_columns(bronze: DataFrame) -> DataFrame:
    """The Bronze columns that deduplication and assembly need, with one time column.

    The time is a timestamp under the name of its text form, which is made or read
    only for rows without milliseconds and does not pass the shuffles.
    """
    names = [name for name in ("event_id", "log_stream", "log_group", "message", "collection_id") if name in bronze.columns]
    return bronze.select(*names, event_time(bronze).alias("timestamp_utc"))


def log_lines(events: DataFrame) -> DataFrame:
    """Deduplicated Bronze rows -> the columns block assembly needs.

    Rows without a stream belong to no execution and are left out; count them
    with streamless_lines().
    """
    group = F.col("log_group") if "log_group" in events.columns else F.lit("")
    message = F.coalesce("message", F.lit(""))
    return events.where(F.col("log_stream").isNotNull()).select(
        "log_stream",
        F.coalesce(group, F.lit("")).alias("log_group"),
        F.coalesce(F.unix_micros(event_time(events)), F.lit(NO_TIME)).alias("t"),
        "event_id",
        message.alias("message"),
    )


def streamless_lines(events: DataFrame) -> DataFrame:
    return events.where(F.col("log_stream").isNull())


STREAM, ORDER = ["log_stream"], ["t", "event_id"]


def cut_streams(measured: DataFrame, chunk: str = WIDTH, rows: int = RANGE_ROWS) -> Ranges:
    """Ranges of the log lines; `measured` may be the lines before deduplication."""
    return cut(log_lines(measured), STREAM, "t", ["event_id"], chunk, rows)


def assign_starts(lines: DataFrame, ranges: Ranges | None = None) -> DataFrame:
    """Give every line the START it belongs to; lines before the first START go.

    A line with both patterns is a START. Two marks are carried across the ranges
    of a stream: the last START, and whether its END has been seen, so that lines
    behind an END go here, in whatever range they lie. Only where a foreign END
    comes between may some stay; assemble() cuts those.
    """
    ranges = ranges or Ranges(STREAM, "t", ["event_id"])

    def id_after(mark: str) -> Column:
        return F.when(F.col("may_mark"), request_id_after(mark, F.col("message"))).otherwise("")

    # Decided once, below the shuffle that the window and the summary share.
    lines = lines.withColumn("may_mark", F.col("message").contains(IN_BOTH_MARKS))
    start_id = id_after(START_MARK)
    start = F.when(start_id != "", F.struct(*ORDER, start_id.alias("request_id"), "log_group"))
    end_id = F.when(start_id != "", "").otherwise(id_after(END_MARK))
    end = F.when(end_id != "", F.struct(*ORDER, end_id.alias("end_id")))
    spec = ranges.window()
    upto = spec.rowsBetween(Window.unboundedPreceding, 0)
    before = spec.rowsBetween(Window.unboundedPreceding, -1)

    here = ranges.dealt(lines).withColumn("own", F.last(start, ignorenulls=True).over(upto)).withColumn("end_id", end_id)
    closes = F.col("end_id") == F.col("own.request_id")
    here = here.withColumns({
        "closed": F.last(F.when(closes, F.struct("own.t", "own.event_id")), ignorenulls=True).over(before),
        "first_end": F.first(F.when(F.col("end_id") != "", F.col("end_id")), ignorenulls=True).over(before),
    })
    here = here.where(F.coalesce(F.col("closed") != F.struct("own.t", "own.event_id"), F.lit(True))).drop("closed", "may_mark")

    # The aggregation sorts its rows, so they leave their texts behind before it.
    marks = ranges.dealt(lines).select(*ranges.grouping, start.alias("start"), end.alias("end")).transform(compute_once, ["start", "end"])
    summary = marks.groupBy(*ranges.grouping).agg(
        F.max("start").alias("start"), F.min("end").alias("first_end"), F.max("end").alias("last_end")
    )
    along = ranges.across()
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("carried", F.last("start", ignorenulls=True).over(earlier))
    ended_own = (F.struct("last_end.t", "last_end.event_id") > F.struct("start.t", "start.event_id")) & (
        F.col("last_end.end_id") == F.col("start.request_id")
    )
    ended_carried = F.col("carried.request_id").isin(F.col("first_end.end_id"), F.col("last_end.end_id"))
    ends = F.coalesce(F.when(F.col("start").isNotNull(), ended_own).otherwise(ended_carried), F.lit(False))
    left_open = F.coalesce("start", "carried")
    running = Window.partitionBy(*STREAM, "open.t", "open.event_id").orderBy(*ranges.places).rowsBetween(Window.unboundedPreceding, 0)
    summary = summary.withColumns({"open": left_open, "ends": ends}).withColumn("over", F.max("ends").over(running))
    summary = summary.withColumn("over", F.coalesce(F.lag("over").over(along), F.lit(False)))

    joined = carry_back(here, summary, ranges, ["carried", "over"])
    behind = F.col("own").isNull() & (F.col("over") | (F.col("first_end") == F.col("carried.request_id")))
    return (
        joined.where(~F.coalesce(behind, F.lit(False)))
        .withColumn("start", F.coalesce("own", "carried"))
        .where(F.col("start").isNotNull())
        .drop("own", "carried", "over", "first_end", *ranges.places)
    )


def assemble(marked: DataFrame) -> DataFrame:
    """Group the lines of each execution and join them in order.

    assign_starts() has dropped the lines behind the END, but for those a foreign
    END has hidden; the window cuts these, so a group has the size of one output
    text. Window and group share one shuffle.
    Two technical columns stay: start_t and start_event_id, the key of the START.
    """
    keyed = marked.withColumns({"start_t": F.col("start.t"), "start_event_id": F.col("start.event_id")})
    closes = F.col("end_id") == F.col("start.request_id")
    execution = ["log_stream", "start_t", "start_event_id"]
    end = F.min(F.when(closes, F.struct("t", "event_id"))).over(Window.partitionBy(*execution))
    grouped = (
        keyed.withColumn("end", end)
        .where(F.col("end").isNull() | (F.struct("t", "event_id") <= F.col("end")))
        .groupBy(*execution)
        .agg(
            F.max("start.request_id").alias("request_id"),
            F.max("start.log_group").alias("log_group"),
            F.sort_array(F.collect_list(F.struct("t", "event_id", "message"))).alias("lines"),
            F.max("end").alias("end"),
        )
    )
    return grouped.select(
        "request_id",
        "log_group",
        "log_stream",
        F.when(F.col("start_t") != NO_TIME, F.timestamp_micros("start_t")).alias("start_ts"),
        F.when(F.col("end.t") != NO_TIME, F.timestamp_micros("end.t")).alias("end_ts"),
        F.col("end").isNotNull().alias("block_closed"),
        F.array_join(F.transform("lines", lambda line: line["message"]), "\n").alias("block_text"),
        "start_t",
        "start_event_id",
    )


def build_blocks(
    events: DataFrame, chunk: str = WIDTH, rows: int = RANGE_ROWS, measured: DataFrame | None = None
) -> DataFrame:
    """Deduplicated Bronze rows -> the seven block columns.

    `measured` (the rows before deduplication) is what the ranges are cut by.
    """
    ranges = cut_streams(events if measured is None else measured, chunk, rows)
    return assemble(assign_starts(log_lines(events), ranges)).select(*BLOCK_COLUMNS)
