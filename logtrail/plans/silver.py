"""Bronze -> Silver."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from logtrail.operators.blocks import build_blocks, line_columns
from logtrail.operators.carry import RANGE_ROWS, WIDTH, Mark, cut, running_last
from logtrail.operators.classify import classify_accesses
from logtrail.operators.dedup import dedup_accesses, dedup_events, keep_first
from logtrail.operators.extract import extract_accesses
from logtrail.operators.geo import attach_geo, distinct_ips, fresh_records, geo_dimension, second_source_records
from logtrail.operators.once import join_key
from logtrail.operators.sessions import TIES, assign_sessions, boundaries, closes, opens, time_key
from logtrail.operators.visitors import BEFORE_ALL, enrich_visitors, is_destroy_event, last_of_buckets, latest_visitors, propagate_visitors
from logtrail.functions.timeparts import event_time, parse_utc
from logtrail.plans.counts import RunCounts
from logtrail.schemas import GEO_RECORD_SCHEMA
from logtrail.session import stages_of_run, write_stage
from logtrail.sources.bronze import BRONZE_PARTITIONS, read_bronze
from logtrail.sources.geo_tables import append_geo_cache, read_geo_cache
from logtrail.sources.ledger import commit_files, parquet_files, partitions_of, pending_files, read_ledger
from logtrail.sources.paths import path_exists, read_parquet_or_empty
from logtrail.sources.registers import (
    VISITOR_SCHEMA, boundaries_path, destroys_path, read_boundaries, read_destroys, read_runs, told_path, visitors_path,
    write_run,
)
from logtrail.sources.silver import day_of, days_of, merge_silver, read_days, silver_days, silver_rows

STAGE = "bronze_to_silver"
OPEN_SCHEMA = "log_stream string, start_ts timestamp"


def accesses_of(blocks: DataFrame) -> DataFrame:
    """Executions -> classified accesses with visitor columns; the wide text ends here."""
    return (
        extract_accesses(blocks).transform(classify_accesses).transform(enrich_visitors).drop("block_text")
    )


def access_core(bronze: DataFrame, chunk: str = WIDTH, rows: int = RANGE_ROWS, counts: RunCounts | None = None) -> DataFrame:
    """Bronze rows -> accesses. The pass that sizes the ranges also counts the rows read."""
    streamless = F.count_if(F.col("log_stream").isNull())
    measured = counts.on(bronze, events=F.count(F.lit(1)), streamless_lines=streamless) if counts else bronze
    return dedup_events(line_columns(bronze)).transform(build_blocks, chunk, rows, measured).transform(accesses_of)


@dataclass(frozen=True)
class GeoInputs:
    city_blocks: DataFrame
    asn_blocks: DataFrame
    cache: DataFrame
    second: DataFrame


@dataclass(frozen=True)
class SilverResult:
    """core: the accesses as built; records: the Silver rows; fresh: addresses looked up; latest: last visitor of each bucket."""

    core: DataFrame
    records: DataFrame
    fresh: DataFrame
    latest: DataFrame

    @property
    def rows(self) -> DataFrame:
        return silver_rows(self.records)


@dataclass(frozen=True)
class History:
    """What earlier runs left: boundary rows of cycles, and the latest visitor of each bucket."""

    boundaries: DataFrame | None = None
    visitors: DataFrame | None = None


def build_silver(
    bronze: DataFrame, geo_inputs: GeoInputs, chunk: str = WIDTH, history: History = History(), counts: RunCounts | None = None
) -> SilverResult:
    """The Silver records of one batch of Bronze rows."""
    return finish_silver(access_core(bronze, chunk, counts=counts), geo_inputs, chunk, history, counts)


def finish_silver(
    accesses: DataFrame, geo_inputs: GeoInputs, chunk: str = WIDTH, history: History = History(), counts: RunCounts | None = None
) -> SilverResult:
    """Sessions, inherited visitors, deduplication, geolocation.

    The core is written once to the shared folder: the session summary, the
    bucket argmax, the distinct addresses and the main pass each read only their
    own columns of it. Deduplication runs before the geo join; geo columns depend
    on the address alone, so the result is the same with fewer rows joined.
    """
    counts = counts or RunCounts()
    one = F.count(F.lit(1))
    core = write_stage(counts.on(accesses, executions=one, closed=F.count_if("block_closed")), "access-core")
    with_visitors = propagate_visitors(core, source=core, history=history.visitors)
    others = None if history.boundaries is None else without(history.boundaries, core)
    sessions = assign_sessions(with_visitors, chunk, source=core, history=others)
    unique = dedup_accesses(sessions)
    ips = write_stage(counts.on(distinct_ips(core), addresses=one), "ips")
    looked_up = fresh_records(ips, geo_inputs.cache, geo_inputs.city_blocks, geo_inputs.asn_blocks)
    fresh = write_stage(counts.on(looked_up, new_addresses=one), "geo-fresh")
    names = GEO_RECORD_SCHEMA.fieldNames()
    known = geo_inputs.cache.select(*names).unionByName(fresh.select(*names))
    records = attach_geo(unique, geo_dimension(ips, known, geo_inputs.second))
    return SilverResult(core, records, fresh, latest_visitors(core, history.visitors))


EXECUTION = ["request_id", "log_stream", "start_ts"]


def without(known: DataFrame, again: DataFrame) -> DataFrame:
    """Rows of `known` whose execution is not among the boundaries of `again`, so that each stands once."""
    keys = boundaries(again).select(*[F.col(name).alias(f"_{name}") for name in EXECUTION])
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in EXECUTION]
    return known.join(keys, same, "left_anti")


# --- what a run changes in rows stored before --------------------------------


def read_visitors(spark: SparkSession, silver_base: str, before: str | None = None) -> DataFrame:
    """Latest visitor of each bucket as of the runs before."""
    return last_of_buckets(read_runs(spark, visitors_path(silver_base), VISITOR_SCHEMA, before))


def last_of_runs(spark: SparkSession, silver_base: str, before: str | None = None) -> DataFrame:
    """bucket_name, visitor_id that the latest run told the destroys of the bucket."""
    if not path_exists(spark, told_path(silver_base)):
        return spark.createDataFrame([], VISITOR_SCHEMA)
    runs = spark.read.schema(T.StructType([*VISITOR_SCHEMA.fields, T.StructField("run", T.StringType())])).parquet(told_path(silver_base))
    runs = runs if before is None else runs.where(F.col("run") != before)
    return keep_first(runs, ["bucket_name"], [F.col("run").desc()]).select(*VISITOR_SCHEMA.fieldNames())


def changed_visitors(latest: DataFrame, before: DataFrame) -> DataFrame:
    """Rows of `latest` whose bucket had another visitor before, or none."""
    old = before.select(F.col("bucket_name").alias("_bucket"), F.col("visitor_id").alias("_before"))
    joined = latest.join(old, F.col("bucket_name") == F.col("_bucket"), "left")
    return joined.where(F.col("_before").isNull() | (F.col("_before") != F.col("visitor_id"))).drop("_bucket", "_before")


def days_with_new_rule(spark: SparkSession, days: set[str], stored: DataFrame, added: DataFrame) -> set[str]:
    """Stored days in which the last boundary before some row may be one of `added`.

    These are the days that hold an added boundary, and those before whose first
    moment the last boundary is an added one: the interval that it rules, up to
    the next boundary. Boundaries and one marker a day are ordered, no record is.
    """
    if not days:
        return set()
    names = [*EXECUTION, "_t", "added", "day"]
    markers = spark.createDataFrame([(day,) for day in sorted(days)], "day string").withColumn(
        "_t", F.coalesce(F.unix_micros(F.try_to_timestamp("day")), F.lit(BEFORE_ALL))
    )
    known, new = (df.select(*EXECUTION, time_key().alias("_t"), F.lit(flag).alias("added")) for df, flag in ((without(stored, added), False), (added, True)))
    rows = known.unionByName(new).withColumn("day", F.lit(None).cast("string"))
    marked = rows.unionByName(markers, allowMissingColumns=True).select(*names)
    marked = write_stage(marked, "boundaries-and-days")
    last = Mark("_last", F.col("day").isNull(), [F.col("added").alias("added")], include_current=False)
    ruled = running_last(marked, cut(marked, [], "_t", TIES), [last]).where("day IS NOT NULL AND _last.added").select("day")
    return days_of(ruled, F.col("day")) | (days_of(added, day_of(F.col("event_ts"))) & days)


def sessions_again(stored: DataFrame, days: set[str], boundary_rows: DataFrame, chunk: str = WIDTH) -> DataFrame:
    """_request, _stream, _session of the stored rows of `days` under all boundaries.

    Boundaries come from their register alone, each once, with the start times that
    Silver does not hold; other rows of one stream at one moment go by request id.
    """
    timed = stored.withColumn("event_ts", parse_utc(F.col("timestamp_utc")))
    rows = timed.where(~(opens() | closes())).withColumn("start_ts", F.col("event_ts")).select(*boundary_rows.columns)
    inside = day_of(F.col("event_ts")).isin(sorted(days))
    records = rows.unionByName(boundary_rows.where(inside))
    found = assign_sessions(records, chunk, history=boundary_rows.where(~inside))
    # Of several executions of one request in one stream, Silver holds the last.
    latest = F.max_by("site_session_id", F.struct("start_ts", "event_ts"))
    return found.groupBy(F.col("request_id").alias("_request"), F.col("log_stream").alias("_stream")).agg(latest.alias("_session"))


def store_run(
    spark: SparkSession, result: SilverResult, silver_base: str, run_id: str, history: History, chunk: str = WIDTH,
    counts: RunCounts | None = None, replace: bool = False, waiting: DataFrame | None = None,
) -> DataFrame:
    """Merge the records of a run and mend what it changes in rows stored before.

    A bucket whose latest visitor changed gives it to its stored destroys, and a
    boundary that comes late gives the rows it rules their session again. Only the
    days of these rows are read and rewritten, found in registers that are far
    narrower and shorter than Silver. The registers are written first: they may
    hold more than Silver, never less, if a run breaks off and is repeated. With
    `replace` the records take the place of stored ones even where they are less complete.
    Executions that wait for lines of a later run (`waiting`) are read again with
    it, so their visitors count now but are not registered.
    """
    counts = counts or RunCounts()
    own = write_stage(boundaries(result.core), "own-boundaries")
    write_run(own, boundaries_path(silver_base), run_id)
    settled = result.core
    if waiting is not None:
        settled = settled.join(waiting.select("log_stream", "start_ts"), ["log_stream", "start_ts"], "left_anti")
    write_run(changed_visitors(latest_visitors(settled, history.visitors), history.visitors), visitors_path(silver_base), run_id)
    told = last_of_runs(spark, silver_base, run_id)
    changed = write_stage(changed_visitors(result.latest, told), "changed-visitors")
    write_run(changed.select(*VISITOR_SCHEMA.fieldNames()), told_path(silver_base), run_id)
    ends = result.core.where(is_destroy_event())
    write_run(ends.select("bucket_name", "request_id", day_of(F.col("event_ts")).alias("day")), destroys_path(silver_base), run_id)

    there = silver_days(spark, silver_base)
    hanging = read_destroys(spark, silver_base).join(changed, "bucket_name", "left_semi")
    visitor_days = (days_of(hanging, F.col("day")) & there) if there else set()
    session_days = days_with_new_rule(spark, there, history.boundaries, own)
    sessions = None
    if session_days:
        every = read_boundaries(spark, silver_base)
        sessions = write_stage(sessions_again(read_days(spark, silver_base, session_days), session_days, every, chunk), "sessions-again")

    def amend(merged: DataFrame) -> DataFrame:
        old = F.col("_new") == 0
        if visitor_days:
            heirs = changed.select(join_key("bucket_name").alias("_bucket"), F.col("visitor_id").alias("_heir"))
            merged = merged.withColumn("_ends", F.when(old & is_destroy_event(), F.col("bucket_name"))).join(
                heirs, F.col("_ends") == F.col("_bucket"), "left"
            )
            merged = merged.withColumn("visitor_id", F.coalesce("_heir", "visitor_id")).drop("_ends", "_bucket", "_heir")
        if sessions is not None:
            same = (F.col("request_id") == F.col("_request")) & (F.col("log_stream") == F.col("_stream"))
            merged = merged.join(sessions, same, "left").withColumn(
                "site_session_id", F.when(old, F.coalesce("_session", "site_session_id")).otherwise(F.col("site_session_id"))
            ).drop("_request", "_stream", "_session")
        return merged

    def observe(merged: DataFrame) -> DataFrame:
        new = F.col("_new") == 1
        return counts.on(merged, records=F.count_if(new), divergent=F.count_if(new & F.col("geo_sources_divergent")))

    return merge_silver(result.records, silver_base, amend, visitor_days | session_days, observe, replace)


# --- incremental runs -----------------------------------------------------------


def open_executions(core: DataFrame) -> DataFrame:
    """Streams whose last execution has not ended yet, with its start.

    Each is waited for until it ends, however old it is: the rows of a run may lie
    at any dates. `stale_before` of run_silver gives up those that started earlier
    and lists them in a reject table.
    """
    last = core.groupBy("log_stream").agg(
        F.max(F.struct("start_ts", "request_id", "block_closed")).alias("last")
    )
    return last.where(~F.col("last.block_closed")).select("log_stream", F.col("last.start_ts").alias("start_ts"))


def _stale(before: str) -> Column:
    return F.coalesce(F.col("start_ts") < F.lit(before).cast("timestamp"), F.lit(False))


def _reread(bronze: DataFrame, waiting: DataFrame) -> DataFrame:
    """Bronze lines of open executions, from their START on."""
    first = waiting.agg(F.date_format(F.min("start_ts"), "yyyy-MM-dd")).first()[0]
    if first is None:
        return bronze.where(F.lit(False))
    recent = bronze.where(F.concat_ws("-", "year", "month", "day") >= first)
    starts = waiting.select(F.col("log_stream").alias("_stream"), F.col("start_ts").alias("_start"))
    same = (F.col("log_stream") == F.col("_stream")) & (event_time(bronze) >= F.col("_start"))
    return recent.join(starts, same, "left_semi")


def run_silver(
    spark: SparkSession,
    bronze_base: str,
    silver_base: str,
    control_base: str,
    city_blocks: DataFrame,
    asn_blocks: DataFrame,
    second_responses: DataFrame,
    run_id: str,
    updated_at_utc: str,
    chunk: str = WIDTH,
    stale_before: str | None = None,
) -> dict:
    """One incremental run: pending Bronze files -> merged Silver -> cache -> ledger.

    An execution still open at the end of the last run is read again together
    with the new lines, so runs of any cut give the rows of one run. Files are
    committed last, also when they held no execution. Returns the counts of the
    run: files, events, streamless lines, executions, addresses, records. They are
    observed while the tables are written.
    """
    with stages_of_run(spark):
        ledger_path, open_base = f"{control_base}/files", f"{control_base}/open"
        counts = RunCounts()
        waiting_files = pending_files(parquet_files(spark, bronze_base), read_ledger(spark, ledger_path), STAGE)
        pending = write_stage(counts.on(waiting_files, files=F.count(F.lit(1))), "pending-files")
        if not counts.values()["files"]:
            return {"files": 0, "records": 0, "divergent": 0}
        bronze = pending_bronze(read_bronze(spark, bronze_base), pending)
        last_open = _latest_open(spark, open_base, ledger_path)
        if last_open is not None:
            bronze = bronze.unionByName(_reread(read_bronze(spark, bronze_base), last_open))
        geo_path = f"{control_base}/geo_cache"
        inputs = GeoInputs(city_blocks, asn_blocks, read_geo_cache(spark, geo_path, run_id), second_source_records(second_responses))
        history = read_history(spark, silver_base, run_id)
        result = build_silver(bronze, inputs, chunk, history, counts)
        append_geo_cache(result.fresh, geo_path, run_id)
        waiting = write_stage(open_executions(result.core), "open-executions")
        if stale_before is not None:
            waiting.where(_stale(stale_before)).write.mode("overwrite").parquet(f"{control_base}/stale/run={run_id}")
            waiting = waiting.where(~_stale(stale_before))
        store_run(spark, result, silver_base, run_id, history, chunk, counts, waiting=waiting)
        waiting.write.mode("overwrite").parquet(f"{open_base}/run={run_id}")
        commit_files(pending, ledger_path, STAGE, run_id, updated_at_utc)
        found = counts.values()
        return {**found, "cached_addresses": found["addresses"] - found["new_addresses"]}


def read_history(spark: SparkSession, silver_base: str, run_id: str | None = None) -> History:
    """Of all runs but `run_id`, which may be a repeated one."""
    return History(read_boundaries(spark, silver_base, run_id), read_visitors(spark, silver_base, run_id))


def pending_bronze(bronze: DataFrame, files: DataFrame) -> DataFrame:
    """Bronze rows of the partitions that the files lie in.

    The partitions are joined by their columns, so the scan is pruned when it runs
    and no path passes through the driver. A partition of which some files were
    processed before is read as a whole; the merge settles repeated rows.
    """
    return bronze.join(partitions_of(files), BRONZE_PARTITIONS, "left_semi")


def _latest_open(spark: SparkSession, open_base: str, ledger_path: str) -> DataFrame | None:
    """Open executions of the last committed run."""
    latest = read_ledger(spark, ledger_path).agg(F.max(F.struct("updated_at_utc", "run_id")).alias("last")).first()[0]
    if latest is None:
        return None
    return read_parquet_or_empty(spark, f"{open_base}/run={latest.run_id}", spark.createDataFrame([], OPEN_SCHEMA).schema)
