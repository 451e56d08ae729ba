"""Collection, tables, ledger, incremental Silver."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from helpers import DAY, MINUTE, day_of_site, raw_json
from logtrail.plans.bronze_job import STAGE, collect_bronze
from logtrail.plans.silver import days_with_new_rule, pending_bronze, run_silver
from logtrail.schemas import BRONZE_COLUMNS, SILVER_COLUMNS, SILVER_SCHEMA, conform
from logtrail.session import write_stage
from logtrail.sources import ledger
from logtrail.sources.bronze import read_bronze, write_bronze
from logtrail.sources.geo_tables import (
    ASN_BLOCK_SCHEMA, CITY_BLOCK_SCHEMA, read_geo_cache, read_network_blocks, append_geo_cache,
)
from logtrail.sources.raw_events import bronze_rows, in_window, read_raw_events, resolve_collection, utc
from logtrail.sources.registers import stored_ids
from logtrail.sources import silver as silver_module
from logtrail.sources.silver import merge_silver, read_days, read_silver, silver_days

NOW = "2024-03-03T00:00:00+00:00"


def test_collection_window():
    first = resolve_collection(NOW)
    assert first.window_start == utc(NOW) - timedelta(hours=25) and first.moves_state
    assert first.collection_id == "20240303T000000Z"
    later = resolve_collection(NOW, "2024-03-02T12:00:00")
    assert later.window_start == utc("2024-03-02T11:55:00+00:00") and later.window_end == utc(NOW)
    assert resolve_collection(NOW, "2024-03-02T12:00:00", overlap_minutes=9).window_start.minute == 51
    manual = resolve_collection(NOW, "2024-03-02T12:00:00", "2024-01-01", "2024-01-02")
    assert (manual.collection_type, manual.moves_state) == ("manual_reprocess", False)
    assert manual.window_end == datetime(2024, 1, 2, tzinfo=timezone.utc)


def test_bronze_rows(spark):
    events = spark.createDataFrame(
        [("e1", 1714537069258, 1714537069000, "s", "ação"), ("e2", None, None, "s", None)],
        "eventId string, timestamp long, ingestionTime long, logStreamName string, message string",
    )
    run = resolve_collection(NOW, log_group="g")
    a, b = bronze_rows(events, run).orderBy("event_id").collect()
    assert list(a.asDict()) == BRONZE_COLUMNS
    assert (a.timestamp_utc, a.ingestion_time) == ("2024-05-01T04:17:49.258000+00:00", "2024-05-01T04:17:49+00:00")
    assert (a.message_size, a.log_group, a.collection_type) == (6, "g", "incremental")
    assert (b.timestamp_utc, b.message_size, b.message) == (None, 0, None)
    with pytest.raises(ValueError, match="event_id"):
        conform(events, BRONZE_COLUMNS, "Bronze")


@pytest.fixture(scope="module")
def site(tmp_path_factory):
    base = tmp_path_factory.mktemp("site")
    (base / "raw").mkdir()
    (base / "raw" / "all.json").write_text(raw_json([*day_of_site(), ("null", None, "s1", "x")]))
    return base


def test_collect_and_state(spark, site):
    paths = dict(raw_path=f"{site}/raw", bronze_base=f"{site}/b", state_path=f"{site}/state")
    assert ledger.load_state(spark, paths["state_path"], STAGE) == {}
    manual = collect_bronze(spark, **paths, now="2024-03-02T01:30:00", window_start="2024-03-01", window_end="2024-03-01T00:15:00")
    assert manual["events"] == 6 and ledger.load_state(spark, paths["state_path"], STAGE) == {}
    first = collect_bronze(spark, **paths, now="2024-03-02T01:00:00")
    state = ledger.load_state(spark, paths["state_path"], STAGE)
    assert state["last_collection_id"] == first["collection_id"] and state["last_events_count"] == first["events"]
    assert [p.split("/b/")[1] for p in state["last_output_paths"]] == [
        f"year=2024/month=03/day={d}/collection_id=20240302T010000Z" for d in ("01", "02")]
    empty = collect_bronze(spark, **paths, now="2024-03-09T00:00:00", window_start="2024-03-08", window_end="2024-03-09", update_state=True)
    assert empty["events"] == 0 and ledger.load_state(spark, paths["state_path"], STAGE) == state
    second = collect_bronze(spark, **paths, now="2024-03-02T02:00:00")
    assert ledger.load_state(spark, paths["state_path"], STAGE)["last_collection_id"] == second["collection_id"]
    assert ledger.load_state(spark, paths["state_path"], STAGE)["last_successful_window_start"].startswith("2024-03-02T00:55")
    again = read_bronze(spark, paths["bronze_base"]).count()
    collect_bronze(spark, **paths, now="2024-03-02T02:00:00", window_start="2024-03-02T00:55:00", window_end="2024-03-02T02:00:00")
    assert read_bronze(spark, paths["bronze_base"]).count() == again


def test_undated_rows_are_rejected(spark, tmp_path):
    events = spark.createDataFrame(
        [("e1", DAY, DAY, "s", "x"), ("e2", None, None, "s", "y")],
        "eventId string, timestamp long, ingestionTime long, logStreamName string, message string",
    )
    write_bronze(bronze_rows(events, resolve_collection(NOW)), f"{tmp_path}/b", f"{tmp_path}/rejects")
    assert [r.event_id for r in read_bronze(spark, f"{tmp_path}/b").collect()] == ["e1"]
    assert [r.event_id for r in spark.read.parquet(f"{tmp_path}/rejects").collect()] == ["e2"]
    row = read_bronze(spark, f"{tmp_path}/b").first()
    assert (row.year, row.month, row.day) == ("2024", "03", "01")


def test_window_and_undated_rows_are_one_scan(spark, tmp_path):
    lines = [("a", DAY, "s", "x"), ("b", None, "s", "y"), ("c", DAY - 48 * 60 * MINUTE, "s", "z")]
    (tmp_path / "raw.json").write_text(raw_json(lines))
    run = resolve_collection("2024-03-01T01:00:00")
    raw = read_raw_events(spark, str(tmp_path / "raw.json"))
    wanted = in_window(raw, run, undated=True)
    assert sorted(row.eventId for row in wanted.collect()) == ["a", "b"]
    assert [row.eventId for row in in_window(raw, run).collect()] == ["a"]
    assert wanted._jdf.queryExecution().executedPlan().toString().count("FileScan json") == 1


def test_collections_over_compressed_raw_files(spark, tmp_path):
    """Raw files of the collections are compressed; three runs over them give the same lines as the rows themselves."""
    rows = [(e, datetime(2024, 1, 2 if e < 60 else 7, e % 24, e % 60), e, "purchase", 1.0, '{"k": 5}') for e in range(120)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    from pathlib import Path

    from testbed.job_queries import collection_runs, collections

    raw = sorted(Path(collections(spark, str(tmp_path))["base"].removeprefix("file:")).glob("raw/part-*"))
    assert raw and all(path.name.endswith(".json.gz") for path in raw)
    lines = {(row.collection_type, row.collection_window_start[:10]): row.lines for row in collection_runs(spark, str(tmp_path)).collect()}
    assert lines[("manual_reprocess", "2024-01-02")] > 400 and lines[("incremental", "2024-01-06")] > 400


def test_column_union_and_required_columns(spark, tmp_path):
    spark.createDataFrame([("1", "t", "s", "m")], "event_id string, timestamp_utc string, log_stream string, message string").write.parquet(f"{tmp_path}/b/a")
    spark.createDataFrame([("2", "t", "s", "m", "g")], "event_id string, timestamp_utc string, log_stream string, message string, log_group string").write.parquet(f"{tmp_path}/b/b")
    found = read_bronze(spark, f"{tmp_path}/b", [f"{tmp_path}/b/a", f"{tmp_path}/b/b"], merge_schema=True)
    assert {r.event_id: r.log_group for r in found.collect()} == {"1": None, "2": "g"}
    spark.createDataFrame([("1",)], "event_id string").write.parquet(f"{tmp_path}/c")
    with pytest.raises(ValueError, match=r"\['log_stream', 'message', 'timestamp_utc'\]"):
        read_bronze(spark, f"{tmp_path}/c", merge_schema=True)


def test_ledger_rules(spark, tmp_path):
    assert ledger.parquet_files(spark, f"{tmp_path}/none").count() == 0
    for name in ("a", "b", "c"):
        spark.range(1).coalesce(1).write.parquet(f"{tmp_path}/t/{name}")
    files = ledger.parquet_files(spark, f"{tmp_path}/t")
    path = f"{tmp_path}/ledger"
    assert ledger.pending_files(files, ledger.read_ledger(spark, path), "x").count() == 3
    ledger.commit_files(files.where(F.col("path").contains("/b/")), path, "x", "run-1", NOW)
    read = ledger.read_ledger(spark, path)
    pending = ledger.pending_files(files, read, "x")
    assert sorted(r.path.split("/")[-2] for r in pending.collect()) == ["a", "c"]
    assert ledger.pending_files(files, read, "other").count() == 3
    last = ledger.last_path(read, "x").first().last_path
    assert [r.path.split("/")[-2] for r in ledger.files_after(files, last).collect()] == ["c"]
    assert ledger.files_after(files, None).count() == 3


def test_geo_tables(spark, tmp_path):
    assert read_geo_cache(spark, f"{tmp_path}/cache").count() == 0
    cache = read_geo_cache(spark, f"{tmp_path}/cache").unionByName(
        spark.createDataFrame([("1.1.1.1",)], "ip string"), allowMissingColumns=True)
    append_geo_cache(cache, f"{tmp_path}/cache", "2024-01")
    append_geo_cache(cache.withColumn("ip", F.lit("2.2.2.2")), f"{tmp_path}/cache", "2024-02")
    append_geo_cache(cache.withColumn("ip", F.lit("2.2.2.2")), f"{tmp_path}/cache", "2024-02")
    assert sorted(r.ip for r in read_geo_cache(spark, f"{tmp_path}/cache").collect()) == ["1.1.1.1", "2.2.2.2"]
    assert read_geo_cache(spark, f"{tmp_path}/cache", "2024-02").count() == 1
    (tmp_path / "asn.csv").write_text("network,asn_number,asn_name\n10.0.0.0/8,7,Ten\n")
    assert read_network_blocks(spark, f"{tmp_path}/asn.csv", ASN_BLOCK_SCHEMA, "csv").first().asn_number == 7


def silver_of(spark, base, cuts, label):
    """Silver after collecting the site's lines in windows that end at the cuts."""
    city = spark.createDataFrame([("10.0.0.0/8", "BR", "Brazil", "c", "", "", 1.0, 2.0, "")], CITY_BLOCK_SCHEMA)
    asn = spark.createDataFrame([("10.0.0.0/8", 7, "Ten")], ASN_BLOCK_SCHEMA)
    second = spark.createDataFrame([], "ip string, country string, city string, region string, postal string, loc string, timezone string, org string")
    start = "2024-03-01T00:00:00+00:00"
    for number, end_ms in enumerate(cuts):
        end = datetime.fromtimestamp(end_ms / 1000, tz=timezone.utc).isoformat()
        collect_bronze(spark, f"{base}/raw", f"{base}/{label}/bronze", f"{base}/{label}/state", end, window_start=start, window_end=end)
        result = run_silver(spark, f"{base}/{label}/bronze", f"{base}/{label}/silver", f"{base}/{label}/control", city, asn,
                            second, f"run-{number}", end)
        assert result["files"] > 0
        start = end
    assert run_silver(spark, f"{base}/{label}/bronze", f"{base}/{label}/silver", f"{base}/{label}/control", city, asn,
                      second, "run-x", end)["files"] == 0
    table = read_silver(spark, f"{base}/{label}/silver")
    assert {(r.day, r.timestamp_utc[8:10]) for r in table.collect()} == {("01", "01"), ("02", "02")}
    return sorted(tuple(r) for r in table.select(*SILVER_COLUMNS).collect())


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def explained(spark, df) -> str:
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_a_merge_reads_only_days_hit(spark, tmp_path):
    """The register of ids is joined without a shuffle of it, and Silver is read in the days of stored copies."""
    base = f"{tmp_path}/silver"
    text = {name: "" for name in SILVER_COLUMNS}

    def rows(*items):
        data = []
        for rid, at, closed in items:
            row = {**text, "request_id": rid, "timestamp_utc": at, "block_closed": closed, "log_stream": "s"}
            data.append(tuple(None if f.dataType.simpleString() == "double" else row[f.name] or False if f.dataType.simpleString() == "boolean" else row[f.name]
                              for f in SILVER_SCHEMA.fields))
        return spark.createDataFrame(data, SILVER_SCHEMA)

    merge_silver(rows(*[(f"r{d}", f"2024-03-{d:02d}T00:00:00Z", True) for d in range(1, 9)], ("none", "", False)), base)
    assert silver_days(spark, base) == {"", *[f"2024-03-{d:02d}" for d in range(1, 9)]}

    def files_of(day):
        return {r[0] for r in read_days(spark, base, {day}).select(F.input_file_name()).collect()}

    files = {day: files_of(day) for day in ("2024-03-05", "2024-03-07")}
    merge_silver(rows(("r2", "2024-03-05T01:00:00Z", True), ("none", "2024-03-05T02:00:00Z", True)), base)
    found = {r.request_id: (r.timestamp_utc, r.day) for r in read_silver(spark, base).collect()}
    assert found["r2"] == ("2024-03-05T01:00:00Z", "05") and found["none"] == ("2024-03-05T02:00:00Z", "05") and len(found) == 9
    assert silver_days(spark, base) == {f"2024-03-{d:02d}" for d in (1, 3, 4, 5, 6, 7, 8)}
    assert files_of("2024-03-07") == files["2024-03-07"] and files_of("2024-03-05") != files["2024-03-05"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        asked = spark.range(10).select(F.concat(F.lit("r"), "id").alias("request_id"))
        text = plan_of(stored_ids(spark, base).join(asked, "request_id", "left_semi"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Bucketed: true" in text and text.count("Exchange hashpartitioning") == 1
    assert "PartitionFilters: [(concat_ws" in explained(spark, read_days(spark, base, {"2024-03-03"})).replace("[concat_ws", "[(concat_ws")


def test_pending_partitions_prune_the_scan(spark, tmp_path):
    for day in range(1, 7):
        events = spark.createDataFrame([(f"e{day}", DAY + day * 1440 * MINUTE, DAY, "s", "x")],
                                       "eventId string, timestamp long, ingestionTime long, logStreamName string, message string")
        write_bronze(bronze_rows(events, resolve_collection(NOW)), f"{tmp_path}/b")
    files = write_stage(ledger.parquet_files(spark, f"{tmp_path}/b").where("path LIKE '%day=04%'"), "pending")
    bronze = pending_bronze(read_bronze(spark, f"{tmp_path}/b"), files)
    assert [r.event_id for r in bronze.collect()] == ["e3"]
    assert "dynamicpruning" in explained(spark, bronze)


def test_days_ruled_by_a_late_boundary(spark):
    """An apply on the 3rd rules the days up to the next boundary, the destroy on the 6th."""
    schema = "request_id string, event_ts timestamp, log_stream string, start_ts timestamp, disparou_apply boolean, disparou_destroy boolean"

    def boundary(rid, day, apply):
        at = datetime(2024, 3, day, 12, tzinfo=timezone.utc)
        return (rid, at, "s", at, apply, not apply)

    stored = spark.createDataFrame([boundary("a1", 1, True), boundary("d6", 6, False), boundary("a8", 8, True)], schema)
    days = {f"2024-03-{d:02d}" for d in range(1, 11)} | {""}
    late = spark.createDataFrame([boundary("a3", 3, True)], schema)
    assert days_with_new_rule(spark, days, stored, late) == {f"2024-03-{d:02d}" for d in (3, 4, 5, 6)}
    last = spark.createDataFrame([boundary("d9", 9, False)], schema)
    assert days_with_new_rule(spark, days, stored, last) == {"2024-03-09", "2024-03-10"}
    assert days_with_new_rule(spark, days, stored, stored.limit(0)) == set()


def test_increments_equal_one_run(spark, site):
    """Cuts inside executions, inside a cycle, and across midnight."""
    whole = silver_of(spark, site, [DAY + 2 * 1440 * MINUTE], "whole")
    assert len(whole) == 11
    cuts = [DAY + 20 * MINUTE + 2500, DAY + 60 * MINUTE + 500, DAY + int(1439.95 * MINUTE) + 4500, DAY + 2 * 1440 * MINUTE]
    parts = silver_of(spark, site, cuts, "parts")
    assert parts == whole


def test_merge_writes_the_rows_of_silver_once(spark, tmp_path, monkeypatch):
    """Beside the new rows and the table itself, a merge writes only the ids and days of what it stores."""
    widths, stage = {}, silver_module.write_stage

    def measured(df, name):
        widths[name] = len(df.columns)
        return stage(df, name)

    monkeypatch.setattr(silver_module, "write_stage", measured)
    base, wide = f"{tmp_path}/silver", len(SILVER_SCHEMA.fields)

    def rows(*items):
        row = {f.name: {"string": "", "double": None, "boolean": False}[f.dataType.simpleString()] for f in SILVER_SCHEMA.fields}
        made = [{**row, "request_id": rid, "timestamp_utc": at, "block_closed": closed, "raw_path": path} for rid, at, closed, path in items]
        return spark.createDataFrame([tuple(r[f.name] for f in SILVER_SCHEMA.fields) for r in made], SILVER_SCHEMA)

    merge_silver(rows(("a", "2024-03-01T00:00:00Z", True, "old"), ("b", "2024-03-02T00:00:00Z", False, "old"), ("c", "", True, "old")), base)
    kept = merge_silver(rows(("a", "2024-03-03T00:00:00Z", False, "new"), ("b", "2024-03-03T00:00:00Z", True, "new"), ("d", "2024-03-03T00:00:00Z", True, "new")), base)
    assert {r.request_id: (r.raw_path, r.day) for r in read_silver(spark, base).collect()} == {
        "a": ("old", "01"), "b": ("new", "03"), "c": ("old", None), "d": ("new", "03")}
    assert silver_days(spark, base) == {"", "2024-03-01", "2024-03-03"}
    assert sorted(map(tuple, kept.select("request_id", "day").collect())) == [("b", "2024-03-03"), ("d", "2024-03-03")]
    assert [name for name, columns in widths.items() if columns >= wide] == ["silver-new"]
