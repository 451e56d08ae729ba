"""Every registered query against its oracle SQL, and the shape of the plans."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as driver
from compare import compare
from logtrail.operators.blocks import build_blocks
from logtrail.operators.dedup import dedup_accesses, dedup_events
from logtrail.operators.geo import lookup_networks
from logtrail.operators.sessions import assign_sessions
from logtrail.session import write_stage
from testbed import fixture, oracles, queries

SF = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(queries.REGISTRY) == set(oracles.oracle_sql())
    assert set(queries.REGISTRY) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(queries.REGISTRY))
def test_query_equals_oracle(spark, name):
    assert compare(spark, SF, name) == ""


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_nested_loops_and_no_single_partition_on_rows(spark):
    bronze = write_stage(fixture.bronze(spark, SF), "bronze")
    core = write_stage(queries.visited(spark, SF), "core")
    plans = {
        "blocks": plan(build_blocks(dedup_events(bronze))),
        "sessions": plan(assign_sessions(core, source=core)),
        "geo": plan(lookup_networks(core.select("ip").distinct(), fixture.city_blocks(spark, SF), fixture.asn_blocks(spark, SF))),
    }
    for name, text in plans.items():
        assert "NestedLoop" not in text and "Cartesian" not in text, name
    assert "SinglePartition" not in plans["blocks"] and "SinglePartition" not in plans["geo"]
    # Sessions order their chunk summary in one task: under it is an aggregate, not the rows.
    single = re.search(r"Exchange SinglePartition.*\n[^\n]*SortAggregate", plans["sessions"])
    assert plans["sessions"].count("SinglePartition") == 1 and single


def test_copies_are_cut_before_the_shuffle(spark):
    bronze = write_stage(fixture.bronze(spark, SF), "bronze")
    text = plan(dedup_events(bronze))
    assert "WindowGroupLimit" in text.split("Exchange hashpartitioning(event_id")[1]
    assert "WindowGroupLimit" in plan(dedup_accesses(write_stage(queries.visited(spark, SF), "core")))


def test_scans_read_only_needed_columns(spark):
    core = write_stage(queries.visited(spark, SF), "core")
    text = plan(core.where("ip <> ''").select("ip").distinct())
    assert re.search(r"PushedFilters: \[.*ip.*\], ReadSchema: struct<ip:string>", text)


def test_lines_are_made_by_code_the_jvm_compiles(spark, capsys):
    """A generated method of more than 8,000 bytes stays in the JVM's interpreter."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan shows no code before it runs
    try:
        fixture.bronze(spark, SF).select("event_id", "log_stream", "timestamp_ms", "message", "collection_id").explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_lines_of_an_execution_are_grouped_as_the_window_sorted_them(spark):
    text = plan(queries.executions(spark, SF))
    assert "SortAggregate" in text and "ObjectHashAggregate" not in text


def test_the_summary_of_the_ranges_sorts_marks_without_texts(spark):
    below_sort = r"Sort \[log_stream#\d+ ASC NULLS FIRST, _chunk#\d+L ASC NULLS FIRST\], false, 0\n[\s|:]*\+- Generate inline"
    assert re.search(below_sort, plan(queries.executions(spark, SF)))
