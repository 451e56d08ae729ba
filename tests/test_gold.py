from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from logtrail.functions import scores
from logtrail.plans import gold
from logtrail.schemas import BOOLEAN_COLUMNS, GOLD_COLUMNS, SILVER_COLUMNS, SILVER_SCHEMA

HOST = "site.example"
CALM = dict(
    request_id="r", timestamp_utc="2024-05-01T10:00:00Z", method="GET", host=HOST, raw_path="/", accept_language="pt",
    sec_fetch_user="?1", sec_fetch_site="none", is_http_event=True, manter_para_analise=True, browser_family="chrome",
    network_type="residencial", visitor_id="v", site_session_id="s", visitor_type="humano_provavel",
)


def silver(spark, *changes):
    rows = []
    for change in changes:
        row = {**{n: (False if n in BOOLEAN_COLUMNS else "") for n in SILVER_COLUMNS}, **CALM, **change}
        for name in ("geo_latitude", "geo_longitude", "geo_distance_km"):
            row[name] = row[name] or None
        rows.append(tuple(row[n] for n in SILVER_COLUMNS))
    return spark.createDataFrame(rows, SILVER_SCHEMA)


ABSENT = dict(accept_language="", sec_fetch_user="", sec_fetch_site="")
CASES = [
    ({}, 0, 1.0),
    (dict(is_known_scanner_network=True), 50, 0.0),
    (dict(is_scanner_user_agent=True), 40, 0.0),
    (dict(raw_path="/.ENV"), 30, 1.0),
    (dict(raw_path="/wp-admin/x", method="POST"), 55, 1.0),
    (dict(host="other"), 50, 1.0),
    (dict(is_cloud_provider=True, network_type="cloud"), 35, 0.75),
    (dict(is_cloud_provider=True, network_type="cloud", method="PUT"), 25, 0.75),
    (dict(**ABSENT, browser_family="unknown"), 25, 0.3),
    (dict(**ABSENT, browser_family="unknown", is_cloud_provider=True, network_type="cloud"), 25, 0.0),
    (dict(is_known_scanner_network=True, is_scanner_user_agent=True, raw_path="/.git", host="x"), 100, 0.0),
    (dict(is_social_preview=True, host="x"), 10, 0.05),
    (dict(is_social_preview=True), 0, 0.05),
    (dict(accept_language=""), 0, 0.8),
]


def test_scores(spark):
    table = silver(spark, *[{**change, "request_id": str(i)} for i, (change, _, _) in enumerate(CASES)])
    rows = {int(r.request_id): r for r in gold.scored(table, HOST).collect()}
    for i, (change, risk, human) in enumerate(CASES):
        assert (rows[i].suspicion_score, rows[i].human_probability) == (risk, pytest.approx(human)), change


def test_projection_keeps_marked_rows(spark):
    table = silver(spark, {}, dict(request_id="wait", manter_para_analise=False), dict(request_id="job", is_http_event=False))
    found = gold.gold_projection(table)
    assert found.columns == GOLD_COLUMNS and sorted(r.request_id for r in found.collect()) == ["job", "r"]
    assert [r.request_id for r in gold.scored(table, HOST).collect()] == ["r"]


def test_sessions_and_visitors(spark):
    table = silver(
        spark,
        dict(request_id="1", disparou_apply=True, visitor_id="a"),
        dict(request_id="2", aguardando_criacao=True, visitor_id="b", timestamp_utc="2024-05-01T10:00:01.500000Z"),
        dict(request_id="3", disparou_destroy=True, visitor_id="a", timestamp_utc="2024-05-01T10:30:00Z",
             expiration_time="2024-05-01T10:30:00+00:00"),
        dict(request_id="4", site_session_id="t", visitor_type="scanner", timestamp_utc="2024-05-02T10:00:00Z",
             disparou_destroy=True, expiration_time="2024-05-03T00:00:00+00:00"),
    )
    sessions = {r.site_session_id: r for r in gold.session_metrics(table).collect()}
    s = sessions["s"]
    assert (s.accesses, s.duration_ms, s.visitors, s.refresh_count, s.provisioned, s.destroyed) == (3, 1_800_000, 2, 1, True, True)
    assert (s.started, s.ended) == ("2024-05-01T10:00:00Z", "2024-05-01T10:30:00Z")
    assert [tuple(r) for r in gold.isolated_sessions(table).collect()] == [("scanner", 1)]
    visitors = {r.visitor_id: r for r in gold.visitor_recurrence(table).collect()}
    assert (visitors["a"].accesses, visitors["a"].is_recurrent, visitors["b"].is_recurrent) == (2, True, False)
    days = {r.day: tuple(r)[1:] for r in gold.daily_lifecycle(table).collect()}
    assert days == {"2024-05-01": (3, 1, 1, 0, 0), "2024-05-02": (1, 0, 1, 0, 0)}
    assert {r.request_id: r.timeout_respected for r in gold.timeout_respected(table).collect()} == {"3": True, "4": False}


def test_request_indicators(spark):
    forwarded = {"": (0, False), "1.1.1.1": (1, False), "2.2.2.2": (1, True), "1.1.1.1, 10.0.0.1": (2, True)}
    table = silver(spark, *[dict(request_id=k, x_forwarded_for=k, ip="1.1.1.1") for k in forwarded])
    for r in gold.forwarded_check(table).collect():
        assert (r.forwarded_count, r.forwarded_mismatch) == forwarded[r.request_id]
    flags = gold.request_flags(silver(spark, dict(method="POST", host="x", raw_query_string="q=<a>", sec_fetch_site="same-site")), HOST).first()
    assert tuple(flags)[1:] == (True, True, False, True, "Mesmo site, origens diferentes")
    df = spark.createDataFrame([("utm_source=linkedin&x=1%20a",)], "q string")
    assert df.select(scores.odd_query(F.col("q"))).first()[0] is False
