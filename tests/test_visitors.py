from __future__ import annotations

import ipaddress
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from logtrail.functions import addresses, identity, useragents
from logtrail.operators import carry
from logtrail.operators.sessions import assign_sessions
from logtrail.operators.visitors import enrich_visitors, propagate_visitors, propagate_visitors_as_of

BASE = datetime(2024, 6, 18, 10, tzinfo=timezone.utc)
SCHEMA = (
    "request_id string, event_ts timestamp, log_stream string, start_ts timestamp, ip string, user_agent string, "
    "range string, motivo_confianca string, disparou_apply boolean, disparou_destroy boolean, bucket_name string, "
    "estado_resposta string"
)
IPS = {"v6": "2001:db8:65a0:12:a:b:c:d", "v4": "198.18.7.152"}


def record(rid, minutes=0, ip=IPS["v4"], ua="Mozilla/5.0 Chrome/120.0", reason="all_checks_passed", apply=False,
           destroy=False, bucket="", state="", stream="s", range_header=""):
    at = None if minutes is None else BASE + timedelta(minutes=minutes)
    return (rid, at, stream, at, ip, ua, range_header, reason, apply, destroy, bucket, state)


def enriched(spark, *records):
    return enrich_visitors(spark.createDataFrame(list(records), SCHEMA))


def by_id(df):
    return {r.request_id: r for r in df.collect()}


def test_address_rules_equal_the_standard_parser(spark):
    rng = random.Random(11)
    texts = [
        "", "1.2.3.4", "01.2.3.4", "256.1.1.1", "1.2.3", "::", "::1", "1::", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8",
        "1::2::3", ":::", "::ffff:1.2.3.4", "64:ff9b::192.0.2.33", "fe80::1%eth0", "fe80::1%", "fe80::1%a%b", "1.2.3.4%e",
        "fe80::1%a/b", "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7:1.2.3.4", "2001:DB8:65a0:5::9", "12345::", "g::",
        "1.2.3.4\n", "1.2.3.4/24", "não", *IPS.values(),
    ]
    for _ in range(2000):
        parts = [f"{rng.randrange(65536):x}"[: rng.randrange(1, 5)] if rng.random() < 0.8 else "" for _ in range(rng.randrange(1, 10))]
        texts.append(":".join(parts))
    ip = F.col("ip")
    df = spark.createDataFrame([(t,) for t in texts], "ip string")
    for row in df.select("ip", addresses.network_prefix(ip).alias("p"), addresses.address_key(ip).alias("k"),
                         addresses.lookup_key(ip).alias("l")).collect():
        try:
            parsed = ipaddress.ip_address(row.ip)
        except ValueError:
            assert (row.p, row.k) == ("", None), row.ip
            continue
        if parsed.version == 4:
            assert (row.p, row.k) == (".".join(row.ip.split(".")[:3]), f"4{int(parsed):08x}")
        else:
            assert (row.p, row.k) == (":".join(row.ip.split(":")[:4]), f"6{int(parsed):032x}"), row.ip
            if parsed.ipv4_mapped:
                assert row.l == f"4{int(parsed.ipv4_mapped):08x}"


def test_masked_key(spark):
    rng = random.Random(2)
    rows = [(f"6{rng.getrandbits(128):032x}", n) for n in range(129)] + [(f"4{rng.getrandbits(32):08x}", n) for n in range(33)]
    df = spark.createDataFrame(rows, "key string, n int")
    for row in df.select("*", addresses.masked_key(F.col("key"), F.col("n")).alias("m")).collect():
        bits = bin(int(row.key[1:], 16))[2:].zfill(4 * (len(row.key) - 1))[: row.n]
        bits += "0" * (-len(bits) % 4)
        assert row.m == "".join(f"{int(bits[i:i + 4], 2):x}" for i in range(0, len(bits), 4))


def test_user_agent_rules(spark):
    ua, rng = F.col("ua"), F.col("r")
    expected = {
        ("Mozilla/5.0 Chrome/120.0", ""): ("chrome", "desktop", False, False),
        ("Mozilla/5.0 Chrome/120 Edg/120", ""): ("edge", "desktop", False, False),
        ("Mozilla/5.0 Chrome/120 OPR/106", ""): ("opera", "desktop", False, False),
        ("Opera/9.80", ""): ("opera", "desktop", False, False),
        ("WhatsApp/2.0 Android", ""): ("whatsapp", "mobile", False, True),
        ("LinkedInBot/1.0", "bytes=0-1"): ("linkedinbot", "desktop", False, True),
        ("facebookexternalhit/1.1", ""): ("facebookbot", "desktop", False, True),
        ("Twitterbot/1.0", ""): ("twitterbot", "desktop", False, True),
        ("Googlebot/2.1", ""): ("googlebot", "desktop", False, False),
        ("Googlebot/2.1", "bytes=0-1"): ("googlebot", "desktop", False, True),
        ("Mozilla/5.0 (iPhone) Safari/604", ""): ("safari", "mobile", False, False),
        ("Firefox/1", "bytes=0-1"): ("firefox", "desktop", False, False),
        ("curl/8.0", ""): ("curl", "desktop", True, False),
        ("python-requests/2.31", ""): ("python", "desktop", True, False),
        ("Mozilla/5.0 PaloAlto/Scanner", ""): ("unknown", "desktop", True, False),
        ("zgrab/0.1 crawler bot", ""): ("unknown", "desktop", True, False),
        ("", ""): ("unknown", "desktop", False, False),
    }
    df = spark.createDataFrame(list(expected), "ua string, r string")
    rows = df.select("ua", "r", useragents.browser_family(ua), useragents.device_type(ua),
                     useragents.is_scanner_user_agent(ua), useragents.is_social_preview(ua, rng)).collect()
    for row in rows:
        assert tuple(row[2:]) == expected[row.ua, row.r], row.ua


def test_visitor_type(spark):
    reasons = [*identity.VISITOR_TYPES, "", "unmapped"]
    df = spark.createDataFrame([(r,) for r in reasons], "reason string")
    found = {r.reason: r[1] for r in df.select("reason", identity.visitor_type(F.col("reason"))).collect()}
    assert found == {**identity.VISITOR_TYPES, "": "", "unmapped": "bot_generico"}


@pytest.mark.parametrize("family", IPS)
def test_visitor_id(spark, family):
    near = {"v6": "2001:db8:65a0:12:1:2:3:4", "v4": "198.18.7.9"}[family]
    r = by_id(enriched(
        spark, record("a", ip=IPS[family]), record("b", 5, ip=near), record("c", ip=IPS[family], ua="curl/8.0"),
        record("bad", ip="não-é-um-ip", ua="curl/8.0"), record("none", ip="", ua="curl/8.0"), record("null", ip=None, ua=None),
    ))
    assert r["a"].visitor_id == r["b"].visitor_id != r["c"].visitor_id
    assert r["bad"].visitor_id == r["none"].visitor_id != r["c"].visitor_id and r["bad"].network_prefix == ""
    assert len(r["null"].visitor_id) == 16 and r["null"].browser_family == "unknown"


def test_destroy_inherits_latest_visitor(spark):
    df = enriched(
        spark,
        record("v1", 0, bucket="b", ua="one"), record("v2", 10, bucket="b", ua="two"),
        record("end", 20, bucket="b", destroy=True, ua=""), record("check", 5, bucket="b", state="eventbridge_timeout", ua=""),
        record("later", 30, bucket="b", ua="three"), record("alone", 0, bucket="c", destroy=True, ua="own"),
        record("place", 0, bucket="TEMPORARIO", destroy=True, ua="own"),
        record("tie1", 40, bucket="t", ua="x", stream="s1"), record("tie2", 40, bucket="t", ua="y", stream="s2"),
        record("tie", 41, bucket="t", destroy=True, ua=""),
    )
    own, whole, as_of = by_id(df), by_id(propagate_visitors(df)), by_id(propagate_visitors_as_of(df, "7 minutes"))
    assert whole["end"].visitor_id == whole["check"].visitor_id == own["later"].visitor_id
    assert as_of["end"].visitor_id == own["v2"].visitor_id and as_of["check"].visitor_id == own["v1"].visitor_id
    for rid in ("alone", "place", "v1", "later"):
        assert whole[rid].visitor_id == as_of[rid].visitor_id == own[rid].visitor_id
    assert whole["tie"].visitor_id == own["tie1"].visitor_id
    assert len(whole) == len(as_of) == 10


def test_cycle_isolated_and_new_apply(spark):
    s = {r.request_id: r.site_session_id for r in assign_sessions(spark.createDataFrame([
        record("before", -5), record("c1", 0, apply=True), record("c2", 1), record("c3", 90),
        record("c4", 100, destroy=True), record("iso1", 110), record("iso2", 111),
        record("a1", 200, apply=True), record("a2", 230, apply=True), record("a3", 231),
        record("both", 240, apply=True, destroy=True), record("after", 241), record("undated", None),
    ], SCHEMA)).collect()}
    assert s["c1"] == s["c2"] == s["c3"] == s["c4"]
    assert s["a1"] != s["a2"] == s["a3"] != s["both"] != s["after"]
    assert len(set(s.values())) == 9


@pytest.mark.parametrize("chunk, size", [("1 minute", 10**6), ("3 hours", 10**6), ("30 days", 10**6), ("30 days", 50), ("1 hour", 9)])
def test_random_cycles_equal_state_machine(spark, chunk, size, monkeypatch):
    monkeypatch.setattr(carry, "SAMPLES", 3)
    rng = random.Random(5)
    rows = [record(f"r{i:04d}", rng.randrange(600), apply=rng.random() < 0.1, destroy=rng.random() < 0.1,
                   stream=f"s{rng.randrange(3)}") for i in range(800)]
    expected, open_id = {}, None
    for row in sorted(rows, key=lambda r: (r[1], r[2], r[3], r[0])):
        open_id = row[0] if row[8] else open_id
        expected[row[0]] = open_id or row[0]
        open_id = None if row[9] else open_id
    df = spark.createDataFrame(rows, SCHEMA)
    owner = {r.request_id: r.h for r in df.select("request_id", identity.session_hash(F.col("request_id")).alias("h")).collect()}
    found = {r.request_id: r.site_session_id for r in assign_sessions(df, chunk, rows=size).collect()}
    assert found == {rid: owner[o] for rid, o in expected.items()}


def test_history_opens_a_cycle(spark):
    history = spark.createDataFrame([record("old", 0, apply=True)], SCHEMA).select(
        "request_id", "event_ts", "log_stream", "start_ts", "disparou_apply", "disparou_destroy")
    rows = assign_sessions(spark.createDataFrame([record("new", 60)], SCHEMA), history=history).collect()
    (expected,) = spark.range(1).select(identity.session_hash(F.lit("old")).alias("h")).collect()
    assert [(r.request_id, r.site_session_id) for r in rows] == [("new", expected.h)]
