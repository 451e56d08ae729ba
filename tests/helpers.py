"""Log lines for whole-chain tests: executions of one site, cut anywhere."""

from __future__ import annotations

import json
from datetime import datetime, timezone

DAY = int(datetime(2024, 3, 1, tzinfo=timezone.utc).timestamp() * 1000)
MINUTE = 60_000


def execution(number, minute, kind, stream="s1", ip="10.0.0.1", gap_ms=1000):
    """(eventId, timestamp, stream, message) lines of one execution."""
    rid, ms = f"req-{number:03d}", DAY + int(minute * MINUTE)
    request = {
        "rawPath": "/", "rawQueryString": "", "headers": {"cf-connecting-ip": ip, "user-agent": "Mozilla/5.0 Chrome/120"},
        "requestContext": {"http": {"method": "GET", "sourceIp": "1.1.1.1"}, "timeEpoch": ms},
    }
    bucket = "site-1" if kind in ("serve", "destroy", "check") else None
    http = kind in ("apply", "serve", "wait")
    lines = [f"START RequestId: {rid} Version: $LATEST"]
    lines += ["Evento recebido:", json.dumps(request)] if http else []
    lines.append(json.dumps({"event": "lambda_execution", "origem_eventbridge": not http, "temp_item": kind == "wait",
                             "active_items": 1 if bucket else 0, "bucket": bucket}))
    lines += [json.dumps({"event": "access_decision", "trusted": True, "reason": "all_checks_passed", "user_agent": "x"})] if http else []
    lines += {"apply": ['{"event": "deploy_triggered"}'], "serve": ["Servindo site via proxy S3"],
              "destroy": [json.dumps({"event": "destroy_triggered", "bucket": bucket})]}.get(kind, [])
    lines.append(f"END RequestId: {rid}")
    return [(f"e{number:03d}-{i}", ms + i * gap_ms, stream, text) for i, text in enumerate(lines)]


def day_of_site():
    """Two cycles over two streams, with one execution across midnight."""
    plan = [
        (1, 10, "wait", "s1"), (2, 20, "apply", "s2"), (3, 22, "wait", "s1"), (4, 30, "serve", "s2"),
        (5, 60, "check", "s1"), (6, 90, "destroy", "s2"), (7, 100, "serve", "s1"),
        (8, 200, "apply", "s1"), (9, 260, "serve", "s1"), (10, 1439.95, "serve", "s2"), (11, 1500, "destroy", "s1"),
    ]
    return [line for number, minute, kind, stream in plan for line in execution(number, minute, kind, stream)]


def raw_json(lines):
    return "\n".join(
        json.dumps({"eventId": e, "timestamp": t, "ingestionTime": t, "logStreamName": s, "message": m})
        for e, t, s, m in lines
    )
