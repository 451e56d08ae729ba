"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) select the
data and the cores. Each query runs from its sources to a sink that discards the
rows. `silver_build` is the whole chain up to the Silver table; the reports after
it read that table, as they do after a Silver run.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from logtrail.session import build_session  # noqa: E402
from testbed import queries  # noqa: E402

HEADLINE = [
    "bronze_by_date", "dedup_events", "blocks", "event_json_fields", "op_events", "estado_resposta", "visitor_id",
    "destroy_visitor", "site_sessions", "geo_range_join",
]
REPORTS = ["silver_dedup", "suspicion_score", "visitor_recurrence", "session_metrics", "network_breakdown", "divergence_summary"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "logtrail-bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name: str, run) -> None:
        begin = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - begin, 3)

    def discard(name: str) -> None:
        queries.REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    # Start-up of the JVM and of code generation is not a query.
    queries.REGISTRY["estado_resposta"](spark, sf_dir.replace("sf0.1", "sf0.001")).count()
    for name in HEADLINE:
        timed(name, lambda: discard(name))
    timed("silver_build", lambda: queries.silver_table(spark, sf_dir))
    for name in REPORTS:
        timed(name, lambda: discard(name))
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
