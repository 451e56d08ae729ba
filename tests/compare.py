"""Compare registered queries with their oracle SQL: python tests/compare.py [sf] [name ...]."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as driver  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([normal(row[i]) for i in order]) for row in rows)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def compare(spark, sf_dir: str, name: str) -> str:
    """'' when equal, else the first difference."""
    result = driver.queries()[name](spark, sf_dir)
    found = rows_of(result.columns, [tuple(row) for row in result.collect()])
    cursor = connect(sf_dir).execute(driver.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    expected = rows_of(columns, cursor.fetchall())
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(set(columns) ^ set(result.columns))}"
    if found == expected:
        return "" if found else "both empty"
    only_found = [r for r in found if r not in set(expected)][:1]
    only_expected = [r for r in expected if r not in set(found)][:1]
    return f"{len(found)} / {len(expected)} rows; only Spark {only_found}; only SQL {only_expected}"


if __name__ == "__main__":
    from logtrail.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    names = sys.argv[2:] or list(driver.queries())
    session = build_session(
        "compare", "local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
           "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    for query in names:
        begin = time.time()
        try:
            outcome = compare(session, f"/root/testdata/sf{sf}", query) or "ok"
        except Exception as error:  # report and go on with the next query
            outcome = f"ERROR {str(error)[:600]}"
        print(f"{query:24s} {time.time() - begin:6.1f}s {outcome}", flush=True)
