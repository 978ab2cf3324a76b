"""Run registered queries against their SQL checks and report times.

    python tests/check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from larkspur.plans.catalog import ORACLES, QUERIES  # noqa: E402
from larkspur.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return con


def canonical(rows: list[tuple], names: list[str]) -> list[str]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(_plain(r[i]) for i in order)) for r in rows)


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (int, float)):
        return float(value)
    return str(value)


def compare(spark_rows, spark_names, sql_rows, sql_names) -> str:
    if sorted(spark_names) != sorted(sql_names):
        return f"columns {sorted(spark_names)} <> {sorted(sql_names)}"
    a, b = canonical(spark_rows, spark_names), canonical(sql_rows, sql_names)
    if a == b:
        return ""
    only_a, only_b = [x for x in set(a) - set(b)], [x for x in set(b) - set(a)]
    return f"rows {len(a)} / {len(b)}, differ {len(only_a)} / {len(only_b)}: {sorted(only_a)[:2]} / {sorted(only_b)[:2]}"


def check(spark, con, sf: str, name: str) -> tuple[str, int, float]:
    start = time.time()
    df = QUERIES[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    seconds = time.time() - start
    if name not in ORACLES:
        return ("" if rows else "no rows"), len(rows), seconds
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    return compare(rows, df.columns, result.fetchall(), names), len(rows), seconds


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    spark, con, bad = local_session("check"), connect(options.sf), 0
    spark.sparkContext.setLogLevel("OFF")
    for name in options.names or QUERIES:
        try:
            problem, rows, seconds = check(spark, con, options.sf, name)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem, rows, seconds = f"{type(error).__name__}: {str(error)[:600]}", -1, 0.0
        bad += bool(problem)
        kind = "sql " if name in ORACLES else "rows"
        print(f"{'BAD ' if problem else 'ok  '} {kind} {name:26s} {rows:8d} {seconds:7.2f}s {problem}", flush=True)
    print(f"{bad} bad")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
