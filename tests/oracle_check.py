"""Run every registered query on Spark and its SQL on DuckDB and compare all rows.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from parcelwise.plans.catalog import QUERIES
from parcelwise.plans.oracles import ORACLES
from parcelwise.session import local_session
from parcelwise.sources.homes import TABLES


def canonical_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(x):
        if x is None or (isinstance(x, float) and x != x):
            return ""
        return repr(float(x)) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(con, got_columns: list[str], got: list[tuple], sql: str) -> str:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(columns) != sorted(got_columns):
        return f"columns differ: {sorted(set(columns) ^ set(got_columns))}"
    a, b = canonical_rows(got_columns, got), canonical_rows(columns, want)
    if a == b:
        return "ok"
    differing = [(x, y) for x, y in zip(a, b) if x != y]
    example = [(p, q) for p, q in zip(*differing[0]) if p != q][:4] if differing else ""
    return f"DIFFERENT: {len(a)} vs {len(b)} rows, {len(differing)} differ, e.g. {example}"


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = local_session("oracle-check")
    spark.sparkContext.setLogLevel("OFF")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    failed = 0
    for name, run in QUERIES.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = run(spark, sf)
            rows = [tuple(r) for r in df.collect()]
            verdict = compare(con, df.columns, rows, ORACLES[name]) if name in ORACLES else "no SQL"
        except Exception as error:  # report and go on to the next query
            verdict = f"FAILED {type(error).__name__}: {str(error)[:400]}"
        failed += verdict not in ("ok", "no SQL")
        print(f"{name:28s} {time.time() - start:6.2f}s  {verdict}", flush=True)
        spark.catalog.clearCache()
    print("all equal" if not failed else f"{failed} not equal")
    return failed


if __name__ == "__main__":
    sys.exit(main())
