"""Run registered queries in Spark and their SQL in DuckDB, and compare names, types and rows.

usage: python tools/compare.py FOLDER [query name or prefix* ...]
"""

from __future__ import annotations

import fnmatch
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martwright.registry import CASES  # noqa: E402
from martwright.session import local_session  # noqa: E402

TYPES = {"int": "integer", "string": "varchar", "timestamp_ntz": "timestamp"}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(os.listdir(folder)):
        name = file.removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{folder}/{file}'")
    return con


def rows_of(frame_rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in frame_rows)


def compare(spark, con, folder: str, name: str, df=None) -> str:
    """Empty when both sides agree, else what differs."""
    case = CASES[name]
    df = case.run(spark, folder) if df is None else df
    have = rows_of(df.collect(), df.columns)
    if case.sql is None:
        return ""
    result = con.execute(case.sql)
    columns = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]).lower() for d in result.description}
    want = rows_of(result.fetchall(), columns)
    if sorted(columns) != sorted(df.columns):
        return f"columns differ: {sorted(set(columns) ^ set(df.columns))}"
    types = [(c, TYPES.get(k, k), kinds[c].replace(" ", "")) for c, k in df.dtypes]
    wrong = [t for t in types if t[1] != t[2]]
    if len(have) != len(want):
        return f"rows differ: {len(have)} against {len(want)}; types {wrong}"
    if have != want:
        a, b = next((a, b) for a, b in zip(have, want) if a != b)
        return f"values differ:\n   {a}\n   {b}"
    return f"types differ: {wrong}" if wrong else ""


def main() -> int:
    folder, patterns = sys.argv[1], sys.argv[2:] or ["*"]
    names = [n for n in CASES if any(fnmatch.fnmatch(n, p) for p in patterns)]
    spark, con, failed = local_session(cores=8), duck(folder), 0
    for name in names:
        started = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        checked = "ok  " if CASES[name].sql else "run "
        print(f"{'FAIL' if problem else checked} {name} {time.time() - started:.2f}s {problem}")
    print(f"{len(names)} queries, {failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
