"""Run registered queries against their SQL text in DuckDB and report differences.

Usage: python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_of(cursor_rows):
    return Counter(tuple(plain(v) for v in row) for row in cursor_rows)


def connect(folder: str):
    from arrears.sources.views import BASE_TABLES

    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def difference(spark, con, folder: str, entry) -> tuple[str | None, int]:
    """Text of the first difference, or None, and the number of Spark rows."""
    df = entry.run(spark, folder)
    names = sorted(df.columns)
    mine = rows_of(tuple(r) for r in df.select(*names).collect())
    count = sum(mine.values())
    if entry.oracle is None:
        return None, count
    expected = rows_of(con.execute(f"SELECT {', '.join(names)} FROM ({entry.oracle}) q").fetchall())
    if mine == expected:
        return None, count
    only_mine, only_theirs = mine - expected, expected - mine
    return (
        f"{count} rows against {sum(expected.values())}; columns {names}\n"
        f"   spark only ({sum(only_mine.values())}): {list(only_mine)[:3]}\n"
        f"   sql only   ({sum(only_theirs.values())}): {list(only_theirs)[:3]}"
    ), count


def main(folder: str, names: list[str]) -> int:
    from arrears.session import build_session
    from catalogue import REGISTRY

    spark = build_session("compare", "local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names or list(REGISTRY):
        start = time.time()
        try:
            text, count = difference(spark, con, folder, REGISTRY[name])
        except Exception as error:  # a broken query must not hide the others
            text, count = f"{type(error).__name__}: {str(error)[:600]}", -1
        kind = "sql " if REGISTRY[name].sql else "rows"
        print(f"{'ok  ' if text is None else 'FAIL'} {kind} {name:32s} {count:8d} rows {time.time() - start:6.2f} s", flush=True)
        if text:
            failed += 1
            print("   " + text, flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    arguments = sys.argv[1:]
    where = arguments.pop(0) if arguments and arguments[0].startswith("/") else "/root/testdata/sf0.01"
    sys.exit(1 if main(where, arguments) else 0)
