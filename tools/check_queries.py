"""Run named queries and their SQL on the same tables and compare the rows.

    python tools/check_queries.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from datetime import date, datetime

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from emberline.registry import BOOK
from emberline.session import build_session


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return value + 0.0 if value != int(value) or abs(value) > 1e15 else float(int(value))
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    return value


def table_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(repr([plain(r[i]) for i in order]) for r in rows)


def compare(spark, connection, sf_dir, entry):
    start = time.perf_counter()
    df = entry.query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    seconds = time.perf_counter() - start
    if entry.sql is None:
        return seconds, len(rows), "rows only" if rows else "EMPTY"
    result = connection.execute(entry.sql)
    names = [d[0] for d in result.description]
    mine, theirs = table_of(df.columns, rows), table_of(names, result.fetchall())
    if mine[0] != theirs[0]:
        return seconds, len(rows), f"COLUMNS {mine[0]} vs {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return seconds, len(rows), f"ROWS {len(mine[1])} vs {len(theirs[1])}"
    wrong = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    if wrong:
        return seconds, len(rows), f"VALUES {len(wrong)} differ: {wrong[0][0]} vs {wrong[0][1]}"
    return seconds, len(rows), "equal"


def main(sf_dir, names):
    spark = build_session(
        master="local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb.connect()
    for name in os.listdir(sf_dir):
        if name.endswith(".parquet"):
            connection.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{sf_dir}/{name}'")
    bad = 0
    for name in names or BOOK:
        try:
            seconds, n, verdict = compare(spark, connection, sf_dir, BOOK[name])
        except Exception as error:
            seconds, n, verdict = 0.0, 0, f"ERROR {type(error).__name__}: {str(error)[:600]}"
        bad += verdict not in ("equal", "rows only")
        print(f"{name:34s} {seconds:7.2f} s {n:7d} rows  {verdict}", flush=True)
    print(f"{bad} not equal of {len(names or BOOK)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
