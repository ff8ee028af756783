"""Compare registered queries with their SQL in DuckDB on the same Parquet files."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(data_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, con, key: str, run, sql: str, data_dir: str) -> tuple[bool, str]:
    start = time.time()
    df = run(spark, data_dir)
    got_names, got = df.columns, [tuple(r) for r in df.collect()]
    took = time.time() - start
    start = time.time()
    cursor = con.execute(sql)
    want_names, want = [d[0] for d in cursor.description], cursor.fetchall()
    note = f"{len(got)} rows, spark {took:.1f}s, sql {time.time() - start:.1f}s"
    if sorted(got_names) != sorted(want_names):
        return False, f"columns {sorted(set(got_names) ^ set(want_names))}; {note}"
    a, b = bag(got_names, got), bag(want_names, want)
    if a != b:
        extra, missing = list((a - b).items())[:2], list((b - a).items())[:2]
        return False, f"{sorted(got_names)}\n   only spark ({sum((a - b).values())}) {extra}\n   only sql ({sum((b - a).values())}) {missing}; {note}"
    return True, note


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from ledgerloom.session import build_session

    data = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(data), entry.oracle_sql(), []
    for key, run in entry.queries().items():
        if wanted and key not in wanted:
            continue
        if key not in sqls:
            print("ROWS", key, run(spark, data).count(), flush=True)
            continue
        try:
            ok, note = compare(spark, con, key, run, sqls[key], data)
        except Exception as e:  # report and go on with the next query
            ok, note = False, f"{type(e).__name__} {str(e)[:900]}"
        print("ok  " if ok else "FAIL", key, note, flush=True)
        bad += [] if ok else [key]
    print(f"{len(bad)} failed: {bad}")
