"""Runs a registered query and its SQL on the same tables and compares them."""

from __future__ import annotations

import math
import sys
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, (bytes, bytearray)):
        return bytes(x)
    if isinstance(x, float):
        return round(x, 6)
    return x


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def differences(frame, con, sql: str) -> str | None:
    cursor = con.execute(sql)
    want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}; spark {got[1][:2]} sql {want[1][:2]}"
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    return f"{len(bad)} of {len(got[1])} rows differ, first {bad[:2]}" if bad else None


if __name__ == "__main__":
    import time

    sys.path[:0] = [str(Path(__file__).resolve().parent.parent)]
    import __spark_entry__ as entry
    from polarscan.session import build_session

    sf = sys.argv[1]
    names = sys.argv[2:]
    spark = build_session("oracle", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sqls = connect(sf), entry.queries(), entry.oracle_sql()
    failed = []
    for name in [n for n in queries if not names or any(n.startswith(x) for x in names)]:
        start = time.time()
        try:
            frame = queries[name](spark, sf)
            problem = differences(frame, con, sqls[name]) if name in sqls else f"rows-only: {frame.count()}"
        except Exception as error:
            problem = f"ERROR {str(error)[:1500]}"
        ok = problem is None or problem.startswith("rows-only")
        print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
        failed += [] if ok else [name]
    print("failed:", failed)
