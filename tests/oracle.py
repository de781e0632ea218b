"""Compare named queries with their SQL in DuckDB."""

from __future__ import annotations

import math
import sys

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "null" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if v is None:
        return "null"
    return str(v)


def kind(v) -> str:
    return "bool" if isinstance(v, bool) else type(v).__name__


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> tuple[int, str | None]:
    """(rows, first difference or None)."""
    got_names = df.columns
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(got_names) != sorted(want_names):
        return len(got), f"columns {sorted(got_names)} != {sorted(want_names)}"
    for n in got_names:
        a = {kind(r[got_names.index(n)]) for r in got[:200]} - {"NoneType"}
        b = {kind(r[want_names.index(n)]) for r in want[:200]} - {"NoneType"}
        if a and b and a != b:
            return len(got), f"types of {n}: {a} != {b}"
    g, w = rows_of(got_names, got), rows_of(want_names, want)
    if g != w:
        gs, ws = set(g), set(w)
        return len(got), f"{len(g)} vs {len(w)} rows; only here {sorted(gs - ws)[:3]}; only there {sorted(ws - gs)[:3]}"
    return len(got), None


if __name__ == "__main__":
    import time

    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    names = sys.argv[2:] or list(entry.queries())
    bad = 0
    for n in names:
        t = time.time()
        try:
            df = entry.queries()[n](spark, sf)
            sql = entry.oracle_sql().get(n)
            count, diff = compare(df, con, sql) if sql else (df.count(), None)
        except Exception as e:
            count, diff = -1, f"{type(e).__name__}: {str(e)[:600]}"
        if diff:
            bad += 1
        print(f"{'BAD' if diff else 'ok '} {n:28s} {count:7d} {time.time() - t:6.2f}s {diff or ''}", flush=True)
    print("failed:", bad)
