"""Compare registered queries with their SQL. Usage: oracle_check.py [sf_dir] [name ...]"""
from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def canonical(v):
    if v is None:
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, int):
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return str(v)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def compare(con, sql: str, df, counts: list | None = None):
    """None if equal, else a short description of the difference."""
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    if counts is not None:
        counts.append(len(got[1]))
    cur = con.execute(sql)
    want = normal([c[0] for c in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} vs {want[0]}"
    if got[1] != want[1]:
        a, b = set(got[1]), set(want[1])
        return (f"rows {len(got[1])} vs {len(want[1])}; only spark {len(a - b)}: {sorted(a - b)[:2]}; "
                f"only sql {len(b - a)}: {sorted(b - a)[:2]}")
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(e.queries())
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), e.oracle_sql(), 0
    for name in names:
        t0, counts = time.time(), []
        try:
            df = e.queries()[name](spark, sf_dir)
            diff = compare(con, sqls[name], df, counts) if name in sqls else "no oracle"
        except Exception as x:  # noqa: BLE001
            diff = f"{type(x).__name__}: {str(x)[:700]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} {time.time() - t0:.1f}s rows={counts} {diff or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} equal")
    return bad


if __name__ == "__main__":
    sys.exit(main())
