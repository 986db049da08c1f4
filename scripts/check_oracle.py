"""Run every registered query on Spark and its oracle SQL on DuckDB, and
compare row counts, column names and order-insensitive values.

usage: python scripts/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from meterflow.queries import REGISTRY  # noqa: E402
from meterflow.session import build_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    return repr(v)


def rows_spark(df):
    cols = sorted(df.columns)
    return cols, Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())


def rows_duck(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    data = cur.fetchall()
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, Counter(tuple(norm(r[i]) for i in idx) for r in data)


def main() -> int:
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)] or list(REGISTRY)
    if os.environ.get("VANILLA"):
        # a plain session, as a caller might bring: no engine settings applied
        from pyspark.sql import SparkSession

        spark = (
            SparkSession.builder.master("local[8]")
            .config("spark.sql.shuffle.partitions", "8")
            .config("spark.ui.enabled", "false")
            .config("spark.sql.session.timeZone", os.environ.get("VANILLA_TZ", "America/New_York"))
            .config("spark.sql.ansi.enabled", os.environ.get("VANILLA_ANSI", "false"))
            .getOrCreate()
        )
    else:
        spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for name in names:
        q = REGISTRY[name]
        t0 = time.time()
        try:
            sc, sr = rows_spark(q.build(spark, sf))
        except Exception as exc:  # report and continue
            print(f"FAIL  {name}: spark error {type(exc).__name__}: {str(exc)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if not q.oracle:
            print(f"ROWS  {name}: {sum(sr.values())} rows ({ts:.1f}s, no oracle)")
            continue
        try:
            dc, dr = rows_duck(con, q.oracle)
        except Exception as exc:
            print(f"FAIL  {name}: duckdb error {str(exc)[:400]}")
            bad += 1
            continue
        if sc != dc:
            print(f"FAIL  {name}: columns spark={sc} duck={dc}")
            bad += 1
        elif sr != dr:
            only_s = list((sr - dr).elements())[:3]
            only_d = list((dr - sr).elements())[:3]
            print(f"FAIL  {name}: rows spark={sum(sr.values())} duck={sum(dr.values())}\n   spark-only {only_s}\n   duck-only  {only_d}")
            bad += 1
        else:
            print(f"OK    {name}: {sum(sr.values())} rows ({ts:.1f}s)")
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
