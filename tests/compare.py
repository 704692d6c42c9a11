"""Run registered queries in Spark and their twins in DuckDB and compare every value.

Usage: python tests/compare.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return ("ts", v.isoformat())
    if isinstance(v, dt.date):
        return ("date", v.isoformat())
    return v


def _kind(v):
    return type(_plain(v)).__name__


def spark_rows(df):
    names = sorted(df.columns)
    return names, [tuple(_plain(r[c]) for c in names) for r in df.collect()]


def duck_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], [tuple(_plain(r[i]) for i in order) for r in cur.fetchall()]


def differences(left, right):
    (ln, lr), (rn, rr) = left, right
    if ln != rn:
        return f"columns {ln} vs {rn}"
    ls, rs = sorted(lr, key=repr), sorted(rr, key=repr)
    if ls != rs or [[type(x) for x in r] for r in ls] != [[type(x) for x in r] for r in rs]:
        only_l = [r for r in ls if r not in set(rs)][:3]
        only_r = [r for r in rs if r not in set(ls)][:3]
        return f"rows {len(ls)} vs {len(rs)}\n   {ln}\n   spark only {only_l}\n   sql only   {only_r}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            left = spark_rows(build(spark, sf_dir))
            took = time.time() - start
            if name not in oracles:
                print(f"rows  {name} {len(left[1])} {took:.2f}s")
                continue
            start = time.time()
            problem = differences(left, duck_rows(con, oracles[name]))
            duck = time.time() - start
        except Exception as error:  # noqa: BLE001
            problem, took, duck = f"{type(error).__name__}: {str(error)[:1500]}", 0, 0
        if problem:
            bad += 1
        print(f"{'FAIL ' if problem else 'ok   '} {name} {len(left[1]) if not problem else ''} {took:.2f}s sql {duck:.2f}s {problem or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
