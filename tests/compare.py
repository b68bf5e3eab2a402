"""Runs registered queries in Spark and their SQL in DuckDB, and compares the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(
        tuple(plain(r[i]) for i in order) for r in rows
    )


def compare(spark, con, sf_dir, query, sql):
    """``None`` if equal, else a description of the difference."""
    df = query(spark, sf_dir)
    names, got = bag(df.columns, df.collect())
    cur = con.execute(sql)
    want_names, want = bag([c[0] for c in cur.description], cur.fetchall())
    if names != want_names:
        return f"columns {names} != {want_names}"
    if got != want:
        extra, lack = got - want, want - got
        return (
            f"{sum(got.values())} rows, expected {sum(want.values())}; "
            f"extra {list(extra.items())[:3]}; missing {list(lack.items())[:3]}"
        )
    return None


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from tallybook.catalog import oracle_sql, queries
    from tallybook.session import build_session

    sf_dir, wanted = argv[1], argv[2:]
    spark = build_session(
        "compare",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = oracle_sql()
    bad = 0
    for name, query in queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        if name not in oracles:
            print("no sql", name)
            continue
        started = time.time()
        try:
            diff = compare(spark, con, sf_dir, query, oracles[name])
        except Exception as e:
            diff = f"{type(e).__name__}: {str(e)[:600]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'DIFF'} {name} {time.time() - started:.2f}s {diff or ''}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main(sys.argv)
