"""Run registered queries in Spark and in DuckDB and compare the rows.

    python -m checks.compare [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import time
from collections import Counter

import duckdb

from checks.registry import ORACLES, QUERIES
from postloom.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    return str(value) if isinstance(value, dt.date) else value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def main() -> int:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("names", nargs="*")
    options = args.parse_args()
    spark = build_session("local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(options.sf)
    bad = 0
    for name in options.names or QUERIES:
        started = time.time()
        try:
            df = QUERIES[name](spark, options.sf)
            ours = rows_of(df.columns, df.collect())
            spark_s = time.time() - started
            if name not in ORACLES:
                print(f"{name:28} rows {ours.total():7} (no SQL)", flush=True)
                continue
            started = time.time()
            relation = con.execute(ORACLES[name])
            names = [d[0] for d in relation.description]
            theirs = rows_of(names, relation.fetchall())
        except Exception as error:  # noqa: BLE001 - report and go on
            bad += 1
            print(f"{name:28} ERROR {str(error)[:700]}", flush=True)
            continue
        same = sorted(df.columns) == sorted(names) and ours == theirs
        bad += not same
        print(f"{name:28} {'ok  ' if same else 'DIFF'} rows {ours.total():7} {theirs.total():7} "
              f"spark {spark_s:5.1f}s sql {time.time() - started:5.1f}s", flush=True)
        if not same:
            print("   columns", sorted(df.columns), sorted(names))
            for side, rows in (("spark", ours - theirs), ("sql", theirs - ours)):
                for row in list(rows)[:2]:
                    print("  ", side, str(row)[:600])
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
