"""Compare registered queries with their SQL in DuckDB: python tests/check_queries.py [sf] [name ...]."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _norm(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def compare(spark, con, build, sql, sf_dir):
    """None when equal, else what differs."""
    df = build(spark, sf_dir)
    table = df.toArrow()
    spark_columns, spark_rows = rows_of(df.columns, list(zip(*[c.to_pylist() for c in table.columns])) if table.num_rows else [])
    if sql is None:
        return None, len(spark_rows)
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    duck_columns, duck_rows = rows_of(names, got.fetchall())
    if spark_columns != duck_columns:
        return f"columns {spark_columns} != {duck_columns}", len(spark_rows)
    if len(spark_rows) != len(duck_rows):
        return f"rows {len(spark_rows)} != {len(duck_rows)}", len(spark_rows)
    for a, b in zip(spark_rows, duck_rows):
        if a != b:
            return f"{spark_columns}: {a} != {b}", len(spark_rows)
    return None, len(spark_rows)


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = []
    for name, build in queries.items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        start = time.time()
        try:
            problem, n = compare(spark, con, build, oracles.get(name), sf_dir)
        except Exception as exc:  # report and go on
            problem, n = f"{type(exc).__name__}: {str(exc)[:600]}", -1
        took = time.time() - start
        if problem:
            bad.append(name)
        print(f"{'BAD ' if problem else 'ok  '} {name} rows={n} {took:.1f}s {'' if name in oracles else '(no sql)'} {problem or ''}", flush=True)
    print(f"{len(bad)} bad: {bad}")
    spark.stop()


if __name__ == "__main__":
    main()
