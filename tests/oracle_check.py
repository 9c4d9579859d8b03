"""Run registered queries next to their SQL and report differences.

Usage: python tests/oracle_check.py [data folder] [name part ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return value
    return str(value)


def as_set(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        tuple(str(plain(r[i])) for i in order) for r in rows
    )


def kinds(names, rows):
    found = {}
    for row in rows:
        for name, value in zip(names, row):
            if value is not None and name not in found:
                found[name] = type(value).__name__
    return found


def compare(spark, con, folder, name, build, sql):
    started = time.time()
    df = build(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    spark_seconds = time.time() - started
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan:
        return "DIFF", len(rows), spark_seconds, "plan has a cross product"
    if sql is None:
        return "rows-only", len(rows), spark_seconds, ""
    rel = con.sql(sql)
    names, expected = list(rel.columns), rel.fetchall()
    left, right = as_set(df.columns, rows), as_set(names, expected)
    note = ""
    if left[0] != right[0]:
        note = f"columns {left[0]} vs {right[0]}"
    elif len(left[1]) != len(right[1]):
        note = f"rows {len(left[1])} vs {len(right[1])}"
    elif left[1] != right[1]:
        diff = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
        note = f"{len(diff)} rows differ, first {diff[0]}"
    elif kinds(df.columns, rows) != kinds(names, expected):
        note = f"types {kinds(df.columns, rows)} vs {kinds(names, expected)}"
    return ("ok" if not note else "DIFF"), len(rows), spark_seconds, note


def session(partitions: int = 8):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


if __name__ == "__main__":
    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    oracle = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        try:
            status, n, seconds, note = compare(spark, con, folder, name, build, oracle.get(name))
        except Exception as exc:  # report and go on with the next query
            status, n, seconds, note = "ERROR", -1, 0.0, str(exc)[:1500]
        bad += status in ("DIFF", "ERROR")
        print(f"{status:9} {name:40} rows={n:<8} {seconds:6.2f}s {note}", flush=True)
    print("failed:", bad)
