"""Runs a query on Spark and its SQL on DuckDB and compares rows, columns and values."""

from __future__ import annotations

import datetime
import decimal
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(repr(plain(r[i])) for i in order) for r in rows])


def difference(df, con, sql) -> str | None:
    """None when equal, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    if len(want) != len(got):
        return f"{len(got)} rows instead of {len(want)}"
    for g, w in zip(got, want, strict=True):
        if g != w:
            return f"{g} instead of {w}"
    return None


if __name__ == "__main__":
    import sys
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries

    from sluiceworks.session import session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = session(master="local[8]", spark_ui_enabled="false", spark_sql_shuffle_partitions="8",
                    spark_driver_memory="8g", spark_ui_showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    wanted = sys.argv[1:] or list(queries())
    for name in wanted:
        start = time.time()
        try:
            df = queries()[name](spark, folder)
            sql = oracle_sql().get(name)
            result = difference(df, con, sql) if sql else f"no oracle, {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            result = f"{type(e).__name__}: {str(e)[:600]}"
        failed += result is not None
        print(f"{time.time() - start:6.1f}s {name}: {result or 'same'}", flush=True)
    print(f"{failed} of {len(wanted)} differ")
