"""Compare registered queries with their SQL twins on the same parquet tables."""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    """Values as the clients hand them out, without hiding a difference in type."""
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, (dt.date, dt.datetime)):
        return ("time", str(value))
    return (type(value).__name__, value)


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(spark_columns, spark_rows, sql_columns, sql_rows) -> str:
    """Empty when both sides hold the same rows, else what differs first."""
    if sorted(spark_columns) != sorted(sql_columns):
        return f"columns {sorted(spark_columns)} != {sorted(sql_columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} != {len(sql_rows)}"
    left, right = bag(spark_columns, spark_rows), bag(sql_columns, sql_rows)
    if left == right:
        return ""
    extra, missing = left - right, right - left
    cut = lambda c: str(sorted(c, key=str)[:2])[:700]
    return f"{sum(extra.values())} rows differ; spark {cut(extra)} sql {cut(missing)}"


def run(spark, con, name, query, sf_dir) -> str:
    df = query.run(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if query.sql is None:
        return "" if rows else "no rows"
    cursor = con.execute(query.sql)
    columns = [d[0] for d in cursor.description]
    return difference(df.columns, rows, columns, cursor.fetchall())


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from caselabel.catalog import REGISTRY
    from caselabel.session import local_session

    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(REGISTRY)
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            found = run(spark, con, name, REGISTRY[name], sf_dir)
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s {found}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
