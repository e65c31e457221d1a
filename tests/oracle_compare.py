"""Run a Spark DataFrame and a DuckDB statement on the same parquet tables and
compare them order-insensitively (columns sorted by name, values normalised)."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
from collections import Counter

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "nan"
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v if isinstance(v, (str, int, bool)) else str(v)


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def value_hash(c: Counter) -> str:
    h = hashlib.sha256()
    for row, n in sorted(c.items(), key=lambda kv: repr(kv[0])):
        h.update(repr((row, n)).encode())
    return h.hexdigest()


def compare(spark_df, sql: str, sf_dir: str, con=None) -> dict:
    spark_cols = spark_df.columns
    spark_rows = [tuple(r) for r in spark_df.collect()]
    con = con or duck(sf_dir)
    res = con.execute(sql)
    duck_cols = [d[0] for d in res.description]
    duck_rows = res.fetchall()
    a, b = rows_of(spark_cols, spark_rows), rows_of(duck_cols, duck_rows)
    out = {
        "columns_match": sorted(spark_cols) == sorted(duck_cols),
        "spark_rows": len(spark_rows), "oracle_rows": len(duck_rows),
        "values_match": a == b,
        "spark_cols": sorted(spark_cols), "oracle_cols": sorted(duck_cols),
    }
    if not out["values_match"]:
        out["only_spark"] = list((a - b).items())[:3]
        out["only_oracle"] = list((b - a).items())[:3]
    return out
