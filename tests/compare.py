"""Run registered queries against their SQL counterparts in DuckDB and compare the values exactly."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, datetime.datetime) and value.time() == datetime.time(0):
        return value.date().isoformat()
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0 if value else 0.0
    if isinstance(value, (list, tuple)):
        return tuple(canonical(v) for v in value)
    return value


def canonical_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    made = [tuple(canonical(row[i]) for i in order) for row in rows]
    return sorted(made, key=repr)


def spark_rows(df):
    return sorted(df.columns), canonical_rows(df.columns, [tuple(row) for row in df.collect()])


def sql_rows(con, sql: str):
    cur = con.execute(sql)
    columns = [item[0] for item in cur.description]
    return sorted(columns), canonical_rows(columns, cur.fetchall())


def difference(df, con, sql: str) -> str | None:
    """None when equal, otherwise a short description."""
    columns, rows = spark_rows(df)
    sql_columns, expected = sql_rows(con, sql)
    if columns != sql_columns:
        return f"columns {set(columns) ^ set(sql_columns)}"
    if len(rows) != len(expected):
        return f"rows {len(rows)} != {len(expected)}"
    bad = [(a, b) for a, b in zip(rows, expected) if a != b]
    if not bad:
        kinds = [{type(v) for v in col if v is not None} for col in zip(*rows)] if rows else []
        other = [{type(v) for v in col if v is not None} for col in zip(*expected)] if rows else []
        wrong = [c for c, a, b in zip(columns, kinds, other) if a != b]
        return f"types of {wrong}" if wrong else None
    return f"{len(bad)} rows differ, e.g. {columns}\n  {bad[0][0]}\n  {bad[0][1]}"
