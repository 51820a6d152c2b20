"""Run queries in Spark and their SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def oracle_connection(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def difference(df, con, sql: str) -> str | None:
    """What differs between a Spark result and the SQL answer; None if nothing does."""
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want = _sorted(want_columns, result.fetchall())
    got = _sorted(df.columns, df.collect())
    if sorted(want_columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(want_columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    for g, w in zip(got, want):
        if g != w or [type(v) for v in g] != [type(v) for v in w]:
            return f"row {g} instead of {w} in columns {sorted(df.columns)}"
    return None
