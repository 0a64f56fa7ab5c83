"""Run a query and its SQL side by side and compare rows, whatever their order."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if hasattr(value, "isoformat"):
        return value.isoformat(sep=" ") if hasattr(value, "hour") else value.isoformat()
    if isinstance(value, float):
        return repr(value)
    return value


def typed(value):
    return None if value is None else plain(value)


def rows_of_spark(df) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    return columns, [tuple(plain(v) for v in r) for r in df.select(columns).collect()]


def rows_of_sql(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(plain(r[i]) for i in order) for r in cur.fetchall()]


def difference(df, con, sql: str) -> str | None:
    s_cols, s_rows = rows_of_spark(df)
    d_cols, d_rows = rows_of_sql(con, sql)
    if s_cols != d_cols:
        return f"columns {s_cols} against {d_cols}"
    key = lambda r: tuple((v is None, str(v)) for v in r)
    s_rows.sort(key=key)
    d_rows.sort(key=key)
    if len(s_rows) != len(d_rows):
        only = set(s_rows) ^ set(d_rows)
        return f"{len(s_rows)} rows against {len(d_rows)}; e.g. {list(only)[:3]}"
    for a, b in zip(s_rows, d_rows):
        if a != b:
            return f"{a} against {b}"
    return None
