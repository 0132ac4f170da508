"""Compare a Spark result with the SQL statement of the same name, row by row."""

from __future__ import annotations

import datetime
import glob
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return float(value) if abs(value) < 2**50 else value
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(con, df, sql: str) -> list[str]:
    """Empty if equal, otherwise a few lines that say what differs."""
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    if sorted(want_columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(want_columns)}"]
    want = rows_of(want_columns, result.fetchall())
    got = rows_of(df.columns, df.collect())
    out = []
    if sum(want.values()) != sum(got.values()):
        out.append(f"rows {sum(got.values())} != {sum(want.values())}")
    names = sorted(df.columns)
    out += [f"only spark: {dict(zip(names, r))}" for r in list((got - want))[:3]]
    out += [f"only sql:   {dict(zip(names, r))}" for r in list((want - got))[:3]]
    return out
