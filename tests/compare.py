"""Run catalogued queries next to their SQL in DuckDB and report differences."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(folder, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, bool):
        return str(v)
    return str(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    return canonical([c[0] for c in cur.description], cur.fetchall())


def difference(got, want) -> str | None:
    """None when equal, else a short account."""
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if bad:
        return f"{len(bad)} of {len(got[1])} rows differ, e.g. {bad[0][0]} != {bad[0][1]}"
    return None
