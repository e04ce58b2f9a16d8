"""Runs a registered query and its SQL side by side and reports the first difference."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _sort_key(row):
    return [(v is not None, str(type(v)), v if not isinstance(v, bool) else int(v)) for v in row]


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=_sort_key)


def differences(df, con, sql) -> str | None:
    cur = con.execute(sql)
    want_cols, want = rows_of([c[0] for c in cur.description], cur.fetchall())
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    kinds = {type(v) for row in want for v in row} ^ {type(v) for row in got for v in row}
    for g, w in zip(got, want):
        if g != w:
            bad = [(c, a, b) for c, a, b in zip(got_cols, g, w) if a != b]
            return f"first difference: {str(bad)[:600]}"
    return f"types differ: {kinds}" if kinds - {type(None)} else None
