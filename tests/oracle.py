"""Compare a registered query with its SQL, as bags of rows."""

from __future__ import annotations

import collections
import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if hasattr(value, "isoformat"):
        return value.replace(tzinfo=None).isoformat() if hasattr(value, "tzinfo") else value.isoformat()
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), collections.Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str:
    """Empty when equal, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want_names, want = bag(names, cursor.fetchall())
    got_names, got = bag(df.columns, df.collect())
    if want_names != got_names:
        return f"columns {got_names} instead of {want_names}"
    if want == got:
        return ""
    return (
        f"{sum(got.values())} rows, expected {sum(want.values())}; "
        f"only ours: {list((got - want).items())[:3]}; only theirs: {list((want - got).items())[:3]}"
    )
