"""Compare a registered Spark query with its SQL equivalent, value by value."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def as_counter(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql) -> str | None:
    """None when equal, else a short account of what differs."""
    rows = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    mine, theirs = as_counter(df.columns, rows), as_counter(names, expected)
    if mine == theirs:
        return None
    extra, missing = list((mine - theirs))[:2], list((theirs - mine))[:2]
    account = [f"rows {len(rows)} / {len(expected)}"]
    for a, b in zip(extra, missing):
        account += [f"{n}: {x!r} / {y!r}" for n, x, y in zip(sorted(names), a, b) if x != y]
    return "; ".join(account + [f"only here {extra[:1]}", f"only there {missing[:1]}"])[:1500]
