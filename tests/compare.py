"""Runs a query and its SQL on the same tables and says how they differ."""

from __future__ import annotations

import datetime
import glob
import math
import os
from collections import Counter

import duckdb


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return db


def value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def difference(df, db, sql: str) -> str | None:
    """None where columns and all rows, as a multiset, are the same."""
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} but SQL has {sorted(names)}"
    order = sorted(names)
    theirs = Counter(tuple(value(r[names.index(c)]) for c in order) for r in cursor.fetchall())
    ours = Counter(tuple(value(r[c]) for c in order) for r in df.collect())
    if ours == theirs:
        return None
    return f"{sum(ours.values())} rows but SQL has {sum(theirs.values())}; only here {list((ours - theirs).items())[:3]}; only there {list((theirs - ours).items())[:3]}"
