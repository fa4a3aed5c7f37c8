"""Compare a query with its expected SQL as the gate does: by content, any order."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None when both sides agree, else a short account of how they differ."""
    df = query(spark, sf_dir)
    ours = df.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = bag(df.columns, ours), bag(names, theirs)
    if a == b:
        return None
    extra, missing = list((a - b).items())[:3], list((b - a).items())[:3]
    return f"rows {len(ours)} vs {len(theirs)}; only ours {extra}; only expected {missing}"
