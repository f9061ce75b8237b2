"""Run a registered query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def differences(df, con, sql: str) -> str | None:
    """None when names, number of rows and all values agree, else what differs."""
    left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    right = rows_of([d[0] for d in result.description], result.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows != {len(right[1])}"
    if not left[1]:
        return "no rows"
    bad = [(a, b) for a, b in zip(left[1], right[1]) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    if bad:
        return f"{len(bad)} of {len(left[1])} rows differ on {left[0]}, e.g. {bad[0][0]} != {bad[0][1]}"
    return None
