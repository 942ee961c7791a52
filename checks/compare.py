"""Run a query in Spark and its SQL in DuckDB and compare the rows as multisets."""

from __future__ import annotations

import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    return value


def multiset(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> str | None:
    """None when both sides agree, otherwise a short description."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = multiset(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} expected {sorted(names)}"
    got = multiset(df.columns, [tuple(r) for r in df.collect()])
    if got == want:
        return None
    extra, lost = got - want, want - got
    return (
        f"rows {sum(got.values())} expected {sum(want.values())}; "
        f"extra {list(extra.items())[:3]} missing {list(lost.items())[:3]}"
    )
