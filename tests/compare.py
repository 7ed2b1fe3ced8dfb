"""Runs a query and its SQL side by side, the way the correctness gate does."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def duck(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def differences(frame, connection, sql: str, digits: int | None = None) -> str | None:
    """None if rows agree as bags, else what differs first."""
    columns = sorted(frame.columns)
    got = [tuple(plain(r[c]) for c in columns) for r in frame.select(columns).collect()]
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}"
    order = [names.index(c) for c in columns]
    want = [tuple(plain(r[k]) for k in order) for r in result.fetchall()]
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    shaped = lambda rows: sorted(rows, key=lambda r: tuple((x is None, str(type(x)) if not isinstance(x, (int, float)) else "", x if x is not None else 0) for x in r))
    got, want = shaped(got), shaped(want)
    for a, b in zip(got, want, strict=True):
        if a != b and not (digits is not None and all(x == y or isinstance(x, float) and isinstance(y, (int, float)) and abs(x - y) <= 10.0**-digits for x, y in zip(a, b, strict=True))):
            return f"{dict(zip(columns, a, strict=True))} against {dict(zip(columns, b, strict=True))}"
    return None
