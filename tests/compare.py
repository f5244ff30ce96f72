"""Compare a Spark result with a DuckDB result as multisets of rows."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, bool):
        return ("bool", value)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def assert_same(df, con: duckdb.DuckDBPyConnection, sql: str) -> int:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    expected = rows_of(names, result.fetchall())
    actual = rows_of(df.columns, df.collect())
    missing, surplus = expected - actual, actual - expected
    assert not missing and not surplus, (
        f"{sum(missing.values())} missing, e.g. {list(missing)[:3]}; "
        f"{sum(surplus.values())} surplus, e.g. {list(surplus)[:3]}"
    )
    return sum(actual.values())
