"""Small made-up streams, and plain-Python answers to check against."""

from __future__ import annotations

import datetime as dt
import random

BASE_MS = 1_600_000_000_000

RATE_SCHEMA = "id BIGINT, hbdm STRING, ts BIGINT, num INT"


def at(ms: int) -> dt.datetime:
    return dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc)


def skewed(n: int = 240, seed: int = 7) -> list[tuple]:
    """Rates with ties in time, nulls, a null key, and one key with most of the rows."""
    rng = random.Random(seed)
    rows, ts = [], BASE_MS
    for i in range(n):
        ts += rng.choice([0, 0, 1, 100, 900, 1000, 1001, 5000])
        code = rng.choice(["CNY"] * 5 + ["USD", "EUR", None])
        rows.append((i, code, ts, rng.choice([None, 0, 1, 2, 3, -4])))
    rng.shuffle(rows)
    return rows


def frame(spark, rows, schema: str = RATE_SCHEMA):
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, schema).withColumn("et", F.timestamp_millis("ts"))


def by_key(rows: list[tuple]) -> dict:
    groups: dict = {}
    for row in sorted(rows, key=lambda r: (r[2], r[0])):
        groups.setdefault(row[1], []).append(row)
    return groups


def total(values) -> int | None:
    known = [v for v in values if v is not None]
    return sum(known) if known else None
