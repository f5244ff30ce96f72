"""Deduplication with built-in state that the watermark evicts.

Each form keys on a time window of the event time, so state for a window is dropped
once the watermark passes its end, and rows of a closed window count as late.  A row
is passed on at once.  Within a micro-batch Spark does not say which duplicate that
is; across batches the earlier batch wins.  :func:`first_in_bucket` waits for the
window to close instead and then gives the first row to arrive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import hashing
from tidemark.functions.time import bucket_key, duration_ms, time_bucket

_WINDOW = "_window"


def _drop_within(df: DataFrame, et: str, window: str, delay: str, keys: dict[str, Column | str]) -> DataFrame:
    """Drop duplicates of ``keys`` inside the event-time window."""
    timed = df.withWatermark(et, delay).withColumn(_WINDOW, F.window(F.col(et), window))
    staged = timed.withColumns({n: F.col(c) if isinstance(c, str) else c for n, c in keys.items()})
    # Two event-time columns would leave Spark no single one to evict by.
    return staged.drop(et).dropDuplicates([*keys, _WINDOW])


def dedup_bucket(
    df: DataFrame,
    width: str,
    delay: str = "1 second",
    window: str = "30 seconds",
    keys: Sequence[str] = ("hbdm",),
    ts: str = "ts",
    et: str = "et",
) -> DataFrame:
    """One row per key and bucket; ``et`` is left out of the result, ``ts`` stays."""
    bucket = {"_bucket": time_bucket(ts, duration_ms(width))}
    unique = _drop_within(df, et, window, delay, {**{k: k for k in keys}, **bucket})
    return unique.drop(_WINDOW, "_bucket")


def first_in_bucket(
    df: DataFrame,
    width: str,
    order: Sequence[str],
    delay: str = "1 second",
    window: str = "30 seconds",
    keys: Sequence[str] = ("hbdm",),
    ts: str = "ts",
    et: str = "et",
) -> DataFrame:
    """The row of each key and bucket that is first in ``order``, once its window closed.

    Map tasks combine before the shuffle, so a hot bucket arrives as one row per task.
    """
    row = F.struct(*[F.col(c) for c in df.columns if c not in {*keys, et}])
    first = (
        df.withWatermark(et, delay)
        .groupBy(
            *keys,
            time_bucket(ts, duration_ms(width)).alias("_bucket"),
            F.window(F.col(et), window).alias(_WINDOW),
        )
        .agg(F.min_by(row, F.struct(*[F.col(c) for c in order])).alias("_first"))
    )
    return first.select(*keys, "_first.*")


def dedup_hour(
    df: DataFrame,
    keys: Sequence[str] = ("id",),
    delay: str = "1 minute",
    et: str = "et",
) -> DataFrame:
    """One row per key and hour; adds ``hour_end``."""
    unique = _drop_within(df, et, "1 hour", delay, {k: k for k in keys})
    return unique.withColumn("hour_end", F.col(f"{_WINDOW}.end")).drop(_WINDOW)


def dedup_bitmap(
    df: DataFrame,
    window: str = "30 seconds",
    delay: str = "1 second",
    ts: str = "ts",
    code: str = "hbdm",
    bits: int = 30,
    et: str = "et",
) -> DataFrame:
    """One row per window and bitmap position of its second and code."""
    offset = hashing.bit_offset(bucket_key(ts, 1000, code), bits)
    unique = _drop_within(df, et, window, delay, {"offset": offset})
    return unique.withColumn("window_end", F.col(f"{_WINDOW}.end")).drop(_WINDOW)
