"""Event time and time buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS_MS = {
    "millisecond": 1,
    "second": 1000,
    "minute": 60_000,
    "hour": 3_600_000,
    "day": 86_400_000,
}


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def duration_ms(duration: str) -> int:
    """Milliseconds in a duration such as ``"30 seconds"``."""
    amount, unit = duration.split()
    return int(amount) * _UNITS_MS[unit.rstrip("s")]


def event_time(ts: Column | str) -> Column:
    """Epoch milliseconds as a timestamp."""
    return F.timestamp_millis(_col(ts))


def epoch_ms(et: Column | str) -> Column:
    """Timestamp as epoch milliseconds, truncated."""
    return F.unix_millis(_col(et).cast("timestamp"))


def epoch_us(et: Column | str) -> Column:
    return F.unix_micros(_col(et).cast("timestamp"))


def time_bucket(ts: Column | str, width_ms: int) -> Column:
    """Number of the bucket that holds an epoch-millisecond time."""
    return F.call_function("div", _col(ts), F.lit(int(width_ms)).cast("long"))


def bucket_end(ts: Column | str, width_ms: int, offset_ms: int = 0) -> Column:
    """End of the bucket, in epoch milliseconds, with an optional bucket offset."""
    width = F.lit(int(width_ms)).cast("long")
    offset = F.lit(int(offset_ms)).cast("long")
    shifted = _col(ts) - offset
    return shifted - F.pmod(shifted, width) + offset + width


def bucket_key(ts: Column | str, width_ms: int, code: Column | str) -> Column:
    """Bucket number followed by the code, the text that duplicates share."""
    return F.concat(time_bucket(ts, width_ms).cast("string"), _col(code))


def time_text(ts: Column | str) -> Column:
    """An epoch-millisecond time as text, its fraction without trailing zeros."""
    et = event_time(ts)
    fraction = F.regexp_replace(F.date_format(et, "SSS"), "0{1,2}$", "")
    return F.concat(F.date_format(et, "yyyy-MM-dd HH:mm:ss."), fraction)
