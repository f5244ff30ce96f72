"""Keyed event-time operators that Structured Streaming has no built-in form for.

All share one scheme.  Rows of a key wait in checkpointed state until the watermark has
passed them; no earlier row can then arrive, so they are released in event order.
The released rows are appended to a short *tail* of earlier rows, the result is
computed over both with array operations, and a new tail is kept.  The tail is what
the next rows still need (the last ten rows, one time frame, one total), so state
stays bounded.  Rows are kept in blocks, one per key and input batch, because the state
store is asked once per block.

Inputs carry their event time a second time as ``event_us``, microseconds since the
epoch, which keeps time zones out of the Python side.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark import session
from tidemark.functions.time import duration_ms, epoch_us

# The workers, and the driver-side one that declares the state, need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Spark renames columns that start with an underscore on their way to Python.
US = "event_us"


def _as_sent(df: DataFrame, name: str) -> Column:
    """A column as it travels to Python: pandas would round integers beside a null."""
    field = df.schema[name]
    if field.nullable and isinstance(field.dataType, T.IntegralType):
        return F.col(name).cast("string").alias(name)
    return F.col(name)


def _columns(frame: pd.DataFrame, schema: T.StructType) -> list[list]:
    """The columns of a batch as lists of the schema's types, with ``None`` for null."""
    columns = []
    for field in schema.fields:
        values = frame[field.name]
        missing = values.isna().tolist()
        integral = isinstance(field.dataType, T.IntegralType)
        columns.append(
            [
                None if gone else int(v) if integral else v
                for v, gone in zip(values.tolist(), missing, strict=True)
            ]
        )
    return columns


def _frame(columns: list[list], names: Sequence[str]) -> pd.DataFrame:
    return pd.DataFrame(
        {n: pd.Series(c, dtype=object) for n, c in zip(names, columns, strict=True)}
    )


def _running(values: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Exact running sums, from 0 on, and running numbers of the values that are not null.

    Python's own numbers are added: they neither wrap nor round.
    """
    known = values.notna().to_numpy()
    numbers = np.zeros(len(values) + 1, dtype=object)
    numbers[1:][known] = values.to_numpy(dtype=object)[known]
    return np.cumsum(numbers), np.concatenate([[0], np.cumsum(known)])


def _between(sums: np.ndarray, known: np.ndarray, low: np.ndarray, high: np.ndarray) -> pd.Series:
    """Sums over places ``low`` to ``high``, null where all values are null."""
    total = sums[high] - sums[low]
    return pd.Series(np.where(known[high] > known[low], total, None), dtype=object)


def _sum_type(df: DataFrame, value: str) -> str:
    """The type of an exact sum, as ``sum`` has it."""
    kind = df.schema[value].dataType
    if isinstance(kind, T.IntegralType):
        return "BIGINT"
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({min(38, kind.precision + 10)},{kind.scale})"
    raise TypeError(
        f"{value} must be an integer or decimal column: running totals are kept, which floating point would round"
    )


class InEventOrder(StatefulProcessor):
    """Releases rows in event order and keeps a tail of earlier ones."""

    def __init__(
        self,
        rows: T.StructType,
        order: Sequence[str],
        output: T.StructType,
        horizon_ms: int | None = None,
    ) -> None:
        self.rows = rows
        self.order = list(order)
        self.output = output
        self.horizon_ms = horizon_ms

    def tail_schema(self) -> T.StructType:
        return self.rows

    def compute(
        self, tail: pd.DataFrame, ready: pd.DataFrame
    ) -> tuple[pd.DataFrame, pd.DataFrame]:
        """Results for the released rows, and the new tail."""
        raise NotImplementedError

    def expire(self, tail: pd.DataFrame, watermark_us: int) -> tuple[pd.DataFrame | None, pd.DataFrame]:
        """Results and tail once the watermark is a horizon past the last row."""
        return None, tail.iloc[0:0]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "first_us BIGINT, block BINARY")
        self.tail = handle.getValueState("tail", "block BINARY")

    def handleInputRows(
        self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any
    ) -> Iterator[pd.DataFrame]:
        earliest: int | None = None
        for batch in rows:
            if batch.empty:
                continue
            first = int(batch[US].min())
            self.pending.appendValue((first, pickle.dumps(_columns(batch, self.rows))))
            earliest = first if earliest is None else min(earliest, first)
        if earliest is not None:
            self._wake_at(earliest)
        return iter(())

    def handleExpiredTimer(
        self, key: Any, timerValues: Any, expiredTimerInfo: Any
    ) -> Iterator[pd.DataFrame]:
        watermark_us = timerValues.getCurrentWatermarkInMs() * 1000
        results: list[pd.DataFrame] = []
        tail = self._load_tail()
        known = len(tail)
        ready = self._release(watermark_us)
        if len(ready):
            out, tail = self.compute(tail, ready)
            results.append(out)
            if self.horizon_ms is not None and len(tail):
                self._wake_at(int(tail[US].iloc[-1]) + self.horizon_ms * 1000)
        expired = (
            self.horizon_ms is not None
            and len(tail) > 0
            and int(tail[US].iloc[-1]) + self.horizon_ms * 1000 <= watermark_us
        )
        if expired:
            out, tail = self.expire(tail, watermark_us)
            if out is not None:
                results.append(out)
        if len(ready) or expired:
            if len(tail):
                self.tail.update((pickle.dumps(_columns(tail, self.tail_schema())),))
            elif known:
                self.tail.clear()
        wanted = self.output.fieldNames()
        return iter([out[wanted] for out in results if len(out)])

    def _load_tail(self) -> pd.DataFrame:
        names = self.tail_schema().fieldNames()
        if not self.tail.exists():
            return _frame([[] for _ in names], names)
        return _frame(pickle.loads(bytes(self.tail.get()[0])), names)

    def _release(self, watermark_us: int) -> pd.DataFrame:
        """Take the rows the watermark has passed out of the state, in event order."""
        names = self.rows.fieldNames()
        blocks = list(self.pending.get()) if self.pending.exists() else []
        due = [block for first, block in blocks if first <= watermark_us]
        if not due:
            return _frame([[] for _ in names], names)
        waiting = [(first, block) for first, block in blocks if first > watermark_us]
        rows = pd.concat(
            [_frame(pickle.loads(bytes(block)), names) for block in due], ignore_index=True
        )
        passed = rows[US].to_numpy(dtype=np.int64) <= watermark_us
        left = rows[~passed]
        if len(left):
            waiting.append((int(left[US].min()), pickle.dumps(_columns(left, self.rows))))
        if waiting:
            self.pending.put(waiting)
            self._wake_at(min(first for first, _ in waiting))
        else:
            self.pending.clear()
        return rows[passed].sort_values([US, *self.order], ignore_index=True)

    def close(self) -> None:
        pass

    def _wake_at(self, us: int) -> None:
        self.handle.registerTimer(-(-us // 1000))


class RowFrame(InEventOrder):
    """Sum over the current and the preceding rows."""

    def __init__(self, rows, order, output, value: str, preceding: int) -> None:
        super().__init__(rows, order, output)
        self.value = value
        self.preceding = preceding

    def compute(self, tail, ready):
        both = pd.concat([tail, ready], ignore_index=True)
        here = np.arange(len(tail), len(both))
        low = np.maximum(here - self.preceding, 0)
        out = ready.assign(sum_num=_between(*_running(both[self.value]), low, here + 1))
        keep = both.iloc[max(0, len(both) - self.preceding) :] if self.preceding else both.iloc[0:0]
        return out, keep


class TimeFrame(InEventOrder):
    """Sum over a time frame that ends at the current time, peers included."""

    def __init__(self, rows, order, output, value: str, length_ms: int) -> None:
        super().__init__(rows, order, output, horizon_ms=length_ms)
        self.value = value

    def compute(self, tail, ready):
        both = pd.concat([tail, ready], ignore_index=True)
        us = both[US].to_numpy(dtype=np.int64)
        now = us[len(tail) :]
        span = self.horizon_ms * 1000
        low = np.searchsorted(us, now - span, side="left")
        high = np.searchsorted(us, now, side="right")
        out = ready.assign(sum_num=_between(*_running(both[self.value]), low, high))
        return out, both[us >= us[-1] - span]


class Unbounded(InEventOrder):
    """Sum over everything so far, peers included; the tail is the one total."""

    def __init__(self, rows, order, output, value: str) -> None:
        super().__init__(rows, order, output)
        self.value = value

    def tail_schema(self) -> T.StructType:
        return T.StructType([T.StructField(US, T.LongType()), self.output["sum_num"]])

    def compute(self, tail, ready):
        us = ready[US].to_numpy(dtype=np.int64)
        before = pd.Series([tail["sum_num"].iloc[0] if len(tail) else None], dtype=object)
        sums, known = _running(pd.concat([before, ready[self.value]], ignore_index=True))
        after = 1 + np.searchsorted(us, us, side="right")
        totals = _between(sums, known, np.zeros(len(us), np.int64), after)
        return ready.assign(sum_num=totals), _frame([[int(us[-1])], [totals.iloc[-1]]], [US, "sum_num"])


class SessionFirst(InEventOrder):
    """The rows that open a session; the tail is the last time of the session."""

    def tail_schema(self) -> T.StructType:
        return T.StructType([T.StructField(US, T.LongType())])

    def compute(self, tail, ready):
        us = ready[US].to_numpy(dtype=np.int64)
        gap = self.horizon_ms * 1000
        first = int(tail[US].iloc[0]) if len(tail) else us[0] - gap - 1
        opens = us - np.concatenate([[first], us[:-1]]) > gap
        return ready[opens], _frame([[int(us[-1])]], [US])


class Repeats(InEventOrder):
    """All runs of ``at_least`` to ``at_most`` events, reported when they complete."""

    def __init__(self, rows, order, output, at_least: int, at_most: int, within_ms: int | None) -> None:
        super().__init__(rows, order, output, horizon_ms=within_ms)
        self.at_least = at_least
        self.at_most = at_most

    def compute(self, tail, ready):
        both = pd.concat([tail, ready], ignore_index=True)
        us = both[US].to_numpy(dtype=np.int64)
        end = np.arange(len(tail), len(both))
        found = []
        for length in range(self.at_least, self.at_most + 1):
            stop = end[end >= length - 1]
            start = stop - (length - 1)
            if self.horizon_ms is not None:
                in_time = us[stop] - us[start] < self.horizon_ms * 1000
                start, stop = start[in_time], stop[in_time]
            found.append(
                both.iloc[start].reset_index(drop=True).assign(length=length, end_us=us[stop])
            )
        reach = self.at_most - 1
        keep = both.iloc[max(0, len(both) - reach) :] if reach else both.iloc[0:0]
        return pd.concat(found, ignore_index=True), keep


class Succession(InEventOrder):
    """A first event and its very next one, in time, or the timeout of the first.

    The tail is the open first event.
    """

    def __init__(self, rows, order, output, within_ms: int) -> None:
        super().__init__(rows, order, output, horizon_ms=within_ms)

    def compute(self, tail, ready):
        both = pd.concat([tail, ready], ignore_index=True)
        us = both[US].to_numpy(dtype=np.int64)
        opens = both["opens_match"].to_numpy(dtype=bool)[:-1]
        meets = both["meets_match"].to_numpy(dtype=bool)[1:]
        in_time = us[1:] - us[:-1] < self.horizon_ms * 1000
        starts = both.iloc[:-1]
        matched = starts[opens & in_time & meets].assign(
            kind="match", next_us=us[1:][opens & in_time & meets]
        )
        late = starts[opens & ~in_time].assign(kind="timeout", next_us=None)
        last = both.iloc[-1:]
        keep = last if bool(last["opens_match"].iloc[0]) else last.iloc[0:0]
        return pd.concat([matched, late], ignore_index=True), keep

    def expire(self, tail, watermark_us):
        return tail.assign(kind="timeout", next_us=None), tail.iloc[0:0]


class RepeatAlert(InEventOrder):
    """Rows that complete ``at_least`` events of their key inside the time frame."""

    def __init__(self, rows, order, output, task: str, within_ms: int, at_least: int) -> None:
        super().__init__(rows, order, output, horizon_ms=within_ms)
        self.task = task
        self.at_least = at_least

    def compute(self, tail, ready):
        both = pd.concat([tail, ready], ignore_index=True)
        us = both[US].to_numpy(dtype=np.int64)
        now = us[len(tail) :]
        span = self.horizon_ms * 1000
        low = np.searchsorted(us, now - span, side="left")
        count = np.searchsorted(us, now, side="right") - low
        tasks = both[self.task].to_numpy(dtype=object)
        out = ready.assign(cnt=count, first_task=tasks[low])
        return out[count >= self.at_least], both[us >= us[-1] - span]


class Changelog(StatefulProcessor):
    """Old and new running count for every arriving row; the state is one count."""

    def __init__(
        self, rows: T.StructType, value: str, order: Sequence[str], output: T.StructType
    ) -> None:
        self.rows = rows
        self.value = value
        self.order = list(order)
        self.output = output

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n BIGINT")

    def handleInputRows(self, key, rows, timerValues):
        names = self.rows.fieldNames()
        batches = [_frame(_columns(b, self.rows), names) for b in rows if not b.empty]
        if not batches:
            return iter(())
        arrived = pd.concat(batches, ignore_index=True).sort_values(
            self.order, ignore_index=True
        )
        known = self.count.exists()
        before = int(self.count.get()[0]) if known else 0
        counts = arrived[self.value].notna().to_numpy()
        totals = before + np.cumsum(counts.astype(np.int64))
        adds = counts.copy()
        takes = counts.copy()
        if not known:
            adds[0], takes[0] = True, False
        new = arrived[adds].assign(acc=True, cnt_num=totals[adds], _side=1)
        old = arrived[takes].assign(acc=False, cnt_num=totals[takes] - 1, _side=0)
        self.count.update((int(totals[-1]),))
        both = pd.concat([old, new]).sort_values([*self.order, "_side"])
        return iter([both[self.output.fieldNames()]])

    def close(self) -> None:
        pass


def _groups(keys: Sequence[str]) -> dict[str, Column]:
    """Grouping columns without nulls, one constant group when there is no key.

    A null in a numeric key reaches Python as NaN, which equals no other row's.
    """
    if not keys:
        return {"all_rows": F.lit(0)}
    groups: dict[str, Column] = {}
    for i, key in enumerate(keys):
        groups[f"group_{i}"] = F.coalesce(F.col(key).cast("string"), F.lit(""))
        groups[f"absent_{i}"] = F.col(key).isNull()
    return groups


def _apply(
    df: DataFrame,
    keys: Sequence[str],
    et: str,
    payload: Sequence[str],
    order: Sequence[str],
    extra: dict[str, str],
    make,
    flags: dict[str, Column] | None = None,
) -> DataFrame:
    """Run a processor per key and give its rows their event time back.

    ``extra`` names the columns the processor adds; ``flags`` are helper columns for
    it that do not come out again.
    """
    session.use_rocksdb_state(df.sparkSession)
    helpers = flags or {}
    columns = list(dict.fromkeys([*keys, *order, *payload]))
    groups = _groups(keys)
    df = df.filter(F.col(et).isNotNull())  # as the built-in event-time operators do
    staged = df.select(
        et,
        epoch_us(et).alias(US),
        *[_as_sent(df, c) for c in columns],
        *[c.alias(n) for n, c in {**helpers, **groups}.items()],
    )
    rows = T.StructType(
        [T.StructField(US, T.LongType())]
        + [df.schema[c] for c in columns]
        + [T.StructField(n, T.BooleanType()) for n in helpers]
    )
    added = T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in extra.items()))
    output = T.StructType([f for f in rows.fields if f.name not in helpers] + added.fields)
    result = staged.groupBy(*groups).transformWithStateInPandas(
        statefulProcessor=make(rows, output),
        outputStructType=output,
        outputMode="append",
        timeMode="eventTime",
    )
    return result.select(
        *keys,
        F.timestamp_micros(US).alias(et),
        *[c for c in columns if c not in keys],
        *extra,
    )


def over_rows(
    df: DataFrame,
    keys: Sequence[str],
    et: str,
    order: Sequence[str],
    value: str,
    preceding: int,
) -> DataFrame:
    return _apply(
        df, keys, et, [value], order, {"sum_num": _sum_type(df, value)},
        lambda rows, out: RowFrame(rows, order, out, value, preceding),
    )


def over_range_time(
    df: DataFrame, keys: Sequence[str], et: str, order: Sequence[str], value: str, length: str
) -> DataFrame:
    return _apply(
        df, keys, et, [value], order, {"sum_num": _sum_type(df, value)},
        lambda rows, out: TimeFrame(rows, order, out, value, duration_ms(length)),
    )


def over_range_unbounded(
    df: DataFrame, keys: Sequence[str], et: str, order: Sequence[str], value: str
) -> DataFrame:
    return _apply(
        df, keys, et, [value], order, {"sum_num": _sum_type(df, value)},
        lambda rows, out: Unbounded(rows, order, out, value),
    )


def dedup_session_first(
    df: DataFrame,
    keys: Sequence[str],
    gap: str,
    et: str,
    order: Sequence[str],
    payload: Sequence[str] = (),
) -> DataFrame:
    return _apply(
        df, keys, et, payload, order, {},
        lambda rows, out: SessionFirst(rows, order, out, duration_ms(gap)),
    )


def times(
    df: DataFrame,
    condition: Column,
    et: str,
    order: Sequence[str],
    at_least: int,
    at_most: int,
    keys: Sequence[str] = (),
    payload: Sequence[str] = (),
    within: str | None = None,
) -> DataFrame:
    found = _apply(
        df.filter(condition), keys, et, payload, order,
        {"length": "INT", "end_us": "BIGINT"},
        lambda rows, out: Repeats(
            rows, order, out, at_least, at_most, None if within is None else duration_ms(within)
        ),
    )
    return found.withColumn("end_et", F.timestamp_micros("end_us")).drop("end_us")


def succession(
    df: DataFrame,
    first: Column,
    second: Column,
    within: str,
    et: str,
    order: Sequence[str],
    keys: Sequence[str] = (),
    payload: Sequence[str] = (),
) -> DataFrame:
    """Matches and timeouts of a strict succession, told apart by ``kind``."""
    found = _apply(
        df, keys, et, payload, order,
        {"kind": "STRING", "next_us": "BIGINT"},
        lambda rows, out: Succession(rows, order, out, duration_ms(within)),
        {
            "opens_match": F.coalesce(first, F.lit(False)),
            "meets_match": F.coalesce(second, F.lit(False)),
        },
    )
    return found.withColumn("next_et", F.timestamp_micros("next_us")).drop("next_us")


def repeat_alert(
    df: DataFrame,
    keys: Sequence[str],
    et: str,
    order: Sequence[str],
    task: str,
    within: str,
    at_least: int = 5,
) -> DataFrame:
    task_type = df.schema[task].dataType.simpleString()
    return _apply(
        df, keys, et, [task], order, {"cnt": "BIGINT", "first_task": task_type},
        lambda rows, out: RepeatAlert(rows, order, out, task, duration_ms(within), at_least),
    )


def retract_count(df: DataFrame, key: str, order: Sequence[str], value: str = "num") -> DataFrame:
    """Every change of the running count per key, in order of arrival."""
    session.use_rocksdb_state(df.sparkSession)
    groups = _groups([key])
    columns = list(dict.fromkeys([key, value, *order]))
    rows = df.select(*columns).schema
    staged = df.select(
        *[_as_sent(df, c) for c in columns], *[c.alias(n) for n, c in groups.items()]
    )
    added = T.StructType.fromDDL("acc BOOLEAN, cnt_num BIGINT")
    output = T.StructType(
        [added["acc"], rows[key], added["cnt_num"], *[rows[c] for c in order]]
    )
    return staged.groupBy(*groups).transformWithStateInPandas(
        statefulProcessor=Changelog(rows, value, order, output),
        outputStructType=output,
        outputMode="update",
        timeMode="none",
    )
