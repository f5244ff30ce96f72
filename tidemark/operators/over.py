"""Running aggregation over row frames and time frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.time import duration_ms, epoch_us
from tidemark.plans import ordered

# Kinds of events in the order they count at equal times.
LEAVES, ARRIVES, ASKS = 0, 1, 2
KIND = "_kind"

_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)


def over_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    preceding: int,
    column: str = "sum_num",
    rows_per_task: int | None = None,
) -> DataFrame:
    """Sum over the current row and the ``preceding`` rows before it."""
    return ordered.bounded_window(
        df,
        keys,
        order,
        lambda w: {column: F.sum(value).over(w.rowsBetween(-preceding, 0))},
        preceding=preceding,
        rows_per_task=rows_per_task,
    )


def over_range_unbounded(
    df: DataFrame,
    keys: Sequence[str],
    et: str,
    value: str,
    column: str = "sum_num",
    tie: Sequence[str] = (),
    rows_per_task: int | None = None,
) -> DataFrame:
    """Sum over everything up to the current time, rows of equal time included.

    ``tie`` orders rows of equal time, so that even those can be split between tasks.
    """
    _require_exact(df, value)

    def plain(rows: DataFrame) -> DataFrame:
        frame = (
            Window.partitionBy(*keys)
            .orderBy(et)
            .rangeBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return rows.withColumn(column, F.sum(value).over(frame))

    def cut(rows: DataFrame, chunks: int) -> DataFrame:
        asked = ask_frames(rows, keys, et, None, {column: F.col(value)}, tie, chunks)
        return asked.filter(F.col(KIND) == ASKS).drop(KIND, "_us")

    return ordered.by_size(df, keys, ordered.measure(df, keys, rows_per_task), plain, cut)


def over_range_time(
    df: DataFrame,
    keys: Sequence[str],
    et: str,
    value: str,
    length: str,
    column: str = "sum_num",
    tie: Sequence[str] = (),
    rows_per_task: int | None = None,
) -> DataFrame:
    """Sum over the time frame that ends now and reaches ``length`` back, inclusive."""
    _require_exact(df, value)
    values = {"_sum": F.col(value), "_rows": F.col(value).isNotNull().cast("long")}

    def cut(rows: DataFrame, chunks: int) -> DataFrame:
        asked = ask_frames(rows, keys, et, length, values, tie, chunks)
        return asked.filter(F.col(KIND) == ASKS).drop(KIND)

    framed = ordered.by_size(
        df, keys, ordered.measure(df, keys, rows_per_task), lambda rows: with_frame(rows, keys, et, length, values), cut
    )
    return framed.withColumn(column, F.when(F.col("_rows") > 0, F.col("_sum"))).drop(
        "_sum", "_rows", "_us"
    )


def with_frame(
    df: DataFrame,
    keys: Sequence[str],
    et: str,
    length: str,
    values: Mapping[str, Column],
) -> DataFrame:
    """Add time-frame sums, and ``_us``, for keys that fit a task: one shuffle, linear time.

    A sliding range frame would be summed anew for each row.  Here a row adds its
    values when it occurs and takes them back one microsecond after it left the
    frame, which turns the frame into a growing one; null counts as zero.
    """
    span = F.lit(duration_ms(length) * 1000 + 1).cast("long")
    staged = {name: f"_add_{name}" for name in values}
    rows = df.withColumns(
        {"_us": epoch_us(et), **{staged[n]: F.coalesce(v, F.lit(0)) for n, v in values.items()}}
    ).withColumn("_leaves", F.explode(F.array(F.lit(False), F.lit(True))))
    leaves = F.col("_leaves")
    payload = [c for c in df.columns if c not in keys]
    signed = rows.withColumns(
        {
            **{c: F.when(~leaves, F.col(c)) for c in payload},
            "_us": F.when(leaves, F.col("_us") + span).otherwise(F.col("_us")),
            **{c: F.when(leaves, -F.col(c)).otherwise(F.col(c)) for c in staged.values()},
        }
    )
    frame = (
        Window.partitionBy(*keys)
        .orderBy("_us")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = signed.withColumns({n: F.sum(staged[n]).over(frame) for n in values})
    return summed.filter(~leaves).drop("_leaves", *staged.values())


def ask_frames(
    df: DataFrame,
    keys: Sequence[str],
    et: str,
    length: str | None,
    values: Mapping[str, Column],
    tie: Sequence[str],
    chunks: int,
    keep: Sequence[str] = (),
    arrivals: str | None = None,
) -> DataFrame:
    """Time-frame sums for keys of any size, as one running total over events.

    Each row becomes up to three events: its values leave the frame (``length`` after
    it, never when that is ``None``), they arrive, and the row asks for the sum.  At
    equal times they come in that order, so a row sees its peers wherever the chunk
    borders fall, and no group of equal times has to stay in one task.  Only the
    asking event carries the row; ``keep`` names columns the arriving one needs too.
    ``arrivals`` adds the number of rows that have arrived so far.
    """
    kinds = [ARRIVES, ASKS] if length is None else [LEAVES, ARRIVES, ASKS]
    kind = F.col(KIND)
    staged = {name: f"_add_{name}" for name in values}
    events = df.withColumns(
        {"_us": epoch_us(et), **{staged[n]: v for n, v in values.items()}}
    ).withColumn(KIND, F.explode(F.array(*[F.lit(k) for k in kinds])))
    payload = [c for c in df.columns if c not in {*keys, *tie, *keep}]
    columns = {
        **{c: F.when(kind == ASKS, F.col(c)) for c in payload},
        **{
            c: F.when(kind == ARRIVES, F.col(c)).when(kind == LEAVES, -F.col(c))
            for c in staged.values()
        },
    }
    if length is not None:
        span = F.lit(duration_ms(length) * 1000 + 1).cast("long")
        columns["_us"] = F.when(kind == LEAVES, F.col("_us") + span).otherwise(F.col("_us"))
    sums = {n: F.col(staged[n]) for n in values}
    if arrivals is not None:
        sums[arrivals] = F.when(kind == ARRIVES, 1).otherwise(0).cast("long")
    totals = ordered.running_total(
        events.withColumns(columns),
        keys,
        ["_us", KIND, *tie],
        sums,
        chunks=chunks * len(kinds),
    )
    return totals.drop(*staged.values())


def match(df: DataFrame, totals: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join on ``on`` in which a null key matches a null key."""
    renamed = totals.withColumnsRenamed({c: f"_m_{c}" for c in on})
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_m_{c}"))
    return df.join(renamed, condition, "inner").drop(*[f"_m_{c}" for c in on])


def _require_exact(df: DataFrame, value: str) -> None:
    if not isinstance(df.schema[value].dataType, _EXACT):
        raise TypeError(
            f"{value} must be an integer or decimal column: frame sums are kept as "
            "differences of running totals, which floating point would round"
        )
