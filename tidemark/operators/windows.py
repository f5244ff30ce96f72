"""Tumbling, hopping and session windows, as DataFrame operators and as SQL.

All of them run on batch tables and on watermarked streams.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.time import duration_ms
from tidemark.plans import ordered
from tidemark.session import checkpointed


# How partial results of a function combine.
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def _columns(aggregates: Mapping[str, tuple[str, str]]) -> list[Column]:
    unknown = {f for f, _ in aggregates.values()} - set(_MERGE)
    if unknown:
        raise ValueError(f"cannot merge {sorted(unknown)}; use {sorted(_MERGE)}")
    return [getattr(F, f)(c).alias(n) for n, (f, c) in aggregates.items()]


def _interval(ms: int) -> Column:
    return F.expr(f"INTERVAL '{ms / 1000:.3f}' SECOND")


def tumble(
    df: DataFrame, et: str, size: str, keys: Sequence[str], aggregates: Sequence[Column]
) -> DataFrame:
    """Aggregate per key and tumbling window; adds ``w_start`` and ``w_end``."""
    return _unpack(df.groupBy(*keys, F.window(F.col(et), size).alias("_w")).agg(*aggregates), keys)


def hop(
    df: DataFrame,
    et: str,
    size: str,
    slide: str,
    keys: Sequence[str],
    aggregates: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """Aggregate per key and hopping window of ``size``, started every ``slide``.

    ``aggregates`` maps a result column to a function (count, sum, min or max) and its
    input column.  A row lies in ``size / slide`` windows.  A batch table is aggregated
    once per ``slide`` instead, and only these panes are copied to their windows.
    """
    panes, rest = divmod(duration_ms(size), duration_ms(slide))
    if df.isStreaming or rest:
        grouped = df.groupBy(*keys, F.window(F.col(et), size, slide).alias("_w"))
        return _unpack(grouped.agg(*_columns(aggregates)), keys)
    paned = tumble(df, et, slide, keys, _columns(aggregates))
    starts = [
        F.col("w_start") - _interval(back * duration_ms(slide)) for back in range(panes)
    ]
    copied = paned.withColumn("w_start", F.explode(F.array(*starts)))
    return (
        copied.groupBy(*keys, "w_start")
        .agg(*[_MERGE[f](n).alias(n) for n, (f, _) in aggregates.items()])
        .select(*keys, "w_start", (F.col("w_start") + _interval(duration_ms(size))).alias("w_end"), *aggregates)
    )


def session(
    df: DataFrame,
    et: str,
    gap: str,
    keys: Sequence[str],
    aggregates: Mapping[str, tuple[str, str]],
    tie: Sequence[str] = (),
    rows_per_task: int | None = None,
) -> DataFrame:
    """Aggregate per key and session; events exactly one gap apart share a session.

    ``aggregates`` maps a result column to a function (count, sum, min or max) and
    its input column.  Spark's session operator sorts all sessions of a key in one
    task, so a batch table with a hot key is cut into chunks instead; ``tie`` then
    orders rows of equal time.
    """
    df = df.filter(F.col(et).isNotNull())  # both plans: a row without a time has no session

    def plain(rows: DataFrame) -> DataFrame:
        grouped = rows.groupBy(*keys, F.session_window(F.col(et), gap).alias("_w"))
        return _unpack(grouped.agg(*_columns(aggregates)), keys)

    def cut(rows: DataFrame, chunks: int) -> DataFrame:
        narrow = rows.select(*dict.fromkeys([*keys, et, *tie, *(c for _, c in aggregates.values())]))
        chunked = ordered.into_chunks(narrow, keys, [et, *tie], chunks)
        return _session_in_chunks(chunked, et, gap, keys, aggregates, [et, *tie])

    if df.isStreaming:
        return plain(df)
    return ordered.by_size(df, keys, ordered.measure(df, keys, rows_per_task), plain, cut)


def _session_in_chunks(
    cut: DataFrame,
    et: str,
    gap: str,
    keys: Sequence[str],
    aggregates: Mapping[str, tuple[str, str]],
    order: Sequence[str],
) -> DataFrame:
    """Sessions inside each chunk, then merge those that touch a chunk border.

    Only the first and the last session of a (key, chunk) can continue elsewhere, so
    the second step sees at most two rows per chunk.
    """
    length = _interval(duration_ms(gap))

    def numbered(rows: DataFrame, by: Sequence[str], start: str, end: str, sort: Sequence[str]) -> DataFrame:
        ordered_rows = Window.partitionBy(*by).orderBy(*sort)
        before = F.lag(end).over(ordered_rows)
        opens = rows.withColumn(
            "_opens", F.when(before.isNull() | (F.col(start) > before + length), 1).otherwise(0)
        )
        running = ordered_rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return opens.withColumn("_session", F.sum("_opens").over(running))

    by_chunk = [*keys, ordered.CHUNK]
    local = (
        numbered(cut, by_chunk, et, et, order)
        .groupBy(*by_chunk, "_session")
        .agg(
            F.min(et).alias("w_start"),
            F.max(et).alias("_last"),
            *_columns(aggregates),
        )
    )
    in_chunk = Window.partitionBy(*by_chunk)
    pieces = checkpointed(
        local.withColumn(
            "_border",
            (F.col("_session") == 1) | (F.col("_session") == F.max("_session").over(in_chunk)),
        )
    )
    results = [*keys, "w_start", (F.col("_last") + length).alias("w_end"), *aggregates]
    joined = (
        numbered(
            pieces.filter("_border").drop("_session"),
            keys,
            "w_start",
            "_last",
            ["w_start", "_last", ordered.CHUNK],
        )
        .groupBy(*keys, "_session")
        .agg(
            F.min("w_start").alias("w_start"),
            F.max("_last").alias("_last"),
            *[_MERGE[f](n).alias(n) for n, (f, _) in aggregates.items()],
        )
    )
    return pieces.filter("NOT _border").select(*results).unionByName(joined.select(*results))


def _unpack(grouped: DataFrame, keys: Sequence[str]) -> DataFrame:
    results = [c for c in grouped.columns if c not in {*keys, "_w"}]
    return grouped.select(
        *keys,
        F.col("_w.start").alias("w_start"),
        F.col("_w.end").alias("w_end"),
        *results,
    )


def rate_summary(df: DataFrame, et: str = "et", size: str = "1 second", key: str = "hbdm") -> DataFrame:
    """Sum of ``num`` with the first and last ``ts`` per key and tumbling window."""
    return tumble(
        df,
        et,
        size,
        [key],
        [
            F.sum("num").alias("sum_num"),
            F.min("ts").alias("min_ts"),
            F.max("ts").alias("max_ts"),
        ],
    )


def sql_tumble(df: DataFrame, size: str, et: str = "et") -> DataFrame:
    return df.sparkSession.sql(
        f"""
        SELECT hbdm,
               window.start AS r_start,
               window.end AS r_end,
               window.end - INTERVAL '0.001' SECOND AS r_time,
               count(num) AS cnt_num,
               count(1) AS cnt_all
        FROM {{rate}}
        GROUP BY window({et}, '{size}'), hbdm
        """,
        rate=df,
    )


def sql_hop(df: DataFrame, slide: str, size: str, et: str = "et") -> DataFrame:
    """Hopping windows; the order of ``slide`` and ``size`` is that of SQL ``HOP``."""
    return df.sparkSession.sql(
        f"""
        SELECT hbdm,
               window.start AS r_start,
               window.end AS r_end,
               count(num) AS cnt_num
        FROM {{rate}}
        GROUP BY window({et}, '{size}', '{slide}'), hbdm
        """,
        rate=df,
    )


def sql_session(df: DataFrame, gap: str, et: str = "et") -> DataFrame:
    return df.sparkSession.sql(
        f"""
        SELECT hbdm,
               session_window.start AS s_start,
               session_window.end AS s_end,
               count(num) AS cnt_num
        FROM {{rate}}
        GROUP BY session_window({et}, '{gap}'), hbdm
        """,
        rate=df,
    )
