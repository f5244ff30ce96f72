"""Ordered computations per key that survive a hot key.

``Window.partitionBy(key)`` puts all rows of a key into one task.  That is the
best plan while keys are small, and no plan at all when one key holds a third of
100 TB.  The functions here measure first: one scan counts the rows and sketches the frequent
keys.  Keys that fit ``rows_per_task`` stay on the plain window.  The rows of the others

1. are range-partitioned by (key, order), which cuts a hot key into consecutive chunks
   of about equal size whatever its time distribution, and pinned with a
   checkpoint so that every later step sees the same chunk borders even when an
   executor is lost;
2. pass the window inside (key, chunk);
3. are repaired where something crosses a chunk border, from a table that has at most a few rows
   per chunk.

The order columns have to make each row of a key distinct, otherwise "the next
row" is not defined.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark import session

CHUNK = "_chunk"
_INNER = "_inner"
_END = "_end"
_SEED = "_seed"

Build = Callable[[WindowSpec], Mapping[str, Column]]

#: Keys that the sketch of frequent keys keeps; it misses none that has over 7 / SKETCH_KEYS of the rows.
SKETCH_KEYS = 1 << 16
#: Most frequent keys that are told apart; with more, all rows are cut.
MOST_HOT = 10_000


@dataclass(frozen=True)
class Sizes:
    """How to run an ordered computation: which keys have to be cut, and into how many chunks in all.

    No chunks: every key fits a task.  Chunks without ``hot`` keys: all rows are cut.
    """

    chunks: int = 0
    hot: tuple[int, ...] = ()


def measure(df: DataFrame, keys: Sequence[str], rows_per_task: int | None = None) -> Sizes:
    """Count the rows and find the keys with more rows than a task takes, in one scan."""
    budget = session.rows_per_task(df.sparkSession, rows_per_task)
    if not keys:
        rows = df.count()
        return Sizes(max(2, math.ceil(rows / budget))) if rows > budget else Sizes()
    key = F.xxhash64(*keys)
    # A mergeable sketch of frequent items; its estimates are never too low.
    top = F.call_function("approx_top_k", key, F.lit(MOST_HOT), F.lit(SKETCH_KEYS))
    found = df.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(key).alias("keys"), top.alias("top")).first()
    rows = found["rows"]
    if rows <= budget:
        return Sizes()
    if 7 * rows > budget * SKETCH_KEYS:  # too coarse for this many rows: count
        chunks = chunks_needed(df, keys, rows_per_task)
        return Sizes(chunks)
    hot = [(t["item"], t["count"]) for t in found["top"] if t["count"] > budget]
    if not hot:
        return Sizes()
    cut = sum(n for _, n in hot)
    exact = found["keys"] < SKETCH_KEYS // 4  # so few keys all have a place of their own in the sketch
    if len(hot) == MOST_HOT or (exact and cut == rows):
        return Sizes(max(2, math.ceil(rows / budget)))
    return Sizes(max(2, math.ceil(cut / budget)), tuple(h for h, _ in hot))


def by_size(
    df: DataFrame,
    keys: Sequence[str],
    sizes: Sizes,
    plain: Callable[[DataFrame], DataFrame],
    cut: Callable[[DataFrame, int], DataFrame],
) -> DataFrame:
    """``plain`` for the keys that fit a task, ``cut`` into chunks for the hot ones."""
    if not sizes.chunks:
        return plain(df)
    if not sizes.hot:
        return cut(df, sizes.chunks)
    is_hot = F.xxhash64(*keys).isin(list(sizes.hot))
    return plain(df.filter(~is_hot)).unionByName(cut(df.filter(is_hot), sizes.chunks))


def chunks_needed(
    df: DataFrame, keys: Sequence[str], rows_per_task: int | None = None
) -> int:
    """0 when the rows of every key fit one task, else the number of chunks to cut."""
    budget = session.rows_per_task(df.sparkSession, rows_per_task)
    if keys:
        sizes = df.groupBy(*keys).count()
        total, largest = sizes.agg(F.sum("count"), F.max("count")).first()
    else:
        total = largest = df.count()
    if not total or largest <= budget:
        return 0
    return max(2, math.ceil(total / budget))


def into_chunks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunks: int
) -> DataFrame:
    """Cut ``df`` into consecutive ranges of (keys, order), numbered by ``_chunk``."""
    ranged = df.repartitionByRange(chunks, *keys, *order)
    return session.checkpointed(ranged.withColumn(CHUNK, F.spark_partition_id()))


def bounded_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    build: Build,
    preceding: int = 0,
    following: int = 0,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Add window columns that look at a fixed number of neighbouring rows.

    ``build`` gets an ordered window and returns the columns to add; none of them
    may reach more than ``preceding`` rows back or ``following`` rows ahead.
    """
    def plain(rows: DataFrame) -> DataFrame:
        return rows.withColumns(dict(build(Window.partitionBy(*keys).orderBy(*order))))

    def cut(rows: DataFrame, chunks: int) -> DataFrame:
        return bounded_in_chunks(into_chunks(rows, keys, order, chunks), keys, order, build, preceding, following).drop(CHUNK)

    return by_size(df, keys, measure(df, keys, rows_per_task), plain, cut)


def bounded_in_chunks(
    cut: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    build: Build,
    preceding: int,
    following: int,
) -> DataFrame:
    """The chunked form of :func:`bounded_window`; keeps ``_chunk``.

    Rows far enough from both ends of their chunk are final.  The others are
    computed over the chunk ends alone: taking ``preceding + following`` rows from
    each end leaves no gap inside the reach of a row that needs it.
    """
    reach = preceding + following
    local = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    one = F.lit(1)
    # A lag or lead that finds no row tells how close the chunk border is.
    marked = cut.withColumns(
        {
            _INNER: F.lag(one, preceding).over(local).isNotNull()
            & F.lead(one, following).over(local).isNotNull(),
            _END: F.lag(one, reach).over(local).isNull()
            | F.lead(one, reach).over(local).isNull(),
        }
    )
    inner = marked.withColumns(dict(build(local))).filter(F.col(_INNER))
    whole = Window.partitionBy(*keys).orderBy(*order)
    outer = marked.filter(F.col(_END)).withColumns(dict(build(whole))).filter(~F.col(_INNER))
    return inner.unionByName(outer).drop(_INNER, _END)


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, Column],
    rows_per_task: int | None = None,
    chunks: int | None = None,
) -> DataFrame:
    """Add running sums from the first row of the key up to the current one.

    Pass ``chunks`` when the number is already known, to save the measuring.
    """
    sizes = measure(df, keys, rows_per_task) if chunks is None else Sizes(chunks)

    def plain(rows: DataFrame) -> DataFrame:
        running = (
            Window.partitionBy(*keys)
            .orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return rows.withColumns({n: F.sum(v).over(running) for n, v in values.items()})

    def cut(rows: DataFrame, chunks: int) -> DataFrame:
        return running_in_chunks(into_chunks(rows, keys, order, chunks), keys, order, values).drop(CHUNK)

    return by_size(df, keys, sizes, plain, cut)


def running_in_chunks(
    cut: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, Column],
) -> DataFrame:
    """The chunked form of :func:`running_total`; keeps ``_chunk``.

    Each (key, chunk) starts from a seed row that carries the total of the earlier
    chunks, so the big side is shuffled once and joined with nothing.
    """
    staged = {name: f"_add_{name}" for name in values}
    rows = cut.withColumns(
        {_SEED: F.lit(1), **{staged[n]: v for n, v in values.items()}}
    )
    totals = rows.groupBy(*keys, CHUNK).agg(
        *[F.sum(staged[n]).alias(staged[n]) for n in values]
    )
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(CHUNK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    seeds = totals.select(
        *keys,
        CHUNK,
        F.lit(0).alias(_SEED),
        *[F.sum(staged[n]).over(earlier).alias(staged[n]) for n in values],
    )
    running = (
        Window.partitionBy(*keys, CHUNK)
        .orderBy(_SEED, *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    seeded = rows.unionByName(seeds, allowMissingColumns=True)
    summed = seeded.withColumns({n: F.sum(staged[n]).over(running) for n in values})
    return summed.filter(F.col(_SEED) == 1).drop(_SEED, *staged.values())
