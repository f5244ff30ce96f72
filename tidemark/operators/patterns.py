"""Event patterns: repeats, strict succession, timeouts and repeat alerts.

Without ``keys`` a pattern runs over the global order of its input, as an un-keyed
pattern does; ``plans.ordered`` cuts that order into chunks once it is too long for
a task.  ``order`` has to make rows distinct.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.time import duration_ms, epoch_us
from tidemark.operators.over import ARRIVES, ASKS, KIND, LEAVES, ask_frames, match, with_frame
from tidemark.plans import ordered
from tidemark.session import checkpointed


def times(
    df: DataFrame,
    condition: Column,
    order: Sequence[str],
    at_least: int,
    at_most: int,
    keys: Sequence[str] = (),
    events: Sequence[str] = ("et",),
    within: str | None = None,
    et: str = "et",
    rows_per_task: int | None = None,
) -> DataFrame:
    """All runs of ``at_least`` to ``at_most`` matching events, other events ignored.

    Each matching event starts one run per length that enough events follow.
    The result has the columns of the first event plus ``length`` and ``matched``,
    the list of the run's events.
    """
    if not 1 <= at_least <= at_most:
        raise ValueError("need 1 <= at_least <= at_most")
    item = F.struct(*[F.col(c) for c in dict.fromkeys([et, *events])])
    run = ordered.bounded_window(
        df.filter(condition),
        keys,
        order,
        lambda w: {"_run": F.collect_list(item).over(w.rowsBetween(0, at_most - 1))},
        following=at_most - 1,
        rows_per_task=rows_per_task,
    )
    lengths = run.withColumn(
        "length", F.explode(F.sequence(F.lit(at_least), F.lit(at_most)))
    ).filter(F.col("length") <= F.size("_run"))
    matched = lengths.withColumn("matched", F.slice("_run", 1, F.col("length"))).drop("_run")
    if within is None:
        return matched
    last_us = epoch_us(F.element_at("matched", -1)[et])
    return matched.filter(last_us - epoch_us(et) < duration_ms(within) * 1000)


def times_timed_out(
    df: DataFrame,
    condition: Column,
    order: Sequence[str],
    at_most: int,
    within: str,
    keys: Sequence[str] = (),
    et: str = "et",
    rows_per_task: int | None = None,
) -> DataFrame:
    """Starts of runs that the bound runs out on before ``at_most`` events.

    ``matched_count`` is how far the run came, the start included.
    """
    run = ordered.bounded_window(
        df.filter(condition),
        keys,
        order,
        lambda w: {"_run": F.collect_list(epoch_us(et)).over(w.rowsBetween(0, at_most - 1))},
        following=at_most - 1,
        rows_per_task=rows_per_task,
    )
    bound = epoch_us(et) + duration_ms(within) * 1000
    counted = run.withColumn(
        "matched_count", F.size(F.filter("_run", lambda us: us < bound))
    )
    return counted.filter(F.col("matched_count") < at_most).drop("_run")


def _successor(
    df: DataFrame,
    second: Column,
    order: Sequence[str],
    keys: Sequence[str],
    et: str,
    rows_per_task: int | None,
) -> DataFrame:
    staged = df.withColumn("_is_second", F.coalesce(second, F.lit(False)))
    return ordered.bounded_window(
        staged,
        keys,
        order,
        lambda w: {
            "next_et": F.lead(et).over(w),
            "_next_matches": F.lead("_is_second").over(w),
        },
        following=1,
        rows_per_task=rows_per_task,
    )


def next_within(
    df: DataFrame,
    first: Column,
    second: Column,
    within: str,
    order: Sequence[str],
    keys: Sequence[str] = (),
    et: str = "et",
    rows_per_task: int | None = None,
) -> DataFrame:
    """First events whose very next event matches ``second`` in less than ``within``."""
    staged = _successor(df, second, order, keys, et, rows_per_task)
    in_time = epoch_us("next_et") - epoch_us(et) < duration_ms(within) * 1000
    return staged.filter(first & F.col("_next_matches") & in_time).drop(
        "_is_second", "_next_matches"
    )


def timed_out(
    df: DataFrame,
    first: Column,
    within: str,
    order: Sequence[str],
    keys: Sequence[str] = (),
    et: str = "et",
    rows_per_task: int | None = None,
) -> DataFrame:
    """First events that the bound runs out on: no next event, or one that is too late.

    An event in time that does not match ends the pattern without a timeout.
    """
    staged = _successor(df, F.lit(True), order, keys, et, rows_per_task)
    late = epoch_us("next_et") - epoch_us(et) >= duration_ms(within) * 1000
    return staged.filter(first & (F.col("next_et").isNull() | late)).drop(
        "_is_second", "_next_matches"
    )


def repeat_alert(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    task: str,
    within: str,
    at_least: int = 5,
    et: str = "et",
    rows_per_task: int | None = None,
) -> DataFrame:
    """Rows that are at least the ``at_least``-th of their key within the time frame.

    Adds ``cnt``, the rows in the frame, and ``first_task``, the task of its first row.
    ``order`` must start with ``et``.
    """

    def plain(rows: DataFrame) -> DataFrame:
        counted = with_frame(rows, keys, et, within, {"cnt": F.lit(1).cast("long")})
        return _with_frame_start(counted, keys, order, task, within, at_least)

    def cut(rows: DataFrame, chunks: int) -> DataFrame:
        return _repeat_alert_in_chunks(rows, keys, order, task, within, at_least, et, chunks)

    return ordered.by_size(df, keys, ordered.measure(df, keys, rows_per_task), plain, cut)


def _with_frame_start(
    counted: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    task: str,
    within: str,
    at_least: int,
) -> DataFrame:
    """Keep the alerts and add the task of their frame's first row.

    Each alert looks back from a probe placed at the start of its frame.  Going
    through the key from the end, the last row met before a probe is the first row
    of the frame.  The shuffle by key is that of the count.
    """
    span = F.lit(duration_ms(within) * 1000).cast("long")
    kinds = F.when(F.col("cnt") >= at_least, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    probed = counted.withColumn("_probe", F.explode(kinds)).withColumns(
        {
            "_us": F.col("_us") - F.col("_probe") * span,
            "_task": F.when(F.col("_probe") == 0, F.struct(F.col(task).alias("task"))),
        }
    )
    backwards = (
        Window.partitionBy(*keys)
        .orderBy(F.col("_us").desc(), "_probe", *[F.col(c).desc() for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = probed.withColumn(
        "first_task", F.last("_task", ignorenulls=True).over(backwards)["task"]
    )
    return found.filter(F.col("_probe") == 1).drop("_us", "_probe", "_task")


def _repeat_alert_in_chunks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    task: str,
    within: str,
    at_least: int,
    et: str,
    chunks: int,
) -> DataFrame:
    """Number the rows of a key; the frame's first row is then found by its number."""
    one = F.lit(1).cast("long")
    # Read twice below, so the running totals are kept.
    asked = checkpointed(ask_frames(
        df, keys, et, within, {"cnt": one}, order, chunks, keep=[task], arrivals="_number"
    ).filter(F.col(KIND) != LEAVES))
    alerts = (
        asked.filter((F.col(KIND) == ASKS) & (F.col("cnt") >= at_least))
        .withColumn("_number", F.col("_number") - F.col("cnt") + 1)
        .drop(KIND, "_us")
    )
    firsts = asked.filter(F.col(KIND) == ARRIVES).select(
        *keys, "_number", F.col(task).alias("first_task")
    )
    return match(alerts, firsts, [*keys, "_number"]).drop("_number")


def alert_text(key: str, task: str = "first_task") -> Column:
    """The alert message: key and task, separated by a comma."""
    return F.concat_ws(",", F.col(key).cast("string"), F.col(task).cast("string"))
