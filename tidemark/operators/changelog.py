"""Grouped results as a changelog or as a latest-row-per-key table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans import ordered


def retract_count(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str = "num",
    rows_per_task: int | None = None,
) -> DataFrame:
    """Every change of the running count: the old value retracted, the new one added.

    The first row of a key has nothing to retract.  A row whose ``value`` is null
    does not change the count and so leaves no trace, unless it opens its key.
    """
    counted = ordered.running_total(
        df,
        [key],
        order,
        {
            "_rows": F.lit(1).cast("long"),
            "_count": F.when(F.col(value).isNotNull(), 1).otherwise(0).cast("long"),
        },
        rows_per_task,
    )
    return changes(counted, key, order, F.col(value).isNotNull())


def changes(counted: DataFrame, key: str, order: Sequence[str], counts: Column) -> DataFrame:
    """The changelog of running counts: ``_rows`` and ``_count`` up to each row, which ``counts`` or not."""
    added = F.struct(F.lit(True).alias("acc"), F.col("_count").alias("cnt_num"))
    retracted = F.struct(F.lit(False).alias("acc"), (F.col("_count") - 1).alias("cnt_num"))
    change = (
        F.when(F.col("_rows") == 1, F.array(added))
        .when(counts, F.array(retracted, added))
        .otherwise(F.array().cast("array<struct<acc:boolean,cnt_num:bigint>>"))
    )
    return counted.select(key, *order, F.explode(change).alias("_change")).select(
        F.col("_change.acc").alias("acc"),
        key,
        F.col("_change.cnt_num").alias("cnt_num"),
        *order,
    )


def net_changes(
    changelog: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], acc: str = "acc"
) -> DataFrame:
    """The changelog with all that cancels inside a key left out: what was before, and what is after.

    A key gives its first retraction and its last addition, or nothing where both have one
    value.  At equal ``order`` a retraction comes before the addition.  First and last are chosen
    in the map tasks, so a key with many changes reaches its reducer as one row a task.
    """
    place = F.struct(*order, acc)
    change = F.struct(F.col(acc).alias("acc"), F.col(value).alias("value"))
    ends = changelog.groupBy(*keys).agg(F.min_by(change, place).alias("_first"), F.max_by(change, place).alias("_last"))
    first, last = F.col("_first"), F.col("_last")
    taken = F.when(~first["acc"], first)
    given = F.when(last["acc"], last)
    same = taken.isNotNull() & given.isNotNull() & taken["value"].eqNullSafe(given["value"])
    left = F.when(~same, F.filter(F.array(taken, given), lambda c: c.isNotNull()))
    return ends.select(*keys, F.explode(left).alias("_change")).select(
        F.col("_change.acc").alias(acc), *keys, F.col("_change.value").alias(value)
    )


def as_upserts(
    changelog: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], acc: str = "acc"
) -> DataFrame:
    """A retracting changelog as the rows to write by key: the value of each key that has one in the end."""
    ends = net_changes(changelog, keys, value, order, acc)
    return ends.filter(acc).drop(acc)


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key, as an upsert by key leaves it."""
    rank = F.row_number().over(
        Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    )
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
