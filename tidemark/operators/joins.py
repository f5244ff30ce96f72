"""Inner join of two streams inside a shared tumbling window."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import session
from tidemark.plans import ordered

_SALT = "_salt"


def window_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    left_time: str,
    right_time: str,
    size: str,
    salt: int = 1,
) -> DataFrame:
    """Pairs that share the key and the tumbling window.

    It is an equi-join on key and window, so rows of different windows never meet
    in a task.  In batch, AQE splits a (key, window) group that outgrows its task.
    A stream has no AQE: ``salt`` spreads each left group over that many tasks and
    copies the right side to all of them, which leaves the result unchanged.
    Columns of the two sides must have different names.
    """
    lhs = left.withColumn("_lw", F.window(F.col(left_time), size))
    rhs = right.withColumn("_rw", F.window(F.col(right_time), size))
    condition = F.col("_lw") == F.col("_rw")
    for left_key, right_key in on:
        condition = condition & (F.col(left_key) == F.col(right_key))
    if salt > 1:
        lhs = lhs.withColumn(
            _SALT, F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(salt)).cast("int")
        )
        rhs = rhs.withColumn(f"{_SALT}_r", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        condition = condition & (F.col(_SALT) == F.col(f"{_SALT}_r"))
    return lhs.join(rhs, condition, "inner").drop("_lw", "_rw", _SALT, f"{_SALT}_r")


def hot_pairs(left: DataFrame, group: Column, rows_per_task: int | None = None) -> dict[int, int]:
    """Groups (hashes) with more rows than a task takes, and the number of tasks for each.

    A mergeable sketch of frequent items finds them in one scan; its estimates are never too low.
    """
    budget = session.rows_per_task(left.sparkSession, rows_per_task)
    top = F.call_function("approx_top_k", group, F.lit(ordered.MOST_HOT), F.lit(ordered.SKETCH_KEYS))
    found = left.agg(top.alias("top")).first()["top"]
    return {t["item"]: math.ceil(t["count"] / budget) for t in found if t["count"] > budget}


def window_join_by_size(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], left_time: str, right_time: str, size: str,
    rows_per_task: int | None = None,
) -> DataFrame:
    """:func:`window_join` of two tables that salts the hot (key, window) groups alone.

    Left rows of a hot group are dealt over several tasks, and only the right rows of these groups are
    copied to them.  The salts are a table of at most ``MOST_HOT`` groups.
    """
    def grouped(df: DataFrame, keys: Sequence[str], et: str, name: str) -> DataFrame:
        window = F.window(F.col(et), size)["start"]
        return df.withColumn(name, F.xxhash64(*keys, F.unix_micros(window.cast("timestamp"))))

    lhs = grouped(left, [k for k, _ in on], left_time, "_lg")
    rhs = grouped(right, [k for _, k in on], right_time, "_rg")
    hot = hot_pairs(lhs, F.col("_lg"), rows_per_task)
    if not hot:
        return window_join(left, right, on, left_time, right_time, size)
    table = F.broadcast(left.sparkSession.createDataFrame(list(hot.items()), "_hot long, _tasks int"))
    own = F.pmod(F.xxhash64(*left.columns), F.coalesce("_tasks", F.lit(1))).cast("int")
    all_ = F.explode(F.sequence(F.lit(0), F.coalesce("_tasks", F.lit(1)) - 1))
    lhs = lhs.join(table, F.col("_lg") == F.col("_hot"), "left").select(*left.columns, own.alias("_ls"))
    rhs = rhs.join(table, F.col("_rg") == F.col("_hot"), "left").select(*right.columns, all_.alias("_rs"))
    return window_join(lhs, rhs, [*on, ("_ls", "_rs")], left_time, right_time, size).drop("_ls", "_rs")


def order_rate_join(orders: DataFrame, rates: DataFrame, size: str = "10 seconds", salt: int = 1) -> DataFrame:
    """Orders with the rates of their currency and window, and the converted value.

    Both sides need an event time ``et``.
    """
    lhs = orders.withColumnRenamed("et", "_let")
    rhs = rates.withColumnsRenamed({"ts": "rate_ts", "hbdm": "rate_hbdm", "et": "_ret"})
    return converted(window_join(lhs, rhs, [("hbdm", "rate_hbdm")], "_let", "_ret", size, salt))


def converted(joined: DataFrame) -> DataFrame:
    """The nine columns of orders with rates, the converted value last."""
    return joined.select(
        "ts",
        "catlog",
        "subcat",
        "hbdm",
        "value",
        "rate_ts",
        "rate_hbdm",
        "num",
        (F.col("num").cast("long") * F.col("value").cast("long")).alias("amount"),
    )
