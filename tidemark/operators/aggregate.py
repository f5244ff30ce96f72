"""Unbounded grouped aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_count(df: DataFrame, key: str = "hbdm", value: str = "num") -> DataFrame:
    """Number of non-null values per key."""
    return df.groupBy(key).agg(F.count(value).alias("cnt_num"))


def group_sum_sql(df: DataFrame, key: str = "hbdm", value: str = "num") -> DataFrame:
    return df.sparkSession.sql(
        f"SELECT `{key}`, sum(`{value}`) AS sum_num FROM {{rate}} GROUP BY `{key}`", rate=df
    )
