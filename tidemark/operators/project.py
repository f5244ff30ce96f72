"""Projection, renaming, filters, routing and splitting into words."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROUTE = "route"
MAIN = "main"


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def with_arrival(df: DataFrame, column: str = "pt", arrival: Column | None = None) -> DataFrame:
    """Append the processing time; pass ``arrival`` for a reproducible one.

    Without it the column is the clock of the batch or micro-batch.
    """
    return df.withColumn(column, F.current_timestamp() if arrival is None else arrival)


def with_event_time(df: DataFrame, ts: str = "ts", column: str = "et", delay: str | None = None) -> DataFrame:
    """Promote epoch milliseconds to event time, watermarked on a stream."""
    timed = df.withColumn(column, F.timestamp_millis(F.col(ts)))
    return timed.withWatermark(column, delay) if delay is not None else timed


def equals(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def sql_equals(df: DataFrame, column: str, value: object) -> DataFrame:
    """The same filter as SQL text over the table."""
    return df.sparkSession.sql(
        f"SELECT * FROM {{rate}} WHERE `{column}` = {{wanted}}", rate=df, wanted=value
    )


def with_route(df: DataFrame, routes: Mapping[str, Column]) -> DataFrame:
    """Name the branch of each row: the first condition that holds, else ``main``."""
    chosen: Column | None = None
    for name, condition in routes.items():
        chosen = (
            F.when(condition, F.lit(name))
            if chosen is None
            else chosen.when(condition, F.lit(name))
        )
    label = F.lit(MAIN) if chosen is None else chosen.otherwise(F.lit(MAIN))
    return df.withColumn(ROUTE, label)


def route(df: DataFrame, name: str) -> DataFrame:
    """The rows of one branch of a routed DataFrame."""
    return df.filter(F.col(ROUTE) == name).drop(ROUTE)


def split_routes(df: DataFrame, routes: Mapping[str, Column]) -> dict[str, DataFrame]:
    """All branches, the rest under ``main``."""
    routed = with_route(df, routes)
    return {name: route(routed, name) for name in [*routes, MAIN]}


def retry_routes(log_type: str = "type") -> dict[str, Column]:
    """Routes for the retry records of a command log."""
    kind = F.lower(F.col(log_type))
    return {
        "airport_retry": kind == "airport_retry",
        "drone_retry": kind == "drone_retry",
    }


def words(df: DataFrame, text: str, keep: Sequence[str] = (), word: str = "word") -> DataFrame:
    """One row per word of every line of the text; lines are cut at single blanks.

    Blanks side by side have an empty word between them, and an empty line is one empty
    word.  Blanks at the end of a line, a final line break and an empty text add nothing.
    """
    own = F.col(text)
    # The expensive pattern is for texts that need it.
    body = F.when(F.endswith(own, F.lit("\n")), F.regexp_replace(own, "\\r?\\n$", "")).otherwise(own)
    lines = F.when(F.contains(own, F.lit("\r")), F.split(body, "\\r?\\n")).otherwise(F.split(body, "\n"))
    line, trimmed = F.col("_line"), F.col("_trimmed")
    cut = (
        F.when(line == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, " "))
    )
    read = df.filter(own != "").select(*keep, F.explode(lines).alias("_line"))
    return read.withColumn("_trimmed", F.rtrim("_line")).select(*keep, F.explode(cut).alias(word))


def distinct_words(df: DataFrame, text: str, word: str = "word") -> DataFrame:
    return words(df, text, word=word).distinct()


def map_batches(df: DataFrame, function: Callable, schema: T.StructType | str) -> DataFrame:
    """A user function over Arrow-backed pandas batches, for what columns cannot express."""
    return df.mapInPandas(function, schema)
