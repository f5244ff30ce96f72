"""Deduplication: exact per time bucket, per bitmap position, per session, and by bloom filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import hashing
from tidemark.functions.time import bucket_end, bucket_key, duration_ms, time_bucket
from tidemark.plans import ordered


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key.

    Spark keeps only the first row of a key in each map task before the shuffle,
    so a hot key reaches its reducer as one row per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def dedup_bucket(
    df: DataFrame, width: str, order: Sequence[str], keys: Sequence[str] = ("hbdm",), ts: str = "ts"
) -> DataFrame:
    """First row to arrive per key and time bucket."""
    staged = df.withColumn("_bucket", time_bucket(ts, duration_ms(width)))
    return first_per(staged, [*keys, "_bucket"], order).drop("_bucket")


def dedup_hour(
    df: DataFrame, order: Sequence[str], keys: Sequence[str] = ("id",), ts: str = "ts"
) -> DataFrame:
    """First row to arrive per key and hour; adds ``hour_end`` in epoch milliseconds."""
    return dedup_window(df, "1 hour", order, keys, ts).withColumnRenamed("window_end", "hour_end")


def dedup_window(
    df: DataFrame, window: str, order: Sequence[str], keys: Sequence[str], ts: str = "ts"
) -> DataFrame:
    """First row to arrive per key and tumbling window; adds ``window_end``."""
    staged = df.withColumn("window_end", bucket_end(ts, duration_ms(window)))
    return first_per(staged, [*keys, "window_end"], order)


def dedup_bitmap(
    df: DataFrame,
    window: str,
    order: Sequence[str],
    ts: str = "ts",
    code: str | Column = "hbdm",
    bits: int = 30,
    second: str = "1 second",
) -> DataFrame:
    """First row to arrive per window and bitmap position of its second and code.

    Two different texts on one position count as duplicates, as they do in the
    bitmap; ``offset`` and ``window_end`` stay in the result to make that visible.
    """
    text = bucket_key(ts, duration_ms(second), code)
    staged = df.withColumns(
        {
            "window_end": bucket_end(ts, duration_ms(window)),
            "offset": hashing.bit_offset(text, bits),
        }
    )
    return first_per(staged, ["window_end", "offset"], order)


def dedup_session_first(
    df: DataFrame,
    keys: Sequence[str],
    gap: str,
    order: Sequence[str],
    et: str = "et",
    rows_per_task: int | None = None,
) -> DataFrame:
    """The row that opens each session: the first one, or more than a gap after the last."""
    length = F.expr(f"INTERVAL '{duration_ms(gap) / 1000:.3f}' SECOND")
    staged = ordered.bounded_window(
        df,
        keys,
        order,
        lambda w: {"_before": F.lag(et).over(w)},
        preceding=1,
        rows_per_task=rows_per_task,
    )
    opens = F.col("_before").isNull() | (F.col(et) > F.col("_before") + length)
    return staged.filter(opens).drop("_before")


def bloom_words(
    seen: DataFrame, keys: Sequence[str], words: int, k: int, hash_of: hashing.KeyHash = hashing.xx_hash
) -> DataFrame:
    """A bloom filter of the keys in ``seen`` as a table of 64-bit words.

    ``bit_or`` combines on the map side, so duplicate and hot keys cost nothing.
    """
    return (
        seen.select(
            hashing.word_number(keys, words, hash_of).alias("word"),
            hashing.word_mask(keys, k, hash_of).alias("mask"),
        )
        .groupBy("word")
        .agg(F.bit_or("mask").alias("bits"))
    )


def bloom_union(left: DataFrame, right: DataFrame) -> DataFrame:
    """The filter of the keys of both filters, which must have the same shape."""
    return left.unionByName(right).groupBy("word").agg(F.bit_or("bits").alias("bits"))


def bloom_mark(
    df: DataFrame,
    filter_words: DataFrame,
    keys: Sequence[str],
    words: int,
    k: int,
    column: str,
    hash_of: hashing.KeyHash = hashing.xx_hash,
) -> DataFrame:
    """Flag the rows whose key may be in the filter; never false for one that is."""
    probed = df.withColumns(
        {"_word": hashing.word_number(keys, words, hash_of), "_mask": hashing.word_mask(keys, k, hash_of)}
    )
    joined = probed.join(
        filter_words.withColumnsRenamed({"word": "_word", "bits": "_bits"}), "_word", "left"
    )
    hit = F.coalesce(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False))
    return joined.withColumn(column, hit).drop("_word", "_mask", "_bits")


def bloom_antifilter(
    df: DataFrame,
    seen: DataFrame,
    keys: Sequence[str],
    expected: int | None = None,
    fpp: float = 0.01,
    hash_of: hashing.KeyHash = hashing.xx_hash,
) -> DataFrame:
    """Rows whose key is surely not in ``seen``, plus none that is.

    Of the unseen rows a share of about ``fpp`` is lost while ``seen`` holds at most
    ``expected`` distinct keys; the default counts its rows, which is never too few.
    """
    expected = seen.count() if expected is None else expected
    words, k = hashing.word_filter_shape(expected, fpp)
    marked = bloom_mark(df, bloom_words(seen, keys, words, k, hash_of), keys, words, k, "_seen", hash_of)
    return marked.filter(~F.col("_seen")).drop("_seen")

