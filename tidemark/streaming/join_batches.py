"""Inner join of two streams in tumbling windows, micro-batch by micro-batch.

A batch joins its new rows with those of both sides whose windows are still open, so a pair is out
in the batch in which its later row arrives.  The join is a table join: the hot (key, window) groups
of the batch are found by a sketch and salted, the others are left alone.  Rows wait in a table of the
shared folder until the watermark, the lesser of the two sides', has passed the end of their window.

Results and state of a batch lie in folders of its run and number; a batch that is tried again
reads the state of the batch before and overwrites its own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import duration_ms, epoch_us
from tidemark.operators import joins
from tidemark.sources import tables
from tidemark.sources.upsert import BATCH_COLUMN, RUN_COLUMN, partition_of, run_of
from tidemark.streaming import sinks

_LEFT, _RIGHT = "left_row", "right_row"


def both_sides(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two streams as one: a row has its columns on its own side."""
    one = left.select(F.struct(*left.columns).alias(_LEFT))
    other = right.select(F.struct(*right.columns).alias(_RIGHT))
    return one.unionByName(other, allowMissingColumns=True)


class JoinBatches:
    """The ``foreachBatch`` target for the rows of :func:`both_sides`.

    ``late`` counts, after each call, the rows of that batch whose window was already closed.
    """

    def __init__(
        self, target: str, state: str, on: Sequence[tuple[str, str]], left_time: str, right_time: str, size: str,
        delays: tuple[str, str] = ("1 second", "1 second"), finish: Callable[[DataFrame], DataFrame] = lambda df: df,
        rows_per_task: int | None = None,
    ) -> None:
        self.target, self.state, self.on, self.size = target, state, list(on), size
        self.times, self.delays_us = (left_time, right_time), tuple(duration_ms(d) * 1000 for d in delays)
        self.finish, self.rows_per_task = finish, rows_per_task
        self.schema, self.late = None, 0

    def _end(self, side: int):
        length = duration_ms(self.size) * 1000
        us = epoch_us(self.times[side])
        return us - F.pmod(us, F.lit(length)) + length

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        here = partition_of(batch, batch_id)
        before = f"{self.state}/{RUN_COLUMN}={run_of(batch)}/{BATCH_COLUMN}={batch_id - 1}"
        known = tables.exists(spark, f"{before}/clock")
        clock = spark.read.parquet(f"{before}/clock").first() if known else None
        batch = batch.persist()
        try:
            ends, passed = [None, None], None if clock is None else clock.watermark_us
            new, old, late = [], [], 0
            for side, name in enumerate((_LEFT, _RIGHT)):
                rows = batch.filter(F.col(name).isNotNull()).select(f"{name}.*").filter(F.col(self.times[side]).isNotNull())
                in_time = F.lit(True) if passed is None else self._end(side) > passed
                seen = rows.agg(F.max(epoch_us(self.times[side])).alias("last"), F.count_if(~in_time).alias("late")).first()
                late += seen.late
                ends[side] = max((t for t in (seen.last, None if clock is None else clock[f"last_{side}"]) if t is not None), default=None)
                new.append(rows.filter(in_time))
                old.append(spark.read.schema(rows.schema).parquet(f"{before}/side_{side}") if known else None)
            pairs = self._joined(new[0], new[1] if old[1] is None else new[1].unionByName(old[1]))
            if old[0] is not None:
                pairs = pairs.unionByName(self._joined(old[0], new[1]))
            found = self.finish(pairs)
            self.schema = found.schema
            found.write.mode("overwrite").parquet(f"{self.target}/{here}")
            watermark = None
            if None not in ends:
                watermark = min(t // 1000 * 1000 - d for t, d in zip(ends, self.delays_us, strict=True))
                watermark = watermark if passed is None else max(watermark, passed)
            for side in (0, 1):
                kept = new[side] if old[side] is None else new[side].unionByName(old[side])
                open_ = kept if watermark is None else kept.filter(self._end(side) > watermark)
                open_.write.mode("overwrite").parquet(f"{self.state}/{here}/side_{side}")
            values = {"watermark_us": watermark, "last_0": ends[0], "last_1": ends[1]}
            spark.range(1).select(*[F.lit(v).cast("long").alias(n) for n, v in values.items()]).coalesce(1).write.mode(
                "overwrite"
            ).parquet(f"{self.state}/{here}/clock")
            self.late = late
        finally:
            batch.unpersist()

    def _joined(self, left: DataFrame, right: DataFrame) -> DataFrame:
        return joins.window_join_by_size(left, right, self.on, *self.times, self.size, self.rows_per_task)


def drain(rows: DataFrame, base: str | None = None, **join) -> DataFrame:
    """Join what a stream of :func:`both_sides` has, and return all pairs written below ``base`` so far."""
    spark = rows.sparkSession
    base = base or sinks.run_folder(spark)
    target = JoinBatches(f"{base}/data", f"{base}/state", **join)
    sinks.drain(sinks.each_batch(rows, target, f"{base}/checkpoint"))
    if target.schema is None:
        raise ValueError("the stream has no data yet")
    return spark.read.schema(target.schema).parquet(f"{base}/data").select(*target.schema.names)
