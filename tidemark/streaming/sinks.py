"""Starting streams, and sinks that write a micro-batch to several targets."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from tidemark import session
from tidemark.functions import hashing
from tidemark.operators import dedup
from tidemark.operators.changelog import latest_per
from tidemark.sources import tables
from tidemark.sources.upsert import BATCH_COLUMN, RUN_COLUMN, partition_of, run_of


def start(
    writer: DataStreamWriter, name: str | None = None, interval: str | None = "1 second"
) -> StreamingQuery:
    """Start with a checkpoint per ``interval``; ``None`` drains what is there and stops."""
    if name:
        writer = writer.queryName(name)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def drain(writer: DataStreamWriter) -> StreamingQuery:
    """Process everything available and wait for it."""
    query = start(writer, interval=None)
    query.awaitTermination()
    return query


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped as late in the batches the query still remembers (100 by default).

    :class:`LateRows` counts over the whole life of a stream.
    """
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


class LateRows(StreamingQueryListener):
    """Adds up the rows dropped as late, by stream id; register it before the stream starts."""

    def __init__(self) -> None:
        self.dropped: Counter[str] = Counter()

    def onQueryStarted(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.dropped[str(progress.id)] += sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...


def state_rows(query: StreamingQuery) -> int:
    """State rows after the last batch."""
    last = query.lastProgress
    return 0 if last is None else sum(o["numRowsTotal"] for o in last["stateOperators"])


def each_batch(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> DataStreamWriter:
    return (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )


class FanOut:
    """Writes a micro-batch to several file targets, each with its own rows.

    A target's files of a batch are one partition that a retry overwrites, so every
    target is exactly-once.  The batch is computed once for all targets.
    """

    def __init__(
        self,
        targets: Mapping[str, Callable[[DataFrame], DataFrame]],
        file_format: str = "parquet",
    ) -> None:
        self.targets = dict(targets)
        self.file_format = file_format

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        shared = batch.persist()
        try:
            for path, rows in self.targets.items():
                rows(shared).write.mode("overwrite").format(self.file_format).save(
                    f"{path}/{partition_of(batch, batch_id)}"
                )
        finally:
            shared.unpersist()


class BloomDedup:
    """Approximate deduplication across micro-batches with bloom filters on files.

    A filter that is full is sealed and the next one opened, twice as large and with less
    error, so that all of them together lose at most a share ``fpp`` of the new keys
    however many come.  A batch is tested against every filter, of which there are as many
    as the number of keys has doublings, and adds its keys to a filter with room for all
    of them.  Each batch writes its own partition and reads only those of earlier batches
    and other runs, so a retry sees the filters the first attempt saw.
    """

    def __init__(
        self,
        filter_path: str,
        target: str,
        keys: Sequence[str],
        order: Sequence[str],
        expected: int = 1_000_000,
        fpp: float = 0.01,
    ) -> None:
        self.filter_path = filter_path
        self.target = target
        self.keys = list(keys)
        self.order = list(order)
        self.expected = expected
        self.fpp = fpp

    def capacity(self, part: int) -> int:
        return self.expected << part

    def shape(self, part: int) -> tuple[int, int]:
        """Words and hash functions of filter ``part``; the errors of all sum up to ``fpp``."""
        return hashing.word_filter_shape(self.capacity(part), 0.6 * self.fpp / (part + 1) ** 2)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = run_of(batch)
        held = self._held(spark, run, batch_id)
        rows = dedup.first_per(batch, self.keys, self.order)
        for part in sorted(held):
            marked = dedup.bloom_mark(rows, self._words(spark, run, batch_id, part), self.keys, *self.shape(part), "_seen")
            rows = marked.filter(~F.col("_seen")).drop("_seen")
        place = partition_of(batch, batch_id)
        rows.write.mode("overwrite").parquet(f"{self.target}/{place}")
        kept = spark.read.schema(rows.schema).parquet(f"{self.target}/{place}")
        new = kept.count()
        part = max(held, default=0)
        while self.capacity(part) - held.get(part, 0) < new:
            part += 1
        dedup.bloom_words(kept, self.keys, *self.shape(part)).withColumns(
            {"part": F.lit(part), "keys": F.lit(0).cast("long")}
        ).unionByName(
            # The row without a word says how many keys came.
            spark.range(1).select(
                F.lit(None).cast("long").alias("word"), F.lit(None).cast("long").alias("bits"),
                F.lit(part).alias("part"), F.lit(new).cast("long").alias("keys"),
            )
        ).write.mode("overwrite").parquet(f"{self.filter_path}/{place}")

    def _files(self, spark: SparkSession, run: str, before: int) -> DataFrame | None:
        if not tables.exists(spark, self.filter_path):
            return None
        return (
            spark.read.schema(f"word BIGINT, bits BIGINT, part INT, keys BIGINT, {RUN_COLUMN} STRING, {BATCH_COLUMN} BIGINT")
            .parquet(self.filter_path)
            .filter((F.col(RUN_COLUMN) != run) | (F.col(BATCH_COLUMN) < before))
        )

    def _held(self, spark: SparkSession, run: str, before: int) -> dict[int, int]:
        """Keys in each filter; there are few filters."""
        files = self._files(spark, run, before)
        return {} if files is None else {r.part: r.n for r in files.groupBy("part").agg(F.sum("keys").alias("n")).collect()}

    def _words(self, spark: SparkSession, run: str, before: int, part: int) -> DataFrame:
        files = self._files(spark, run, before).filter((F.col("part") == part) & F.col("word").isNotNull())
        return files.groupBy("word").agg(F.bit_or("bits").alias("bits"))

    def compact(self, spark: SparkSession, target: str, upto: int) -> None:
        """Fold the filters of all runs, up to batch ``upto`` of direct calls, into one batch elsewhere."""
        files = self._files(spark, "direct", upto + 1)
        folded = files.filter("word IS NOT NULL").groupBy("part", "word").agg(F.bit_or("bits").alias("bits"))
        counts = files.filter("word IS NULL").groupBy("part").agg(F.sum("keys").alias("keys"))
        folded.withColumn("keys", F.lit(0).cast("long")).unionByName(counts, allowMissingColumns=True).write.mode(
            "overwrite"
        ).parquet(f"{target}/{RUN_COLUMN}=compacted/{BATCH_COLUMN}=0")


def run_folder(spark: SparkSession) -> str:
    """A new folder in the shared folder, for the files of one run."""
    return f"{session.shared_dir(spark)}/run-{uuid.uuid4().hex}"


def run_to_table(df: DataFrame, mode: str = "append", keys: Sequence[str] = ()) -> DataFrame:
    """Drain a stream into files of the shared folder and read them back.

    In update mode a row replaces the earlier one with the same ``keys``.  Without keys
    every row that was written is returned, as a changelog wants it.
    """
    spark = df.sparkSession
    base = run_folder(spark)
    if mode == "append":
        writer = (
            df.writeStream.format("parquet")
            .outputMode("append")
            .option("path", f"{base}/data")
            .option("checkpointLocation", f"{base}/checkpoint")
        )
        drain(writer)
        return spark.read.schema(df.schema).parquet(f"{base}/data")
    drain(each_batch(df, FanOut({f"{base}/data": lambda b: b}), f"{base}/checkpoint", mode))
    fields = T.StructType([*df.schema.fields, T.StructField(BATCH_COLUMN, T.LongType())])
    rows = spark.read.schema(fields).parquet(f"{base}/data")
    if mode == "update" and keys:
        rows = latest_per(rows, list(keys), [BATCH_COLUMN])
    return rows.select(*df.columns)
