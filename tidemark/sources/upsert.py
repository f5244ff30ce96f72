"""Keyed targets: an upsert log on files, and batched statements for databases."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.changelog import latest_per

BATCH_COLUMN = "batch_id"
RUN_COLUMN = "run"
WRITTEN_COLUMN = "written_at"
SEQUENCE = "_sequence"


def run_of(batch: DataFrame) -> str:
    """The id of the stream that a micro-batch comes from; ``direct`` outside of one.

    A stream keeps its id for as long as its checkpoint lives, and batch numbers start
    again with a new checkpoint, so files are kept apart by both.
    """
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


def partition_of(batch: DataFrame, batch_id: int) -> str:
    """The folder of one batch of one run, which a retry of the batch overwrites."""
    return f"{RUN_COLUMN}={run_of(batch)}/{BATCH_COLUMN}={batch_id}"


class UpsertLog:
    """A keyed table kept as one small file set per batch, merged when read.

    Writing a batch again replaces exactly its own partition, so a retried batch
    leaves no trace; nothing already written is rewritten.
    """

    def __init__(self, path: str, keys: Sequence[str], order: Sequence[str]) -> None:
        self.path = path
        self.keys = list(keys)
        self.order = list(order)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        """The ``foreachBatch`` form."""
        self.write(batch, batch_id)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        latest_per(batch, self.keys, self.order).withColumn(
            WRITTEN_COLUMN, F.current_timestamp()
        ).write.mode("overwrite").parquet(f"{self.path}/{partition_of(batch, batch_id)}")

    def read(self, spark: SparkSession) -> DataFrame:
        """The current row of each key; a later batch wins over an earlier one, also of another run."""
        log = spark.read.parquet(self.path)
        return latest_per(log, self.keys, [WRITTEN_COLUMN, BATCH_COLUMN, *self.order]).drop(
            WRITTEN_COLUMN, RUN_COLUMN, BATCH_COLUMN
        )

    def compact(self, spark: SparkSession, target: str) -> UpsertLog:
        """Write the current rows as the first batch of a new log."""
        compacted = UpsertLog(target, self.keys, self.order)
        self.read(spark).withColumn(WRITTEN_COLUMN, F.current_timestamp()).write.mode("overwrite").parquet(
            f"{target}/{RUN_COLUMN}=compacted/{BATCH_COLUMN}=0"
        )
        return compacted


class CompactedLog:
    """An :class:`UpsertLog` whose reads stay bounded: batches are merged in levels under a manifest.

    Every write is one run of level 0.  When a level has ``fan`` runs they are merged by key into one run of
    the next level, so a key is rewritten once a level and ``n`` batches leave at most
    ``fan * log(n, fan)`` runs to read.  The manifest is a numbered file that lists the live runs; a new one
    is created only if its number is still free, which is the commit.  What a writer leaves
    behind before it commits is not listed and not read; a batch that is written again after its commit changes
    nothing.  One writer at a time: two would race for a number, and the later one fails.
    """

    def __init__(self, path: str, keys: Sequence[str], order: Sequence[str], fan: int = 8) -> None:
        self.path, self.keys, self.order, self.fan = path, list(keys), list(order), fan

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.write(batch, batch_id)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version, runs, done = self._manifest(spark)
        if done.get(run_of(batch), -1) >= batch_id:
            return
        folder = f"{self.path}/runs/{uuid.uuid4().hex}"
        numbered = latest_per(batch, self.keys, self.order).withColumn(SEQUENCE, F.lit(version + 1).cast("long"))
        numbered.write.parquet(folder)
        runs = [*runs, (0, folder)]
        level = 0
        while sum(r[0] == level for r in runs) >= self.fan:
            merged = f"{self.path}/runs/{uuid.uuid4().hex}"
            self._latest(spark, [f for own, f in runs if own == level]).write.parquet(merged)
            runs = [r for r in runs if r[0] != level] + [(level + 1, merged)]
            level += 1
        self._commit(spark, version + 1, runs, {**done, run_of(batch): batch_id})

    def read(self, spark: SparkSession) -> DataFrame:
        """The current row of each key."""
        _, runs, _ = self._manifest(spark)
        if not runs:
            raise ValueError("nothing has been written yet")
        return self._latest(spark, [folder for _, folder in runs]).drop(SEQUENCE)

    def live_runs(self, spark: SparkSession) -> int:
        return len(self._manifest(spark)[1])

    def vacuum(self, spark: SparkSession) -> int:
        """Remove the runs and manifests that the current manifest does not need; the number of runs.

        Not while another reader may still use an older manifest.
        """
        version, runs, _ = self._manifest(spark)
        live = {folder.rsplit("/", 1)[1] for _, folder in runs}
        files, removed = self._files(spark, self.path), 0
        for status in self._listed(spark, "runs"):
            if status.getPath().getName() not in live:
                removed += bool(files.delete(status.getPath(), True))
        for status in self._listed(spark, "manifests"):
            if int(status.getPath().getName().split(".")[0]) < version:
                files.delete(status.getPath(), False)
        return removed

    def _latest(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        return latest_per(spark.read.parquet(*folders), self.keys, [SEQUENCE, *self.order])

    @staticmethod
    def _files(spark: SparkSession, path: str):
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(spark._jsc.hadoopConfiguration())

    def _listed(self, spark: SparkSession, kind: str) -> list:
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        files = self._files(spark, self.path)
        return list(files.listStatus(at)) if files.exists(at) else []

    def _manifest(self, spark: SparkSession) -> tuple[int, list[tuple[int, str]], dict[str, int]]:
        """Number, runs with their levels, and the last batch of each stream."""
        numbers = [
            int(s.getPath().getName().split(".")[0]) for s in self._listed(spark, "manifests") if s.getPath().getName().endswith(".json")
        ]
        if not numbers:
            return 0, [], {}
        stream = self._files(spark, self.path).open(spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifests/{max(numbers):012}.json"))
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        content = json.loads(text)
        return max(numbers), [(level, folder) for level, folder in content["runs"]], content["done"]

    def _commit(self, spark: SparkSession, version: int, runs: list[tuple[int, str]], done: dict[str, int]) -> None:
        """Write the manifest aside, then rename it to its number, which fails if that is taken."""
        files, place = self._files(spark, self.path), spark._jvm.org.apache.hadoop.fs.Path
        aside = place(f"{self.path}/manifests/{uuid.uuid4().hex}.tmp")
        target = place(f"{self.path}/manifests/{version:012}.json")
        stream = files.create(aside, False)
        try:
            stream.write(bytearray(json.dumps({"runs": runs, "done": done}).encode()))
        finally:
            stream.close()
        if files.exists(target) or not files.rename(aside, target):
            files.delete(aside, False)
            raise RuntimeError(f"another writer committed version {version}")


def replace_statement(table: str, columns: Sequence[str]) -> str:
    marks = ",".join("?" for _ in columns)
    return f"REPLACE INTO {table}({','.join(columns)}) values({marks})"


def write_batched(
    df: DataFrame,
    connect: Callable[[], Any],
    statement: str,
    columns: Sequence[str],
    batch_size: int = 1000,
) -> None:
    """Run a DB-API statement for every row, ``batch_size`` rows per round trip.

    ``connect`` runs on the executors, once per partition.  The statement has to be
    a replacing one, because a retried task sends its rows again; reduce the input
    with ``latest_per`` first so that a key is not replaced twice.
    """

    def send(rows: Iterator) -> None:
        connection = connect()
        try:
            cursor = connection.cursor()
            pending: list[tuple] = []
            for row in rows:
                pending.append(tuple(row))
                if len(pending) == batch_size:
                    cursor.executemany(statement, pending)
                    pending = []
            if pending:
                cursor.executemany(statement, pending)
            connection.commit()
        finally:
            connection.close()

    df.select(*columns).foreachPartition(send)

