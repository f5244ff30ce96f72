"""Kafka-compatible message logs.

The connector is the public ``spark-sql-kafka`` package and has to be on the
cluster's class path.  Decoders and encoders work on a plain ``value`` column, so
everything downstream of :func:`text` runs on the file source as well.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter



@dataclass(frozen=True)
class MessageLog:
    """Where the topics are and how to read them."""

    servers: str
    group: str | None = None
    starting: str = "latest"
    max_offsets_per_trigger: int = 10_000_000
    extra: Mapping[str, str] = field(default_factory=dict)

    def reader_options(self, topics: Sequence[str]) -> dict[str, str]:
        """All topics form one stream; the trigger limit bounds a micro-batch."""
        options = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": ",".join(topics),
            "startingOffsets": self.starting,
            "maxOffsetsPerTrigger": str(self.max_offsets_per_trigger),
        }
        if self.group:
            options["kafka.group.id"] = self.group
        return {**options, **self.extra}

    def writer_options(self, topic: str | None = None) -> dict[str, str]:
        """Without ``topic`` the rows name their own in a ``topic`` column."""
        options = {"kafka.bootstrap.servers": self.servers}
        if topic:
            options["topic"] = topic
        return {**options, **self.extra}

    def stream(self, spark: SparkSession, *topics: str) -> DataFrame:
        raw = spark.readStream.format("kafka").options(**self.reader_options(topics)).load()
        return text(raw)

    def read(self, spark: SparkSession, *topics: str) -> DataFrame:
        """The topics as a bounded table, from the earliest offset on."""
        options = {**self.reader_options(topics), "startingOffsets": "earliest"}
        options.pop("maxOffsetsPerTrigger", None)
        return text(spark.read.format("kafka").options(**options).load())

    def writer(
        self,
        df: DataFrame,
        checkpoint: str,
        topic: str | None = None,
        name: str | None = None,
    ) -> DataStreamWriter:
        """Append messages; Spark's sink repeats a message when a batch is retried."""
        options = self.writer_options(topic)
        writer = (
            df.writeStream.format("kafka")
            .outputMode("append")
            .options(**options)
            .option("checkpointLocation", checkpoint)
        )
        return writer.queryName(name) if name else writer


def text(raw: DataFrame) -> DataFrame:
    """Message values as text, with their topic and position for ordering."""
    return raw.select(
        F.col("value").cast("string").alias("value"), "topic", "partition", "offset"
    )


def messages(df: DataFrame, value: Column, topics: Sequence[str] = ()) -> DataFrame:
    """The ``value`` column of a sink, once per topic when several are given."""
    if not topics:
        return df.select(value.alias("value"))
    return df.select(
        value.alias("value"),
        F.explode(F.array(*[F.lit(t) for t in topics])).alias("topic"),
    )
