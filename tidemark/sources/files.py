"""File sources and sinks, for tables and for streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tidemark import schemas

#: Files in a micro-batch.  A stateful operator holds the rows of one key and one
#: micro-batch in one task, so a stream should not start with its whole history;
#: history is what the batch operators are for.
FILES_PER_TRIGGER = 16


def read_rate_csv(spark: SparkSession, path: str) -> DataFrame:
    """Part files of headerless rate lines."""
    return spark.read.schema(schemas.RATE).csv(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files as ``value``."""
    return spark.read.text(path)


def read_device_events(spark: SparkSession, path: str) -> DataFrame:
    """JSON documents that may span lines."""
    return spark.read.schema(schemas.DEVICE_EVENT).json(path, multiLine=True)


def stream_text(
    spark: SparkSession, path: str, files_per_trigger: int = FILES_PER_TRIGGER
) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)


def stream_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    file_format: str = "parquet",
    files_per_trigger: int = FILES_PER_TRIGGER,
) -> DataFrame:
    """A folder of table files as a stream."""
    return (
        spark.readStream.format(file_format)
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(path)
    )


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Headerless CSV with the columns in their declared order."""
    df.write.mode(mode).csv(path)


def stream_files(df: DataFrame, path: str, checkpoint: str, file_format: str = "parquet") -> DataStreamWriter:
    """Exactly-once files: the sink's log and the checkpoint commit a batch together."""
    return (
        df.writeStream.format(file_format)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def stream_console(df: DataFrame, checkpoint: str, mode: str = "append") -> DataStreamWriter:
    return (
        df.writeStream.format("console")
        .outputMode(mode)
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
    )
