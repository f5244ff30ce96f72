"""Parquet tables, and the rate view over the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import session
from tidemark.functions.time import epoch_ms
from tidemark.sources.files import FILES_PER_TRIGGER

PROPS = "k INT"

#: The ``events`` table, for streams, which take no schema from files.
EVENTS = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    session.configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder, in whatever file system it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory()


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def rate_view(events: DataFrame) -> DataFrame:
    """Events as rates: ``event_id, user_id, et, ts, hbdm, num``.

    ``event_id`` is the order of arrival.
    """
    return events.select(
        "event_id",
        "user_id",
        F.col("ts").alias("et"),
        epoch_ms("ts").alias("ts"),
        F.col("event_type").alias("hbdm"),
        F.from_json("props", PROPS)["k"].alias("num"),
    )


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate_view(table(spark, sf_dir, "events"))


def stream_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rate view as a stream, with ``et`` as a timestamp that can be watermarked.

    The table may be one file or a folder of part files; a stream source reads folders,
    so a single file is picked out of the folder above it.
    """
    session.configure(spark)
    reader = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", FILES_PER_TRIGGER)
    path = f"{sf_dir}/events.parquet"
    if is_folder(spark, path):
        raw = reader.parquet(path)
    else:
        raw = reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return rate_view(raw).withColumn("et", F.col("et").cast("timestamp"))
