"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

#: Most rows of one key that an ordered computation may put into a single task.
ROWS_PER_TASK_CONF = "spark.tidemark.rowsPerTask"
DEFAULT_ROWS_PER_TASK = 4_000_000


def local_session(
    cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g"
) -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    return configure(
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings results depend on; cluster sizing is left alone.

    Epoch arithmetic on zone-less timestamps needs UTC.  Merging sessions before
    the shuffle is the partial aggregation of session windows, off by default.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.sessionWindow.merge.sessions.in.local.partition", "true")
    return spark


def use_rocksdb_state(spark: SparkSession) -> SparkSession:
    """Keep streaming state off-heap; ``transformWithState`` requires it."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


def rows_per_task(spark: SparkSession, override: int | None = None) -> int:
    if override is not None:
        return max(1, int(override))
    return max(1, int(spark.conf.get(ROWS_PER_TASK_CONF, str(DEFAULT_ROWS_PER_TASK))))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can read, from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local folder would lose the data together with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
    spark.sparkContext.setCheckpointDir(fallback)
    return spark.sparkContext.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the table.

    It cuts the lineage as ``checkpoint()`` does, but stays columnar: the table is
    compressed, and later steps read only the columns they use.
    """
    path = f"{shared_dir(df.sparkSession)}/tidemark-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
