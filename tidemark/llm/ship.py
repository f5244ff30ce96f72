"""What the tasks need from the driver: the package itself, and a shared folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import session

_shipped: set[str] = set()


def package(spark: SparkSession) -> None:
    """Let the executors' Python import this package; once for each application.

    The archive is only the hand-over to Spark, which copies it to every executor.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="tidemark-package-")) / f"{root.name}-package.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def prepare(spark: SparkSession) -> None:
    """Session settings of the operators: the library's own, and small Arrow batches.

    Bytes, not rows, bound a batch, so that long documents do not fill a worker.
    """
    session.configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    package(spark)


def folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the one that driver and executors share, as a URI."""
    path = f"{session.shared_dir(spark).rstrip('/')}/tidemark-{purpose}-{uuid.uuid4().hex}"
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


#: Most rows of ids and numbers that a join may broadcast; more are shuffled.
BROADCAST_ROWS = 500_000


def measured(
    df: DataFrame, limit: int = BROADCAST_ROWS, keep: Callable[[DataFrame], DataFrame] = session.checkpointed
) -> DataFrame:
    """``df`` written once by ``keep``, for a join: broadcast if it has few rows, else left to a shuffle.

    For narrow tables of ids and numbers only, whose size follows from their rows.
    """
    kept = keep(df)
    return F.broadcast(kept) if kept.count() <= limit else kept


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, for a join with all its columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


class Scratch:
    """Tables that only steps of one operator read, removed once its result is written.

    They lie in one new folder of the shared one, so any executor can read them again, and
    removing them frees the disk for the next operator.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = folder(spark, "scratch")

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def result(self, df: DataFrame) -> DataFrame:
        """Write the result outside the folder, then remove the folder."""
        kept = session.checkpointed(df)
        self.remove()
        return kept

    def remove(self) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
