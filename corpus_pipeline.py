"""From raw documents to encoded training text, stage by stage.

Each stage takes what its predecessor kept, as a Parquet table, and decides on all of it:
toxic documents go, one document of each near-duplicate class stays, repeated passages
are cut out of the texts, documents that contain a benchmark item go, and the rest is encoded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import session
from tidemark.llm import bpe, decontaminate, jaccard, ship, substring, toxicity

import public_tokenizers  # isort: skip  (without the subpackage above, its absence is what the import reports)

RANKS = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship.prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles and a similarity of 0.8, the least of each class stays."""
    ship.prepare(spark)
    return jaccard.one_of_each(docs, width=5, threshold=(4, 5))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship.prepare(spark)
    return substring.without_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship.prepare(spark)
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship.prepare(spark)
    coded = bpe.encode(docs, public_tokenizers.path(RANKS))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontaminate", drop_contaminated),
    ("byte_bpe", encode),
]

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = session.checkpointed(docs)
    return docs
