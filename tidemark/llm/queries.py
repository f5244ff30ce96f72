"""The operators bound to the test tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment,
    audit,
    bpe,
    decontaminate,
    jaccard,
    ngrams,
    quality,
    repair,
    ship,
    substring,
    token_counts,
    toxicity,
    warc,
    winnowing,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship.prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        *quality.MEASURES,
        (~quality.passes(F.col("failed"), quality.POLICIES["base"])).alias("base_failed"),
        quality.passes(F.col("failed"), quality.POLICIES["v2"]).alias("kept"),
        "failed",
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring.removals(_table(spark, sf_dir, "documents"), span=35)
    return rows.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(_table(spark, sf_dir, "pages"), least_revisit=0)


def op4_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return repair.encode_and_read(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def _remainder():
    return F.crc32(F.col("doc_id").cast("string")) % 5


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), learn=_remainder() != 0)
    return toxicity.score(docs, model).select(
        "doc_id",
        (_remainder() == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op6_ngram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = _remainder() == 1
    rows = ngrams.score(docs, ngrams.train(docs, learn=~held_out, least_pair=ngrams.LEAST_PAIR))
    return rows.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(_table(spark, sf_dir, "documents"), width=3, threshold=(9, 10))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return rows.withColumn("over_limit", F.col("n_tokens") > 2048)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(_table(spark, sf_dir, "documents"), path, verify=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each (document, benchmark item) pair with at least 80 % of the item's 5-word shingles."""
    return decontaminate.contained(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = winnowing.compare_edited(_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited_text", 256).alias("edited_sha256"),
        winnowing.as_text(F.col("chosen")).alias("fingerprint"),
        winnowing.as_text(F.col("edited_chosen")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_warc": op3_warc,
    "op4_repair_ids": op4_repair_ids,
    "op5_toxicity": op5_toxicity,
    "op6_ngram_scores": op6_ngram_scores,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_token_counts": op8_token_counts,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_decontaminate": op10_decontaminate,
    "op11_winnowing": op11_winnowing,
    "op12_filter_audit": op12_filter_audit,
    "op13_token_alignment": op13_token_alignment,
}
