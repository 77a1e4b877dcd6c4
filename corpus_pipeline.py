"""A training corpus from documents: each stage's result is written and reread as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lamellar.llm import bpe, mixing, pii, quality, simhash
from lamellar.session import discard, scratch, scratch_scope, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Only documents that no quality rule rejects."""
    return quality.keep_good(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates."""
    return simhash.keep_first(docs)


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return pii.mask(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at square-root weights, globally shuffled."""
    return mixing.replicate(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, their count, and digests of the ids and of the decoded text, per row."""
    return bpe.digests(docs, bpe.default_path(), keep_ids=True)


STAGES: list[tuple[str, Stage]] = [("quality", good), ("near_duplicates", distinct), ("personal_data", masked), ("mixing", mixed), ("tokens", tokenized)]

#: SimHash, the random field and BPE have no SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result is a Parquet table in the shared folder, kept until the next one is.

    The last table stays until the session ends or clears its scratch files.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            discard(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
