"""A training corpus from raw documents: each stage reads what the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetspark.llm import mixing, near_dedup, packing, pii, quality
from fleetspark.llm.common import Workspace, table
from fleetspark.llm.queries import MIX_WEIGHTS, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; the ranking is learnt from labels."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels"), None))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the smallest id."""
    return near_dedup.drop_near_duplicates(docs)


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return pii.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the fitted rates ask for the target shares of domains."""
    return mixing.draw(docs, table(spark, sf_dir, "labels"), MIX_WEIGHTS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("pii", without_pii),
    ("mixing", mixed),
    ("packing", packed),
]

# Learnt models and public tokenizers are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each reads a table that the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    ws = Workspace(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = ws.land(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
