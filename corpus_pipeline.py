"""A pipeline from raw documents to encoded training text.

Each stage applies one operator to all that the stage before kept: quality
rules, near-duplicates, shared passages, the mix of sources, and encoding.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from siltlake.llm import byte_bpe, chunks, mixing, outliers, simhash_dedup
from siltlake.llm.common import ship, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Sources are repeated to meet the target weights; none falls below one copy,
# so that no clean document is lost here.
MIX = mixing.Mix(least=1.0)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return outliers.good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash_dedup.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return chunks.without_passages(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, MIX)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return byte_bpe.with_ids(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("near duplicates", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing", mix),
    ("encoding", encode),
]

# No stage but the mix can be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
