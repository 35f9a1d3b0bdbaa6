"""The training-corpus pipeline: five stages, each over all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlens.llm.block_naming import keep_exact
from marketlens.llm.common import documents, table
from marketlens.llm.language_filters import keep_identified
from marketlens.llm.near_texts import keep_one_near
from marketlens.llm.packing import packed
from marketlens.llm.queries import vocabulary
from marketlens.llm.seed_alignment import keep_clean
from marketlens.sources.workspace import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language."""
    return keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return keep_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return keep_one_near(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two length."""
    return packed(docs, vocabulary)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontamination", decontaminated),
    ("packing", packing),
]

#: Bloom filters, XXH64 fingerprints, alignments and token ids are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
