"""From raw documents to training shards.

Quality rules, near duplicates, benchmark decontamination, mixing sources to target weights, sharding.
Each stage is written as Parquet in the shared folder and read again as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadlens.llm import decontamination, jaccard, mixing, quality, sharding
from roadlens.llm.frames import stored, table

N_SHARDS = 40

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the perplexity bands keep."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word shingles, similarity of 0.8 and more)."""
    return jaccard.one_of_each(docs, threshold=80, n=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontamination.remove(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in shards of near equal sizes, with each row's shard and slot."""
    return sharding.into_shards(docs, N_SHARDS)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shards", shards),
]

#: The perplexity model, the similarity components and the packing have no SQL form; the stages are
#: tested against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
