"""A training-data pipeline: raw documents to packed windows, one operator a stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeshore.llm import chunk_dedup, jaccard_join, langid, mixing, packing
from lakeshore.llm.common import materialise, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected."""
    return langid.keep_identified(docs, langid.fit(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return chunk_dedup.drop_copies(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at the rates that bring the domains to their target weights."""
    return mixing.mix(docs, table(spark, sf_dir, "labels"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed windows."""
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("ngram_jaccard_join", ngram_jaccard_join),
          ("mixing", mix_sources), ("packing", pack)]

#: The stages are trained models and a tokenizer: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
