"""The registered queries of the text operators: each applies one to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeshore.llm import (
    chunk_dedup,
    decontamination,
    fertility,
    html_content,
    jaccard_join,
    langid,
    mixing,
    packing,
    periodic_runs,
    pseudonyms,
    quality_gam,
    toxicity,
    whitening,
)
from lakeshore.llm.common import id_remainder, table


def _held_out(modulus: int, remainder: int):
    return (id_remainder("doc_id", modulus) == remainder).alias("held_out")


def op1_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judge(table(spark, sf_dir, "documents"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op3_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_gam.fit(docs, table(spark, sf_dir, "labels"))
    return quality_gam.score(docs, model).select("doc_id", _held_out(4, 2), "score", "predicted")


def op4_soft_membership_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.rate_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs)).select("doc_id", _held_out(4, 2), "lang_pred", "score", "rejected")


def op6_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = chunk_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_content.extract(table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", _held_out(5, 0), "score", "predicted")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return whitening.whiten(rows, whitening.fit(rows))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.plant_periods(table(spark, sf_dir, "documents")))


def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_tokeniser_fertility, op2_ngram_jaccard_join, op3_quality_gam, op4_soft_membership_mixing,
                            op5_language_id, op6_feistel_pseudonyms, op7_packing, op8_exact_dedup, op9_html_main_text, op10_toxicity,
                            op11_embedding_whitening, op12_periodic_runs, op13_benchmark_decontamination)}

__all__ = ["QUERIES", *QUERIES]
