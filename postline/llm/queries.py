"""The registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postline.llm import (
    audit,
    bagminhash,
    bpe,
    gru,
    itq,
    langid,
    mixing,
    packing,
    paragraphs,
    perplexity,
    quality,
    residues,
    suffixes,
)
from postline.llm.common import stage, table


def op1_gated_word_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru.score(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(table(spark, sf_dir, "documents"))


def op3_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.quality_rules(table(spark, sf_dir, "documents"))


def op4_itq_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_paragraph_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.removal(table(spark, sf_dir, "documents"))


def op6_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents")))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(stage(mixing.sized(table(spark, sf_dir, "documents"))))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_line_field_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_maximal_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removal(table(spark, sf_dir, "documents"))


def op10_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents")).drop("node")


def op11_path_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_residue_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residues.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    op1_gated_word_model,
    op2_language_id,
    op3_perplexity_rules,
    op4_itq_near_duplicates,
    op5_paragraph_bands,
    op6_pattern_packing,
    op7_source_mixing,
    op8_line_field_quality,
    op9_maximal_repeats,
    op10_bagminhash,
    op11_path_counts,
    op12_residue_negatives,
    op13_merge_rounds,
)

#: Not expressible: trained models, tokenisers, suffix arrays, sketches; tests hold those against brute force.
SQL = {"op7_source_mixing": mixing.SQL, "op11_path_counts": audit.SQL, "op12_residue_negatives": residues.SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
