"""From documents to packed training sequences: each stage works on what the one before it kept.

Stages are written as Parquet in the shared folder and read again, so a lost
executor costs at most the work of its own stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postline.llm import bagminhash, mixing, packing, quality, suffixes
from postline.llm.common import stage, table

#: The stages need trained models, sketches, suffix arrays and a tokeniser, which SQL cannot express.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the line field does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near duplicates."""
    return bagminhash.keep_one_of_each(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, their texts without byte strings that repeat."""
    return suffixes.deduplicated(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of the mix: repeated once per epoch, the one at a source's cut shortened."""
    return mixing.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents with their place in a sequence."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each_group),
    ("repeated_passages", without_repeated_passages),
    ("mixing", mixed_sources),
    ("packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
