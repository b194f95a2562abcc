"""From raw documents to packed training sequences: each stage calls one corpus operator,
is written as Parquet and read again as the next stage's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary.llm import line_dedup, quality_rules, sequence_packing, simhash_dedup, source_mixing
from tributary.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their failing lines."""
    return quality_rules.kept_documents(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that occurred earlier."""
    return line_dedup.deduplicated_documents(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash_dedup.one_of_each_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the sources' target weights; a document drawn twice is there twice."""
    return source_mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in training sequences."""
    return sequence_packing.packed_documents(docs)


STAGES = [("quality rules", quality), ("line dedup", dedup_lines), ("simhash near-dedup", dedup_documents),
          ("source mixing", mix), ("packing", pack)]

#: Fingerprint components, hashed draws and packing are beyond SQL: tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
