"""The corpus pipeline: quality, near duplicates, repeated substrings, decontamination, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents.

Rows: null and empty texts stay null and empty, and are packed as their end ids; rows with one doc_id or none are kept row by row, but
of near copies (the same text, too) one row stays, that with the smallest doc_id, a null one last. Without labels of both kinds quality
accepts or rejects all alike, without benchmark items decontamination changes nothing; empty documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from winnowry.llm import decontaminate, jaccard, packing, quality, substrings
from winnowry.llm.common import stored, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (4) accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (9)."""
    return jaccard.keep_one(docs)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without bytes of strings that stand elsewhere too (3)."""
    return substrings.remove(docs)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of benchmark windows (7)."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in token sequences (8)."""
    return packing.pack(docs, packing.vocabulary_path())


STAGES = [("quality", good), ("near_duplicates", distinct), ("substrings", unrepeated), ("decontamination", unseen), ("packing", packed)]

#: Stages train a model, close over links and run a tokenizer, which SQL can't express; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
