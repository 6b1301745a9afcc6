"""The corpus pipeline: five stages over ``documents``, each written and read again by who runs it.

1. quality: documents that the base rules or the divergence from their language reject go.
2. near_dedup: one document of each group of near-duplicates stays, those linked by a Jaccard
   similarity of 0.8 or more of their shingles of five words, found by SimHash.
3. substrings: bytes of passages that a document with a smaller id also has go; ``n_chars`` follows the text.
4. mixing: documents stand as often as their source's target weight says.
5. packing: the mix, by words, in bins of several permitted lengths. A row for each piece of a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridia.llm import mixing, neardup, packing, quality, substrings
from meridia.llm.common import checkpointed, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep, with all columns, of any names. Null and short texts go; equal rows are judged alike; no rows give no rows."""
    return quality.judge(docs).where("quality.kept").select("row.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, the one with the smallest id; a null id stands last, of equal rows one stays. Null and empty texts are one group."""
    return neardup.one_of_each(docs)


def substrings_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, their texts without bytes of passages that a smaller id has; ``n_chars``, where there is such a column, follows. Null texts stay null; rows of one id, or without one, take nothing from each other."""
    left = substrings.remove(docs)
    return left.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else left


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them. Texts without words, and null ones, are not taken; a null source is one of its own, equal rows are taken alike."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each row: doc_id, piece, first, size, bin_group, bin, bin_length, offset. Texts without words need no place; equal rows are packed each."""
    return packing.pack_documents(docs).withColumnRenamed("id", "doc_id").withColumnRenamed("group", "bin_group")


STAGES = [("quality", quality_stage), ("near_dedup", near_dedup_stage), ("substrings", substrings_stage), ("mixing", mixing_stage), ("packing", packing_stage)]

#: XXH64, the splitting tree and best fit are not for SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
