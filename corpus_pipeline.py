"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing, packing.

Each stage is a function of (spark, docs, sf_dir) over all that the stage
before it kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockbook.llm import line_dedup, minhash_dedup, mixing, packing, quality_rules
from stockbook.llm.common import stored_table, table

#: No source is drawn more often than this, and every document at least once.
REPEAT_LIMIT = 2.0


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the posterior accept."""
    return quality_rules.filter_quality(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated line runs; whole copies go."""
    return line_dedup.drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: its smallest doc_id; of rows equal in id and text one.

    Documents without a word are in no group and stay.
    """
    return minhash_dedup.drop_near_duplicates(docs, shingle=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources flattened as far as the repetition limit allows; rare sources' rows repeat, none goes."""
    return mixing.mix(docs, repeat_limit=REPEAT_LIMIT, cover=True)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens placed in sequences."""
    return packing.pack_documents(docs, with_ids=False)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("minhash_dedup", near_duplicates),
          ("mixing", mixture), ("packing", sequences)]

#: EM, MinHash and the genetic algorithm are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored_table(docs)
    return docs
