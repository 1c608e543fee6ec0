"""The corpus pipeline: quality rules, line dedup, near duplicates, benchmark decontamination, packing.

Every stage reads the whole table that the stage before it wrote, and writes its own as Parquet into the shared folder.
All but the last return the columns of documents; the last returns the places of all pieces in the packed sequences.

A stage's own tables in the shared folder are discarded when the next stage begins, so its result must be written by then.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession

from cellweave.llm import decontaminate, jaccard_join, line_dedup, packing, quality
from cellweave.llm.common import discard, recorded, release, stored, table

_LEFT: list[DataFrame] = []  # tables that the stage before has stored


def _stage(body: Callable[[], DataFrame]) -> DataFrame:
    discard(*_LEFT)
    _LEFT.clear()
    with recorded(_LEFT):
        return body()


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return _stage(lambda: quality.keep_good(docs))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines go; so does a document of nothing else."""
    return _stage(lambda: line_dedup.keep_first_copies(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates (five words, Jaccard 0.8) stays: that with the smallest doc_id."""
    return _stage(lambda: jaccard_join.keep_one(docs, 5, Fraction(4, 5)))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return _stage(lambda: decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return _stage(lambda: packing.pack_documents(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", packing_stage),
]

# Components, prefix doubling and packing can't be put in one SQL text; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        discard(*before)
        before = [docs]
        release(spark)
    discard(*_LEFT)
    _LEFT.clear()
    return docs
