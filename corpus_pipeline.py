"""The training-data pipeline: language ID, exact dedup, SimHash near-dedup, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor kept; its result is
written as Parquet and reread as the next stage's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import grace, langmix, mixing, packing, simhash
from quarry.llm.common import read_table, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or that a background explains better than the learned languages, go."""
    return langmix.recognised(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays: that with the largest doc_id."""
    return grace.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component stays: that with the smallest doc_id."""
    return simhash.one_of_each(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix; one that it uses twice comes twice, one that it does not use goes."""
    return mixing.mixed_rows(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per packed piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packing.pack(docs, with_ids=False)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("best_fit_packing", packing_stage),
]

#: SQL can express neither the language mixtures nor the fingerprints nor the token ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the last stage returns for the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = table(docs, f"pipeline-{name}", compression="zstd")
    return docs
