"""A training corpus from raw documents, in five stages.

Each stage takes what its predecessor kept, and all but the last return the
columns of ``documents``:

1. language ID: texts in none of the learned languages go;
2. n-gram join: one document of each group of near duplicates stays;
3. substring dedup: repeated passages are cut out of texts, texts that were
   nothing else go;
4. decontamination: documents that hold a benchmark window go;
5. packing: pieces of documents and the bins they are in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scholarlake.llm import decontamination, language_id, ngram_join, packing, substring_dedup
from scholarlake.llm.common import shipped_code, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shipped_code(spark)
    return language_id.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shipped_code(spark)
    return ngram_join.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shipped_code(spark)
    return substring_dedup.stripped(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shipped_code(spark)
    items = table(spark, sf_dir, "benchmark")
    return decontamination.without_contaminated(docs, items, unnamed=True)


def bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shipped_code(spark)
    return packing.packed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_languages),
    ("ngram_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontamination", benchmark_passages),
    ("packing", bins),
]

# Trained models and packing have no SQL; the stages are tested against plain ones.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
