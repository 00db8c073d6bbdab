"""Corpus pipeline: the stages that make packed training sequences of the documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``; all but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rangelake.llm import decontamination, exact_dedup, language_id, near_duplicates, packing
from rangelake.llm.shared import cut, shared_folder, table

#: Words that packing caches: less than by itself, as its workers go on to serve other stages. Results don't depend on it.
CACHED = 200_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, and those that resemble no learned language."""
    return language_id.known_language(docs)


def dedup_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest doc_id stays."""
    return exact_dedup.drop_duplicates(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates that links connect, the row with the smallest doc_id stays."""
    return near_duplicates.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences; one row per piece."""
    return packing.best_fit_pack(docs, words=CACHED)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", dedup_exact),
    ("ngram_jaccard_join", dedup_near),
    ("decontamination", decontaminate),
    ("best_fit_packing", pack),
]

#: Language ID, retrieval and tokenisation can't be written in SQL; the operators' tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, f"{k}-{name}", folder)
    return docs
