"""The corpus pipeline: five stages from ``documents`` to a training mix.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents.  All but the
last return the columns of ``documents``; the last adds ``copies``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slicerefresh.llm import decontam, exact_dedup, jaccard, langid, mixing
from slicerefresh.llm.shared import table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language; those without a letter or a known language go."""
    return langid.in_some_language(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (but for the case of A-Z) the one with the largest id."""
    return exact_dedup.first_of_each(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, 0.8 alike or more) the one with the smallest id."""
    return jaccard.one_of_each(docs, width=5, share=(80, 100))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix of sources, with the number of copies to take."""
    return mixing.mixed(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
]

#: SQL cannot express the language filters; tests/llm compares the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
