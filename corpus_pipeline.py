"""The corpus pipeline: documents in, a mixed, clean and encoded token file out.

Each stage takes the documents that the one before it kept, and all but the last return the columns
of documents. Rows without a doc_id are judged by their texts; an empty table passes through as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from colweave.llm import decontaminate, language_id, mixing, near_dups, token_files
from colweave.session import cut_lineage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts whose language stays unclear to a network that learned from
    other documents."""
    return language_id.accept_across(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each class of near duplicates."""
    return near_dups.first_of_class(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, in whatever order its passages stand."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents so that every source has the same share of the text, in random order."""
    return mixing.repeat(docs)


def token_file(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the subword ids in the mixed order and returns per document what the files hold."""
    return token_files.encode_and_read(docs, token_files.file_order(docs))


STAGES = [
    ("language id", known_language),
    ("near-duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", mixed_sources),
    ("token output", token_file),
]
#: No stage but the mixing can be said in SQL; tests/llm/test_pipeline.py holds run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
