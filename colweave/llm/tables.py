"""What the operators share on the Spark side: column selection, splits, tasks over text groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave.llm import textops as T


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(by: int, key: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo `by`; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(by))


def over_groups(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, column: str = "text") -> DataFrame:
    """`work` on every group of rows with a few MB of text, in tasks of the given partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for group in T.groups(batch, column):
                    yield work(group)
        finally:
            T.release()

    return df.mapInArrow(run, schema)


def sample(df: DataFrame, most: int, key: str = "doc_id") -> DataFrame:
    """At most `most` rows, chosen by hash of the key: the same ones in every run."""
    return df.orderBy(F.xxhash64(key, F.lit(17)), key).limit(most)


def chosen_texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """`chosen` (doc_id and other columns, a bounded number of distinct ids) with `text`: one row for
    each id, however many rows of docs have it, with the least text of them."""
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return found.groupBy(*chosen.columns).agg(F.min("text").alias("text"))
