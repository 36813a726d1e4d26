"""Runs that arrive as a stream."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from colweave import schemas as S
from colweave.operators.cache import one_per_key, read_response_cache, usable_entries


def stream_new_sql(requests: DataFrame, retention: str, time: str = "ts") -> DataFrame:
    """Requests whose ``cache_key`` did not occur within ``retention`` before.

    The key state goes when the watermark passes it. ``stream_unseen_sql`` lets a key pass once for good.
    """
    return requests.withWatermark(time, retention).dropDuplicatesWithinWatermark(["cache_key"])


def read_unseen(spark: SparkSession, path: str) -> DataFrame | None:
    """Requests let through so far, one per key, with the stream and batch that brought them; None before
    the first."""
    try:
        found = spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException:
        return None
    return found.withColumns({"stream": F.col("stream").cast("string"), "batch": F.col("batch").cast("long")})


def put_unseen(requests: DataFrame, batch: int, path: str, stream: str, cache_path: str | None = None, files: int = 1) -> None:
    """Adds those requests of one batch whose key neither the table in ``path`` nor the response cache
    knows, one row per key, as the partition (stream, batch).

    The rows that this very batch has left before do not count as known and are replaced as a whole, so
    a batch that is worked again leaves what it left the first time. Rows without key are left out.
    Known keys are found by anti joins on the key alone; payloads of the cache are read for the keys of
    the batch only.
    """
    spark = requests.sparkSession
    new = one_per_key(requests.where("cache_key is not null").drop("stream", "batch"))
    before = read_unseen(spark, path)
    if before is not None:
        own = (F.col("stream") == stream) & (F.col("batch") == batch)
        new = new.join(before.where(~own).select("cache_key"), "cache_key", "left_anti")
    if cache_path is not None:
        try:
            stored = read_response_cache(spark, cache_path)
        except FileNotFoundError:
            stored = None
        if stored is not None:
            asked = stored.join(new.select("cache_key"), "cache_key", "left_semi")
            new = new.join(usable_entries(asked), "cache_key", "left_anti")
    placed = new.withColumns({"stream": F.lit(stream), "batch": F.lit(batch).cast("long")})
    spread = placed.repartition(files, "cache_key")
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stream", "batch").parquet(path)


def stream_unseen_sql(
    requests: DataFrame, path: str, checkpoint: str, cache_path: str | None = None, files: int = 1
) -> StreamingQuery:
    """Requests still to be parsed, whatever their age: each ``cache_key`` gets into the table in ``path``
    once for good, and not at all if the response cache has a usable answer.

    What is known stands in tables and not in the state of the stream, so no watermark bounds it. A
    batch that failed halfway is worked again under its number and replaces its own rows. The stream is
    known by its checkpoint: one with another checkpoint adds to the same table and writes over nothing.
    One stream at a time.
    """
    stream = "s" + hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    return (
        requests.writeStream.foreachBatch(lambda rows, batch: put_unseen(rows, batch, path, stream, cache_path, files))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_run_coverage(nodes: DataFrame, window: str, lateness: str, time: str = "ts") -> DataFrame:
    """Nodes by status and node coverage of each closed window; later rows are dropped."""
    done = F.col("parsed") + F.col("partial")
    counts = (
        nodes.withWatermark(time, lateness)
        .groupBy(F.window(time, window).alias("w"))
        .agg(
            *[F.count_if(F.col("status") == s).alias(s) for s in S.STATUSES],
            F.count_if(F.col("status") != "skipped").alias("eligible_count"),
        )
    )
    ratio = F.coalesce(done / F.nullif(F.col("eligible_count"), F.lit(0)), F.lit(1.0))
    return counts.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *S.STATUSES,
        "eligible_count",
        ratio.alias("node_coverage"),
    )


def write_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there now, exactly once, into Parquet files."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
