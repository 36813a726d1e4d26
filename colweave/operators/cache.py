"""Response cache as a table keyed by SQL content, and the call budget of a run."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colweave import schemas as S
from colweave.functions.sqltext import cache_key, dynamic_sql_marker, marker_excerpt, mask_literals
from colweave.session import KEY, RUN, cut_lineage

SALTS = 64


def prepare_sql(nodes: DataFrame, mode: str, parser_version: str, tool_version: str, redact: bool = False) -> DataFrame:
    """One scan of all SQL texts: masked text if asked for, cache key, marker and excerpt."""
    texts = mask_literals(nodes, "sql", "sql") if redact else nodes
    sql = F.col("sql")
    return texts.withColumns(
        {
            "cache_key": cache_key(
                sql, F.col("dialect"), F.lit(mode), F.lit(parser_version), F.lit(tool_version)
            ),
            "marker": dynamic_sql_marker(sql),
            "excerpt": marker_excerpt(sql),
        }
    )


def usable_entries(cache: DataFrame) -> DataFrame:
    """Keys with a response that parses; a broken entry is a miss."""
    return cache.where(F.try_parse_json("payload").isNotNull()).select("cache_key").distinct()


def split_cached(requests: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requests that the cache answers, and those still to be parsed."""
    known = usable_entries(cache)
    return (
        requests.join(known, "cache_key", "left_semi"),
        requests.join(known, "cache_key", "left_anti"),
    )


def cache_hit_stats(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """Hits, misses and whole percent per run. The first request of an unknown key is a miss."""
    per_key = requests.groupBy(*RUN, "cache_key").agg(F.count("*").alias("n"))
    known = usable_entries(cache).withColumn("known", F.lit(1))
    missed = F.when(F.col("known").isNull(), 1).otherwise(0)
    out = per_key.join(known, "cache_key", "left").groupBy(*RUN).agg(
        F.sum(F.col("n") - missed).alias("hits"), F.sum(missed).cast("bigint").alias("misses")
    )
    share = F.floor(F.lit(100) * F.col("hits") / (F.col("hits") + F.col("misses")))
    return out.withColumn("hit_rate_pct", share.cast("bigint"))


def one_per_key(responses: DataFrame) -> DataFrame:
    """One answer per key, the latest if the answers have a time (``written``); ties go by a digest, so
    the order of arrival does not matter.

    Rows are put in order by their key, time and digest; payloads are carried and never compared. Spark
    keeps the first row of a key in each task before the shuffle.
    """
    rest = sorted(c for c in responses.columns if c != "cache_key")
    order = [F.desc("written")] if "written" in rest else []
    first = F.row_number().over(W.partitionBy("cache_key").orderBy(*order, F.xxhash64(*rest)))
    return responses.withColumn("_place", first).where("_place = 1").drop("_place")


def write_response_cache(responses: DataFrame, path: str, files: int = 1) -> None:
    """Puts responses into the cache, one row per key on disk, in directories by the first two characters
    of the key.

    An answer takes the place of the one stored under its key. Only the directories that hold a key
    whose answer is new or another are written again, whole, so the cache never grows by repeats and
    needs no compaction; the merged rows are kept in the shared folder first, so a write that fails
    halfway can be done again from there. One writer at a time. The keys are digests, so the
    directories, and the ``files`` files that each task group writes into one, are of equal size.
    """
    spark = responses.sparkSession
    new = one_per_key(responses).withColumns({"bucket": F.left("cache_key", F.lit(2)), "digest": F.xxhash64(*sorted(c for c in responses.columns if c != "cache_key"))})
    stored = _stored(spark, path)
    if stored is not None:
        kept = new.join(stored.select("bucket", "cache_key", "digest"), ["bucket", "cache_key", "digest"], "left_anti")
        new = cut_lineage(kept)
        touched = new.select("bucket").distinct()  # 256 at most
        same = stored.join(F.broadcast(touched), "bucket", "left_semi").join(new.select("cache_key"), "cache_key", "left_anti")
        new = new.unionByName(same, allowMissingColumns=True)
    merged = cut_lineage(new)
    spread = merged.repartition("bucket", F.pmod(F.xxhash64("cache_key"), F.lit(files)))
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The cache as it is on disk; None if there is none yet."""
    try:
        found = spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException:
        return None
    return found.withColumn("bucket", F.lpad(F.col("bucket").cast("string"), 2, "0"))


def read_response_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored answers, one per key, as they are on disk."""
    found = _stored(spark, path)
    if found is None:
        raise FileNotFoundError(path)
    return found.drop("digest")


def quota_cut(
    planned: DataFrame,
    cache: DataFrame,
    budget: int = S.ANONYMOUS_BUDGET,
    detail: str = "anonymous tier rate-limited",
) -> DataFrame:
    """Outcome of every eligible node when a run may spend ``budget`` calls.

    Nodes go in order of their id; a key without a usable entry that was not seen
    earlier spends a call.
    From the node that needs call number budget + 1 on, all nodes of the run fail.

    Only that one node per run has to be found. The first node of each new key is an aggregate;
    of those, each of 64 salts keeps its budget + 1 smallest before the run is looked at as a
    whole, so a run of any size leaves at most 64 * (budget + 1) rows for the last window.
    """
    eligible = planned.where("eligible").select(*KEY, "cache_key")
    firsts = (
        eligible.groupBy(*RUN, "cache_key")
        .agg(F.min("node_id").alias("node_id"))
        .join(usable_entries(cache), "cache_key", "left_anti")
        .withColumn("salt", F.pmod(F.xxhash64("cache_key"), F.lit(SALTS)))
    )
    by_salt = F.row_number().over(W.partitionBy(*RUN, "salt").orderBy("node_id"))
    by_run = F.row_number().over(W.partitionBy(*RUN).orderBy("node_id"))
    cuts = (
        firsts.withColumn("rn", by_salt)
        .where(F.col("rn") <= budget + 1)
        .withColumn("call", by_run)
        .where(F.col("call") == budget + 1)
        .select(*RUN, F.col("node_id").alias("cut_id"))
    )
    beyond = F.col("node_id") >= F.col("cut_id")
    return eligible.join(cuts, RUN, "left").select(
        *KEY,
        F.when(beyond, "failed").otherwise("answered").alias("outcome"),
        F.when(beyond, "quota_limited").alias("reason"),
        F.when(F.col("node_id") == F.col("cut_id"), detail)
        .when(beyond, "anonymous tier exhausted earlier in this run")
        .alias("detail"),
    )
