"""Session helpers: keys shared by all tables, checkpoint folder, local session for tests."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN = ["project", "run_id"]
KEY = ["project", "run_id", "node_id"]

RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def held_names(keys: Sequence[str]) -> dict[str, str]:
    """New names for keys. Under them the planner sees the layout that parts of a union share; names that SQL has
    qualified hide it."""
    return {c: f"_{c}" for c in keys}


def numbered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with a number made from ``keys`` before its columns. As the first of the keys of a join or an aggregate it
    lets the sort go by it instead of comparing the texts of many keys that begin alike."""
    return df.select(F.xxhash64(*keys).alias("_number"), "*")


def join_numbered(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """``left`` and ``right`` joined on ``keys``, sorted by their number."""
    return numbered(left, keys).join(numbered(right, keys), ["_number", *keys], how).drop("_number")


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("colweave")
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in RECOMMENDED_CONF.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as the cluster names it in
    ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine; elsewhere a lost
    executor would take the data with it.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="colweave-"))
        configured = sc.getCheckpointDir()
    return configured


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Later rounds start from the files, so a lost executor costs one scan and not all rounds, and
    the planner knows the true size.
    """
    path = fresh_path(df.sparkSession, "round")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_placed(df: DataFrame, by: Sequence[str], parts: int) -> DataFrame:
    """As ``cut_lineage``, for rows that are dealt over ``parts`` tasks by ``by``: they are read back in this
    layout, so joins and aggregates by these columns need no exchange.

    The files are one bucketed table, whose name is this session's.
    """
    name = f"placed_{uuid.uuid4().hex}"
    path = fresh_path(df.sparkSession, "round")
    df.write.bucketBy(parts, *by).saveAsTable(name, format="parquet", path=path)
    return df.sparkSession.table(name)
