"""Content state of nodes, kept between runs: what was added, removed or changed, and what depends on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave.functions.sqltext import normalize_sql
from colweave.operators.graph import descendants, known_nodes_only
from colweave.session import KEY, RUN

NODE = ["project", "node_id"]


def node_state(nodes: DataFrame) -> DataFrame:
    """A digest of what decides the lineage of each node: type, name, adapter, tags and SQL.

    SQL counts up to white space. A node that a manifest lists twice has the greatest of its digests.
    """
    known = [c for c in ("resource_type", "name", "adapter_type", "fqn", "tags", "path") if c in nodes.columns]
    sql = [c for c in ("compiled_code", "compiled_sql") if c in nodes.columns]
    content = F.to_json(F.struct(*known, *[normalize_sql(F.col(c)).alias(c) for c in sql]), {"ignoreNullFields": "false"})
    # the first 15 hex digits of each half fit into a long, so the aggregate stays a hash aggregate
    digest = F.sha2(content, 256)
    half = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("bigint")
    return nodes.groupBy(*KEY).agg(F.max(half(1)).alias("state_1"), F.max(half(33)).alias("state_2"))


def write_state(states: DataFrame, path: str) -> None:
    """Keeps the states of these runs; other runs in the folder stay."""
    states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*RUN).parquet(path)


def read_state(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    found = spark.read.parquet(path).select(*KEY, "state_1", "state_2")
    return found if run_id is None else found.where(F.col("run_id") == run_id)


def state_changes(current: DataFrame, earlier: DataFrame) -> DataFrame:
    """Per node of either side: added, removed, changed or same. The run is that of the current side,
    null for a removed node. Several earlier runs of a node: it is the same if one of them is."""
    states = ["state_1", "state_2"]
    now = current.select(*NODE, F.col("run_id").alias("now_run"), *[F.col(c).alias(f"now_{c}") for c in states], F.lit(True).alias("is_now"))
    before = earlier.select(*NODE, *states, F.lit(True).alias("was"))
    # a row for each pair of states, folded to one a node by plain flags: no task holds the states of a node as a set
    same = F.max(F.struct(*states).eqNullSafe(F.struct(*[F.col(f"now_{c}") for c in states])) & F.col("was").isNotNull())
    both = now.join(before, NODE, "full").groupBy(*NODE, "now_run", "now_state_1", "now_state_2", "is_now").agg(F.max("was").alias("was"), same.alias("same"))
    change = F.when(F.col("is_now").isNull(), "removed").when(F.col("was").isNull(), "added").when(F.col("same"), "same").otherwise("changed")
    return both.select("project", F.col("now_run").alias("run_id"), "node_id", change.alias("change"))


def state_modified(nodes: DataFrame, edges: DataFrame, earlier: DataFrame, downstream: bool = True) -> DataFrame:
    """Nodes that are new or changed against an earlier state, and those downstream of them or of removed
    nodes: ``reason`` is added, changed or downstream.

    ``edges``: (parent_id, child_id) of the current manifest, of whichever map. Removed nodes count as
    seeds in every run of their project, since children that still name them have lost a parent.
    """
    changes = state_changes(node_state(nodes), earlier)
    own = changes.where("change in ('added', 'changed')").select(*KEY, F.col("change").alias("reason"))
    if not downstream:
        return own
    runs = nodes.select(*RUN).distinct()
    removed = changes.where("change = 'removed'").select(*NODE).join(runs, "project").select(*KEY)
    reached = known_nodes_only(descendants(own.select(*KEY).unionByName(removed), edges), nodes)
    below = reached.select(*KEY).join(own.select(*KEY), KEY, "left_anti")
    return own.unionByName(below.withColumn("reason", F.lit("downstream")))
