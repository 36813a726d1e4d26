"""Closure over model edges by semi-naive rounds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave.session import RUN, cut_lineage

COMPACT_EVERY = 8


def reachable(seeds: DataFrame, steps: DataFrame, labels: list[str], walks: list[str] | None = None) -> DataFrame:
    """Nodes reachable from each seed set in one step or more.

    ``seeds``: labels, walks, project, run_id, node_id; ``steps``: walks, project, run_id, src,
    dst. A label names a seed set and a walk a set of steps, so several closures share one loop.
    A seed is in the result only if a path leads back to it.

    Each round joins only the newest nodes, distinct, and takes off those already seen, so cycles
    end and a hub is expanded once. Steps and rounds are written to the shared folder: a round
    never recomputes an earlier one, and a small frontier is known to be small, so the steps are
    not shuffled for it. The number of rounds is the depth of the graph.
    """
    walks = walks or []
    at = [*walks, *RUN, "node_id"]
    keys = [*labels, *at]
    steps = cut_lineage(steps.select(*walks, *RUN, F.col("src").alias("node_id"), "dst").distinct())
    frontier = seeds.select(*keys).distinct()
    seen: list[DataFrame] = []
    while True:
        reached = frontier.join(steps, at).select(*labels, *walks, *RUN, F.col("dst").alias("node_id")).distinct()
        if seen:
            reached = reached.join(reduce(DataFrame.unionByName, seen), keys, "left_anti")
        frontier = cut_lineage(reached)
        if frontier.isEmpty():
            break
        seen.append(frontier)
        if len(seen) >= COMPACT_EVERY:
            seen = [cut_lineage(reduce(DataFrame.unionByName, seen))]
    return reduce(DataFrame.unionByName, seen) if seen else frontier


def upward(edges: DataFrame) -> DataFrame:
    return edges.select(*RUN, F.col("child_id").alias("src"), F.col("parent_id").alias("dst"))


def downward(edges: DataFrame) -> DataFrame:
    return edges.select(*RUN, F.col("parent_id").alias("src"), F.col("child_id").alias("dst"))


def ancestors(seeds: DataFrame, edges: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """All nodes upstream of the seeds along (parent_id, child_id) edges."""
    return reachable(seeds, upward(edges), labels or [])


def descendants(seeds: DataFrame, edges: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """All nodes downstream of the seeds."""
    return reachable(seeds, downward(edges), labels or [])


def known_nodes_only(reached: DataFrame, nodes: DataFrame) -> DataFrame:
    """Drop reached ids that are no nodes, such as sources."""
    return reached.join(nodes.select(*RUN, "node_id").distinct(), [*RUN, "node_id"], "left_semi")
