"""Closures that carry a value: real sources behind result sets at any depth, and tags along columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colweave import schemas as S
from colweave.functions.rules import is_synthetic_column, transform_code
from colweave.session import KEY, RUN, cut_lineage

COMPACT_EVERY = 8
#: What a path of several transforms amounts to: the strongest of them, in this order.
STRENGTH = ["direct", "expression", "aggregate", "control", "unknown"]


def strength(code: Column) -> Column:
    """Place in STRENGTH of a transform code."""
    return F.element_at(F.array(*[F.lit(STRENGTH.index(t)) for t in S.TRANSFORMS]), code + 1)


def strength_name(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(t) for t in STRENGTH]), rank.cast("int") + 1)


def least_paths(
    seeds: DataFrame, steps: DataFrame, labels: Sequence[str], at: Sequence[str], passes: Column | None = None, stay: Sequence[str] = (),
    cut: Callable[[DataFrame], DataFrame] = cut_lineage,
) -> DataFrame:
    """Every place that a label reaches, with the least ``depth`` and, among the paths of that length,
    the least ``rank``; the rank of a path is the greatest of its steps and its seed.

    ``seeds``: labels, at, rank; ``steps``: at, ``to_`` + at, step_rank and what ``passes`` needs, a condition
    on label and step. Seeds have depth 0 and are distinct but for their rank. ``stay``: columns of at that
    no step changes, so that steps need no ``to_`` for them. ``cut`` writes what a round starts from.

    A place is new to a label in one round only, and then its depth is settled: a shorter path would
    have come before, and all paths of this length are in the round. So each round joins only the newest
    places, distinct, and takes off those already seen; cycles end, and a hub is expanded once a label.
    Keys of joins and aggregates hold label and place, so a single large node is spread over all tasks.
    """
    keys = [*labels, *at]
    # sorts of the join go by one number instead of texts that begin alike
    place = F.xxhash64(*at).alias("_place")
    steps = cut(steps.select("*", place))
    frontier = cut(seeds.groupBy(*keys).agg(F.min("rank").alias("rank")).select(*keys, F.lit(0).alias("depth"), "rank"))
    seen, depth = [frontier], 0
    while True:
        depth += 1
        met = frontier.select("*", place).join(steps, ["_place", *at])
        if passes is not None:
            met = met.where(passes)
        to = [F.col(c) if c in stay else F.col(f"to_{c}").alias(c) for c in at]
        reached = met.select(*labels, *to, F.greatest("rank", "step_rank").alias("rank")).groupBy(*keys).agg(F.min("rank").alias("rank"))
        for known in seen:  # one after the other: a union would lose the layout of its parts
            reached = reached.join(known.select(*keys), keys, "left_anti")
        frontier = cut(reached.select(*keys, F.lit(depth).alias("depth"), "rank"))
        if frontier.isEmpty():
            return reduce(DataFrame.unionByName, seen)
        seen.append(frontier)
        if len(seen) > COMPACT_EVERY:
            seen = [cut(reduce(DataFrame.unionByName, seen))]


def trace_multi_hop(resolved: DataFrame, cut: Callable[[DataFrame], DataFrame] = cut_lineage) -> DataFrame:
    """Real sources of every target column, through result sets at any depth.

    ``resolved``: lines with target and source tables, see ``resolve_lines``. A path goes on where the
    source is a known table that is not real and stands as a target elsewhere in the node; it ends at a
    real source. ``depth`` is the least number of relationships (1: the source is real itself) and
    ``transform`` the strongest on the way, the weakest over all paths of that depth.

    The walk goes from the real sources back to the targets, so a place is only met with sources that it
    has: what is held are the rows of the result, and no ways that end nowhere.
    """
    place = ["parent_id", "col"]
    rank = strength(transform_code(F.col("rel_type")))
    lines = resolved.where(~is_synthetic_column(F.col("target_col")))
    named = lines.where((F.col("source_col") != "") & F.col("source_fqn").isNotNull()).select(
        *KEY, F.col("target_parent_id").alias("parent_id"), F.col("target_col").alias("col"), "source_parent_id", "source_col",
        "source_is_real", "up_table", "up_column", rank.alias("rank"),
    )
    steps = named.where("not source_is_real").groupBy(*KEY, "source_parent_id", "source_col", *place).agg(F.min("rank").alias("step_rank"))
    steps = steps.select(
        *KEY, F.col("source_parent_id").alias("parent_id"), F.col("source_col").alias("col"), "step_rank",
        *[F.col(k).alias(f"to_{k}") for k in place],
    )
    ends = named.where("source_is_real").select(*KEY, *place, "up_table", "up_column", "rank")
    found = least_paths(ends, steps, ["up_table", "up_column"], [*KEY, *place], stay=KEY, cut=cut)
    starts = lines.select(*KEY, F.col("target_parent_id").alias("parent_id"), "target_fqn", F.col("target_col").alias("col")).distinct()
    return found.join(starts, [*KEY, *place]).select(
        *KEY, F.col("parent_id").alias("target_parent_id"), "target_fqn", F.col("col").alias("target_col"), "up_table", "up_column",
        (F.col("depth") + 1).alias("depth"), strength_name(F.col("rank")).alias("transform"),
    )


def column_steps(nodes: DataFrame, columns: DataFrame, edges: DataFrame) -> DataFrame:
    """Steps between columns of tables over all nodes of a run: from an upstream column to the column of
    the table that the node builds (``nodes``: keys and fqn), with the column's transform."""
    named = edges.join(nodes.select(*KEY, "fqn"), KEY).join(columns.select(*KEY, F.col("name").alias("column"), "transform"), [*KEY, "column"])
    return named.select(
        *RUN, F.col("up_table").alias("src_table"), F.col("up_column").alias("src_column"),
        F.col("fqn").alias("dst_table"), F.col("column").alias("dst_column"), "transform",
    )


def propagate_tags(tags: DataFrame, steps: DataFrame, stops: Mapping[str, Sequence[str]] | None = None, stops_all: Sequence[str] = ("control",)) -> DataFrame:
    """Tags of columns, and of all columns that are computed from them.

    ``tags``: project, run_id, table, column, tag; ``steps``: project, run_id, src_table, src_column,
    dst_table, dst_column, transform. A tag does not pass a transform in ``stops_all``, nor one that
    ``stops`` names for it. A column has the union of its own tags and those that reach it, each once,
    with the least number of steps from a column that was tagged (``depth``; 0 for a tag of its own).
    """
    held = F.col("transform").isin(*stops_all)
    for tag, transforms in (stops or {}).items():
        held = held | ((F.col("tag") == tag) & F.col("transform").isin(*transforms))
    walk = steps.select(
        *RUN, F.col("src_table").alias("table"), F.col("src_column").alias("column"),
        *[F.col(k).alias(f"to_{k}") for k in RUN], F.col("dst_table").alias("to_table"), F.col("dst_column").alias("to_column"),
        "transform", F.lit(0).alias("step_rank"),
    ).distinct()
    found = least_paths(tags.withColumn("rank", F.lit(0)), walk, ["tag"], [*RUN, "table", "column"], ~F.coalesce(held, F.lit(False)))
    return found.select(*RUN, "table", "column", "tag", "depth")
