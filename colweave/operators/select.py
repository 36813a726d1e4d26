"""Node selection, planning and guards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colweave import schemas as S
from colweave.functions.rules import (
    blank_to_null,
    resolve_dialect,
    skip_reason,
    skip_reason_with_sql,
)
from colweave.operators.graph import downward, known_nodes_only, reachable, upward
from colweave.session import KEY, RUN, cut_lineage


def match_tag(tag: str) -> Column:
    return F.coalesce(F.array_contains("tags", tag), F.lit(False))


def match_name_or_fqn(text: str) -> Column:
    """Name, full dotted name or its last part, in any case."""
    wanted = text.lower()
    candidates = [
        F.lower("name"),
        F.lower(F.array_join("fqn", ".")),
        F.lower(F.try_element_at("fqn", F.lit(-1))),
    ]
    by_fqn = F.coalesce(F.size("fqn") > 0, F.lit(False))
    return F.coalesce(candidates[0] == wanted, F.lit(False)) | (
        by_fqn & F.coalesce((candidates[1] == wanted) | (candidates[2] == wanted), F.lit(False))
    )


def _base(token: str) -> Column:
    body = token.strip("+")
    return match_tag(body[4:]) if body.startswith("tag:") else match_name_or_fqn(body)


def _any(tokens: list[str]) -> Column:
    return reduce(Column.__or__, [_base(t) for t in tokens], F.lit(False))


def match_tokens(nodes: DataFrame, tokens: dict[str, list[str]]) -> DataFrame:
    """Flag, in one pass over the nodes, what the tokens of each side match.

    Columns: side, node keys, and whether to walk to parents (``up``) or children (``down``).
    """
    rows = []
    for side, listed in tokens.items():
        clean = [t.strip() for t in listed if t.strip()]
        rows.append(
            F.struct(
                F.lit(side).alias("side"),
                _any(clean).alias("hit"),
                _any([t for t in clean if t.startswith("+")]).alias("up"),
                _any([t for t in clean if t.endswith("+")]).alias("down"),
            )
        )
    flagged = nodes.select(*KEY, F.explode(F.array(*rows)).alias("m"))
    return flagged.where("m.hit").select("m.side", *KEY, "m.up", "m.down")


def walk_tokens(matched: DataFrame, parent_edges: DataFrame, child_edges: DataFrame) -> DataFrame:
    """Matched nodes with the closures their ``+`` signs ask for: side and node keys, distinct.

    A closure of a union is the union of the closures, so all tokens of all sides share one loop,
    upward over the parent edges and downward over the child edges.
    """
    cols = ["side", *KEY]
    matched = cut_lineage(matched)
    directions = F.array_compact(
        F.array(F.when(F.col("up"), F.lit("up")), F.when(F.col("down"), F.lit("down")))
    )
    seeds = matched.select(*cols, F.explode(directions).alias("walk"))
    steps = upward(parent_edges).withColumn("walk", F.lit("up")).unionByName(
        downward(child_edges).withColumn("walk", F.lit("down"))
    )
    reached = reachable(seeds, steps, ["side"], ["walk"])
    return matched.select(*cols).unionByName(reached.select(*cols)).distinct()


def select_union(nodes: DataFrame, tokens: list[str]) -> DataFrame:
    """Nodes that some token matches; all nodes without tokens."""
    if not tokens:
        return nodes.select(*KEY)
    return match_tokens(nodes, {"select": tokens}).select(*KEY).distinct()


def select_exclude(selected: DataFrame, excluded: DataFrame) -> DataFrame:
    return selected.join(excluded.select(*KEY).distinct(), KEY, "left_anti")


def select_resource_type(nodes: DataFrame, resource_types: list[str]) -> DataFrame:
    wanted = [r.strip().lower() for r in resource_types]
    return nodes.where(F.lower(F.coalesce("resource_type", F.lit(""))).isin(*wanted))


def select_nodes(
    nodes: DataFrame,
    edges: DataFrame,
    select: list[str] | None = None,
    exclude: list[str] | None = None,
    resource_types: list[str] | None = None,
) -> DataFrame:
    """Selected node keys: union of ``select``, minus ``exclude``, of the resource types.

    Parents are walked over the parent map and children over the child map, which may differ.
    """
    ids = select_resource_type(nodes, resource_types) if resource_types else nodes
    tokens = {k: v for k, v in {"select": select, "exclude": exclude}.items() if v}
    if not tokens:
        return ids.select(*KEY)
    up = edges.where(F.col("origin") == "parent_map")
    down = edges.where(F.col("origin") == "child_map")
    matched = match_tokens(nodes, tokens)
    walks = any(t.strip().startswith("+") or t.strip().endswith("+") for v in tokens.values() for t in v)
    found = walk_tokens(matched, up, down) if walks else matched.select("side", *KEY)
    chosen = ids.select(*KEY)
    if select:
        chosen = known_nodes_only(found.where("side = 'select'").select(*KEY).distinct(), ids)
    if exclude:
        chosen = select_exclude(chosen, found.where("side = 'exclude'"))
    return chosen


# --- planning -------------------------------------------------------------------------------


def lineage_eligibility(nodes: DataFrame) -> DataFrame:
    reason = skip_reason(F.col("resource_type"))
    return nodes.withColumns({"eligible": reason.isNull(), "skip_reason": reason})


def eligibility_with_sql(nodes: DataFrame, override: str | None = None) -> DataFrame:
    """Add dialect, eligible and skip_reason from resource_type, sql and adapter_type."""
    forced = F.lit(override).cast("string")
    return (
        nodes.withColumn("dialect", resolve_dialect(F.col("adapter_type"), forced))
        .withColumn(
            "skip_reason",
            skip_reason_with_sql(
                F.col("resource_type"), F.col("sql"), F.col("adapter_type"), F.col("dialect")
            ),
        )
        .withColumn("eligible", F.col("skip_reason").isNull())
    )


def plan_report(nodes: DataFrame) -> DataFrame:
    """What a run would do with each node, from ``eligibility_with_sql``."""
    body = skip_reason(F.col("resource_type")).isNull()
    return nodes.select(
        *KEY,
        "name",
        "resource_type",
        "dialect",
        F.coalesce(blank_to_null(F.col("compiled_path")), F.col("path")).alias("sql_path"),
        "eligible",
        "skip_reason",
        F.when(body, F.coalesce(F.length("sql"), F.lit(0))).otherwise(0).cast("bigint").alias("chars"),
    )


def selection_size_guard(planned: DataFrame, mode: str, threshold: int = S.SIZE_GUARD) -> DataFrame:
    """Runs to refuse: more eligible nodes than ``threshold`` in the rate-limited mode."""
    per_run = planned.groupBy(*RUN).agg(F.count_if("eligible").alias("eligible_count"))
    limited = F.lit(mode == "anonymous")
    return per_run.where(limited & (F.col("eligible_count") > threshold)).withColumn(
        "threshold", F.lit(threshold).cast("bigint")
    )


def attach_downstream(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Distinct children of each node by the child map; a node without children has one null row."""
    children = (
        edges.where(F.col("origin") == "child_map")
        .select(*RUN, F.col("parent_id").alias("node_id"), "child_id")
    )
    return nodes.select(*KEY).join(children, KEY, "left")
