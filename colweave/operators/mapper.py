"""From relationships and tables to columns, edges, reasons and status of each node.

The input rows of ``lines`` are (relationship, source) pairs, see ``explode_relationships``.
All "first one wins" rules go by ``rel_ord``. The ordinal and the small transform code are packed
into one long, so "the transform of the first relationship" is a plain ``min`` over longs: it is
combined before the shuffle, stays in the hash aggregate and does not depend on arrival order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colweave import schemas as S
from colweave.functions.rules import (
    is_star_on_real,
    is_synthetic_column,
    transform_code,
    transform_name,
)
from colweave.functions.sqltext import dynamic_sql_marker, marker_excerpt
from colweave.session import KEY, held_names, join_numbered

CODE_BITS = 3  # room for one transform code below the ordinal


def _join_side(lines: DataFrame, tables: DataFrame, side: str, how: str) -> DataFrame:
    """``lines`` with name and reality of the table at one of their ends."""
    parent = f"{side}_parent_id"
    ends = tables.select(
        *KEY, F.col("table_id").alias(parent), F.col("fqn").alias(f"{side}_fqn"), F.col("is_real").alias(f"{side}_is_real")
    )
    return join_numbered(lines, ends, [*KEY, parent], how)


def drop_star_targets(joined: DataFrame) -> DataFrame:
    """No empty target column, and no ``*`` on a real table (on a result set it stays)."""
    return joined.where(
        (F.col("target_col") != "") & ~is_star_on_real(F.col("target_col"), F.col("target_is_real"))
    )


def join_relationship_targets(lines: DataFrame, tables: DataFrame) -> DataFrame:
    """Lines whose target table is known, with its name. Unknown targets drop out."""
    return _join_side(lines, tables, "target", "inner")


def join_relationship_sources(lines: DataFrame, tables: DataFrame) -> DataFrame:
    """Add the source table. A real source with a column is an edge; an unknown one never is."""
    joined = _join_side(lines, tables, "source", "left")
    is_edge = F.col("source_is_real") & (F.col("source_col") != "")
    return joined.withColumns(
        {
            "up_table": F.when(is_edge, F.col("source_fqn")),
            "up_column": F.when(is_edge, F.col("source_col")),
            "source_unknown": F.col("src_ord").isNotNull() & F.col("source_fqn").isNull(),
        }
    )


def resolve_lines(lines: DataFrame, tables: DataFrame) -> DataFrame:
    return join_relationship_sources(drop_star_targets(join_relationship_targets(lines, tables)), tables)


def group_edges(resolved: DataFrame) -> DataFrame:
    """Distinct upstream pairs of each (node, target name, target column), one row each.

    A group without any upstream keeps one row with nulls. This first aggregate spreads even a
    huge group over all tasks, because the upstream pair is part of its key.
    """
    code = transform_code(F.col("rel_type"))
    packed = F.shiftleft("rel_ord", CODE_BITS) + code
    return resolved.groupBy(*KEY, "target_fqn", "target_col", "up_table", "up_column").agg(
        F.min(packed).alias("first_any"),
        F.min(F.when(code != S.DIRECT, packed)).alias("first_other"),
    )


def _code(packed: str) -> Column:
    return F.col(packed).bitwiseAND(F.lit(2**CODE_BITS - 1))


def accumulate_target_columns(grouped: DataFrame) -> DataFrame:
    """One row per (node, target name, target column): transform, first type, upstream count."""
    out = grouped.groupBy(*KEY, "target_fqn", "target_col").agg(
        F.min("first_any").alias("first_any"),
        F.min("first_other").alias("first_other"),
        F.count("up_table").alias("n_upstream"),
    )
    return out.withColumns(
        {
            "first_ord": F.shiftright("first_any", CODE_BITS),
            "transform_code": F.coalesce(_code("first_other"), F.lit(S.DIRECT)).cast("int"),
            "first_is_value": _code("first_any") != S.CONTROL,
        }
    ).withColumn("transform", transform_name(F.col("transform_code"))).drop("first_any", "first_other")


def column_confidence(groups: DataFrame) -> DataFrame:
    """Medium if the first relationship is control, else high with an upstream, else low."""
    rank = (
        F.when(~F.col("first_is_value"), 1).when(F.col("n_upstream") > 0, 0).otherwise(2)
    )
    return groups.withColumn("confidence_code", rank).withColumn(
        "confidence", F.element_at(F.array(*[F.lit(c) for c in S.CONFIDENCES]), F.col("confidence_code") + 1)
    )


def merge_columns_by_name(groups: DataFrame) -> DataFrame:
    """One row per (node, column name). Upstreams unite, the earliest group gives the rest.

    So a column may be of low confidence and still have upstreams. Helper columns of the parser
    drop out after the merge.
    """
    # ordinal, 3 bits of transform and 2 of confidence in one long
    packed = F.shiftleft("first_ord", 5) + F.col("transform_code") * 4 + F.col("confidence_code")
    merged = groups.groupBy(*KEY, F.col("target_col").alias("name")).agg(
        F.min(packed).alias("first"), F.max(F.col("n_upstream") > 0).alias("has_upstream")
    )
    names = F.array(*[F.lit(c) for c in S.CONFIDENCES])
    return merged.where(~is_synthetic_column(F.col("name"))).select(
        *KEY,
        "name",
        transform_name(F.shiftright("first", 2).bitwiseAND(F.lit(7))).alias("transform"),
        F.element_at(names, F.col("first").bitwiseAND(F.lit(3)).cast("int") + 1).alias("confidence"),
        "has_upstream",
    )


def lineage_columns(grouped: DataFrame) -> DataFrame:
    return merge_columns_by_name(column_confidence(accumulate_target_columns(grouped)))


def lineage_edges(grouped: DataFrame) -> DataFrame:
    """Distinct (node, column, upstream table, upstream column); only real, known sources."""
    return (
        grouped.where(F.col("up_table").isNotNull() & ~is_synthetic_column(F.col("target_col")))
        .select(*KEY, F.col("target_col").alias("column"), "up_table", "up_column")
        .distinct()
    )


def upstream_tables(tables: DataFrame) -> DataFrame:
    """Distinct real tables of a node, write targets included."""
    return tables.where("is_real").select(*KEY, "fqn").distinct()


def union_counts(parts: list[DataFrame], names: list[str], keys: list[str] = KEY) -> DataFrame:
    """Sum count columns of several tables per key in one shuffle, without any outer join. Tables that share a
    layout are not shuffled."""
    held = held_names(keys)
    padded = [
        p.select(*[F.col(k).alias(h) for k, h in held.items()], *[(F.col(n) if n in p.columns else F.lit(0)).cast("bigint").alias(n) for n in names])
        for p in parts
    ]
    rows = reduce(DataFrame.unionByName, padded).groupBy(*held.values()).agg(*[F.sum(n).alias(n) for n in names])
    return rows.withColumnsRenamed({h: k for k, h in held.items()})


def node_status(responses: DataFrame, columns: DataFrame, tables: DataFrame) -> DataFrame:
    """Status and confidence of every answered node, also of those without columns and tables."""
    counts = union_counts(
        [
            responses.select(*KEY),
            columns.select(*KEY, F.lit(1).alias("total_columns"), F.col("has_upstream").cast("int").alias("resolved_columns")),
            tables.where("is_real").select(*KEY, F.lit(1).alias("real_tables")),
        ],
        ["total_columns", "resolved_columns", "real_tables"],
    )
    empty = (F.col("total_columns") == 0) & (F.col("real_tables") == 0)
    resolved = F.col("resolved_columns") > 0
    status = F.when(empty, "unsupported").when(resolved, "parsed").otherwise("partial")
    confidence = (
        F.when(resolved & (F.col("resolved_columns") == F.col("total_columns")), "high")
        .when(resolved, "medium")
        .otherwise("low")
    )
    return counts.select(
        *KEY, status.alias("status"), confidence.alias("confidence"), "total_columns", "resolved_columns"
    )


def compute_node_confidence(columns: DataFrame, nodes: DataFrame) -> DataFrame:
    """High if every column is resolved, medium if some, low if none or no columns."""
    counts = union_counts(
        [
            nodes.select(*KEY),
            columns.select(*KEY, F.lit(1).alias("total"), F.col("has_upstream").cast("int").alias("resolved")),
        ],
        ["total", "resolved"],
    )
    return counts.select(
        *KEY,
        F.when((F.col("total") > 0) & (F.col("resolved") == F.col("total")), "high")
        .when(F.col("resolved") > 0, "medium")
        .otherwise("low")
        .alias("confidence"),
    )


# --- reasons --------------------------------------------------------------------------------


def orphan_index(diagnostics: DataFrame) -> DataFrame:
    """Ordinal of the first orphan diagnostic of each key. Each one is filed under its exact and upper
    name."""
    keyed = diagnostics.where(F.col("category") == "orphan_column").select(
        *KEY, F.explode(F.array_distinct(F.array(F.col("near_column"), F.upper("near_column")))).alias("near"), "err_ord"
    )
    return keyed.groupBy(*KEY, "near").agg(F.min("err_ord").alias("err_ord"))


def attach_orphan_reason(columns: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """Reason of each column without upstream: its exact name first, then its upper-cased one.

    Columns ask for both names in one join, ordinals are compared as longs, and the texts come last, by
    ordinal.
    """
    open_columns = columns.where(~F.col("has_upstream")).select(*KEY, "name")
    asked = open_columns.select(*KEY, "name", F.posexplode(F.array(F.col("name"), F.upper("name"))).alias("way", "near"))
    met = join_numbered(asked, orphan_index(diagnostics), [*KEY, "near"], "left").groupBy(*KEY, "name").agg(
        F.min(F.when(F.col("way") == 0, F.col("err_ord"))).alias("exact"), F.min("err_ord").alias("any")
    )
    first = met.select(*KEY, "name", F.coalesce("exact", "any").alias("err_ord"))
    texts = diagnostics.where(F.col("category") == "orphan_column").select(*KEY, "err_ord", "line", "col", "message")
    return join_numbered(first, texts, [*KEY, "err_ord"], "left").select(
        *KEY,
        "name",
        F.when(F.col("err_ord").isNotNull(), "parser_orphan_column").otherwise("upstream_unresolved").alias("reason"),
        "line",
        "col",
        F.col("message").alias("parser_message"),
    )


UNRESOLVED = {
    "section": "int",
    "ord": "bigint",
    "src_ord": "bigint",
    "reason": "string",
    "target_column": "string",
    "rel_type": "string",
    "source_parent_id": "string",
    "line": "bigint",
    "col": "bigint",
    "parser_message": "string",
    "marker": "string",
    "fragment_preview": "string",
    "detail": "string",
}


def reason_rows(df: DataFrame, section: int, **given: Column) -> DataFrame:
    """Reasons in the common shape; fields that are not given are null."""
    given["section"] = F.lit(section)
    return df.select(
        *KEY, *[given.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in UNRESOLVED.items()]
    )


def unknown_source_rows(resolved: DataFrame) -> DataFrame:
    c = F.col
    return reason_rows(
        resolved.where("source_unknown"), 1,
        ord=c("rel_ord"), src_ord=c("src_ord"), reason=F.lit("source_table_unknown"),
        target_column=c("target_col"), rel_type=c("rel_type"), source_parent_id=c("source_parent_id"),
    )


def unresolved_rows(
    resolved: DataFrame, columns: DataFrame, diagnostics: DataFrame, sqls: DataFrame | None = None
) -> DataFrame:
    """All reasons of a node.

    Their order is (section, ord, src_ord, target_column): unknown sources by relationship,
    columns without upstream by name, other diagnostics by position, then dynamic SQL. The order
    is kept as columns, not as a running number, so no node has to pass through a single task.
    """
    c = F.col
    orphans = attach_orphan_reason(columns, diagnostics)
    parts = [
        unknown_source_rows(resolved),
        reason_rows(
            orphans, 2, reason=c("reason"), target_column=c("name"),
            line=c("line"), col=c("col"), parser_message=c("parser_message"),
        ),
        reason_rows(
            diagnostics.where(c("category").isNull()), 3, ord=c("err_ord"),
            reason=F.lit("parser_syntax_hint"), line=c("line"), col=c("col"), parser_message=c("message"),
        ),
    ]
    if sqls is not None:
        parts.append(dynamic_sql_rows(sqls))
    return reduce(DataFrame.unionByName, parts)


def dynamic_sql_rows(sqls: DataFrame) -> DataFrame:
    """One reason per node whose SQL text holds a dynamic-SQL marker."""
    marked = sqls.withColumn("marker", dynamic_sql_marker(F.col("sql"))).where("marker is not null")
    return reason_rows(
        marked, 4, reason=F.lit("dynamic_sql"), marker=F.col("marker"),
        fragment_preview=marker_excerpt(F.col("sql")),
    )


def apply_dynamic_sql(statuses: DataFrame, sqls: DataFrame) -> DataFrame:
    """Dynamic SQL caps the confidence at low and turns parsed into partial."""
    marked = sqls.select(*KEY, dynamic_sql_marker(F.col("sql")).alias("marker")).where("marker is not null")
    hit = F.col("marker").isNotNull()
    return (
        statuses.join(marked, KEY, "left")
        .withColumn("confidence", F.when(hit, "low").otherwise(F.col("confidence")))
        .withColumn("status", F.when(hit & (F.col("status") == "parsed"), "partial").otherwise(F.col("status")))
        .drop("marker")
    )
