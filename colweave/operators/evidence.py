"""Evidence of scripts that write several targets: per target its sources and column edges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave import schemas as S
from colweave.functions.rules import is_synthetic_column
from colweave.operators.mapper import union_counts
from colweave.session import KEY, cut_lineage, held_names

EDGE = ["target_fqn", "target_col", "up_table", "up_column"]


def _value_lines(resolved: DataFrame) -> DataFrame:
    return resolved.where((F.lower("rel_type") == S.VALUE_TYPE) & F.col("src_ord").isNotNull())


def resolve_one_hop(resolved: DataFrame) -> DataFrame:
    """Edges into real targets whose source is a result set, followed one hop to a real source.

    ``resolved``: lines with target and source tables, see ``resolve_lines``. Both sides are reduced to
    distinct pairs before the equi-join, so repeated relationships of one result-set column do not
    multiply; each output row is an edge of the result.
    """
    return hop_edges(write_lines(resolved), real_inputs(resolved))


def write_lines(resolved: DataFrame) -> DataFrame:
    """Value lines into a real, named, non-synthetic target column with a known source."""
    col = F.col("target_col")
    return _value_lines(resolved).where(
        F.col("target_is_real") & (col != "") & (col != "*") & ~is_synthetic_column(col)
        & ~F.col("source_unknown") & (F.col("source_col") != "")
    )


def real_inputs(resolved: DataFrame) -> DataFrame:
    """Distinct real sources of each (parent, column). A parent that is no known table is the source of
    no write, so lines with a known target are all that matter."""
    found = _value_lines(resolved).where("up_table is not null")
    return found.select(
        *KEY,
        F.col("target_parent_id").alias("source_parent_id"),
        F.col("target_col").alias("source_col"),
        "up_table",
        "up_column",
    ).distinct()


def hop_edges(writes: DataFrame, inputs: DataFrame) -> DataFrame:
    through = (
        writes.where(~F.col("source_is_real"))
        .groupBy(*KEY, "target_parent_id", "target_fqn", "target_col", "source_parent_id", "source_col")
        .agg(F.max("rel_ord").alias("rel_ord"))
    )
    return through.join(inputs, [*KEY, "source_parent_id", "source_col"]).select(
        *KEY, "target_parent_id", *EDGE, "rel_ord"
    )


def write_edges(resolved: DataFrame) -> DataFrame:
    """Distinct edges of each write target, direct or over one result set, with the last ordinal."""
    writes = write_lines(resolved)
    direct = writes.where("source_is_real").select(*KEY, "target_parent_id", *EDGE, "rel_ord")
    held = held_names(KEY)
    both = direct.withColumnsRenamed(held).unionByName(hop_edges(writes, real_inputs(resolved)).withColumnsRenamed(held))
    last = both.groupBy(*held.values(), "target_parent_id", *EDGE).agg(F.max("rel_ord").alias("rel_ord"))
    return last.withColumnsRenamed({h: c for c, h in held.items()})


def attach_write_subtype(edges: DataFrame, tables: DataFrame) -> DataFrame:
    """Sub-type of each write target by name: the table of its last relationship, nulls included."""
    last = edges.groupBy(*KEY, "target_parent_id", "target_fqn").agg(F.max("rel_ord").alias("rel_ord"))
    typed = last.join(
        tables.select(*KEY, F.col("table_id").alias("target_parent_id"), "sub_type"),
        [*KEY, "target_parent_id"],
    )
    return typed.groupBy(*KEY, "target_fqn").agg(
        F.max(F.struct("rel_ord", "target_parent_id", "sub_type"))["sub_type"].alias("sub_type")
    )


def evidence_counts(edges: DataFrame, processes: DataFrame) -> DataFrame:
    """Nodes with evidence: some target, and two targets or two processes."""
    per_target = edges.select(*KEY, *EDGE).distinct().groupBy(*KEY, "target_fqn").count()
    per_node = per_target.groupBy(*KEY).agg(
        F.count("*").alias("write_target_count"), F.sum("count").alias("column_edge_count")
    )
    counted = per_node.join(processes.select(*KEY, "process_count"), KEY, "left").withColumn(
        "process_count", F.coalesce("process_count", F.lit(0)).cast("bigint")
    )
    return counted.where("write_target_count >= 2 or process_count >= 2")


def procedural_write_targets(
    resolved: DataFrame, tables: DataFrame, processes: DataFrame, cut: Callable[[DataFrame], DataFrame] = cut_lineage
) -> DataFrame:
    """One row per edge of each write target, for nodes that count as procedural.

    The edges, far fewer than the lines, are written once by ``cut``: counts, sub-types and result all
    start from them.
    """
    edges = cut(write_edges(resolved))
    kept = edges.select(*KEY, *EDGE).distinct().join(evidence_counts(edges, processes), KEY)
    return kept.join(attach_write_subtype(edges, tables), [*KEY, "target_fqn"])


def split_reads_writes(resolved: DataFrame, tables: DataFrame) -> DataFrame:
    """Real tables of a node with their ``role``: a table that value lines go into is written, one that
    some line comes from is read, and one that is listed without either is read too."""
    one = F.lit(1)
    counts = union_counts(
        [
            tables.where("is_real").select(*KEY, "fqn"),
            write_lines(resolved).select(*KEY, F.col("target_fqn").alias("fqn"), one.alias("writes")),
            resolved.where("source_is_real").select(*KEY, F.col("source_fqn").alias("fqn"), one.alias("reads")),
        ],
        ["reads", "writes"],
        [*KEY, "fqn"],
    )
    role = F.when(F.col("writes") == 0, "read").when(F.col("reads") == 0, "write").otherwise("read_write")
    return counts.select(*KEY, "fqn", role.alias("role"))
