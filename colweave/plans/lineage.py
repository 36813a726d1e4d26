"""The four jobs: plan, map, check and diff, composed from the operators."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave import schemas as S
from colweave.operators import emit, evidence, mapper, quality
from colweave.operators.cache import one_per_key, prepare_sql
from colweave.operators.compare import diff_headline, diff_report, edge_count_regressions, edge_counts
from colweave.operators.select import eligibility_with_sql, select_nodes
from colweave.session import KEY, RUN, cut_lineage
from colweave.sources import responses as R
from colweave.sources.documents import LineageTables
from colweave.sources.manifests import Manifests, resolve_compiled_sql


class Lineage(NamedTuple):
    nodes: DataFrame
    columns: DataFrame
    edges: DataFrame
    tables: DataFrame
    unresolved: DataFrame
    diagnostics: DataFrame
    writes: DataFrame


def plan_run(
    manifests: Manifests,
    files: DataFrame,
    target_dir: str,
    mode: str,
    tool_version: str,
    parser_version: str = "unknown",
    dialect: str | None = None,
    select: list[str] | None = None,
    exclude: list[str] | None = None,
    resource_types: list[str] | None = None,
    redact: bool = False,
) -> DataFrame:
    """Selected nodes of all projects with SQL, dialect, eligibility and cache key."""
    chosen = select_nodes(manifests.nodes, manifests.edges, select, exclude, resource_types)
    nodes = manifests.nodes.join(chosen, KEY, "left_semi")
    adapters = manifests.meta.groupBy(*RUN).agg(F.max("adapter_type").alias("adapter_type"))
    with_sql = resolve_compiled_sql(nodes.join(adapters, RUN, "left"), files, target_dir)
    planned = prepare_sql(eligibility_with_sql(with_sql, dialect), mode, parser_version, tool_version, redact)
    return cut_lineage(planned)


def map_run(planned: DataFrame, answers: DataFrame) -> Lineage:
    """Lineage of every planned node. ``answers``: cache_key, payload, http_status, code, detail, mode.

    Answers join by content, so one answer serves all nodes with the same SQL. Nodes that are not
    eligible are skipped and those without a good answer failed; both stay in the result.

    What several steps use is written once: the parsed payloads (as variants, so the JSON is read
    a single time), the tables, the resolved lines and the grouped edges.
    """
    answered = R.classify_responses(
        planned.where("eligible").join(one_per_key(answers), "cache_key", "left")
    )
    good = answered.where("outcome = 'ok' and payload is not null")
    flows = cut_lineage(R.normalize_responses(good).select(*KEY, "flow"))
    tables = cut_lineage(R.explode_dbobjs(flows))
    lines = R.explode_relationships(flows)
    diagnostics = cut_lineage(R.explode_diagnostics(flows))
    resolved = cut_lineage(mapper.resolve_lines(lines, tables))
    grouped = cut_lineage(mapper.group_edges(resolved))
    columns = mapper.lineage_columns(grouped)
    edges = mapper.lineage_edges(grouped)
    status = mapper.node_status(good, columns, tables)
    sqls = good.select(*KEY, "sql")
    capped = mapper.apply_dynamic_sql(status, sqls).join(good.select(*KEY, "dialect"), KEY)

    def stopped(df: DataFrame, status: str) -> DataFrame:
        return df.select(
            *KEY, F.lit(status).alias("status"), F.lit("low").alias("confidence"),
            F.lit(0).cast("bigint").alias("total_columns"), F.lit(0).cast("bigint").alias("resolved_columns"), "dialect",
        )

    bad = answered.where("outcome <> 'ok' or payload is null")
    skipped = planned.where(~F.col("eligible"))
    nodes = capped.unionByName(stopped(bad, "failed")).unionByName(stopped(skipped, "skipped"))
    unresolved = (
        mapper.unresolved_rows(resolved, columns, diagnostics, sqls)
        .unionByName(mapper.reason_rows(bad, 5, reason=F.coalesce("reason", F.lit("parser_error")), detail=F.col("detail")))
        .unionByName(mapper.reason_rows(skipped, 5, reason=F.lit("skipped"), detail=F.col("skip_reason")))
    )
    writes = evidence.procedural_write_targets(resolved, tables, R.process_counts(flows))
    return Lineage(nodes, columns, edges, mapper.upstream_tables(tables), unresolved, diagnostics, writes)


def _rendered(
    lineage: Lineage, children: DataFrame, meta: DataFrame, generator: str, backend: Mapping[str, str], cache_stats: DataFrame | None
) -> tuple[DataFrame, DataFrame]:
    docs = emit.render_lineage_doc(
        lineage.nodes, lineage.columns, lineage.edges, lineage.tables, children,
        lineage.unresolved, lineage.diagnostics, lineage.writes,
    )
    stats = quality.run_stats(lineage.nodes)
    described = stats.select(*RUN, "eligible_count", F.expr("parsed+partial+unsupported+failed+skipped").alias("selected_count"))
    full_meta = meta.join(described, RUN)
    return docs, emit.document_headers(stats.drop("eligible_count"), full_meta, generator, "0.2.x", backend, cache_stats=cache_stats)


def render_run(
    lineage: Lineage, children: DataFrame, meta: DataFrame, generator: str, backend: Mapping[str, str], cache_stats: DataFrame | None = None
) -> DataFrame:
    """Lines of one document per run. ``children``: keys and child_id of ``attach_downstream``."""
    docs, headers = _rendered(lineage, children, meta, generator, backend, cache_stats)
    return emit.document_lines(cut_lineage(docs), headers)  # read twice there


def render_table(
    lineage: Lineage, children: DataFrame, meta: DataFrame, generator: str, backend: Mapping[str, str], cache_stats: DataFrame | None = None
) -> DataFrame:
    """Rows of a document table, one document per node."""
    docs, headers = _rendered(lineage, children, meta, generator, backend, cache_stats)
    return emit.document_rows(cut_lineage(docs), cut_lineage(headers))  # read twice there


def document_stats(doc: LineageTables) -> DataFrame:
    """Run statistics of documents that were read back: those that they state, or counted from their
    nodes where there are no headers."""
    if doc.headers is not None:
        zero = lambda c, name: F.coalesce(F.col(c), F.lit(0)).alias(name)
        counts = [zero(f"stats.{s}", s) for s in (*S.STATUSES, "total_columns", "resolved_columns")]
        return doc.headers.select(*RUN, *counts, zero("manifest_metadata.eligible_count", "eligible_count"), F.col("stats.coverage").alias("coverage"))
    per_node = mapper.union_counts(
        [
            doc.nodes.select(*KEY),
            doc.columns.select(*KEY, F.lit(1).alias("total_columns")),
            doc.edges.select(*KEY, "column").distinct().select(*KEY, F.lit(1).alias("resolved_columns")),
        ],
        ["total_columns", "resolved_columns"],
    )
    return quality.run_stats(doc.nodes.join(per_node, KEY))


def _counts(doc: LineageTables) -> DataFrame:
    return edge_counts(doc.nodes, doc.edges)


def check_documents(current: LineageTables, baseline: LineageTables | None = None, **gates) -> DataFrame:
    """All gates over documents; one verdict row per failure, or one OK row per run."""
    counts = (_counts(current), _counts(baseline)) if baseline is not None else None
    return quality.check_run(document_stats(current), current.nodes, counts=counts, **gates)


def diff_documents(current: LineageTables, baseline: LineageTables) -> tuple[DataFrame, DataFrame]:
    """Headline per run, and the regressions as text and JSON."""
    lost = edge_count_regressions(_counts(current), _counts(baseline))
    return diff_headline(current.nodes, lost), diff_report(lost)
