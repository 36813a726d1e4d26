"""Lineage documents and catalog payloads.

A payload belongs to one node and has one form whatever the node's size. All items of a node come
from one parser answer and one manifest entry, so a payload is bounded by those rows. The flat
tables (edges, columns, unresolved) are the form for analysis.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colweave import schemas as S
from colweave.functions.rules import (
    dataset_urn,
    dialect_platform,
    schema_field_urn,
    service_fqn,
    service_name,
)
from colweave.session import KEY, RUN, held_names, join_numbered, numbered


def emit_status_filter(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("status").isin(*S.EMITTED_STATUSES))


def _sorted(c: Column) -> Column:
    return F.sort_array(c)


def _edge_items(columns: DataFrame, edges: DataFrame) -> DataFrame:
    """One row per column and upstream; a column without upstream has one row with null ``u``."""
    ups = edges.select(
        *KEY, F.col("column").alias("name"),
        F.struct(F.col("up_table").alias("table"), F.col("up_column").alias("column")).alias("u"),
    )
    return join_numbered(columns, ups, [*KEY, "name"], "left").select(
        *KEY, F.struct("name", "transform", "confidence").alias("c"), "u"
    )


REASON = ["reason", "target_column", "rel_type", "source_parent_id", "line", "col", "parser_message", "marker", "fragment_preview", "detail"]
WRITE = "struct<target_fqn:string,target_col:string,up_table:string,up_column:string,sub_type:string>"
DIAGNOSTIC = "struct<err_ord:bigint,type:string,category:string,near_column:string,line:bigint,col:bigint,message:string>"
REASON_TYPES = "struct<section:int,ord:bigint,src_ord:bigint,target_column:string,rel_type:string,source_parent_id:string,reason:string,line:bigint,col:bigint,parser_message:string,marker:string,fragment_preview:string,detail:string>"


def render_lineage_doc(
    nodes: DataFrame,
    columns: DataFrame,
    edges: DataFrame,
    tables: DataFrame,
    downstream: DataFrame,
    unresolved: DataFrame,
    diagnostics: DataFrame | None = None,
    writes: DataFrame | None = None,
    detail_chars: int = 200,
) -> DataFrame:
    """One JSON document per node: keys A to Z, arrays in a fixed order.

    Columns go by name, upstreams by (table, column), tables and children by name, reasons in
    the order of ``unresolved_rows``. Evidence appears only for nodes that have some; ``writes`` are rows
    of ``procedural_write_targets``.
    """
    order = ["section", "ord", "src_ord", "target_column", "rel_type", "source_parent_id", "reason", "line", "col", "parser_message", "marker", "fragment_preview", "detail"]
    diagnostic = ["err_ord", "type", "category", "near_column", "line", "col", "message"]
    edge = ["target_fqn", "target_col", "up_table", "up_column", "sub_type"]

    def items(df: DataFrame, **given: Column) -> DataFrame:
        ((name, item),) = given.items()
        return df.select(*[F.col(c).alias(h) for c, h in held.items()], item.alias(name), *([] if name != "wts" else ["p"]))

    # all kinds of items come together by node in one union and one aggregate, which lets items dealt by node stay where they are
    held = held_names(KEY)
    per_column = numbered(_edge_items(columns, edges), [*KEY, "c.name"]).groupBy("_number", *KEY, "c").agg(_sorted(F.collect_list("u")).alias("us"))
    column = F.struct(F.col("c.name").alias("name"), F.col("c.confidence").alias("confidence"), F.col("c.transform").alias("transform"), "us")
    parts = [
        items(per_column, cs=column),
        items(tables, ts=F.col("fqn")),
        items(downstream, ds=F.col("child_id")),
        items(unresolved, rs=F.struct(*order).cast(REASON_TYPES)),
    ]
    if diagnostics is not None:
        parts.append(items(diagnostics, gs=F.struct(*diagnostic)))
    if writes is not None:
        per_target = writes.select(*KEY, F.struct(*edge).cast(WRITE).alias("w"), F.col("process_count").cast("bigint").alias("p"))
        per_target = per_target.groupBy(*KEY, F.col("w.target_fqn").alias("table"), F.col("w.sub_type").alias("sub_type")).agg(
            _sorted(F.collect_list("w")).alias("edges"), F.max("p").alias("p")
        )
        parts.append(items(per_target, wts=F.when(F.col("table").isNotNull(), F.struct("table", "sub_type", "edges"))))
    rows = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
    lists = [c for c in rows.columns if c not in (*held.values(), "p")]
    got = numbered(rows, list(held.values())).groupBy("_number", *held.values()).agg(*[_sorted(F.collect_list(c)).alias(c) for c in lists], *([] if writes is None else [F.max("p").alias("p")]))
    listed_of = got.withColumnsRenamed({h: c for c, h in held.items()})
    joined = numbered(nodes.select(*KEY, "status", "confidence", "dialect"), KEY).join(listed_of, ["_number", *KEY], "left")
    if diagnostics is None:
        joined = joined.withColumn("gs", F.lit(None).cast(f"array<{DIAGNOSTIC}>"))
    if writes is None:
        joined = joined.withColumns({"wts": F.lit(None).cast(f"array<struct<table:string,sub_type:string,edges:array<{WRITE}>>>"), "p": F.lit(None).cast("bigint")})
    none = F.array()

    def listed(name: str, shape) -> Column:
        return F.coalesce(F.transform(F.col(name), shape), none)

    def pair(u: Column) -> Column:
        return F.struct(u["column"].alias("column"), u["table"].alias("table"))

    def reason(r: Column) -> Column:
        """A reason as it is, but for the parser's error text, of which a document has the start."""
        return F.struct(*[(F.left(r[f], F.lit(detail_chars)) if f == "detail" else r[f]).alias(f) for f in sorted(REASON)])

    def write_target(w: Column) -> Column:
        return F.struct(
            F.array_distinct(F.transform(w["edges"], lambda e: e["target_col"])).alias("columns"),
            F.transform(
                w["edges"],
                lambda e: F.struct(
                    F.struct(e["up_column"].alias("column"), e["up_table"].alias("table")).alias("from"),
                    e["target_col"].alias("target_column"),
                ),
            ).alias("edges"),
            _sorted(F.array_distinct(F.transform(w["edges"], lambda e: e["up_table"]))).alias("from"),
            F.nullif(w["sub_type"], F.lit("")).alias("subType"),
            w["table"].alias("table"),
        )

    diagnostics_json = F.when(
        F.size("gs") > 0,
        F.transform("gs", lambda g: F.struct(*[g[f].alias(f) for f in ("category", "col", "line", "message", "near_column", "type")])),
    )
    procedural = F.when(
        F.size("wts") > 0,
        F.struct(
            F.aggregate("wts", F.lit(0).cast("bigint"), lambda n, w: n + F.size(w["edges"])).alias("column_edge_count"),
            F.col("p").alias("process_count"),
            F.size("wts").alias("write_target_count"),
            F.transform("wts", write_target).alias("write_targets"),
        ),
    )
    evidence = F.when(
        (F.size("gs") > 0) | (F.size("wts") > 0),
        F.struct(diagnostics_json.alias("parser_diagnostics"), procedural.alias("procedural")),
    )
    doc = F.struct(
        listed(
            "cs",
            lambda c: F.struct(
                c["confidence"].alias("confidence"), c["name"].alias("name"), c["transform"].alias("transform"),
                F.transform(c["us"], pair).alias("upstream"),
            ),
        ).alias("columns"),
        "confidence",
        "dialect",
        listed("ds", lambda d: d).alias("downstream"),
        evidence.alias("evidence"),
        "node_id",
        "status",
        listed("rs", reason).alias("unresolved"),
        listed("ts", lambda t: t).alias("upstream_tables"),
        F.array().cast("array<string>").alias("warnings"),
    )
    return joined.select(*KEY, F.to_json(doc).alias("doc"))


def document_lines(docs: DataFrame, headers: DataFrame) -> DataFrame:
    """Lines that, in order, make up one JSON document per run.

    ``headers`` has one row per run: ``head`` (JSON members that sort before ``nodes``) and
    ``tail`` (those after). Order: project, run_id, section, node_id. ``docs`` are read twice. They meet the
    first of their run by the whole key, so no run has to come together.
    """
    known = docs.dropna(subset=RUN)
    first = known.groupBy(*RUN).agg(F.min("node_id").alias("node_id")).withColumn("comma", F.lit(""))
    body = known.join(first, KEY, "left").select(
        *RUN, F.lit(1).alias("section"), "node_id", F.concat(F.coalesce("comma", F.lit(",")), "doc").alias("line")
    )

    def edge(section: int, text: Column) -> DataFrame:
        return headers.select(*RUN, F.lit(section).alias("section"), F.lit("").alias("node_id"), text.alias("line"))

    head = edge(0, F.concat(F.lit("{"), "head", F.lit(',"nodes":[')))
    tail = edge(2, F.concat(F.lit("],"), "tail", F.lit("}")))
    return head.unionByName(body).unionByName(tail)


def document_headers(
    stats: DataFrame, meta: DataFrame, generator: str, schema_version: str, backend: Mapping[str, str],
    generated_at: Column | None = None, cache_stats: DataFrame | None = None,
) -> DataFrame:
    """Header and trailer of each run's document. ``generated_at`` only if it need not be repeatable;
    ``cache_stats`` are rows of ``cache_hit_stats``."""
    joined = stats.join(meta, RUN)
    hits = []
    if cache_stats is not None:
        shown = F.struct(F.col("hit_rate_pct").alias("hit_rate_pct"), F.col("hits").alias("hits"), F.col("misses").alias("misses"))
        joined = joined.join(cache_stats.select(*RUN, shown.alias("cache_stats")), RUN, "left")
        hits = [F.col("cache_stats")]
    manifest = F.struct(*sorted(c for c in meta.columns if c not in RUN))
    counts = F.struct(*sorted([*S.STATUSES, "total_columns", "resolved_columns", "coverage"]))
    head = [F.struct(*hits, *[F.lit(backend[k]).alias(k) for k in sorted(backend)]).alias("backend")]
    if generated_at is not None:
        head.append(F.date_format(F.to_utc_timestamp(generated_at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generated_at"))
    head += [F.lit(generator).alias("generator"), manifest.alias("manifest_metadata")]
    tail = F.struct(F.lit(schema_version).alias("schema_version"), counts.alias("stats"))

    def members(json: Column) -> Column:
        return F.substring(json, F.lit(2), F.length(json) - 2)

    return joined.select(*RUN, members(F.to_json(F.struct(*head))).alias("head"), members(F.to_json(tail)).alias("tail"))


def deterministic_order(lines: DataFrame) -> DataFrame:
    """Total order of document lines; a range partitioning, so no task sorts it all."""
    return lines.orderBy(*RUN, "section", "node_id")


def write_documents(lines: DataFrame, path: str) -> None:
    """Text files per run; read in name order they are the run's JSON document. Other runs in the
    folder stay."""
    deterministic_order(lines).select(*RUN, "line").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*RUN).text(path)


def document_rows(docs: DataFrame, headers: DataFrame) -> DataFrame:
    """One whole, valid document per node: the header of its run and the node alone. A run without nodes
    has one document without any. ``headers`` has one row per run, see ``document_headers``. ``docs`` are read
    twice; where the headers are known to be small they go to the documents, which stay where they are."""
    heads = headers.select(*RUN, "head", "tail")
    bare = heads.join(docs.select(*RUN).distinct(), RUN, "left_anti")
    both = docs.join(heads, RUN).unionByName(bare, allowMissingColumns=True)
    line = F.concat(F.lit("{"), "head", F.lit(',"nodes":['), F.coalesce("doc", F.lit("")), F.lit("],"), "tail", F.lit("}"))
    return both.select(*RUN, F.coalesce("node_id", F.lit("")).alias("node_id"), line.alias("line"))


def write_document_table(rows: DataFrame, path: str) -> None:
    """Text files of one document a line, by run. Runs in ``rows`` replace those of the same key; others
    in the folder stay. Nodes are dealt over tasks by ranges, so files in name order are in node order."""
    spread = rows.repartitionByRange(*RUN, "node_id").sortWithinPartitions(*RUN, "node_id")
    spread.select(*RUN, "line").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*RUN).text(path)


# --- catalogs -------------------------------------------------------------------------------


def emit_datahub(
    nodes: DataFrame,
    columns: DataFrame,
    edges: DataFrame,
    tables: DataFrame,
    env: str = "PROD",
    platform_map: Mapping[str, str] | None = None,
    generator: str = "colweave",
) -> DataFrame:
    """One upstreamLineage change proposal per parsed or partial node.

    The platform is a matter of the node, so URNs are built after the items of a node are
    together; items themselves need no join with the nodes.
    """
    fine = edges.join(columns.select(*KEY, F.col("name").alias("column"), "transform"), [*KEY, "column"])
    fine = fine.groupBy(*KEY).agg(_sorted(F.collect_list(F.struct("column", "up_table", "up_column", "transform"))).alias("fs"))
    coarse = tables.groupBy(*KEY).agg(_sorted(F.collect_list("fqn")).alias("ts"))
    joined = (
        emit_status_filter(nodes)
        .select(*KEY, dialect_platform(F.col("dialect"), platform_map).alias("platform"))
        .join(fine, KEY, "left")
        .join(coarse, KEY, "left")
        .withColumn("urn", dataset_urn(F.col("platform"), F.col("node_id"), env))
    )
    platform, urn = F.col("platform"), F.col("urn")

    def fine_entry(f: Column) -> Column:
        source = schema_field_urn(dataset_urn(platform, f["up_table"], env), f["up_column"])
        return F.struct(
            F.lit("FIELD").alias("downstreamType"),
            F.array(schema_field_urn(urn, f["column"])).alias("downstreams"),
            f["transform"].alias("transformOperation"),
            F.lit("FIELD_SET").alias("upstreamType"),
            F.array(source).alias("upstreams"),
        )

    def table_entry(t: Column) -> Column:
        audit = F.struct(F.lit(f"urn:li:corpuser:{generator}").alias("actor"), F.lit(0).alias("time"))
        return F.struct(
            audit.alias("auditStamp"), dataset_urn(platform, t, env).alias("dataset"), F.lit("TRANSFORMED").alias("type")
        )

    aspect = F.struct(
        F.coalesce(F.transform("fs", fine_entry), F.array()).alias("fineGrainedLineages"),
        F.coalesce(F.transform("ts", table_entry), F.array()).alias("upstreams"),
    )
    proposal = F.struct(
        F.struct(aspect.alias("json")).alias("aspect"),
        F.lit("upstreamLineage").alias("aspectName"),
        F.lit("UPSERT").alias("changeType"),
        F.lit("dataset").alias("entityType"),
        urn.alias("entityUrn"),
        F.struct(
            F.lit(0).alias("lastObserved"),
            F.lit(generator).alias("registryName"),
            F.lit(generator).alias("registryVersion"),
            F.lit(generator).alias("runId"),
        ).alias("systemMetadata"),
    )
    return joined.select(*KEY, F.to_json(proposal).alias("payload"))


def emit_openmetadata(
    nodes: DataFrame,
    edges: DataFrame,
    tables: DataFrame,
    service: str | None = None,
) -> DataFrame:
    """One lineage request per (node, upstream table), with its column pairs by target column.

    A request for a table without column edges has no details block.
    """
    pair = [*KEY, "up_table"]
    known = tables.select(*KEY, F.col("fqn").alias("up_table")).distinct()
    items = known.join(edges, pair, "left").select(*pair, "column", "up_column")
    per_column = (
        items.groupBy(*pair, "column")
        .agg(_sorted(F.collect_list("up_column")).alias("ups"))
    )
    entry = F.when(F.col("column").isNotNull(), F.struct("column", "ups"))
    requests = per_column.groupBy(*pair).agg(_sorted(F.collect_list(entry)).alias("cols"))
    joined = (
        requests.join(
            emit_status_filter(nodes).select(*KEY, service_name(F.col("dialect"), service).alias("svc")), KEY
        )
        .withColumn("source", service_fqn(F.col("svc"), F.col("up_table")))
        .withColumn("target", service_fqn(F.col("svc"), F.col("node_id")))
    )

    def column_entry(c: Column) -> Column:
        return F.struct(
            F.transform(c["ups"], lambda u: F.concat(F.col("source"), F.lit("."), u)).alias("fromColumns"),
            F.concat(F.col("target"), F.lit("."), c["column"]).alias("toColumn"),
        )

    def entity(name: str) -> Column:
        return F.struct(F.col(name).alias("fullyQualifiedName"), F.lit("table").alias("type"))

    details = F.when(F.size("cols") > 0, F.struct(F.transform("cols", column_entry).alias("columnsLineage")))
    edge = F.struct(
        entity("source").alias("fromEntity"), details.alias("lineageDetails"), entity("target").alias("toEntity")
    )
    return joined.select(*pair, F.to_json(F.struct(edge.alias("edge"))).alias("payload"))


def write_payloads(payloads: DataFrame, path: str) -> None:
    """One payload per line, in directories by project and run. Other runs in the folder stay."""
    payloads.select(*RUN, "payload").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*RUN).text(path)
