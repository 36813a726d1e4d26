"""Lineage documents, read back as tables.

A document comes as a file of its own (``read_lineage_docs``), or as a row of a document table
(``read_document_table``): text files of one whole, valid document a line, with the header of its run
and one node. Both give the same tables.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave import schemas as S
from colweave.functions.rules import blank_to_null
from colweave.session import KEY, RUN, cut_lineage


class LineageTables(NamedTuple):
    nodes: DataFrame
    columns: DataFrame
    edges: DataFrame
    tables: DataFrame
    downstream: DataFrame
    unresolved: DataFrame
    diagnostics: DataFrame
    writes: DataFrame
    #: What the documents state of their runs; None where only nodes were given.
    headers: DataFrame | None = None
    #: Texts that are no documents, with the reason.
    rejects: DataFrame | None = None


def tables_of(nodes: DataFrame) -> LineageTables:
    """Flatten node documents (project, run_id, node_ord, n). Parts of one node unite here."""
    n = nodes.select(*RUN, "node_ord", F.col("n.node_id").alias("node_id"), "n")
    columns = n.select(*KEY, "node_ord", F.explode("n.columns").alias("c"))
    edges = columns.select(
        *KEY, "node_ord", F.col("c.name").alias("column"), F.explode("c.upstream").alias("u")
    )
    proc = "n.evidence.procedural"
    targets = n.select(
        *KEY, "node_ord", *[F.col(f"{proc}.{f}").alias(f) for f in ("write_target_count", "column_edge_count", "process_count")],
        F.explode(f"{proc}.write_targets").alias("w"),
    )
    return LineageTables(
        nodes=n.select(*KEY, "node_ord", "n.status", "n.confidence", "n.dialect").distinct(),
        columns=columns.select(*KEY, "node_ord", "c.name", "c.transform", "c.confidence").distinct(),
        edges=edges.select(
            *KEY, "node_ord", "column", F.col("u.table").alias("up_table"), F.col("u.column").alias("up_column")
        ),
        tables=n.select(*KEY, "node_ord", F.explode("n.upstream_tables").alias("fqn")),
        downstream=n.select(*KEY, "node_ord", F.explode("n.downstream").alias("child_id")),
        unresolved=n.select(*KEY, "node_ord", F.posexplode("n.unresolved").alias("seq", "u")).select(
            *KEY, "node_ord", "seq", "u.*"
        ),
        diagnostics=n.select(*KEY, "node_ord", F.posexplode("n.evidence.parser_diagnostics").alias("seq", "d")).select(
            *KEY, "node_ord", "seq", "d.*"
        ),
        writes=targets.select("*", F.explode("w.edges").alias("e")).select(
            *KEY, "node_ord", F.col("w.table").alias("target_fqn"), F.col("e.target_column").alias("target_col"),
            F.col("e.from.table").alias("up_table"), F.col("e.from.column").alias("up_column"), F.col("w.subType").alias("sub_type"),
            "write_target_count", "column_edge_count", "process_count",
        ),
    )


def parse_node_lines(lines: DataFrame) -> LineageTables:
    """``lines``: project, run_id, doc - one node per line."""
    return tables_of(
        lines.select(*RUN, F.lit(0).alias("node_ord"), F.from_json("doc", S.NODE_DOCUMENT).alias("n"))
    )


def parse_documents(texts: DataFrame) -> LineageTables:
    """``texts``: project, run_id, doc - whole documents, each with its header and array of nodes.

    A null ``project`` is the one that the document names, else ``unknown``. A run may have any number
    of documents. Texts are parsed once and written, since ten tables are read from them. A text that
    is not JSON, or has no list of nodes, goes to ``rejects`` as it is. A run has one row of
    ``headers`` if its documents agree on it.
    """
    shape = f"{S.DOCUMENT}, _broken string"
    parsed = texts.withColumn("d", F.from_json("doc", shape, {"columnNameOfCorruptRecord": "_broken"}))
    named = F.coalesce("project", blank_to_null(F.col("d.manifest_metadata.project_name")), F.lit("unknown"))
    error = F.when(F.col("d.nodes").isNotNull(), None).when(F.col("d._broken").isNotNull() | F.col("doc").isNull(), "document is not valid JSON").otherwise("document has no list of nodes")
    docs = cut_lineage(parsed.select(named.alias("project"), "run_id", "d", error.alias("error"), F.when(error.isNotNull(), F.col("doc")).alias("text")))
    good = docs.where("error is null")
    header = [F.col(f"d.{f}") for f in ("schema_version", "generator", "generated_at", "manifest_metadata", "backend", "stats")]
    return tables_of(good.select(*RUN, F.posexplode("d.nodes").alias("node_ord", "n")))._replace(
        headers=good.select(*RUN, *header).distinct(), rejects=docs.where("error is not null").select(*RUN, "error", "text")
    )


def read_lineage_docs(spark: SparkSession, paths: list[str], run_id: str) -> LineageTables:
    """Files of one whole document each; the project is the one each document names."""
    texts = spark.read.text(paths, wholetext=True)
    return parse_documents(texts.select(F.lit(None).cast("string").alias("project"), F.lit(run_id).alias("run_id"), F.col("value").alias("doc")))


def read_document_table(spark: SparkSession, path: str) -> LineageTables:
    """A document table as ``emit.write_document_table`` makes it: any number of files a run, which
    Spark splits by lines, so a run of any size is read by many tasks."""
    rows = spark.read.schema("value string, project string, run_id string").text(path)
    return parse_documents(rows.where("value <> ''").select(*RUN, F.col("value").alias("doc")))
