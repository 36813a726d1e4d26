"""One query per operator, over the views of the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave.bindings.views import NODE, node_tasks, read_answers, read_lines, read_spread, read_table, spark_view, with_arrays
from colweave.functions import rules, sqltext
from colweave.operators import cache, citations, compare, emit, evidence, graph, mapper, paths, quality, select, state
from colweave.session import KEY, RUN, cut_lineage, cut_placed, fresh_path
from colweave.sources import documents, manifests, responses
from colweave.streaming import runs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

TARGET_DIR = "/work/target"
TOKENS = ["+order_17", "NATION_3+", "geo.region.asia", "tag:AUTOMOBILE", "order_21+"]
EXCLUDED = ["tag:4-NOT SPECIFIED", "+Customer#000000005"]
TYPES = ["model", " SNAPSHOT ", "incremental"]


class Inputs:
    """The views as the tables that the operators take."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.raw_lines: DataFrame | None = None

    def view(self, name: str) -> DataFrame:
        return spark_view(self.spark, self.sf_dir, name, self.raw_lines)

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def spread(self, name: str) -> DataFrame:
        return read_spread(self.spark, self.sf_dir, name)

    def cut(self, df: DataFrame) -> DataFrame:
        """``df``, which is in the layout of the lines, written and read back in it."""
        return cut_placed(df, NODE, self.tasks)

    @cached_property
    def tasks(self) -> int:
        return node_tasks(self.spark, self.sf_dir)

    @cached_property
    def lines(self) -> DataFrame:
        return self.view("v_line")

    @cached_property
    def tables(self) -> DataFrame:
        return responses.describe_tables(self.view("v_tbl"))

    @cached_property
    def diagnostics(self) -> DataFrame:
        return responses.read_diagnostics(self.view("v_diag"))

    @cached_property
    def resolved(self) -> DataFrame:
        return mapper.resolve_lines(self.lines, self.tables)

    @cached_property
    def grouped(self) -> DataFrame:
        return mapper.group_edges(self.resolved)

    @cached_property
    def columns(self) -> DataFrame:
        return mapper.lineage_columns(self.grouped)

    @cached_property
    def edges(self) -> DataFrame:
        return mapper.lineage_edges(self.grouped)

    @cached_property
    def upstream(self) -> DataFrame:
        return mapper.upstream_tables(self.tables)

    @cached_property
    def responses(self) -> DataFrame:
        return self.view("v_resp")

    @cached_property
    def status(self) -> DataFrame:
        return mapper.node_status(self.responses, self.columns, self.tables)

    @cached_property
    def emitted(self) -> DataFrame:
        """Nodes with status and dialect."""
        return self.status.join(self.responses.select(*KEY, "dialect"), KEY)

    @cached_property
    def sqls(self) -> DataFrame:
        return self.view("v_sql")

    @cached_property
    def nodes(self) -> DataFrame:
        return with_arrays(self.view("v_node"))

    @cached_property
    def edges_of_models(self) -> DataFrame:
        return self.view("v_edge")

    @cached_property
    def files(self) -> DataFrame:
        return self.view("v_file")

    @cached_property
    def with_sql(self) -> DataFrame:
        return manifests.resolve_compiled_sql(self.nodes, self.files, TARGET_DIR)

    @cached_property
    def planned(self) -> DataFrame:
        return select.eligibility_with_sql(self.with_sql)

    @cached_property
    def runs(self) -> DataFrame:
        return self.view("v_run")

    @cached_property
    def stats(self) -> DataFrame:
        return quality.run_stats(self.runs)

    def counts(self, view: str) -> DataFrame:
        """Edges of every node that has a parser answer, 0 for one without any."""
        run = F.lit("r0" if view == "v_base" else "r1").alias("run_id")
        return compare.edge_counts(self.responses.select("project", run, "node_id"), self.view(view))

    @cached_property
    def requests(self) -> DataFrame:
        keyed = sqltext.cache_key(
            F.col("sql"), F.col("dialect"), F.lit("anonymous"), F.lit("unknown"), F.lit("1.0")
        )
        return self.view("v_request").withColumn("cache_key", keyed)

    @cached_property
    def cache(self) -> DataFrame:
        """Answers for a third of the customers; every fourth of them is a broken entry."""
        payload = F.when(F.col("o_custkey") % 4 == 0, "{broken").otherwise('{"code": 200}')
        known = self.requests.where(F.col("o_custkey") % 3 == 0)
        return known.select("cache_key", payload.alias("payload")).distinct()

    @cached_property
    def texts(self) -> DataFrame:
        """All SQL texts and all prose."""
        sql = self.sqls.select(F.col("node_id").alias("id"), F.col("sql").alias("text"))
        prose = self.spread("documents").select(F.concat(F.lit("doc."), F.col("doc_id").cast("string")).alias("id"), "text")
        return sql.unionByName(prose)

    @cached_property
    def flows(self) -> DataFrame:
        return responses.normalize_responses(payloads(self)).drop("payload")

    @cached_property
    def docs(self) -> DataFrame:
        """Documents in the layout of the lines. What several parts of them start from is written once in this layout."""
        self.raw_lines = self.cut(read_lines(self.spark, self.sf_dir))
        self.responses = self.cut(read_answers(self.spark, self.sf_dir).select(*KEY, "dialect", "process_count"))
        self.tables = self.cut(self.tables)
        self.diagnostics = self.cut(self.diagnostics)
        self.resolved = self.cut(self.resolved)
        self.columns = self.cut(self.columns)
        self.status = self.cut(self.status)
        sqls = read_answers(self.spark, self.sf_dir, "v_sql")
        writes = evidence.procedural_write_targets(self.resolved, self.tables, self.responses, self.cut)
        return emit.render_lineage_doc(
            self.emitted, self.columns, self.edges, self.upstream, self.view("v_child"),
            mapper.unresolved_rows(self.resolved, self.columns, self.diagnostics, sqls), self.diagnostics, writes,
        )

    @cached_property
    def headers(self) -> DataFrame:
        meta = self.status.select(*RUN).distinct().withColumn("project_name", F.col("project"))
        return emit.document_headers(quality.run_stats(self.status), meta, "colweave", "0.2.x", {"mode": "none"})

    @cached_property
    def writes(self) -> DataFrame:
        return evidence.procedural_write_targets(self.resolved, self.tables, self.responses)


def query(fn: Callable[[Inputs], DataFrame]):
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
    return fn


# --- sources --------------------------------------------------------------------------------


def manifest_texts(i: Inputs) -> DataFrame:
    """One manifest per order: good ones, maps that are null, broken texts and missing files."""
    k = F.col("o_orderkey")
    this, that = F.concat(F.lit("order."), k.cast("string")), F.concat(F.lit("customer."), F.col("o_custkey").cast("string"))
    node = F.struct(
        F.concat(F.lit("Order_"), k.cast("string")).alias("name"),
        F.col("o_orderpriority").alias("resource_type"),
        F.concat(F.lit("select "), k.cast("string")).alias("compiled_code"),
        F.array(F.lit("sales"), F.col("o_orderstatus")).alias("fqn"),
        F.when(k % 9 > 0, F.array(F.col("o_orderpriority"))).alias("tags"),
    )
    doc = F.struct(
        F.struct(
            F.when(k % 4 > 0, F.lit("1.7")).alias("dbt_version"),
            F.concat(F.lit("https://schemas.example.org/manifest/v"), (k % 14).cast("string"), F.lit(".json")).alias("dbt_schema_version"),
            F.when(k % 2 > 0, F.lit("duckdb")).alias("adapter_type"),
        ).alias("metadata"),
        F.create_map(this, node).alias("nodes"),
        F.when(k % 10 > 0, F.create_map(this, F.array(that, F.lit("source.s")))).alias("parent_map"),
        F.create_map(that, F.array(this)).alias("child_map"),
    )
    text = (
        F.when(k % 13 == 1, F.lit(None))
        .when(k % 13 == 2, '{"nodes": ')
        .when(k % 13 == 3, "[1, 2]")
        .otherwise(F.to_json(doc))
    )
    return i.spread("orders").select(
        F.concat(F.lit("p"), (k % 4).cast("string")).alias("project"),
        F.concat(F.lit("r"), k.cast("string")).alias("run_id"),
        F.concat(F.lit("/in/"), k.cast("string"), F.lit(".json")).alias("path"),
        text.alias("value"),
    )


@query
def read_manifests(i):
    """Nodes, edges, metadata and rejects of all manifests, counted per manifest run."""
    found = manifests.parse_manifests(manifest_texts(i))
    nodes = found.nodes.select(
        *RUN, F.lit("node").alias("kind"), "node_id",
        F.concat_ws("|", "name", "resource_type", "compiled_code", F.array_join("fqn", "."), F.array_join("tags", ".")).alias("content"),
    )
    edges = found.edges.select(*RUN, "origin", F.col("child_id"), "parent_id")
    meta = found.meta.select(
        *RUN, F.lit("meta"), F.lit(""), F.concat_ws("|", "dbt_version", "dbt_schema_version", "project_name", "adapter_type")
    )
    rejects = found.rejects.select(*RUN, F.lit("reject"), "path", "error")
    return nodes.union(edges).union(meta).union(rejects)


@query
def manifest_schema_version(i):
    pages = i.table("pages").select("page_id", "url")
    numbered = F.concat(
        F.regexp_replace("url", r"[?#].*$", ""), F.lit("/manifest/v"), (F.col("page_id") % 15).cast("string"),
        F.when(F.col("page_id") % 4 == 0, ".yml").otherwise(".json"),
        F.when(F.col("page_id") % 3 == 0, "//").when(F.col("page_id") % 3 == 1, "?x=/v1.json#y").otherwise("#z?"),
    )
    return manifests.manifest_schema_version(pages.withColumn("dbt_schema_version", numbered)).select(
        "page_id", "schema_token", "is_known"
    )


@query
def read_optional_artifact(i):
    texts = manifest_texts(i)
    found = manifests.parse_optional_artifacts(texts)
    return found.select(*RUN, "path")


@query
def resolve_compiled_sql(i):
    return i.with_sql.select("node_id", "sql")


def payloads(i: Inputs) -> DataFrame:
    """One parser answer per line item, in one of the four envelopes.

    The object tree lists a table twice (the last one counts), the relationships hold one without
    sources, and ``errors`` mixes good and malformed entries or is no list at all.
    """
    q = F.col("l_suppkey")
    text = lambda c: c.cast("string")
    table = lambda tid, name, sub: F.struct(tid.alias("id"), name.alias("name"), sub.alias("subType"))
    no = F.lit(None).cast("string")
    name = F.concat(F.lit("tab_"), text(q))
    tree = F.array(
        F.struct(
            F.lit("DEFAULT_SERVER").alias("name"),
            F.array(
                F.struct(
                    F.when(q % 3 == 0, "<default>").otherwise("db").alias("name"),
                    F.array(
                        F.struct(
                            F.lit("sch").alias("name"),
                            F.array(table(q, F.lit("old"), no), table(q, name, F.when(q % 2 == 0, "temp_table"))).alias("tables"),
                            F.array(table(F.lit(-1), F.concat(F.lit("RS-"), text(F.col("l_linenumber"))), no)).alias("others"),
                        )
                    ).alias("schemas"),
                )
            ).alias("databases"),
        )
    )
    end = lambda col, parent: F.struct(col.alias("column"), parent.alias("parentId"))
    column = F.concat(F.lit("C"), text(F.col("l_partkey") % 5))
    first = F.struct(
        F.col("l_returnflag").alias("type"),
        end(column, F.lit(-1)).alias("target"),
        F.array(end(F.concat(F.lit("k"), text(F.col("l_partkey") % 7)), q), end(no, F.lit(404))).alias("sources"),
    )
    second = F.struct(
        F.lit("fdr").alias("type"), end(F.lit("*"), q).alias("target"),
        F.array().cast("array<struct<column:string,parentId:bigint>>").alias("sources"),
    )
    relationships = F.array(first, second)
    message = F.concat(
        F.lit(" find orphan column(10500) near: ["), column, F.lit("]("), text(F.col("l_linenumber")), F.lit(", "), text(q), F.lit(") ")
    )
    entries = F.concat(
        F.lit('["no object",null,{"errorMessage":42},{"errorMessage":" "},{"errorMessage":"'), message,
        F.lit('","originCoordinates":{"x":1,"y":2}},{"errorMessage":"odd token","errorType":"'),
        F.when(q % 2 == 0, "Note").otherwise(""), F.lit('","originCoordinates":[{"x":'), text(F.col("l_linenumber")),
        F.lit(',"y":"z"}]}]'),
    )
    errors = F.when(q % 11 == 0, '{"errorMessage":"not a list"}').otherwise(entries)
    flow = F.concat(
        F.lit('{"dbobjs":{"servers":'), F.to_json(tree), F.lit('},"relationships":'),
        F.to_json(relationships), F.lit(',"processes":[{"id":1},{"id":2}],"errors":'), errors, F.lit("}"),
    )
    shape = F.col("l_linenumber") % 4
    wrapped = (
        F.when(shape == 0, F.concat(F.lit('{"http_status":200,"body":{"code":200,"data":{"sqlflow":'), flow, F.lit("}}}")))
        .when(shape == 1, F.concat(F.lit('{"code":"200","data":{"sqlflow":'), flow, F.lit("}}")))
        .when(shape == 2, F.concat(F.lit('{"sqlflow":'), flow, F.lit("}")))
        .otherwise(flow)
    )
    parts = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return i.spread("lineitem").select(
        F.concat(F.lit("shop"), text(F.col("l_orderkey") % 4)).alias("project"), F.lit("r1").alias("run_id"),
        F.concat_ws(".", F.lit("line"), *[text(F.col(p)) for p in parts]).alias("node_id"), wrapped.alias("payload"),
    )


@query
def normalize_response(i):
    got = F.try_variant_get("flow", "$.relationships[0].target.column", "string")
    return i.flows.select("node_id", got.alias("first_target"), F.col("flow").isNotNull().alias("has_flow"))


@query
def classify_response(i):
    return responses.classify_responses(i.responses).select("node_id", "outcome", "reason", "detail")


@query
def explode_dbobjs(i):
    return responses.explode_dbobjs(i.flows).select("node_id", "table_id", "collection", "fqn", "sub_type", "is_real")


@query
def explode_relationships(i):
    return responses.explode_relationships(i.flows).drop(*RUN)


@query
def explode_diagnostics(i):
    return responses.explode_diagnostics(i.flows).drop(*RUN)


@query
def read_lineage_docs(i):
    """All that comes back from the files of a document table: one row per thing a document says."""
    path = fresh_path(i.spark, "documents")
    emit.write_document_table(emit.document_rows(i.cut(i.docs), cut_lineage(i.headers)), path)
    back = documents.read_document_table(i.spark, path)
    c = F.col

    def rows(df: DataFrame, kind: str, *content) -> DataFrame:
        node = c("node_id") if "node_id" in df.columns else F.lit("")
        return df.select(*RUN, node.alias("node_id"), F.lit(kind).alias("kind"), F.concat_ws("|", *[x.cast("string") for x in content]).alias("content"))

    return (
        rows(back.headers, "header", c("schema_version"), c("generator"), c("backend.mode"), c("manifest_metadata.project_name"), c("stats.parsed"), c("stats.total_columns"))
        .unionByName(rows(back.nodes, "node", c("status"), c("confidence"), c("dialect")))
        .unionByName(rows(back.columns, "column", c("name"), c("transform"), c("confidence")))
        .unionByName(rows(back.edges, "edge", c("column"), c("up_table"), c("up_column")))
        .unionByName(rows(back.tables, "table", c("fqn")))
        .unionByName(rows(back.downstream, "child", c("child_id")))
        .unionByName(rows(back.unresolved, "reason", c("reason"), c("target_column"), c("source_parent_id"), c("line"), c("col"), c("parser_message"), c("marker")))
        .unionByName(rows(back.diagnostics, "diagnostic", c("type"), c("category"), c("near_column"), c("line"), c("col"), c("message")))
        .unionByName(rows(back.writes, "write", c("target_fqn"), c("target_col"), c("up_table"), c("up_column"), c("sub_type"), c("write_target_count"), c("process_count")))
        .unionByName(rows(back.rejects, "reject", c("text")))
    )


# --- sinks ----------------------------------------------------------------------------------


@query
def render_lineage_doc(i):
    return i.docs.select(*KEY, "doc")


@query
def deterministic_order(i):
    """All documents as ordered lines of one JSON document per run."""
    lines = emit.document_lines(i.cut(i.docs), cut_lineage(i.headers))
    return emit.deterministic_order(lines).select(*RUN, "section", "node_id", "line")


@query
def emit_datahub(i):
    return emit.emit_datahub(i.emitted, i.columns, i.edges, i.upstream, platform_map={"dbvpresto": "presto_db"}).select(
        "node_id", "payload"
    )


@query
def emit_openmetadata(i):
    return emit.emit_openmetadata(i.emitted, i.edges, i.upstream).select("node_id", "up_table", "payload")


@query
def write_response_cache(i):
    """The cache after two writes: the second has new answers to some keys, and keys of its own."""
    path = fresh_path(i.spark, "cache")
    answers = i.requests.select("cache_key", "o_custkey", F.concat(F.lit('{"sql":"'), sqltext.normalize_sql(F.col("sql")), F.lit('"}')).alias("payload"))
    old = answers.where("o_custkey % 2 = 0").select("cache_key", F.lit('{"sql":"?"}').alias("payload"))
    cache.write_response_cache(old, path)
    cache.write_response_cache(answers.where("o_custkey % 4 > 0").drop("o_custkey"), path)
    return cache.read_response_cache(i.spark, path).select("bucket", "cache_key", "payload")


@query
def plan_report(i):
    return select.plan_report(i.planned).drop(*RUN)


@query
def run_summary(i):
    return quality.run_summary(i.stats)


# --- column rules ---------------------------------------------------------------------------


@query
def normalize_sql(i):
    return i.texts.select("id", sqltext.normalize_sql(F.col("text")).alias("sql"))


@query
def cache_key(i):
    """Duplicate SQL by content: how many nodes share each key, and the first of them."""
    return i.requests.groupBy("cache_key").agg(F.count("*").alias("n"), F.min("node_id").alias("first_node"))


@query
def redact_literals(i):
    return sqltext.mask_literals(i.texts, "text", "masked").select("id", "masked")


@query
def dynamic_sql_marker(i):
    return i.texts.select("id", sqltext.dynamic_sql_marker(F.col("text")).alias("marker"))


@query
def marker_excerpt(i):
    return i.texts.select("id", sqltext.marker_excerpt(F.col("text")).alias("excerpt"))


@query
def canonical_dialect(i):
    return i.nodes.select("node_id", rules.canonical_dialect(F.coalesce("adapter_type", F.lit("DBVx"))).alias("dialect"))


@query
def resolve_dialect(i):
    override = F.when(F.col("name").like("%7"), F.lit(" Trino "))
    return i.nodes.select(
        "node_id", rules.resolve_dialect(F.col("adapter_type"), override).alias("dialect"),
        F.when(F.col("dialect").isNull(), rules.dialect_error(F.col("adapter_type"))).alias("error"),
    )


@query
def dialect_platform(i):
    return i.responses.select("node_id", rules.dialect_platform(F.col("dialect"), {"dbvmssql": "tsql"}).alias("platform"))


@query
def dataset_urn(i):
    platform = F.when(F.col("is_real"), "bigquery").otherwise("external")
    return i.tables.select("node_id", "table_id", rules.dataset_urn(platform, F.col("fqn"), "DEV").alias("urn"))


@query
def schema_field_urn(i):
    dataset = rules.dataset_urn(F.lit("spark"), F.col("target_parent_id"))
    return i.lines.select("node_id", "rel_ord", rules.schema_field_urn(dataset, F.col("target_col")).alias("urn"))


@query
def service_fqn(i):
    dialect = F.when(F.col("is_real"), F.lit("dbvsparksql")).when(F.col("db") == "", F.lit("dbv"))
    return i.tables.select("node_id", "table_id", rules.service_fqn(rules.service_name(dialect), F.col("fqn")).alias("fqn"))


@query
def table_fqn(i):
    return i.tables.select("node_id", "table_id", "fqn")


@query
def is_real_table(i):
    return i.tables.select("node_id", "table_id", "is_real")


@query
def is_synthetic_column(i):
    return i.lines.select("node_id", "rel_ord", rules.is_synthetic_column(F.col("target_col")).alias("is_synthetic"))


@query
def classify_relationship(i):
    kind = F.col("rel_type")
    return i.lines.select(
        "node_id", "rel_ord", rules.transform_name(rules.transform_code(kind)).alias("transform"),
        rules.is_value_type(kind).alias("is_value"),
    )


@query
def parse_orphan_diagnostic(i):
    return i.diagnostics.drop(*RUN)


@query
def lineage_eligibility(i):
    return select.lineage_eligibility(i.nodes).select("node_id", "eligible", "skip_reason")


@query
def eligibility_with_sql(i):
    return i.planned.select("node_id", "dialect", "eligible", "skip_reason")


@query
def emit_status_filter(i):
    return emit.emit_status_filter(i.runs).select(*KEY, "status")


@query
def drop_star_targets(i):
    return mapper.drop_star_targets(mapper.join_relationship_targets(i.lines, i.tables)).select(
        "node_id", "rel_ord", "target_fqn", "target_col"
    )


# --- joins ----------------------------------------------------------------------------------


@query
def join_relationship_targets(i):
    return mapper.join_relationship_targets(i.lines, i.tables).select(
        *KEY, "rel_ord", "target_fqn", "target_is_real", "target_col"
    )


@query
def join_relationship_sources(i):
    return i.resolved.select(
        *KEY, "rel_ord", "target_fqn", "target_col", "up_table", "up_column", "source_unknown", "source_parent_id"
    )


@query
def resolve_one_hop(i):
    return evidence.resolve_one_hop(i.resolved).select(*KEY, *evidence.EDGE).distinct()


@query
def attach_orphan_reason(i):
    return mapper.attach_orphan_reason(i.columns, i.diagnostics)


@query
def attach_downstream(i):
    return select.attach_downstream(i.nodes, i.edges_of_models).drop(*RUN)


@query
def split_cached(i):
    hits, todo = cache.split_cached(i.requests, i.cache)
    return hits.select("node_id", F.lit("cached").alias("state")).unionByName(
        todo.select("node_id", F.lit("to_parse").alias("state"))
    )


@query
def attach_write_subtype(i):
    return evidence.attach_write_subtype(evidence.write_edges(i.resolved), i.tables)


@query
def known_nodes_only(i):
    seeds = i.nodes.where(select.match_tag("1-URGENT")).select(*KEY)
    parents = i.edges_of_models.where("origin = 'parent_map'")
    return graph.known_nodes_only(graph.ancestors(seeds, parents), i.nodes).select("node_id")


# --- aggregates -----------------------------------------------------------------------------


@query
def accumulate_target_columns(i):
    return mapper.accumulate_target_columns(i.grouped).select(
        *KEY, "target_fqn", "target_col", "first_ord", "transform", "first_is_value", "n_upstream"
    )


@query
def column_confidence(i):
    return mapper.column_confidence(mapper.accumulate_target_columns(i.grouped)).select(
        *KEY, "target_fqn", "target_col", "confidence"
    )


@query
def merge_columns_by_name(i):
    """For every model column: how it is derived, how sure we are, and which columns feed it."""
    edges = i.edges.withColumnRenamed("column", "name")
    return i.columns.select(*KEY, "name", "transform", "confidence").join(edges, [*KEY, "name"], "left")


@query
def upstream_tables(i):
    return i.upstream


@query
def node_status(i):
    return i.status


@query
def unresolved_rows(i):
    return mapper.unresolved_rows(i.resolved, i.columns, i.diagnostics, i.sqls)


@query
def procedural_write_targets(i):
    return i.writes


@query
def compute_node_confidence(i):
    return mapper.compute_node_confidence(i.columns, i.responses)


@query
def run_stats(i):
    return i.stats


@query
def node_coverage(i):
    return quality.node_coverage(i.stats).select(*RUN, F.round("node_coverage", 9).alias("node_coverage"))


@query
def column_coverage(i):
    return quality.column_coverage(i.stats).select(*RUN, "column_coverage")


@query
def edge_counts(i):
    return compare.edge_counts(i.responses, i.edges)


@query
def cache_hit_stats(i):
    return cache.cache_hit_stats(i.requests, i.cache)


@query
def apply_dynamic_sql(i):
    return mapper.apply_dynamic_sql(i.status, i.sqls).select(*KEY, "status", "confidence")


# --- ordinals and sets ----------------------------------------------------------------------


@query
def quota_cut(i):
    planned = i.requests.withColumn("eligible", F.col("o_custkey") % 5 > 0)
    return cache.quota_cut(planned, i.cache, budget=50)


@query
def failure_preview(i):
    bad = i.runs.where(F.col("status").isin("failed", "unsupported"))
    return quality.failure_preview(bad, [*RUN, "status"])


@query
def select_union(i):
    return select.select_union(i.nodes, [t.strip("+") for t in TOKENS]).select("node_id")


@query
def select_exclude(i):
    out = select.match_tokens(i.nodes, {"exclude": [t.strip("+") for t in EXCLUDED]})
    return select.select_exclude(i.nodes, out).select("node_id")


@query
def select_resource_type(i):
    return select.select_resource_type(i.nodes, TYPES).select("node_id", "resource_type")


# --- graph ----------------------------------------------------------------------------------


@query
def match_tag(i):
    return i.nodes.where(select.match_tag("BUILDING") | select.match_tag("2-HIGH")).select("node_id")


@query
def match_name_or_fqn(i):
    hit = [select.match_name_or_fqn(t) for t in ("nation_3", "GEO.Region.ASIA", "order_11", "customer#000000004")]
    return i.nodes.where(hit[0] | hit[1] | hit[2] | hit[3]).select("node_id")


@query
def ancestors(i):
    seeds = i.nodes.where(select.match_tag("1-URGENT")).select(*KEY)
    return graph.ancestors(seeds, i.edges_of_models.where("origin = 'parent_map'")).select("node_id")


@query
def descendants(i):
    seeds = i.nodes.where(select.match_name_or_fqn("ASIA")).select(*KEY)
    return graph.descendants(seeds, i.edges_of_models.where("origin = 'child_map'")).select("node_id")


@query
def select_nodes(i):
    return select.select_nodes(i.nodes, i.edges_of_models, TOKENS, EXCLUDED, TYPES).select("node_id")


@query
def trace_multi_hop(i):
    """Real sources behind chains of result sets, with the least number of steps."""
    tables = i.cut(responses.describe_tables(i.view("v_hop_tbl")))
    resolved = i.cut(mapper.resolve_lines(i.view("v_hop"), tables))
    return paths.trace_multi_hop(resolved, i.cut).drop("target_parent_id")


@query
def propagate_tags(i):
    """Tags of regions and customers on all columns below; personal data ends at aggregates."""
    return paths.propagate_tags(i.view("v_coltag"), i.view("v_colstep"), {"pii": ["aggregate"], "secret": ["expression"]})


@query
def state_modified(i):
    """Nodes that are new or changed since an earlier manifest, whose states were kept, and all below."""
    path = fresh_path(i.spark, "state")
    state.write_state(state.node_state(with_arrays(i.view("v_node_before"))), path)
    edges = i.view("v_edge_removed").where("origin = 'child_map'")
    return state.state_modified(i.nodes, edges, state.read_state(i.spark, path, "r0")).select("node_id", "reason")


@query
def split_reads_writes(i):
    return evidence.split_reads_writes(i.resolved, i.tables)


# --- gates and comparison -------------------------------------------------------------------


@query
def gate_node_coverage(i):
    return quality.gate_node_coverage(i.stats, 0.5)


@query
def gate_column_coverage(i):
    return quality.gate_column_coverage(i.stats, 0.66)


@query
def gate_unsupported(i):
    return quality.gate_unsupported(i.runs)


@query
def gate_failed(i):
    return quality.gate_failed(i.runs)


@query
def gate_regression(i):
    return quality.gate_regression(i.counts("v_cur"), i.counts("v_base"))


@query
def check_run(i):
    """All five gates over the orders as nodes of a run; the last project has no baseline."""
    nodes = i.view("v_check")
    counts = i.counts("v_cur"), i.counts("v_base").where("project <> 'shop3'")
    return quality.check_run(quality.run_stats(nodes), nodes, 0.85, 0.66, True, True, counts)


@query
def validate_lineage(i):
    return quality.validate_lineage(event_documents(i), keys=["event_id"])


def event_documents(i: Inputs) -> DataFrame:
    """One small document per event, of which many break some rule."""
    e, k = F.col("event_id"), F.regexp_extract("props", "([0-9]+)", 1)
    status = F.when(e % 5 == 0, F.col("event_type")).otherwise("parsed")
    extra = F.when(e % 7 == 0, ',"upstreams":[]').otherwise("")
    transform = F.when(e % 11 == 0, '"copied"').when(e % 11 == 1, "7").otherwise('"direct"')
    edge = F.when(e % 13 == 0, '{"table":"t"}').when(e % 13 == 1, '{"table":"t","column":"c","x":1}').otherwise(
        '{"table":"t","column":"c"}'
    )
    doc = F.concat(
        F.lit('{"schema_version":"0.2.x"'), F.when(e % 17 > 0, ',"generator":"g"').otherwise(""),
        F.lit(',"manifest_metadata":{"dbt_version":"1","project_name":"p","selected_count":'), (e % 19 - 1).cast("string"),
        F.lit(',"eligible_count":1},"backend":{"mode":"m"},"stats":{"coverage":'), k, F.lit('e-2,"parsed":'),
        F.when(e % 23 == 0, "1.5").otherwise("1"), F.lit('},"nodes":[{"node_id":"n","status":"'), status,
        F.lit('","upstream_tables":["t",'), F.when(e % 29 == 0, "3").otherwise('"u"'),
        F.lit('],"columns":[{"name":"c","transform":'), transform, extra, F.lit(',"upstream":['), edge, F.lit("]}]}]}"),
    )
    broken = F.when(e % 31 == 0, "[]").when(e % 31 == 1, "{").otherwise(doc)
    return i.spread("events").select("event_id", broken.alias("doc"))


@query
def selection_size_guard(i):
    return select.selection_size_guard(i.planned, "anonymous", 50)


@query
def edge_count_regressions(i):
    return compare.edge_count_regressions(i.counts("v_cur"), i.counts("v_base"))


@query
def diff_report(i):
    lost = compare.edge_count_regressions(i.counts("v_cur"), i.counts("v_base"))
    lines = compare.diff_report(lost).select(*RUN, "node_id", "line", "json")
    head = compare.diff_headline(i.view("v_cur"), lost)
    none = F.lit(None).cast("string")
    return lines.unionByName(head.select(*RUN, none.alias("node_id"), "line", none.alias("json")))


@query
def compare_against_stock(i):
    return compare.compare_against_stock(i.counts("v_cur"), i.counts("v_base"))


def _golden(i: Inputs, view: str):
    edges = i.view(view)
    tables = edges.select(*KEY, F.col("up_table").alias("fqn"))
    return tables, edges.select(*KEY, "column").distinct(), edges


@query
def golden_drift(i):
    return compare.golden_drift(*_golden(i, "v_cur"), *_golden(i, "v_base"))


@query
def missing_expected_tables(i):
    expected = i.view("v_base").select("project", "node_id", F.upper("up_table").alias("fqn"))
    return compare.missing_expected_tables(expected, i.view("v_cur").select(*KEY, F.col("up_table").alias("fqn")))


@query
def content_fingerprint(i):
    fields = ["column", "up_table", "up_column"]
    both = i.view("v_base").unionByName(i.view("v_cur"))
    prints = compare.content_fingerprint(both, fields)
    drift = compare.fingerprint_drift(prints).select("project", "node_id", F.lit(True).alias("drifted"))
    return prints.join(drift, ["project", "node_id"], "left").select(
        *KEY, "fingerprint", F.coalesce("drifted", F.lit(False)).alias("drifted")
    )


@query
def column_diff(i):
    """Columns with lost or added upstreams, as text and as JSON."""
    now, before = i.view("v_cur"), i.view("v_base")
    names = lambda e: e.select("project", "node_id", F.col("column").alias("name")).distinct()
    return compare.column_diff_report(compare.column_diff(names(now), now, names(before), before))


@query
def status_regressions(i):
    return compare.status_regressions(i.runs, i.view("v_run_before"))


@query
def renamed_columns(i):
    return compare.renamed_columns(i.view("v_ren_cur"), i.view("v_ren_base"))


@query
def cited_ids(i):
    return citations.cited_ids(i.view("v_cite"), i.view("v_index"))


@query
def citation_lint(i):
    return citations.citation_lint(i.view("v_cite"), i.view("v_index"))


# --- streams --------------------------------------------------------------------------------


def _event_stream(i: Inputs) -> DataFrame:
    """The events as a file stream; event time must be a timestamp with time zone."""
    schema = i.table("events").schema
    stream = i.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(i.sf_dir)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _run_stream(i: Inputs, stream: DataFrame) -> DataFrame:
    path = fresh_path(i.spark, "stream")
    runs.write_available(stream, f"{path}/data", f"{path}/state").awaitTermination()
    return i.spark.read.schema(stream.schema).parquet(f"{path}/data")


@query
def stream_new_sql(i):
    sql = F.concat_ws(" ", F.lit("SELECT"), F.col("event_type"), F.lit("FROM"), F.col("user_id").cast("string"))
    lit = F.lit
    keyed = _event_stream(i).select("ts", sqltext.cache_key(sql, lit("d"), lit("m"), lit("p"), lit("v")).alias("cache_key"))
    return _run_stream(i, runs.stream_new_sql(keyed, "366 days")).select("cache_key")


@query
def stream_unseen_sql(i):
    """The events as four files, a batch each, against a cache that knows a third of the users."""
    sql = F.concat_ws(" ", F.lit("SELECT"), F.col("event_type"), F.lit("FROM"), F.col("user_id").cast("string"))
    lit = F.lit
    spread = i.table("events").repartition(4, "ts")  # a key comes in several batches
    keyed = spread.select("event_type", "user_id", sqltext.cache_key(sql, lit("d"), lit("m"), lit("p"), lit("v")).alias("cache_key"))
    path = fresh_path(i.spark, "unseen")
    keyed.write.parquet(f"{path}/events")
    cache.write_response_cache(keyed.where("user_id % 3 = 0").select("cache_key", lit("{}").alias("payload")), f"{path}/cache")
    stream = i.spark.readStream.schema(keyed.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/events")
    runs.stream_unseen_sql(stream, f"{path}/data", f"{path}/state", f"{path}/cache").awaitTermination()
    return runs.read_unseen(i.spark, f"{path}/data").select("cache_key", "event_type", "user_id")


@query
def stream_run_coverage(i):
    kind = F.col("event_type")
    status = (
        F.when(kind == "view", "parsed").when(kind == "click", "partial").when(kind == "purchase", "unsupported")
        .when(kind == "error", "failed").otherwise("skipped")
    )
    nodes = _event_stream(i).select("ts", status.alias("status"))
    out = _run_stream(i, runs.stream_run_coverage(nodes, "1 day", "6 hours"))
    day = F.date_format("window_start", "yyyy-MM-dd")
    return out.select(
        day.alias("day"), "parsed", "partial", "unsupported", "failed", "skipped", "eligible_count",
        F.round("node_coverage", 9).alias("node_coverage"),
    )
