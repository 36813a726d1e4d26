"""From manifest and parser answers to documents, catalog payloads, checks and comparison."""

import json
import os

import pytest
from pyspark.sql import functions as F

from colweave.operators import compare, emit, quality
from colweave.operators.select import attach_downstream
from colweave.plans import lineage as P
from colweave.session import KEY, RUN
from colweave.sources import documents, manifests

MODEL = "model.shop.clean_items"
SQL = "select id, 'x' as label from raw_items"


@pytest.fixture(scope="module")
def manifest(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("manifest")
    doc = {
        "metadata": {"dbt_version": "1.7.4", "dbt_schema_version": "https://x.org/manifest/v11.json", "project_name": "shop", "adapter_type": "bigquery"},
        "nodes": {
            MODEL: {"name": "clean_items", "resource_type": "model", "fqn": ["shop", "clean_items"], "compiled_code": SQL, "path": "c.sql", "tags": ["t"]},
            "model.shop.from_file": {"name": "from_file", "resource_type": "model", "fqn": ["shop", "from_file"], "compiled_path": "m/f.sql", "tags": 7},
            "model.shop.broken": {"name": "broken", "resource_type": "model", "fqn": ["shop", "broken"], "compiled_code": "select )"},
            "seed.shop.s": {"name": "s", "resource_type": "seed", "fqn": ["shop", "s"]},
        },
        "parent_map": None,
        "child_map": {MODEL: ["model.shop.from_file"]},
        "extra": [1],
    }
    (folder / "good.json").write_text(json.dumps(doc))
    (folder / "bad.json").write_text("{")
    (folder / "list.json").write_text("[]")
    return manifests.read_manifests(spark, [str(folder)], "r1")


@pytest.fixture(scope="module")
def planned(spark, manifest):
    files = spark.createDataFrame([("/t/m/f.sql", "select 1; execute immediate q")], "path string, text string")
    return P.plan_run(manifest, files, "/t", "anonymous", "1.0")


@pytest.fixture(scope="module")
def answers(planned):
    tree = {"servers": [{"name": "DEFAULT_SERVER", "databases": [{"name": "", "schemas": [{
        "name": "", "tables": [{"id": 1, "name": "raw_items"}], "others": [{"id": 2, "name": "RS-1"}, {"id": 3, "name": "RS-2"}]}]}]}]}
    star = [
        {"type": "fdd", "target": {"parentId": 3, "column": "*"}, "sources": [{"parentId": 2, "column": "u"}]},
        {"type": "fdd", "target": {"parentId": 2, "column": "*"}, "sources": [{"parentId": 1, "column": c} for c in ("id", "*", "NAME")]},
    ]
    payload = json.dumps({"data": {"sqlflow": {"dbobjs": tree, "relationships": star}}})
    text = F.col("compiled_code")
    failed = text == "select )"
    return planned.where("eligible").select(
        "cache_key", F.when(~failed | text.isNull(), payload).alias("payload"),
        F.when(failed, 500).otherwise(200).alias("http_status"), F.lit("200").alias("code"),
        F.when(failed, "x" * 300).alias("detail"), F.lit("anonymous").alias("mode"),
    )


@pytest.fixture(scope="module")
def mapped(planned, answers):
    return P.map_run(planned, answers)


@pytest.fixture(scope="module")
def written(spark, manifest, mapped, tmp_path_factory):
    children = attach_downstream(manifest.nodes, manifest.edges)
    lines = P.render_run(mapped, children, manifest.meta.drop("path", "generated_at"), "colweave 1", {"mode": "anonymous"})
    path = str(tmp_path_factory.mktemp("out") / "docs")
    emit.write_documents(lines, path)
    return path


def read_json(path):
    parts = sorted(
        os.path.join(root, f) for root, _, files in os.walk(path) for f in files if f.startswith("part-")
    )
    return json.loads("".join(open(p, encoding="utf-8").read() for p in parts))


def test_manifest_tables(manifest):
    assert manifest.nodes.count() == 4
    assert sorted(r.error for r in manifest.rejects.collect()) == ["manifest is not a JSON object", "manifest is not valid JSON"]
    (edge,) = manifest.edges.collect()
    assert (edge.origin, edge.parent_id, edge.child_id) == ("child_map", MODEL, "model.shop.from_file")
    (meta,) = manifests.manifest_schema_version(manifest.meta).collect()
    assert (meta.project, meta.schema_token, meta.is_known) == ("shop", "v11", True)
    tags = {r.node_id: r.tags for r in manifest.nodes.collect()}
    assert tags[MODEL] == ["t"] and tags["model.shop.from_file"] is None


def test_expected_files_that_are_missing(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"nodes": {}}')
    (tmp_path / "b.json").write_text("[]")
    uris = [f"file://{tmp_path}/{name}.json" for name in ("a", "gone")]
    expected = spark.createDataFrame([(u,) for u in uris], "path string")
    found = manifests.read_manifests(spark, [str(tmp_path)], "r", expected)
    assert [(r.path, r.error) for r in found.rejects.collect()] == [(uris[1], "manifest not found")]
    assert found.meta.count() == 1
    assert manifests.read_optional_artifact(spark, [str(tmp_path)]).count() == 2


def test_schema_version_of_urls(spark):
    urls = ["https://a/v12.json", "https://a/v12.json/", "https://a/v9.json?x=1", "v3.json#y", "https://a/v12.yml", "https://a/x12.json", "", None, "https://v1.json/a"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, dbt_schema_version string")
    got = [(r.schema_token, r.is_known) for r in manifests.manifest_schema_version(df).orderBy("i").collect()]
    assert got == [("v12", True), ("v12", True), ("v9", True), ("v3", False), (None, False), (None, False), (None, False), (None, False), (None, False)]


def test_plan(planned):
    rows = {r.node_id: (r.eligible, r.skip_reason, r.sql, r.marker) for r in planned.collect()}
    assert rows[MODEL] == (True, None, SQL, None)
    assert rows["model.shop.from_file"][2:] == ("select 1; execute immediate q", "execute_immediate")
    assert rows["seed.shop.s"][:2] == (False, "seed (no SQL body)")


def test_document(written):
    doc = read_json(written)
    assert list(doc) == sorted(doc)
    assert doc["stats"] == {
        "coverage": 1.0, "failed": 1, "parsed": 1, "partial": 1, "resolved_columns": 2, "skipped": 1, "total_columns": 2, "unsupported": 0,
    }
    assert doc["manifest_metadata"]["eligible_count"] == 3 and doc["manifest_metadata"]["selected_count"] == 4
    nodes = {n["node_id"]: n for n in doc["nodes"]}
    assert [n["node_id"] for n in doc["nodes"]] == sorted(nodes)
    assert nodes[MODEL] == {
        "columns": [{"confidence": "low", "name": "*", "transform": "direct", "upstream": [
            {"column": "*", "table": "raw_items"}, {"column": "NAME", "table": "raw_items"}, {"column": "id", "table": "raw_items"}]}],
        "confidence": "high", "dialect": "dbvbigquery", "downstream": ["model.shop.from_file"], "node_id": MODEL,
        "status": "parsed", "unresolved": [], "upstream_tables": ["raw_items"], "warnings": [],
    }
    assert nodes["model.shop.from_file"]["status"] == "partial"
    assert nodes["model.shop.from_file"]["unresolved"] == [
        {"fragment_preview": "select 1; execute immediate q", "marker": "execute_immediate", "reason": "dynamic_sql"}
    ]
    assert nodes["model.shop.broken"]["unresolved"] == [{"detail": "x" * 200, "reason": "parser_error"}]
    assert nodes["seed.shop.s"]["unresolved"] == [{"detail": "seed (no SQL body)", "reason": "skipped"}]


def test_document_is_valid_and_reads_back(spark, written, mapped):
    text = json.dumps(read_json(written))
    docs = spark.createDataFrame([("shop", "r1", text)], "project string, run_id string, doc string")
    assert quality.validate_lineage(docs).count() == 0
    back = documents.parse_documents(docs)
    keep = [*KEY, "column", "up_table", "up_column"]
    assert sorted(back.edges.select(keep).collect()) == sorted(mapped.edges.select(keep).collect())
    assert {r.gate for r in P.check_documents(back, back, min_node_coverage=0.5, fail_on_unsupported=True).collect()} == {None}
    (bad,) = P.check_documents(back, fail_on_failed=True).collect()
    assert bad.message == "1 node(s) status=failed: model.shop.broken"
    headline, lines = P.diff_documents(back, back)
    assert lines.count() == 0 and headline.first().line.startswith("No regressions")


def test_document_table_replaces_single_runs(spark, manifest, mapped, tmp_path):
    children = attach_downstream(manifest.nodes, manifest.edges)
    hits = spark.createDataFrame([("shop", "r1", 3, 1, 75)], "project string, run_id string, hits long, misses long, hit_rate_pct long")
    meta = manifest.meta.drop("path", "generated_at")
    rows = P.render_table(mapped, children, meta, "colweave 1", {"mode": "anonymous", "parser_version": "4"}, hits)
    path = str(tmp_path / "table")
    emit.write_document_table(rows, path)
    emit.write_document_table(rows.withColumn("run_id", F.lit("20240101")), path)
    texts = spark.read.text(path)
    assert texts.count() == 8
    lines = texts.select("project", F.col("run_id").cast("string").alias("run_id"), F.col("value").alias("doc"))
    assert quality.validate_lineage(lines).count() == 0  # each line is a document
    # again with another line in it: the run is replaced, the other one stays
    emit.write_document_table(rows.where(F.col("node_id") == MODEL).union(rows.limit(1).withColumn("line", F.lit("{oops"))), path)
    back = documents.read_document_table(spark, path)
    assert {(r.run_id, r.node_id) for r in back.nodes.where("run_id = 'r1'").collect()} == {("r1", MODEL)}
    assert back.nodes.where("run_id = '20240101'").count() == 4
    assert [(r.run_id, r.error, r.text) for r in back.rejects.collect()] == [("r1", "document is not valid JSON", "{oops")]
    heads = {r.run_id: r for r in back.headers.collect()}
    assert set(heads) == {"r1", "20240101"} and heads["r1"].backend.parser_version == "4"
    assert heads["20240101"].stats.parsed == 1 and heads["r1"].backend.cache_stats.hits == 3
    (stated,) = P.check_documents(back, min_node_coverage=0.9).where("run_id = '20240101'").collect()
    assert stated.message == "node coverage 66.67% below required 90.00%"


def test_documents_that_are_none(spark):
    texts = ["{", "[]", '{"nodes": 3}', '{"nodes": []}', None, '{"nodes": [{"node_id": "a"}], "manifest_metadata": {"project_name": "named"}}']
    df = spark.createDataFrame([(None, f"r{i}", t) for i, t in enumerate(texts)], "project string, run_id string, doc string")
    back = documents.parse_documents(df)
    assert {r.run_id for r in back.rejects.collect()} == {"r0", "r1", "r2", "r4"}
    assert [(r.project, r.run_id, r.node_id) for r in back.nodes.collect()] == [("named", "r5", "a")]
    assert {(r.project, r.run_id) for r in back.headers.collect()} == {("unknown", "r3"), ("named", "r5")}


def test_missing_baseline_is_a_warning(spark):
    now = counts(spark, [("n", 0, 2)])
    (row,) = quality.gate_regression(now, now.limit(0)).collect()
    assert (row.gate, row.message) == ("baseline", "warning: baseline not found; skipping regression check")
    nodes = spark.createDataFrame([("p", "r", "n", "parsed", 1, 1)], "project string, run_id string, node_id string, status string, total_columns long, resolved_columns long")
    got = {(r.gate, r.message) for r in quality.check_run(quality.run_stats(nodes), nodes, 0.5, counts=(now, now.limit(0))).collect()}
    assert got == {(None, quality.ALL_PASSED), ("baseline", quality.NO_BASELINE)}


def test_catalog_payloads(mapped):
    proposals = [json.loads(r.payload) for r in emit.emit_datahub(mapped.nodes, mapped.columns, mapped.edges, mapped.tables).collect()]
    by_urn = {p["entityUrn"]: p for p in proposals}
    urn = f"urn:li:dataset:(urn:li:dataPlatform:bigquery,{MODEL},PROD)"
    source = "urn:li:dataset:(urn:li:dataPlatform:bigquery,raw_items,PROD)"
    assert len(by_urn) == 2
    aspect = by_urn[urn]["aspect"]["json"]
    assert aspect["upstreams"] == [{"auditStamp": {"actor": "urn:li:corpuser:colweave", "time": 0}, "dataset": source, "type": "TRANSFORMED"}]
    assert [f["upstreams"] for f in aspect["fineGrainedLineages"]] == [[f"urn:li:schemaField:({source},{c})"] for c in ("*", "NAME", "id")]
    assert {f["transformOperation"] for f in aspect["fineGrainedLineages"]} == {"direct"}
    requests = {json.loads(r.payload)["edge"]["toEntity"]["fullyQualifiedName"]: json.loads(r.payload) for r in
                emit.emit_openmetadata(mapped.nodes, mapped.edges, mapped.tables, "warehouse.main").collect()}
    assert requests[f"warehouse.main.{MODEL}"] == {"edge": {
        "fromEntity": {"fullyQualifiedName": "warehouse.main.raw_items", "type": "table"},
        "lineageDetails": {"columnsLineage": [{
            "fromColumns": [f"warehouse.main.raw_items.{c}" for c in ("*", "NAME", "id")], "toColumn": f"warehouse.main.{MODEL}.*"}]},
        "toEntity": {"fullyQualifiedName": f"warehouse.main.{MODEL}", "type": "table"},
    }}


def test_a_node_of_any_size_is_one_payload(spark, tmp_path):
    i = F.col("id")
    big = spark.range(50_000).select(F.lit("p").alias("project"), F.lit("r").alias("run_id"), F.lit("big").alias("node_id"), F.concat(F.lit("c"), i % 3).alias("column"), F.concat(F.lit("t"), i).alias("up_table"), F.lit("k").alias("up_column"))
    edges = big.unionByName(big.limit(1).withColumn("node_id", F.lit("small")))
    columns = edges.select(*KEY, F.col("column").alias("name"), F.lit("direct").alias("transform"), F.lit("high").alias("confidence")).distinct()
    nodes = columns.select(*KEY, F.lit("parsed").alias("status"), F.lit("high").alias("confidence"), F.lit("dbvspark").alias("dialect")).distinct()
    tables = edges.select(*KEY, F.col("up_table").alias("fqn")).distinct()
    none = spark.createDataFrame([], "project string, run_id string, node_id string, child_id string")
    reasons = spark.createDataFrame([], "project string, run_id string, node_id string, section int, ord long, src_ord long, reason string, target_column string, rel_type string, source_parent_id string, line long, col long, parser_message string, marker string, fragment_preview string, detail string")
    docs = emit.render_lineage_doc(nodes, columns, edges, tables, none, reasons)
    assert sorted(r.node_id for r in docs.collect()) == ["big", "small"]
    assert documents.parse_node_lines(docs).edges.count() == 50_001
    fine = emit.emit_datahub(nodes, columns, edges, tables)
    (row,) = fine.where("node_id = 'big'").collect()
    assert len(json.loads(row.payload)["aspect"]["json"]["fineGrainedLineages"]) == 50_000
    path = str(tmp_path / "out")
    emit.write_payloads(fine, path)
    emit.write_payloads(fine.withColumn("run_id", F.lit("r2")), path)  # leaves the other run alone
    assert {r.run_id: r.n for r in spark.read.text(path).groupBy("run_id").agg(F.count("*").alias("n")).collect()} == {"r": 2, "r2": 2}


def test_evidence_in_document(spark):
    key = "project string, run_id string, node_id string"
    one = spark.createDataFrame([("p", "r", "n", "parsed", "high", None)], f"{key}, status string, confidence string, dialect string")
    empty = lambda extra: spark.createDataFrame([], f"{key}, {extra}")
    writes = spark.createDataFrame(
        [("p", "r", "n", "t1", "a", "s", "x", "temp_table", 4), ("p", "r", "n", "t1", "a", "s", "y", "temp_table", 4), ("p", "r", "n", "t0", "b", "s", "x", None, 4)],
        f"{key}, target_fqn string, target_col string, up_table string, up_column string, sub_type string, process_count long",
    )
    diags = spark.createDataFrame([("p", "r", "n", 0, "Hint", None, None, 3, None, "m")], f"{key}, err_ord long, type string, category string, near_column string, line long, col long, message string")
    reason = "section int, ord long, src_ord long, reason string, target_column string, rel_type string, source_parent_id string, line long, col long, parser_message string, marker string, fragment_preview string, detail string"
    (row,) = emit.render_lineage_doc(
        one, empty("name string, transform string, confidence string"), empty("column string, up_table string, up_column string"),
        empty("fqn string"), empty("child_id string"), empty(reason), diags, writes,
    ).collect()
    assert json.loads(row.doc)["evidence"] == {
        "parser_diagnostics": [{"line": 3, "message": "m", "type": "Hint"}],
        "procedural": {"column_edge_count": 3, "process_count": 4, "write_target_count": 2, "write_targets": [
            {"columns": ["b"], "edges": [{"from": {"column": "x", "table": "s"}, "target_column": "b"}], "from": ["s"], "table": "t0"},
            {"columns": ["a"], "edges": [{"from": {"column": c, "table": "s"}, "target_column": "a"} for c in "xy"], "from": ["s"], "subType": "temp_table", "table": "t1"},
        ]},
    }


def doc_of(node="n", **change):
    column = {"name": "c", "upstream": [{"table": "t", "column": "k"}], "confidence": "high", "transform": "direct"} | change.pop("column", {})
    base = {
        "schema_version": "0.2.x", "generator": "g", "backend": {"mode": "m"}, "stats": {},
        "manifest_metadata": {"dbt_version": "1", "project_name": "p", "selected_count": 1, "eligible_count": 1},
        "nodes": [{"node_id": node, "status": "parsed", "columns": [column]} | change.pop("node_fields", {})],
    }
    return {k: v for k, v in (base | change).items() if v is not None}


@pytest.mark.parametrize(
    "doc, violations",
    [
        (doc_of(), set()),
        (doc_of(anything=1, node_fields={"evidence": {}, "dialect": None}), set()),
        (doc_of(generator=None), {("$.generator", "required")}),
        (doc_of(node_fields={"status": "odd"}), {("$.nodes.0.status", "enum")}),
        (doc_of(node_fields={"confidence": "sure"}), {("$.nodes.0.confidence", "enum")}),
        (doc_of(node=5), {("$.nodes.0.node_id", "type")}),
        (doc_of(node_fields={"warnings": [1]}), {("$.nodes.0.warnings.0", "type")}),
        (doc_of(node_fields={"unresolved": ["x"]}), {("$.nodes.0.unresolved.0", "type")}),
        (doc_of(column={"upstreams": []}), {("$.nodes.0.columns.0.", "additional field")}),
        (doc_of(column={"upstream": [{"table": "t", "column": "k", "x": 1}]}), {("$.nodes.0.columns.0.upstream.0.", "additional field")}),
        (doc_of(stats={"coverage": 1.2, "parsed": -1}), {("$.stats.coverage", "range"), ("$.stats.parsed", "range")}),
        (doc_of(manifest_metadata={"dbt_version": "1"}), {(f"$.manifest_metadata.{f}", "required") for f in ("project_name", "selected_count", "eligible_count")}),
        ([], {("$", "object")}),
    ],
)
def test_validation(spark, doc, violations):
    df = spark.createDataFrame([("p", "r", json.dumps(doc))], "project string, run_id string, doc string")
    assert {(r.path, r.rule) for r in quality.validate_lineage(df).collect()} == violations


def counts(spark, rows):
    return spark.createDataFrame([("p", "r", *r) for r in rows], "project string, run_id string, node_id string, node_ord int, n_edges long")


def test_regressions(spark):
    base = counts(spark, [("same", 0, 2), ("less", 0, 3), ("gone", 0, 1), ("twice", 0, 9), ("twice", 1, 1), ("none", 0, 1)])
    now = counts(spark, [("same", 0, 2), ("less", 0, 1), ("new", 0, 5), ("twice", 0, 1), ("none", 0, 0)])
    lost = compare.edge_count_regressions(now, base)
    assert sorted((r.node_id, r.edges_lost, r.current, r.baseline) for r in lost.collect()) == [("less", 2, 1, 3), ("none", 1, 0, 1)]
    assert sorted(r.line for r in compare.diff_report(lost).collect()) == ["  less: 3 -> 1 (-2)", "  none: 1 -> 0 (-1)"]
    assert quality.gate_regression(now, base).first().message == "2 regression(s) vs baseline: less, none"


def test_gate_messages(spark):
    rows = [("p", "r", f"n{i}", "failed" if i < 7 else "parsed", 4, 1) for i in range(10)]
    nodes = spark.createDataFrame(rows, "project string, run_id string, node_id string, status string, total_columns long, resolved_columns long")
    stats = quality.run_stats(nodes)
    got = {r.gate: r.message for r in quality.check_run(stats, nodes, 0.5, 0.75, True, True).collect()}
    assert got == {
        "node_coverage": "node coverage 30.00% below required 50.00%",
        "column_coverage": "column coverage 25.00% below required 75.00%",
        "failed": "7 node(s) status=failed: n0, n1, n2, n3, n4...",
    }
    empty = quality.run_stats(nodes.withColumn("status", F.lit("skipped")).withColumn("total_columns", F.lit(0)).withColumn("resolved_columns", F.lit(0)))
    (row,) = quality.node_coverage(empty).collect()
    assert (row.coverage, row.node_coverage) == (0.0, 1.0)
    assert quality.run_summary(stats).first().summary == "wrote lineage — 3 parsed, 0 partial, 7 failed, 0 skipped, coverage 25%"


def test_fingerprints_see_content_not_order(spark):
    rows = [("r1", "a", "t", "k"), ("r1", "b", "t", "k"), ("r2", "b", "t", "k"), ("r2", "a", "t", "k"), ("r3", "a", "t", "k")]
    df = spark.createDataFrame([("p", r, "n", *x) for r, *x in rows], "project string, run_id string, node_id string, column string, up_table string, up_column string")
    got = {r.run_id: r.fingerprint for r in compare.content_fingerprint(df, ["column", "up_table", "up_column"]).collect()}
    assert got["r1"] == got["r2"] != got["r3"]
    assert set(RUN) < set(KEY)


def test_citations(spark):
    from colweave.operators.citations import cited_ids, citation_lint

    texts = [(1, "We cite E03 and E07, E03 again. E99 is external."), (2, "E033 is not it, xE03 neither; see (E05)."), (3, "none")]
    texts = spark.createDataFrame(texts, "doc_id int, text string")
    index = spark.createDataFrame([("E03", "active"), ("E05", "manual-active"), ("E07", "regression"), ("E08", None)], "id string, label string")
    assert sorted((r.doc_id, r.id) for r in cited_ids(texts, index).collect()) == [(1, "E03"), (1, "E07"), (2, "E05")]
    got = {(r.doc_id, r.id): (r.passes, r.message) for r in citation_lint(texts, index).collect()}
    assert got[1, "E03"] == (True, "E03 (active)")
    assert got[1, "E07"] == (False, "E07 (regression) — must be active/framework-active/manual-active")
