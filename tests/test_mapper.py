"""Parser responses to lineage, case by case, and the same with shuffled input."""

import json

import pytest
from pyspark.sql import functions as F

from colweave.operators import evidence, mapper
from colweave.session import KEY
from colweave.sources import responses as R


def tree(tables=(), views=(), others=(), server="", db="", schema=""):
    schema = {"name": schema, "tables": list(tables), "views": list(views), "others": list(others)}
    return {"servers": [{"name": server, "databases": [{"name": db, "schemas": [schema]}]}]}


def table(tid, name, **more):
    return {"id": tid, "name": name, **more}


def rel(kind, target, *sources):
    end = lambda pair: {"parentId": pair[0], "column": pair[1]}
    return {"type": kind, "target": end(target), "sources": [end(s) for s in sources]}


SRC, RS = table("1", "src"), table("2", "RS-1")
ONE = tree(tables=[SRC], others=[RS])
# a script that fills three tables; two of them from one result set, which itself reads another
MILL = tree(
    tables=[table("w1", "flour", subType="temp_table"), table("w2", "bran"), table("w3", "waste", subType=""), table("g", "grain"), table("d", "dust")],
    others=[table("ra", "RS-11"), table("rb", "RS-12")],
)
ORPHAN = "find orphan column(10500) near: "

CASES = {
    "empty": {},
    # two sources of one column, by two kinds of relationship
    "pair": {
        "dbobjs": tree(tables=[table("u", "tide"), table("v", "moon")], others=[table("o", "RS-7")], server="coast", db="log", schema="sea"),
        "relationships": [rel("fdc", ("o", "level"), ("v", "phase"), ("u", "height")), rel("fdd", ("o", "level"), ("u", "height"))],
    },
    "defaults": {
        "dbobjs": tree(views=[table("k", "barns")], server="DEFAULT_SERVER", db="DEFAULT", schema="land"),
        "relationships": [],
    },
    "unknown_source": {"dbobjs": tree(others=[RS]), "relationships": [rel("fdd", ("2", "id"), ("999", "id"))]},
    "synthetic": {
        "dbobjs": ONE,
        "relationships": [
            rel("fdd", ("2", "id"), ("1", "id")),
            rel("fdd", ("2", "COUNT"), ("1", "id")),
            rel("fdd", ("2", "COUNT(1)"), ("1", "id")),
            rel("fdr", ("2", "RELATIONROWS"), ("1", "id")),
        ],
    },
    "procedural": {
        "dbobjs": MILL,
        "relationships": [
            # both from the result set ra, whose column reads grain itself and the result set rb
            rel("FDD", ("w2", "kg"), ("ra", "sum_kg")),
            rel("fdd", ("w1", "kg"), ("ra", "sum_kg")),
            rel("fdd", ("ra", "sum_kg"), ("g", "kg"), ("rb", "part")),
            # behind two result sets: one hop more than evidence follows
            rel("fdd", ("rb", "part"), ("d", "kg")),
            rel("fdd", ("w3", "note"), ("d", "note")),
            # neither a star, nor a condition, nor an unknown source is a write
            rel("fdd", ("w3", "*"), ("d", "*")), rel("fdr", ("w3", "why"), ("d", "note")), rel("fdd", ("w2", "lost"), ("nowhere", "x")),
            # later, and from a real table: the same edge comes twice
            rel("fdd", ("w1", "kg"), ("g", "kg")),
        ],
        "processes": [],
    },
    # one target, but two processes; and one of each
    "two_processes": {
        "dbobjs": tree(tables=[table("p", "press"), table("l", "olives")]),
        "relationships": [rel("fdd", ("p", "oil"), ("l", "oil"))],
        "processes": [1, 2],
    },
    "one_of_each": {
        "dbobjs": tree(tables=[table("p", "press"), table("l", "olives")]),
        "relationships": [rel("fdd", ("p", "oil"), ("l", "oil")), rel("fdd", ("p", "pulp"), ("l", "oil"))],
        "processes": [1],
    },
    # the name in another case than the column; the first of two messages counts
    "orphan": {
        "dbobjs": tree(tables=[table("b", "boats")], others=[table("q", "RS-2")]),
        "relationships": [rel("fda", ("q", "HARBOUR"), ("lost", "h")), rel("fdd", ("q", "Mast"), ("lost", "m")), rel("fdd", ("q", "keel"), ("b", "keel"))],
        "errors": [
            {"errorMessage": "odd"}, {"errorMessage": ORPHAN.upper() + "harbour ( 9, 1 )"}, {"errorMessage": ORPHAN + "harbour(7 , 30)", "errorType": ""},
            {"errorMessage": ORPHAN + "[HARBOUR](8,2)", "errorType": "Hint"},
        ],
    },
    "untraced": {
        "dbobjs": ONE,
        "relationships": [rel("fdd", ("2", "id"), ("1", "id")), rel("fdd", ("2", "derived"), ("999", "x"))],
    },
    "malformed": {
        "dbobjs": ONE,
        "relationships": [rel("fdd", ("2", "id"), ("1", "id"))],
        "errors": [
            "text", None, {"errorMessage": None, "errorType": "Hint"}, {"errorMessage": 42},
            {"errorMessage": ORPHAN + "[X](2,1)", "originCoordinates": {"x": 2, "y": 1}},
            {"errorMessage": "warning", "originCoordinates": [{}]},
        ],
    },
    "not_a_list": {"dbobjs": ONE, "relationships": [], "errors": {"errorMessage": "no list"}},
    "exact_name": {
        "dbobjs": ONE,
        "relationships": [rel("fdd", ("2", "MyCol"), ("999", "x"))],
        "errors": [
            {"errorMessage": ORPHAN + "[mycol](1,1)"}, {"errorMessage": ORPHAN + "[MyCol](3,5)"},
        ],
    },
    "hint": {
        "dbobjs": ONE,
        "relationships": [rel("fdd", ("2", "id"), ("1", "id"))],
        "errors": [{"errorType": "SyntaxHint", "errorMessage": "expected GO", "originCoordinates": [{"x": 3, "y": 1}]}],
    },
    "control": {"dbobjs": ONE, "relationships": [rel("fdr", ("2", "x"), ("1", "id"))]},
    # the first group of a name gives transform and confidence, the upstreams unite
    "merged": {
        "dbobjs": tree(tables=[SRC], others=[RS, table("3", "RS-2")]),
        "relationships": [
            rel("fda", ("2", "c"), ("3", "q")),
            rel("fdd", ("3", "c"), ("1", "a"), ("1", "b")),
            rel("fdd", ("3", "c"), ("1", "a")),
        ],
    },
    # the last table of an id counts; numbers are ids too
    "duplicate_id": {
        "dbobjs": tree(tables=[table(7, "old"), table(7, "", displayName="shown")]),
        "relationships": [rel("fdd", (7, "*"), (7, "k"))],
    },
    "no_sources": {"dbobjs": ONE, "relationships": [rel("FDC", ("2", "e"))]},
}


def run(spark, shuffled=False):
    rows = [("p", "r", name, json.dumps({"code": 200, "data": {"sqlflow": flow}})) for name, flow in CASES.items()]
    raw = spark.createDataFrame(rows, "project string, run_id string, node_id string, payload string")
    flows = R.normalize_responses(raw)
    tables, lines, diags = R.explode_dbobjs(flows), R.explode_relationships(flows), R.explode_diagnostics(flows)
    if shuffled:
        tables, lines, diags = (d.repartition(7, F.rand(5)).sortWithinPartitions(F.rand(6)) for d in (tables, lines, diags))
    resolved = mapper.resolve_lines(lines, tables)
    grouped = mapper.group_edges(resolved)
    columns = mapper.lineage_columns(grouped)
    out = {
        "status": mapper.node_status(flows, columns, tables),
        "columns": columns,
        "edges": mapper.lineage_edges(grouped),
        "tables": mapper.upstream_tables(tables),
        "unresolved": mapper.unresolved_rows(resolved, columns, diags),
        "diagnostics": diags,
        "writes": evidence.procedural_write_targets(resolved, tables, R.process_counts(flows)),
    }
    return {name: sorted(map(tuple, df.drop("project", "run_id").collect()), key=repr) for name, df in out.items()}


@pytest.fixture(scope="module")
def result(spark):
    return run(spark)


def of(result, what, node):
    return [r[1:] for r in result[what] if r[0] == node]


def test_empty_response(result):
    assert of(result, "status", "empty") == [("unsupported", "low", 0, 0)]


def test_two_sources_of_a_column(result):
    assert of(result, "status", "pair") == [("parsed", "high", 1, 1)]
    assert of(result, "columns", "pair") == [("level", "expression", "high", True)]
    assert of(result, "edges", "pair") == [("level", "coast.log.sea.moon", "phase"), ("level", "coast.log.sea.tide", "height")]
    assert of(result, "tables", "pair") == [("coast.log.sea.moon",), ("coast.log.sea.tide",)]


def test_default_names_are_blank(result):
    assert of(result, "tables", "defaults") == [("land.barns",)]
    assert of(result, "status", "defaults") == [("partial", "low", 0, 0)]


def test_unknown_source_is_no_edge(result):
    assert of(result, "edges", "unknown_source") == []
    reasons = {r[3] for r in of(result, "unresolved", "unknown_source")}
    assert reasons == {"source_table_unknown", "upstream_unresolved"}


def test_synthetic_columns_drop_out(result):
    assert of(result, "columns", "synthetic") == [("id", "direct", "high", True)]


def test_procedural_evidence(result):
    rows = of(result, "writes", "procedural")
    assert [r[:4] for r in rows] == [("bran", "kg", "grain", "kg"), ("flour", "kg", "grain", "kg"), ("waste", "note", "dust", "note")]
    assert [r[4:] for r in rows] == [(3, 3, 0, None), (3, 3, 0, "temp_table"), (3, 3, 0, "")]
    assert of(result, "writes", "two_processes") == [("press", "oil", "olives", "oil", 1, 1, 2, None)]
    assert of(result, "writes", "one_of_each") == []


def test_orphan_column(result):
    found = [(r[0], r[1], r[3], r[4], r[5]) for r in of(result, "diagnostics", "orphan")]
    # blanks are allowed before the comma but not after the bracket
    assert found == [(0, "Hint", None, None, None), (1, "Hint", None, None, None), (2, "SyntaxHint", "harbour", 7, 30), (3, "Hint", "HARBOUR", 8, 2)]
    rows = [r for r in of(result, "unresolved", "orphan") if r[3] == "parser_orphan_column"]
    assert [(r[4], r[7], r[8]) for r in rows] == [("HARBOUR", 7, 30)]
    assert ("Mast", "upstream_unresolved") in {(r[4], r[3]) for r in of(result, "unresolved", "orphan")}


def test_untraced_column(result):
    assert ("derived", "direct", "low", False) in of(result, "columns", "untraced")
    assert of(result, "status", "untraced") == [("parsed", "medium", 2, 1)]
    assert {r[3] for r in of(result, "unresolved", "untraced")} == {"upstream_unresolved", "source_table_unknown"}


def test_malformed_errors(result):
    kinds = [(r[0], r[1], r[2]) for r in of(result, "diagnostics", "malformed")]
    assert kinds == [(4, "SyntaxHint", "orphan_column"), (5, "Hint", None)]
    assert of(result, "diagnostics", "not_a_list") == []


def test_exact_name_before_upper(result):
    rows = [r for r in of(result, "unresolved", "exact_name") if r[3] == "parser_orphan_column"]
    assert [r[9] for r in rows] == [ORPHAN + "[MyCol](3,5)"]


def test_generic_hint(result):
    rows = [r for r in of(result, "unresolved", "hint") if r[3] == "parser_syntax_hint"]
    assert [(r[7], r[8], r[9]) for r in rows] == [(3, 1, "expected GO")]


def test_control(result):
    assert of(result, "columns", "control") == [("x", "control", "medium", True)]


def test_first_group_wins_and_upstreams_unite(result):
    assert of(result, "columns", "merged") == [("c", "aggregate", "low", True)]
    assert of(result, "edges", "merged") == [("c", "src", "a"), ("c", "src", "b")]


def test_last_table_of_an_id_counts(result):
    assert of(result, "tables", "duplicate_id") == [("shown",)]
    assert of(result, "columns", "duplicate_id") == []


def test_group_without_sources(result):
    assert of(result, "columns", "no_sources") == [("e", "expression", "low", False)]


def test_arrival_order_does_not_matter(spark, result):
    assert run(spark, shuffled=True) == result


def test_invariants(result):
    tables = set(result["tables"])
    for node, _, up_table, up_column in result["edges"]:
        assert (node, up_table) in tables and up_column
    for _, _, _, total, resolved in result["status"]:
        assert 0 <= resolved <= total


def test_large_ordinals_are_exact(spark):
    """Ordinals far beyond the precision of a double still decide which relationship is first."""
    big = 2**55
    rows = [("p", "r", "n", big + i, kind, "RS", "c", 0, "T", f"k{i}") for i, kind in enumerate(["fda", "fdc", "fdd"])]
    lines = spark.createDataFrame(
        rows[::-1],
        "project string, run_id string, node_id string, rel_ord long, rel_type string, target_parent_id string,"
        "target_col string, src_ord long, source_parent_id string, source_col string",
    )
    tables = spark.createDataFrame(
        [("p", "r", "n", "RS", "RS-1", False), ("p", "r", "n", "T", "t", True)],
        "project string, run_id string, node_id string, table_id string, fqn string, is_real boolean",
    )
    grouped = mapper.group_edges(mapper.resolve_lines(lines, tables))
    (row,) = mapper.lineage_columns(grouped).collect()
    assert (row.transform, row.confidence) == ("aggregate", "high")
    (group,) = mapper.accumulate_target_columns(grouped).collect()
    assert (group.first_ord, group.n_upstream) == (big, 3)


def test_dynamic_sql(spark):
    statuses = spark.createDataFrame(
        [("p", "r", "a", "parsed", "high"), ("p", "r", "b", "parsed", "high"), ("p", "r", "c", "unsupported", "low")],
        "project string, run_id string, node_id string, status string, confidence string",
    )
    sqls = spark.createDataFrame(
        [("p", "r", "a", "select 1"), ("p", "r", "b", "begin Execute  x; execute immediate y"), ("p", "r", "c", "EXEC sp_executesql @s")],
        "project string, run_id string, node_id string, sql string",
    )
    got = {r.node_id: (r.status, r.confidence) for r in mapper.apply_dynamic_sql(statuses, sqls).collect()}
    assert got == {"a": ("parsed", "high"), "b": ("partial", "low"), "c": ("unsupported", "low")}
    rows = {r.node_id: (r.marker, r.fragment_preview) for r in mapper.dynamic_sql_rows(sqls).collect()}
    assert rows["b"] == ("execute_immediate", "begin Execute  x; execute immediate y")
    assert rows["c"] == ("sp_executesql", "EXEC sp_executesql @s")
    assert set(KEY) <= set(statuses.columns)
