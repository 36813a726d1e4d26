"""Paths, tags, column and status comparison, node state, reads and writes, the response cache."""

import pytest
from pyspark.sql import functions as F

from colweave.operators import cache, compare, evidence, mapper, paths, state
from colweave.session import cut_lineage
from colweave.sources import responses as R
from colweave.streaming import runs

LINES = (
    "project string, run_id string, node_id string, rel_ord long, rel_type string, target_parent_id string, target_col string,"
    "src_ord long, source_parent_id string, source_col string"
)
TABLES = (
    "project string, run_id string, node_id string, table_id string, collection string, server string, db string, schema_name string,"
    "name string, sub_type string"
)
EDGES = "project string, node_id string, column string, up_table string, up_column string"


def resolved(spark, steps, node="n"):
    """Lines from (type, target, source) with table.column; tables named R... are result sets."""
    rows = []
    for i, (kind, target, source) in enumerate(steps):
        rows.append(("p", "r", node, i, kind, *target.split("."), 0, *source.split(".")))
    ids = sorted({x.split(".")[0] for _, t, s in steps for x in (t, s)} - {"gone"})
    tables = [("p", "r", node, t, "others" if t.startswith("R") else "tables", "", "", "", f"RS-{t}" if t.startswith("R") else t, None) for t in ids]
    described = R.describe_tables(spark.createDataFrame(tables, TABLES))
    return mapper.resolve_lines(spark.createDataFrame(rows, LINES), described), described


def traced(spark, steps):
    return {(r.target_fqn, r.target_col, r.up_table, r.up_column): (r.depth, r.transform) for r in paths.trace_multi_hop(resolved(spark, steps)[0]).collect()}


def test_sources_behind_any_number_of_result_sets(spark):
    chain = [("fdd", "t.a", "R0.a")] + [("fda" if k == 3 else "fdd", f"R{k}.a", f"R{k + 1}.a") for k in range(12)] + [("fdc", "R12.a", "s.x")]
    found = traced(spark, chain)
    assert found["t", "a", "s", "x"] == (14, "aggregate")
    assert found["RS-R12", "a", "s", "x"] == (1, "expression")
    assert len(found) == 14


def test_cycles_end_and_the_least_path_counts(spark):
    steps = [
        ("fdd", "t.a", "R1.a"), ("fdd", "R1.a", "R2.a"), ("fdd", "R2.a", "R1.a"), ("fdd", "R2.a", "R2.a"), ("fdd", "R2.a", "s.x"),
        ("fda", "R1.a", "s.x"), ("fdr", "t.b", "R3.b"), ("fdd", "R3.b", "gone.b"), ("fdd", "t.c", "R1.A"),
        # two ways of one length: the weaker transform is told
        ("fdd", "t.d", "R4.d"), ("fda", "R4.d", "R6.d"), ("fdd", "t.d", "R5.d"), ("fdc", "R5.d", "R6.d"), ("fdd", "R6.d", "s.d"),
    ]
    found = {k[1:]: v for k, v in traced(spark, steps).items() if k[0] == "t"}
    assert found == {("a", "s", "x"): (2, "aggregate"), ("d", "s", "d"): (3, "expression")}


def test_the_walk_holds_no_more_than_the_result(spark):
    # a target whose ways end nowhere, and one with a real source behind two result sets (F6)
    steps = [("fdd", "t.a", "R0.a"), *[("fdd", f"R{k}.a", f"R{k + 1}.a") for k in range(6)], ("fdd", "t.b", "R8.b"), ("fda", "R8.b", "R9.b"), ("fdd", "R9.b", "s.x")]
    held = []

    def cut(df):
        held.append((df.columns, df.count()))
        return cut_lineage(df)

    found = paths.trace_multi_hop(resolved(spark, steps)[0], cut).collect()
    assert {(r.target_col, r.depth, r.transform) for r in found if r.target_fqn == "t"} == {("b", 3, "aggregate")}
    assert sum(n for columns, n in held if "depth" in columns) == len(found) == 3


def test_tags_pass_steps_but_those_that_stop_them(spark):
    col = "project string, run_id string"
    steps = spark.createDataFrame(
        [("p", "r", *a.split("."), *b.split("."), t) for a, b, t in [
            ("a.x", "b.x", "direct"), ("b.x", "c.x", "aggregate"), ("b.x", "c.y", "expression"), ("c.y", "a.x", "direct"), ("a.x", "d.x", "control"),
            ("c.y", "d.y", None), ("a.x", "c.y", "direct"), ("a.x", "c.y", "aggregate"),
        ]],
        f"{col}, src_table string, src_column string, dst_table string, dst_column string, transform string",
    )
    tags = spark.createDataFrame([("p", "r", "a", "x", "pii"), ("p", "r", "b", "x", "vat"), ("p", "r", "b", "x", "vat"), ("q", "r", "a", "x", "pii")], f"{col}, table string, column string, tag string")
    found = {(r.project, f"{r.table}.{r.column}", r.tag): r.depth for r in paths.propagate_tags(tags, steps, {"pii": ["aggregate"]}).collect()}
    assert found == {
        ("p", "a.x", "pii"): 0, ("p", "b.x", "pii"): 1, ("p", "c.y", "pii"): 1, ("p", "d.y", "pii"): 2,
        ("p", "b.x", "vat"): 0, ("p", "c.x", "vat"): 1, ("p", "c.y", "vat"): 1, ("p", "a.x", "vat"): 2, ("p", "d.y", "vat"): 2,
        ("q", "a.x", "pii"): 0,
    }
    assert paths.propagate_tags(tags.limit(0), steps).count() == 0


def test_steps_between_columns_of_tables(spark):
    key = "project string, run_id string, node_id string"
    nodes = spark.createDataFrame([("p", "r", "m", "db.m")], f"{key}, fqn string")
    columns = spark.createDataFrame([("p", "r", "m", "c", "aggregate", "high", True)], f"{key}, name string, transform string, confidence string, has_upstream boolean")
    edges = spark.createDataFrame([("p", "r", "m", "c", "db.s", "k")], f"{key}, column string, up_table string, up_column string")
    assert [tuple(r) for r in paths.column_steps(nodes, columns, edges).collect()] == [("p", "r", "db.s", "k", "db.m", "c", "aggregate")]


def edges(spark, text):
    """Edges from `column:table.column,... ...`, a node per line."""
    rows = []
    for node, line in enumerate(text.strip().splitlines()):
        for item in line.split():
            column, ups = item.split(":")
            rows += [("p", f"n{node}", column, *(u.split(".") if "." in u else (u, None))) for u in ups.split(",")]
    return spark.createDataFrame(rows, EDGES)


def test_renames_swaps_and_losses_are_told_apart(spark):
    before = edges(spark, """
        a:t.x,t.y b:t.z
        a:t.x b:t.y c:t.z
        a:t.x b:t.y c:t.z
        a:t.x b:t.x c:t.x
        a:t.x b:t.y
        a:t.x b:t.y""")
    now = edges(spark, """
        new:t.y,t.x b:t.z
        a:t.y b:t.x c:t.z
        b:t.x c:t.y a:t.z
        c:t.x d:t.x
        a:t.x b:t.q more:u
        b:t.x a:t.q""")
    found = {(r.node_id, r.old_name, r.new_name): r.kind for r in compare.renamed_columns(now, before).collect()}
    assert found == {
        ("n0", "a", "new"): "renamed",
        ("n1", "a", "b"): "swapped", ("n1", "b", "a"): "swapped",
        ("n2", "a", "b"): "moved", ("n2", "b", "c"): "moved", ("n2", "c", "a"): "moved",
        ("n3", "a", "d"): "renamed", ("n3", "b", None): "lost",  # c stays; of two that could be d, the first by name
        ("n4", "b", None): "changed", ("n4", None, "more"): "added",
        ("n5", "a", "b"): "moved", ("n5", "b", None): "changed", ("n5", None, "a"): "replaced",
    }
    assert compare.renamed_columns(now, now).count() == 0


def test_column_diff_lists_what_differs(spark):
    before = edges(spark, "a:t.x,t.y,u b:t.z gone:t.w same:t.s\nk:t.k")
    now = edges(spark, "a:t.x,v.y,u b:t.z,t.q more:t.w same:t.s")
    names = lambda e: e.select("project", "node_id", F.col("column").alias("name")).unionByName(
        spark.createDataFrame([("p", "n0", "bare")], "project string, node_id string, name string"))
    diff = compare.column_diff(names(now), now, names(before).where("name <> 'bare'"), before)
    found = {r.column: (r.change, r.severity, [tuple(u) for u in r.lost_upstream], [tuple(u) for u in r.added_upstream]) for r in diff.collect()}
    assert found == {
        "a": ("changed", "regression", [("t", "y")], [("v", "y")]),
        "b": ("changed", "addition", [], [("t", "q")]),
        "gone": ("column_lost", "regression", [("t", "w")], []),
        "more": ("column_added", "addition", [], [("t", "w")]),
        "bare": ("column_added", "addition", [], []),
    }
    report = {r.column: r.line for r in compare.column_diff_report(diff).collect()}
    assert report["a"] == "  n0.a: changed -[t.y] +[v.y]" and report["bare"] == "  n0.bare: column_added"


def test_statuses_that_got_worse(spark):
    schema = "project string, run_id string, node_id string, status string"
    now = [("failed", "a"), ("partial", "b"), ("parsed", "c"), ("skipped", "d"), ("failed", "e"), ("failed", "f"), ("failed", "new")]
    old = [("parsed", "a"), ("partial", "b"), ("failed", "c"), ("parsed", "d"), ("unsupported", "e"), ("skipped", "f"), ("failed", "a")]
    frame = lambda rows: spark.createDataFrame([("p", "r", n, s) for s, n in rows], schema)
    found = sorted((r.node_id, r.baseline, r.current, r.severity) for r in compare.status_regressions(frame(now), frame(old)).collect())
    assert found == [("a", "parsed", "failed", "high"), ("e", "unsupported", "failed", "medium")]


def test_changed_nodes_and_what_depends_on_them(spark, tmp_path):
    schema = "project string, run_id string, node_id string, name string, resource_type string, compiled_code string, tags array<string>"
    old = [("a", "select 1", None), ("b", "select  2", ["x"]), ("c", "select 3", None), ("d", "select 4", None), ("lost", "select 5", None), ("e", None, None)]
    new = [("a", "select 9", None), ("b", " select 2", ["x"]), ("c", "select 3", None), ("d", "select 4", None), ("fresh", "select 6", None), ("e", None, ["t"]), ("z", "", None)]
    frame = lambda rows, run: spark.createDataFrame([("p", run, n, n, "model", s, t) for n, s, t in rows], schema)
    path = str(tmp_path / "state")
    state.write_state(state.node_state(frame(old + [("z", "", None)], "r1")), path)
    state.write_state(state.node_state(frame(old[:2], "r0")), path)
    earlier = state.read_state(spark, path, "r1")
    assert state.read_state(spark, path).count() == 9
    now = frame(new, "r2")
    edges = spark.createDataFrame([("p", "r2", a, b) for a, b in [("a", "c"), ("lost", "d"), ("c", "source.x"), ("b", "b"), ("fresh", "e")]], "project string, run_id string, parent_id string, child_id string")
    found = {r.node_id: r.reason for r in state.state_modified(now, edges, earlier).collect()}
    assert found == {"a": "changed", "fresh": "added", "e": "changed", "c": "downstream", "d": "downstream"}
    changes = {r.node_id: r.change for r in state.state_changes(state.node_state(now), earlier).collect()}
    assert changes["lost"] == "removed" and changes["b"] == changes["z"] == "same"
    assert {r.reason for r in state.state_modified(now, edges, earlier, downstream=False).collect()} == {"added", "changed"}


def test_tables_that_are_read_and_written(spark):
    lines, tables = resolved(spark, [("fdd", "t.a", "s.a"), ("fdd", "u.a", "t.a"), ("fdr", "v.a", "s.a"), ("fdd", "R1.a", "w.a")])
    found = {r.fqn: r.role for r in evidence.split_reads_writes(lines, tables).collect()}
    assert found == {"t": "read_write", "u": "write", "v": "read", "s": "read", "w": "read"}


def stored(spark, path):
    return sorted((r.cache_key, r.payload) for r in cache.read_response_cache(spark, path).collect())


def test_cache_holds_one_row_per_key(spark, tmp_path):
    path = str(tmp_path / "cache")
    with pytest.raises(FileNotFoundError):
        cache.read_response_cache(spark, path)
    frame = lambda rows: spark.createDataFrame(rows, "cache_key string, payload string")
    cache.write_response_cache(frame([("aa1", "x"), ("aa1", "x"), ("ab1", "y"), ("001", "z")]), path)
    assert stored(spark, path) == [("001", "z"), ("aa1", "x"), ("ab1", "y")]
    files = lambda: {str(f): f.stat().st_mtime_ns for f in (tmp_path / "cache").rglob("*.parquet")}
    before = files()
    cache.write_response_cache(frame([("aa1", "new"), ("aa2", None), ("001", "z")]), path)
    assert stored(spark, path) == [("001", "z"), ("aa1", "new"), ("aa2", None), ("ab1", "y")]
    assert spark.read.parquet(path).count() == 4  # on disk, without any aggregate
    kept = {f for f, t in files().items() if before.get(f) == t}
    assert {f.split("bucket=")[1][:2] for f in kept} == {"00", "ab"}  # only one directory was written again
    cache.write_response_cache(frame([("aa1", "new")]), path)
    assert stored(spark, path) == [("001", "z"), ("aa1", "new"), ("aa2", None), ("ab1", "y")]


def test_latest_answer_counts(spark):
    rows = spark.createDataFrame([("k", "old", 1), ("k", "new", 5), ("k", "mid", 3), ("j", None, 2)], "cache_key string, payload string, written long")
    assert sorted((r.cache_key, r.payload) for r in cache.one_per_key(rows).collect()) == [("j", None), ("k", "new")]


REQUEST = "cache_key string, sql string"


def unseen(spark, path):
    return sorted((r.cache_key, r.sql) for r in runs.read_unseen(spark, path).collect())


def test_a_key_passes_a_stream_once_for_good(spark, tmp_path, monkeypatch):
    source, path, answers = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cache")
    frame = lambda rows: spark.createDataFrame(rows, REQUEST)
    more = lambda *rows: frame(list(rows)).coalesce(1).write.mode("append").parquet(source)

    def work(state="state"):
        stream = spark.readStream.schema(REQUEST).option("maxFilesPerTrigger", 1).parquet(source)
        runs.stream_unseen_sql(stream, path, str(tmp_path / state), answers).awaitTermination()

    cache.write_response_cache(spark.createDataFrame([("k1", "{}"), ("k2", "{broken")], "cache_key string, payload string"), answers)
    more(("k1", "a"), ("k2", "b"), ("k2", "b"), ("k3", "c"), (None, "n"))
    work()
    assert unseen(spark, path) == [("k2", "b"), ("k3", "c")]

    # the writer is lost after it has written and before the batch counts as done
    plain = runs.put_unseen

    def lost(*args):
        plain(*args)
        raise RuntimeError("lost")

    more(("k3", "c"), ("k4", "d"))
    monkeypatch.setattr(runs, "put_unseen", lost)
    with pytest.raises(Exception, match="lost"):
        work()
    monkeypatch.setattr(runs, "put_unseen", plain)
    half = unseen(spark, path)
    work()
    assert unseen(spark, path) == half == [("k2", "b"), ("k3", "c"), ("k4", "d")]

    more(("k4", "d"), ("k1", "a"))
    work()
    assert unseen(spark, path) == half  # nothing new
    more(("k5", "e"))
    work("other")  # begins again from the first file under another name
    assert unseen(spark, path) == half + [("k5", "e")]


def test_a_batch_worked_again_replaces_its_own_rows(spark, tmp_path):
    path = str(tmp_path / "out")
    assert runs.read_unseen(spark, path) is None
    frame = lambda rows: spark.createDataFrame(rows, REQUEST + ", batch string")
    runs.put_unseen(frame([("a", "x", "?"), ("a", "y", "?")]), 0, path, "s")
    first = unseen(spark, path)
    runs.put_unseen(frame([("a", "y", "?"), ("a", "x", "?")]), 0, path, "s")
    assert unseen(spark, path) == first and len(first) == 1
    runs.put_unseen(frame([("a", "x", "?"), ("b", "z", "?")]), 1, path, "s")
    runs.put_unseen(frame([]), 2, path, "s")
    assert unseen(spark, path) == first + [("b", "z")]
    assert {(r.stream, r.batch) for r in runs.read_unseen(spark, path).collect()} == {("s", 0), ("s", 1)}


def test_state_changes_hold_no_sets_of_states(spark):
    frame = lambda rows: spark.createDataFrame(rows, "project string, run_id string, node_id string, state_1 long, state_2 long")
    now = frame([("p", "n", "a", 1, 1), ("p", "n", "b", 2, 2), ("p", "n", "c", 3, 3), ("p", "m", "a", 9, 9), (None, None, "d", 1, 1)])
    earlier = frame([("p", "x", "a", 5, 5), ("p", "y", "a", 1, 1), ("p", "y", "a", 1, 1), ("p", "x", "b", 2, 3), ("p", "x", "gone", 1, 1), ("p", "y", "gone", 2, 1), (None, None, "d", 1, 1)])
    found = state.state_changes(now, earlier)
    assert "collect_set" not in found._jdf.queryExecution().toString()
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, [
        ("p", "n", "a", "same"), ("p", "n", "b", "changed"), ("p", "n", "c", "added"), ("p", "m", "a", "changed"),
        ("p", None, "gone", "removed"), (None, None, "d", "added"), (None, None, "d", "removed")]))
