"""Lines are dealt by node once; what is derived from them does not move again."""

import datetime
import re

import pytest

from colweave import session
from colweave.bindings import views
from colweave.bindings.queries import QUERIES
from colweave.operators import emit

LINE = """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,
  l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate date"""


@pytest.fixture()
def tables(spark, tmp_path):
    day = datetime.date(2024, 1, 1)
    rows = [(o, o * 7 + n, o + n, n, 5.0 + n, 1.0, 0.06, 0.05, "ANR"[n % 3], "FO"[o % 2], day) for o in range(40) for n in range(1, 7)]
    spark.createDataFrame(rows, LINE).write.parquet(f"{tmp_path}/lineitem.parquet")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield str(tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)


def exchanges(df):
    return re.findall(r"Exchange .*?(REPARTITION_BY_NUM|ENSURE_REQUIREMENTS)", df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("name", ["upstream_tables", "column_confidence", "accumulate_target_columns", "merge_columns_by_name"])
def test_only_the_lines_are_exchanged(spark, tables, name):
    assert "ENSURE_REQUIREMENTS" not in exchanges(QUERIES[name](spark, tables))


def test_larger_tables_have_more_tasks(spark, tables, monkeypatch):
    monkeypatch.setattr(views, "LINES_OF_TASK", 30)
    assert views.read_lines(spark, tables).rdd.getNumPartitions() == 8


def test_both_tables_of_a_line_come_from_one_reading(spark, tables):
    plan = views.spark_view(spark, tables, "v_tbl")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan


def test_rounds_of_a_closure_stay_where_the_lines_are(spark, tables, monkeypatch):
    """Every intermediate of the walk is written and read in the layout of the lines (F6)."""
    from colweave.bindings import queries

    found = []

    def cut_placed(df, by, parts):
        found.append(exchanges(df))
        return session.cut_placed(df, by, parts)

    monkeypatch.setattr(queries, "cut_placed", cut_placed)
    assert QUERIES["trace_multi_hop"](spark, tables).count()
    assert len(found) > 5 and not [x for x in found if "ENSURE_REQUIREMENTS" in x]


def test_a_union_of_both_runs_keeps_the_layout(spark, tables):
    """Rows of now and before meet without an exchange (F17)."""
    assert "ENSURE_REQUIREMENTS" not in exchanges(QUERIES["column_diff"](spark, tables))


@pytest.fixture()
def orders(spark, tables):
    rows = [(o, o * 3, "FOP"[o % 3], ["1-URGENT", "2-HIGH", "5-LOW"][o % 3]) for o in range(100)]
    spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string").write.parquet(f"{tables}/orders.parquet")
    return tables


def test_documents_are_made_where_the_lines_are(spark, orders, monkeypatch):
    """Lines and answers are exchanged once each, and nothing that is made from them, not even for a union (F4)."""
    from colweave.bindings import queries

    found = []

    def cut_placed(df, by, parts):
        found.append(exchanges(df))
        return session.cut_placed(df, by, parts)

    monkeypatch.setattr(queries, "cut_placed", cut_placed)
    docs = QUERIES["render_lineage_doc"](spark, orders)
    assert len(found) > 5 and not [x for x in [*found, exchanges(docs)] if "ENSURE_REQUIREMENTS" in x]
    assert sum(x.count("REPARTITION_BY_NUM") for x in found) == 2  # the lines, the answers
    assert docs.count() == 100


def moved(df):
    """What stands below each exchange of a plan."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    ends = [next((j for j in range(i + 1, len(plan)) if depth[j] <= d), len(plan)) for i, d in enumerate(depth)]
    return ["\n".join(plan[i:ends[i]]) for i, line in enumerate(plan) if "Exchange " in line]


@pytest.fixture()
def placed(spark):
    """500 documents of two runs, dealt by node, of a size that is not broadcast."""
    rows = spark.range(500).selectExpr("'p' AS project", "concat('r', id % 2) AS run_id", "concat('n', id) AS node_id", "concat('d', id) AS doc")
    broadcast, together = "spark.sql.autoBroadcastJoinThreshold", views.PLACED[0]
    before = {c: spark.conf.get(c) for c in (broadcast, together)}
    spark.conf.set(*views.PLACED)
    spark.conf.set(broadcast, "3000")
    yield session.cut_placed(rows.repartition(4, *views.NODE), views.NODE, 4)
    for c, value in before.items():
        spark.conf.set(c, value)


def headers_of(spark, runs):
    rows = spark.createDataFrame([("p", r, f"h{r}", "t") for r in runs], "project string, run_id string, head string, tail string")
    return session.cut_lineage(rows.coalesce(1))


def test_no_document_moves_for_the_first_of_its_run(spark, placed):
    """Documents that stand by node meet the first of their run where they are (F3)."""
    lines = emit.document_lines(placed, headers_of(spark, ["r0", "r1", "r2"]))
    assert moved(lines) and not any("doc#" in below for below in moved(lines))
    text = {}
    for r in emit.deterministic_order(lines).collect():
        text[r.run_id] = text.get(r.run_id, "") + r.line
    assert text["r2"] == '{hr2,"nodes":[],t}' and text["r1"].startswith('{hr1,"nodes":[d1,d101,d103,') and text["r1"].endswith(",d99],t}")


def test_no_document_moves_for_the_header_of_its_run(spark, placed):
    """Small headers go to documents that stand by node; a run without any keeps its bare document (F2)."""
    rows = emit.document_rows(placed, headers_of(spark, ["r0", "r2"]))
    assert moved(rows) and not any("doc#" in below for below in moved(rows))
    got = {(r.run_id, r.node_id): r.line for r in rows.collect()}
    assert len(got) == 251 and got["r2", ""] == '{hr2,"nodes":[],t}' and got["r0", "n4"] == '{hr0,"nodes":[d4],t}'
