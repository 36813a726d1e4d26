"""Queries over the star-schema tables against their SQL, at the smallest scale."""

import os
import sys
from concurrent.futures import ThreadPoolExecutor

import duckdb
import pytest

SF_DIR = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from colweave.bindings.oracles import ORACLES  # noqa: E402
from colweave.bindings.queries import QUERIES  # noqa: E402
from colweave.bindings.views import TABLES, VIEWS, duckdb_sql, spark_view  # noqa: E402
from compare_oracles import _rows, compare  # noqa: E402

EMPTY: set[str] = set()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def verdicts(spark, con):
    """All queries and their SQL, four at a time: at this scale a query is mostly the planning of its jobs."""

    def run(name):
        try:
            return compare(spark, con.cursor(), SF_DIR, name)
        except Exception as e:  # told by the test of this query
            return name, "ERROR", 0, 0, 0, repr(e)[:3000]

    with ThreadPoolExecutor(4) as pool:
        return {v[0]: v for v in pool.map(run, QUERIES)}


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES) and set(ORACLES) <= set(oracle_sql())
    assert len(QUERIES) == 95 and set(QUERIES) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["project", "run_id", "node_id", "name", "transform", "confidence", "up_table", "up_column"]
    assert not df.isEmpty()


@pytest.mark.parametrize("name", ["v_line_raw", "v_tbl", "v_node", "v_run"])
def test_views_are_the_same_on_both_engines(spark, con, name):
    ours, theirs = spark_view(spark, SF_DIR, name), con.sql(duckdb_sql(f"SELECT * FROM {name}"))
    assert _rows(ours.columns, ours.collect()) == _rows(theirs.columns, theirs.fetchall())
    assert name in VIEWS


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_its_sql(verdicts, name):
    _, verdict, n, _, _, diff = verdicts[name]
    assert verdict == "ok", diff
    assert n > 0 or name in EMPTY


def test_result_does_not_depend_on_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    runs = []
    for n in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        df = queries()["merge_columns_by_name"](spark, SF_DIR)
        runs.append(_rows(df.columns, df.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert runs[0] == runs[1]
