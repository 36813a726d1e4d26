"""Lineage inputs derived from the star-schema tables.

The texts run on Spark and on DuckDB alike. Every view reads whole tables; a ``CASE`` on a key
only decides which shape a row takes (a result set, an unknown source, a helper column, ...).
"""

from __future__ import annotations

import re
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

#: A node in all its runs, so that the views of an earlier and a current run keep the layout too.
NODE = ["project", "node_id"]
NODE_OF_ORDER = {"project": "'shop' || CAST({k} % 4 AS STRING)", "node_id": "'order.' || CAST({k} AS STRING)"}
ORDER_KEY = f"""{NODE_OF_ORDER["project"]} AS project, 'r' || CAST({{k}} % 3 AS STRING) AS run_id,
  {NODE_OF_ORDER["node_id"]} AS node_id"""
LINE_KEY = ORDER_KEY.format(k="l_orderkey")
ORDERS_KEY = ORDER_KEY.format(k="o_orderkey")

VIEWS = {
    # one relationship with at most one source per line item
    "v_line_raw": f"""
SELECT {LINE_KEY}, l_quantity AS qty, l_partkey, l_suppkey, l_linenumber, l_discount, l_tax,
  CAST(l_linenumber AS BIGINT) * 10000000000000 + l_partkey * 1000000 + l_suppkey AS rel_ord,
  CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'fdd' WHEN 'AO' THEN 'FDD' WHEN 'NF' THEN 'fda'
    WHEN 'NO' THEN 'fdc' WHEN 'RF' THEN 'fdr' ELSE 'zzz' END AS rel_type,
  CASE WHEN l_suppkey % 19 = 0 THEN 'gone'
    WHEN l_linenumber <= 4 THEN 'RS' || CAST(l_linenumber % 2 AS STRING)
    ELSE 'S' || CAST(l_suppkey % 10 AS STRING) END AS target_parent_id,
  CASE WHEN l_partkey % 23 = 0 THEN '*' WHEN l_partkey % 29 = 0 THEN '@v'
    WHEN l_partkey % 31 = 0 THEN 'count(1)' WHEN l_partkey % 37 = 0 THEN ''
    WHEN l_partkey % 3 = 0 THEN 'c' || CAST(l_partkey % 5 AS STRING)
    ELSE 'C' || CAST(l_partkey % 5 AS STRING) END AS target_col,
  CASE WHEN l_partkey % 41 = 0 THEN CAST(NULL AS BIGINT) ELSE CAST(0 AS BIGINT) END AS src_ord,
  CASE WHEN l_partkey % 41 = 0 THEN NULL WHEN l_suppkey % 17 = 0 THEN 'missing'
    WHEN l_linenumber > 4 AND l_linenumber % 2 = 1 THEN 'RS' || CAST(l_suppkey % 2 AS STRING)
    ELSE 'T' || CAST(l_suppkey % 25 AS STRING) END AS source_parent_id,
  CASE WHEN l_partkey % 41 = 0 THEN NULL WHEN l_suppkey % 13 = 0 THEN ''
    WHEN l_linenumber > 4 AND l_linenumber % 2 = 1 THEN 'C' || CAST(l_partkey % 5 AS STRING)
    ELSE 'k' || CAST(l_partkey % 7 AS STRING) END AS source_col
FROM {{lineitem}}""",
    "v_line": """
SELECT project, run_id, node_id, rel_ord, rel_type, target_parent_id, target_col, src_ord,
  source_parent_id, source_col FROM v_line_raw""",
    # the tables those relationships name, one row per table id of a node
    "v_tbl": """
SELECT project, run_id, node_id, table_id,
  CASE WHEN table_id LIKE 'RS%' OR table_id IN ('S8', 'S9') THEN 'others'
    WHEN table_id LIKE 'T%1' THEN 'views' ELSE 'tables' END AS collection,
  'DEFAULT_SERVER' AS server,
  CASE WHEN min(l_suppkey) % 3 = 0 THEN '' ELSE 'db' END AS db,
  CASE WHEN min(l_suppkey) % 2 = 0 THEN '<default>' ELSE 'sch' END AS schema_name,
  CASE WHEN table_id LIKE 'RS%' THEN 'RS-1' WHEN table_id = 'T7' THEN ''
    ELSE 'tab_' || lower(table_id) END AS name,
  CASE WHEN table_id LIKE 'S%' AND min(l_suppkey) % 4 < 2 THEN 'temp_table' END AS sub_type
FROM (SELECT project, run_id, node_id, target_parent_id AS table_id, l_suppkey FROM v_line_raw
      UNION ALL
      SELECT project, run_id, node_id, source_parent_id AS table_id, l_suppkey FROM v_line_raw) x
WHERE table_id NOT IN ('gone', 'missing')
GROUP BY project, run_id, node_id, table_id""",
    # models that read each order
    "v_child": """
SELECT DISTINCT project, run_id, node_id, 'mart.' || CAST(l_suppkey % 6 AS STRING) AS child_id FROM v_line_raw""",
    # one parser message per line item; some are blank
    "v_diag": """
SELECT project, run_id, node_id, rel_ord AS err_ord,
  CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE 'Note' END AS error_type,
  CASE WHEN l_discount > 0.05 THEN 'find orphan column(10500) near: ['
      || CASE WHEN l_suppkey % 2 = 0 THEN 'c' ELSE 'C' END || CAST(l_partkey % 5 AS STRING)
      || '](' || CAST(l_linenumber AS STRING) || ',' || CAST(l_suppkey AS STRING) || ')'
    WHEN l_tax > 0.04 THEN 'expected a separator near token ' || CAST(l_partkey AS STRING)
    ELSE '   ' END AS message,
  CASE WHEN l_suppkey % 5 > 0 THEN CAST(l_linenumber AS BIGINT) END AS line,
  CASE WHEN l_suppkey % 5 > 1 THEN l_suppkey END AS col
FROM v_line_raw""",
    # one parser answer per order, also of orders without line items
    "v_resp": f"""
SELECT {ORDERS_KEY}, o_custkey % 4 AS process_count,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'dbvbigquery' WHEN '2-HIGH' THEN 'dbvmssql'
    WHEN '3-MEDIUM' THEN 'dbv' WHEN '4-NOT SPECIFIED' THEN 'dbvpresto' END AS dialect,
  CASE WHEN o_custkey % 7 = 0 THEN 429 WHEN o_custkey % 7 = 1 THEN 503 ELSE 200 END AS http_status,
  CASE WHEN o_custkey % 5 = 0 THEN '200' WHEN o_custkey % 5 = 1 THEN '401' END AS code,
  CASE WHEN o_orderstatus = 'F' THEN 'anonymous' ELSE 'authenticated' END AS mode,
  repeat('detail of order ' || CAST(o_orderkey AS STRING) || '; ', 12) AS detail
FROM {{orders}}""",
    # SQL text of each order: quoted names, escaped strings, numbers, dynamic SQL
    "v_sql": f"""
SELECT {ORDERS_KEY}, o_orderkey, o_custkey, o_orderpriority,
  'SELECT  "q ' || CAST(o_custkey AS STRING) || '", [b ' || CAST(o_orderkey AS STRING) || '], `k 7`,  ''it''''s '
  || o_orderpriority || ''' AS a1, ' || CAST(o_custkey AS STRING) || '.5e3 FROM t' || CAST(o_custkey % 9 AS STRING)
  || CASE o_orderkey % 50 WHEN 0 THEN '; execute immediate stmt USING ' || CAST(o_custkey AS STRING)
       WHEN 1 THEN '; exec sp_executesql @sql' WHEN 2 THEN '; Execute Sp_ExecuteSql @sql; execute immediate x'
       ELSE ' WHERE d = ''open' END AS sql
FROM {{orders}}""",
    # requests: SQL texts of which many are equal up to white space
    "v_request": f"""
SELECT {ORDERS_KEY}, 'SELECT' || CASE WHEN o_orderkey % 2 = 0 THEN ' ' ELSE '   ' END
  || 'c' || CAST(o_custkey AS STRING) || ' FROM ' || o_orderpriority AS sql, o_custkey,
  'dbvbigquery' AS dialect FROM {{orders}}""",
    "v_node": f"""
SELECT 'geo' AS project, 'r1' AS run_id, 'region.' || CAST(r_regionkey AS STRING) AS node_id, r_name AS name,
  'source' AS resource_type, 'geo' AS fqn1, 'Region' AS fqn2, r_name AS fqn3, 'geo' AS tag,
  'bigquery' AS adapter_type, '' AS compiled_code, CAST(NULL AS STRING) AS compiled_sql,
  CAST(NULL AS STRING) AS compiled_path, r_name AS path FROM {{region}}
UNION ALL
SELECT 'geo', 'r1', 'nation.' || CAST(n_nationkey AS STRING), n_name, 'model', 'geo', 'Nation', n_name, 'geo',
  'databricks', 'select ' || n_name, NULL, NULL, n_name FROM {{nation}}
UNION ALL
SELECT 'geo', 'r1', 'customer.' || CAST(c_custkey AS STRING), c_name, 'incremental', 'crm', c_mktsegment, c_name,
  c_mktsegment, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Fabric' ELSE 'oracle' END, NULL, 'select ' || c_name,
  '', c_name FROM {{customer}}
UNION ALL
SELECT 'geo', 'r1', 'order.' || CAST(o_orderkey AS STRING), 'Order_' || CAST(o_orderkey AS STRING),
  CASE WHEN o_orderstatus = 'F' THEN 'model' WHEN o_orderstatus = 'O' THEN 'Snapshot'
    WHEN o_orderpriority = '1-URGENT' THEN 'seed' WHEN o_orderpriority = '2-HIGH' THEN 'test'
    WHEN o_orderpriority = '3-MEDIUM' THEN 'operation' WHEN o_orderpriority = '5-LOW' THEN 'analysis' END,
  'sales', o_orderstatus, 'Order_' || CAST(o_orderkey AS STRING), o_orderpriority,
  CASE o_orderpriority WHEN '1-URGENT' THEN ' BigQuery ' WHEN '2-HIGH' THEN 'sqlserver' WHEN '3-MEDIUM' THEN 'spark'
    WHEN '4-NOT SPECIFIED' THEN 'presto' END,
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'select ' || CAST(o_orderkey AS STRING) END,
  CASE WHEN o_orderkey % 6 = 0 THEN 'select old ' || CAST(o_orderkey AS STRING) END,
  CASE WHEN o_orderkey % 5 = 0 THEN '/abs/o' || CAST(o_orderkey AS STRING) || '.sql'
    WHEN o_orderkey % 5 < 4 THEN 'models/o' || CAST(o_orderkey AS STRING) || '.sql' END,
  'o' || CAST(o_orderkey AS STRING) || '.sql' FROM {{orders}}""",
    "v_file": """
SELECT CASE WHEN o_orderkey % 5 = 0 THEN '/abs/o' WHEN o_orderkey % 7 < 5 THEN '/work/target/models/o' ELSE '/elsewhere/o' END
  || CAST(o_orderkey AS STRING) || '.sql' AS path,
  CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE 'select file ' || CAST(o_orderkey AS STRING) END AS text FROM {orders}""",
    # region -> nation -> customer -> order, and sources that are no nodes
    "v_step": """
SELECT 'region.' || CAST(n_regionkey AS STRING) AS parent_id, 'nation.' || CAST(n_nationkey AS STRING) AS child_id FROM {nation}
UNION ALL
SELECT 'nation.' || CAST(c_nationkey AS STRING), 'customer.' || CAST(c_custkey AS STRING) FROM {customer}
UNION ALL
SELECT 'customer.' || CAST(o_custkey AS STRING), 'order.' || CAST(o_orderkey AS STRING) FROM {orders}""",
    "v_edge": """
SELECT 'geo' AS project, 'r1' AS run_id, 'parent_map' AS origin, parent_id, child_id FROM v_step
UNION ALL
SELECT 'geo', 'r1', 'child_map', parent_id, child_id FROM v_step
UNION ALL
SELECT 'geo', 'r1', 'parent_map', 'source.' || CAST(o_custkey % 10 AS STRING), 'order.' || CAST(o_orderkey AS STRING) FROM {orders}""",
    # one run per day and site, one node per event
    "v_run": """
SELECT project, run_id, node_id, ts, status, dialect, total_columns,
  CASE status WHEN 'parsed' THEN total_columns WHEN 'partial' THEN total_columns - total_columns % 7
    ELSE CAST(0 AS BIGINT) END AS resolved_columns
FROM (SELECT 'site' || CAST(user_id % 3 AS STRING) AS project, CAST(CAST(ts AS DATE) AS STRING) AS run_id,
  'user.' || CAST(user_id AS STRING) || '.' || CAST(event_id AS STRING) AS node_id, ts,
  CASE event_type WHEN 'view' THEN 'parsed' WHEN 'click' THEN 'partial' WHEN 'purchase' THEN 'unsupported'
    WHEN 'error' THEN 'failed' ELSE 'skipped' END AS status,
  CASE WHEN user_id % 2 = 0 THEN 'dbvmssql' END AS dialect,
  CASE WHEN event_type IN ('view', 'click', 'purchase') THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)
    ELSE CAST(0 AS BIGINT) END AS total_columns
  FROM {events}) e""",
    # an earlier and the current lineage of the orders; items of a small quantity have lost their source,
    # and with it nodes that have no others
    "v_base": """
SELECT DISTINCT project, 'r0' AS run_id, node_id, CASE WHEN qty < 10 THEN 'C0' ELSE target_col END AS "column",
  source_parent_id AS up_table, source_col AS up_column FROM v_line_raw WHERE source_parent_id IS NOT NULL""",
    "v_cur": """
SELECT DISTINCT project, 'r1' AS run_id, node_id, "column", up_table, up_column FROM (
  SELECT project, node_id, CASE WHEN qty > 40 THEN 'C1' ELSE target_col END AS "column",
    CASE WHEN qty > 35 THEN 'merged' ELSE source_parent_id END AS up_table,
    CASE WHEN qty <= 6 THEN NULL WHEN qty > 30 THEN 'k' ELSE source_col END AS up_column
  FROM v_line_raw WHERE source_parent_id IS NOT NULL) x WHERE up_column IS NOT NULL""",
    # relationships through chains of result sets, some of them cycles, and the tables they name
    "v_hop": """
SELECT project, run_id, node_id, rel_ord, rel_type,
  CASE WHEN l_linenumber = 1 THEN 'S' ELSE 'RS' || CAST(l_linenumber AS STRING) END AS target_parent_id,
  'c' || CAST(l_partkey % 2 AS STRING) AS target_col, src_ord,
  CASE WHEN l_suppkey % 5 = 0 THEN 'T' || CAST(l_partkey % 3 AS STRING) WHEN l_suppkey % 11 = 0 THEN 'gone'
    ELSE 'RS' || CAST(2 + (l_linenumber + l_partkey % 3) % 6 AS STRING) END AS source_parent_id,
  CASE WHEN l_suppkey % 13 = 0 THEN '' ELSE 'c' || CAST(l_suppkey % 2 AS STRING) END AS source_col
FROM v_line_raw""",
    "v_hop_tbl": """
SELECT DISTINCT project, run_id, node_id, table_id, CASE WHEN table_id LIKE 'RS%' THEN 'others' ELSE 'tables' END AS collection,
  'DEFAULT_SERVER' AS server, 'db' AS db, 'sch' AS schema_name, 'tab_' || lower(table_id) AS name, CAST(NULL AS STRING) AS sub_type
FROM (SELECT project, run_id, node_id, target_parent_id AS table_id FROM v_hop
      UNION ALL SELECT project, run_id, node_id, source_parent_id AS table_id FROM v_hop) x WHERE table_id <> 'gone'""",
    # columns of regions that feed those of nations, customers and orders, and some orders that feed nations
    "v_colstep": """
SELECT 'geo' AS project, 'r1' AS run_id, 'region.' || CAST(n_regionkey AS STRING) AS src_table, 'k' || CAST(n_nationkey % 2 AS STRING) AS src_column,
  'nation.' || CAST(n_nationkey AS STRING) AS dst_table, 'k' || CAST(n_nationkey % 3 AS STRING) AS dst_column, 'direct' AS transform FROM {nation}
UNION ALL
SELECT 'geo', 'r1', 'nation.' || CAST(c_nationkey AS STRING), 'k' || CAST(c_custkey % 3 AS STRING), 'customer.' || CAST(c_custkey AS STRING),
  'k' || CAST(c_custkey % 2 AS STRING),
  CASE c_mktsegment WHEN 'BUILDING' THEN 'aggregate' WHEN 'MACHINERY' THEN 'control' ELSE 'direct' END FROM {customer}
UNION ALL
SELECT 'geo', 'r1', 'customer.' || CAST(o_custkey AS STRING), 'k' || CAST(o_orderkey % 2 AS STRING), 'order.' || CAST(o_orderkey AS STRING),
  'k' || CAST(o_custkey % 2 AS STRING),
  CASE o_orderpriority WHEN '1-URGENT' THEN 'expression' WHEN '5-LOW' THEN 'control' ELSE 'direct' END FROM {orders}
UNION ALL
SELECT 'geo', 'r1', 'order.' || CAST(o_orderkey AS STRING), 'k0', 'nation.' || CAST(o_custkey % 25 AS STRING), 'k1', 'direct'
FROM {orders} WHERE o_orderstatus = 'P'""",
    "v_coltag": """
SELECT 'geo' AS project, 'r1' AS run_id, 'region.' || CAST(r_regionkey AS STRING) AS "table", 'k0' AS "column",
  CASE WHEN r_name < 'B' THEN 'pii' ELSE 'secret' END AS tag FROM {region}
UNION ALL
SELECT 'geo', 'r1', 'customer.' || CAST(c_custkey AS STRING), 'k0', CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'pii' ELSE 'email' END
FROM {customer} WHERE c_mktsegment IN ('AUTOMOBILE', 'FURNITURE')""",
    # columns of orders before and after a release that renames, swaps, rotates, drops and changes some
    "v_ren_base": """
SELECT DISTINCT project, 'r0' AS run_id, node_id, 'c' || CAST(l_linenumber % 4 AS STRING) AS "column",
  'T' || CAST(l_partkey % 5 AS STRING) AS up_table, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE 'k' || CAST(l_suppkey % 3 AS STRING) END AS up_column
FROM (SELECT project, node_id, l_linenumber, l_partkey, l_suppkey FROM v_line_raw) x""",
    "v_ren_cur": """
SELECT DISTINCT project, 'r1' AS run_id, node_id, CASE CAST(substring(node_id, 7) AS BIGINT) % 6
    WHEN 0 THEN CASE "column" WHEN 'c1' THEN 'n1' ELSE "column" END
    WHEN 1 THEN CASE "column" WHEN 'c0' THEN 'c1' WHEN 'c1' THEN 'c0' ELSE "column" END
    WHEN 2 THEN CASE "column" WHEN 'c0' THEN 'c1' WHEN 'c1' THEN 'c2' WHEN 'c2' THEN 'c0' ELSE "column" END
    WHEN 3 THEN CASE "column" WHEN 'c2' THEN 'merged' WHEN 'c3' THEN 'merged' ELSE "column" END
    ELSE "column" END AS "column",
  CASE WHEN "column" = 'c3' AND CAST(substring(node_id, 7) AS BIGINT) % 6 = 4 THEN 'old_' || up_table ELSE up_table END AS up_table, up_column
FROM v_ren_base""",
    # statuses of the nodes of runs in an earlier run
    "v_run_before": """
SELECT project, 'before' AS run_id, node_id, CASE total_columns % 4 WHEN 0 THEN 'parsed' WHEN 1 THEN 'partial' WHEN 2 THEN 'failed' ELSE status END AS status
FROM v_run""",
    # the nodes of an earlier manifest: no snapshots yet, other SQL in one market segment, and some nodes since removed
    "v_node_before": """
SELECT project, 'r0' AS run_id, node_id, name, resource_type, fqn1, fqn2, fqn3, tag, adapter_type,
  CASE WHEN fqn2 = 'BUILDING' THEN 'select 0' ELSE compiled_code END AS compiled_code,
  CASE WHEN compiled_sql IS NULL THEN NULL ELSE compiled_sql || '  ' END AS compiled_sql, compiled_path, path
FROM v_node WHERE resource_type IS NULL OR resource_type <> 'Snapshot'
UNION ALL
SELECT 'geo', 'r0', 'gone.' || CAST(n_nationkey AS STRING), n_name, 'model', 'geo', 'Nation', n_name, 'geo', 'databricks', 'select 1', NULL, NULL, n_name
FROM {nation}""",
    "v_edge_removed": """
SELECT project, run_id, origin, parent_id, child_id FROM v_edge
UNION ALL
SELECT 'geo', 'r1', 'child_map', 'gone.' || CAST(c_nationkey AS STRING), 'customer.' || CAST(c_custkey AS STRING) FROM {customer}
WHERE c_mktsegment = 'MACHINERY'""",
    # orders as nodes of one run, for the check with a baseline
    "v_check": """
SELECT 'shop' || CAST(o_orderkey % 4 AS STRING) AS project, 'r1' AS run_id, 'order.' || CAST(o_orderkey AS STRING) AS node_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'partial' WHEN '2-HIGH' THEN 'unsupported' WHEN '3-MEDIUM' THEN 'failed'
    WHEN '5-LOW' THEN 'skipped' ELSE 'parsed' END AS status,
  o_custkey % 9 AS total_columns, o_custkey % 9 - o_custkey % 3 AS resolved_columns
FROM {orders}""",
    # texts that cite rows, and the index of labelled rows
    "v_cite": """
SELECT doc_id, text || ' E' || lpad(CAST(doc_id % 30 AS STRING), 2, '0') || ', E' || lpad(CAST(doc_id % 7 AS STRING), 2, '0')
  || CASE WHEN doc_id % 3 = 0 THEN ' E1234 xE12' ELSE ' (E' || CAST(10 + doc_id % 40 AS STRING) || ')' END AS text
FROM {documents}""",
    "v_index": """
SELECT 'E' || lpad(CAST(doc_id % 40 AS STRING), 2, '0') AS id,
  CASE WHEN min(quality + 2 * toxic) = 0 THEN 'regression' WHEN max(doc_id) % 4 = 0 THEN NULL
    WHEN max(doc_id) % 4 = 1 THEN 'active' WHEN max(doc_id) % 4 = 2 THEN 'framework-active' ELSE 'manual-active' END AS label
FROM {labels} GROUP BY 'E' || lpad(CAST(doc_id % 40 AS STRING), 2, '0')""",
}


def _needed(text: str) -> list[str]:
    """Views that ``text`` uses, those they use before them."""
    out: list[str] = []
    for name in re.findall(r"\bv_\w+", text):
        if name in VIEWS and name not in out:
            out += [n for n in _needed(VIEWS[name]) if n not in out]
            out.append(name)
    return out


def with_views(text: str, given: Collection[str] = ()) -> str:
    """``text`` with the views it uses, but for those ``given``, put before it as common table expressions."""
    ctes = [f"{n} AS ({VIEWS[n].strip()})" for n in _needed(text) if n not in given]
    if not ctes:
        return text
    if text.lstrip().upper().startswith("WITH "):
        head, rest = text.lstrip()[:5], text.lstrip()[5:]
        if rest.upper().startswith("RECURSIVE "):
            head, rest = head + rest[:10], rest[10:]
        return f"{head}{', '.join(ctes)}, {rest}"
    return f"WITH {', '.join(ctes)} {text}"


def duckdb_sql(text: str) -> str:
    return re.sub(r"\{(\w+)\}", lambda m: m.group(1) if m.group(1) in TABLES else m.group(0), with_views(text))


# what identifies a row of the larger tables
ROW_ID = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"],
    "orders": ["o_orderkey"],
    "events": ["event_id"],
    "documents": ["doc_id"],
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows mean much work each, such as parsing a text.

    It is spread by the row's key over the session's number of shuffle partitions, at every size alike:
    a file of one row group would be one task however many cores wait, and adaptive execution, which
    goes by bytes, would put these small rows together again.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return read_table(spark, sf_dir, name).repartition(tasks, *ROW_ID[name])


#: Sides of a join that are both dealt by some of its keys stay where they are.
PLACED = ("spark.sql.requireAllClusterKeysForCoPartition", "false")
LINES_OF_TASK = 200_000
#: Both tables that a line names, from one reading of the lines: what the unions of the views read twice.
ENDS = {
    "v_tbl": """SELECT project, run_id, node_id, target_parent_id AS table_id, l_suppkey FROM v_line_raw
      UNION ALL
      SELECT project, run_id, node_id, source_parent_id AS table_id, l_suppkey FROM v_line_raw""",
    "v_hop_tbl": """SELECT project, run_id, node_id, target_parent_id AS table_id FROM v_hop
      UNION ALL SELECT project, run_id, node_id, source_parent_id AS table_id FROM v_hop""",
}


def _ends_at_once(text: str) -> str:
    for union in ENDS.values():
        first = union.split("UNION ALL")[0].strip()
        text = text.replace(union, first.replace("target_parent_id AS", "explode(array(target_parent_id, source_parent_id)) AS"))
    return text


def by_node(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """``rows`` of lines or derived from them, in the layout of ``read_lines``."""
    spark.conf.set(*PLACED)
    return rows.repartition(node_tasks(spark, sf_dir), *NODE)


def node_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Over how many tasks ``by_node`` deals."""
    lines = read_table(spark, sf_dir, "lineitem").count()
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), lines // LINES_OF_TASK)


def read_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_line_raw``, dealt by node over the session's number of shuffle partitions, or more if these would be large.

    All that is derived from the lines joins and groups by the node and something of it, and that a
    partitioning by node serves as it is. So the lines move once, and not again for every step. A node has
    the lines of one parser answer. Joins take such a layout only if the session lets them (PLACED).
    The items move as the table has them, dealt by the view's own terms of a node, and the texts of the view are
    made where they arrive.
    """
    return _dealt(spark, sf_dir, "v_line_raw", "lineitem", "l_orderkey")


def read_answers(spark: SparkSession, sf_dir: str, view: str = "v_resp") -> DataFrame:
    """A view of the orders with the key of ``ORDERS_KEY``, dealt as the lines are."""
    return _dealt(spark, sf_dir, view, "orders", "o_orderkey")


def _dealt(spark: SparkSession, sf_dir: str, view: str, table: str, key: str) -> DataFrame:
    spark.conf.set(*PLACED)
    node = [F.expr(NODE_OF_ORDER[c].format(k=key)) for c in NODE]
    rows = read_table(spark, sf_dir, table).repartition(node_tasks(spark, sf_dir), *node)
    return spark.sql(VIEWS[view], **{table: rows})


def spark_view(spark: SparkSession, sf_dir: str, name: str, lines: DataFrame | None = None) -> DataFrame:
    """The view ``name``. ``lines`` are the rows of ``read_lines``, if they have been read."""
    text = _ends_at_once(with_views(f"SELECT * FROM {name}", {"v_line_raw"})).replace('"column"', "`column`").replace('"table"', "`table`")
    text = re.sub(r"\bv_line_raw\b", "{v_line_raw}", text)
    used = {t: read_table(spark, sf_dir, t) for t in re.findall(r"\{(\w+)\}", text) if t in TABLES}
    if "{v_line_raw}" in text:
        used["v_line_raw"] = read_lines(spark, sf_dir) if lines is None else lines
    return spark.sql(text, **used)


def with_arrays(nodes: DataFrame) -> DataFrame:
    """The name parts and the tag of ``v_node`` as the arrays a manifest has."""
    return nodes.withColumns(
        {"fqn": F.array("fqn1", "fqn2", "fqn3"), "tags": F.array("tag")}
    ).drop("fqn1", "fqn2", "fqn3", "tag")
