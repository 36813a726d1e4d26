"""What each query must return, as SQL on the same tables.

The SQL states the rules directly (ordered aggregates, string rules, recursive closures); it
shares only the input views with the Spark side.
"""

from __future__ import annotations

from colweave import schemas as S
from colweave.bindings.views import duckdb_sql
from colweave.functions.sqltext import NUMBER, QUOTED, STRING, WHITESPACE

K = "project, run_id, node_id"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _case(column: str, table: dict, other: str = "NULL") -> str:
    whens = " ".join(f"WHEN {_text(k)} THEN {_text(v)}" for k, v in table.items())
    return f"CASE {column} {whens} ELSE {other} END"


def _list(values: list[str]) -> str:
    return ", ".join(_text(v) for v in values)


_part = "CASE WHEN {c} IN (" + _list(S.DEFAULT_NAMES) + ") THEN NULL ELSE {c} END"
FQN = (
    "coalesce(nullif(concat_ws('.', "
    + ", ".join(_part.format(c=c) for c in ("server", "db", "schema_name"))
    + ", nullif(name, '')), ''), '<id:' || table_id || '>')"
)
IS_REAL = "(collection IN ('tables', 'views') AND name <> '' AND name NOT LIKE 'RS-%')"
SYNTHETIC = "({c} LIKE '@%' OR upper({c}) IN ('COUNT', 'RELATIONROWS') OR regexp_matches(upper({c}), '^COUNT\\([0-9]+\\)$'))"
TRANSFORM = "CASE lower(rel_type) WHEN 'fdd' THEN 'direct' WHEN 'fda' THEN 'aggregate' WHEN 'fdc' THEN 'expression' WHEN 'fdr' THEN 'control' ELSE 'unknown' END"
ORPHAN = r"orphan\s+column\s*\(\d+\)\s*near:\s*\[?([^\]\(]+?)\]?\s*\((\d+)\s*,\s*(\d+)\)"

# steps of the mapper, each by its plain rule
STEPS = {
    "o_tables": f"SELECT *, {FQN} AS fqn, {IS_REAL} AS is_real FROM v_tbl",
    "o_targets": f"""
SELECT l.*, t.fqn AS target_fqn, t.is_real AS target_is_real FROM v_line l JOIN o_tables t
  ON l.project = t.project AND l.run_id = t.run_id AND l.node_id = t.node_id AND l.target_parent_id = t.table_id""",
    "o_kept": "SELECT * FROM o_targets WHERE target_col <> '' AND NOT (target_col = '*' AND target_is_real)",
    "o_sources": """
SELECT l.*, t.fqn AS source_fqn, t.is_real AS source_is_real,
  CASE WHEN t.is_real AND source_col <> '' THEN t.fqn END AS up_table,
  CASE WHEN t.is_real AND source_col <> '' THEN source_col END AS up_column,
  src_ord IS NOT NULL AND t.fqn IS NULL AS source_unknown
FROM {lines} l LEFT JOIN o_tables t
  ON l.project = t.project AND l.run_id = t.run_id AND l.node_id = t.node_id AND l.source_parent_id = t.table_id""",
    "o_groups": f"""
SELECT {K}, target_fqn, target_col, min(rel_ord) AS first_ord,
  coalesce(arg_min({TRANSFORM}, rel_ord) FILTER ({TRANSFORM} <> 'direct'), 'direct') AS transform,
  arg_min({TRANSFORM} <> 'control', rel_ord) AS first_is_value,
  count(DISTINCT (up_table, up_column)) FILTER (up_table IS NOT NULL) AS n_upstream
FROM o_resolved GROUP BY {K}, target_fqn, target_col""",
    "o_rated": """
SELECT *, CASE WHEN NOT first_is_value THEN 'medium' WHEN n_upstream > 0 THEN 'high' ELSE 'low' END AS confidence
FROM o_groups""",
    "o_columns": f"""
SELECT {K}, target_col AS name, arg_min(transform, first_ord) AS transform, arg_min(confidence, first_ord) AS confidence,
  bool_or(n_upstream > 0) AS has_upstream
FROM o_rated WHERE NOT {SYNTHETIC.format(c='target_col')} GROUP BY {K}, target_col""",
    "o_edges": f"""
SELECT DISTINCT {K}, target_col AS "column", up_table, up_column FROM o_resolved
WHERE up_table IS NOT NULL AND NOT {SYNTHETIC.format(c='target_col')}""",
    "o_upstream": f"SELECT DISTINCT {K}, fqn FROM o_tables WHERE is_real",
    "o_status": f"""
SELECT {K},
  CASE WHEN total_columns = 0 AND real_tables = 0 THEN 'unsupported' WHEN resolved_columns > 0 THEN 'parsed' ELSE 'partial' END AS status,
  CASE WHEN resolved_columns > 0 AND resolved_columns = total_columns THEN 'high' WHEN resolved_columns > 0 THEN 'medium' ELSE 'low' END AS confidence,
  total_columns, resolved_columns
FROM (SELECT r.project, r.run_id, r.node_id,
    (SELECT count(*) FROM o_columns c WHERE c.node_id = r.node_id) AS total_columns,
    (SELECT count(*) FROM o_columns c WHERE c.node_id = r.node_id AND has_upstream) AS resolved_columns,
    (SELECT count(*) FROM o_upstream u WHERE u.node_id = r.node_id) AS real_tables
  FROM v_resp r) x""",
    "o_diag": rf"""
SELECT {K}, err_ord, trim(message) AS message,
  coalesce(nullif(error_type, ''), CASE WHEN near IS NULL THEN 'Hint' ELSE 'SyntaxHint' END) AS type,
  CASE WHEN near IS NOT NULL THEN 'orphan_column' END AS category, near AS near_column,
  CASE WHEN near IS NULL THEN line ELSE CAST(regexp_extract(message, '{ORPHAN}', 2, 'i') AS BIGINT) END AS line,
  CASE WHEN near IS NULL THEN col ELSE CAST(regexp_extract(message, '{ORPHAN}', 3, 'i') AS BIGINT) END AS col
FROM (SELECT *, nullif(trim(regexp_extract(message, '{ORPHAN}', 1, 'i')), '') AS near FROM v_diag WHERE trim(message) <> '') x""",
    "o_index": f"""
SELECT {K}, near, arg_min(line, err_ord) AS line, arg_min(col, err_ord) AS col, arg_min(message, err_ord) AS message
FROM (SELECT *, near_column AS near FROM o_diag WHERE category IS NOT NULL
      UNION ALL SELECT *, upper(near_column) AS near FROM o_diag WHERE category IS NOT NULL) x GROUP BY {K}, near""",
    "o_orphans": f"""
SELECT c.project, c.run_id, c.node_id, c.name,
  CASE WHEN coalesce(e.message, u.message) IS NULL THEN 'upstream_unresolved' ELSE 'parser_orphan_column' END AS reason,
  coalesce(e.line, u.line) AS line, coalesce(e.col, u.col) AS col, coalesce(e.message, u.message) AS parser_message
FROM o_columns c
LEFT JOIN o_index e ON (e.node_id, e.near) = (c.node_id, c.name)
LEFT JOIN o_index u ON (u.node_id, u.near) = (c.node_id, upper(c.name))
WHERE NOT c.has_upstream""",
    "o_marked": """
SELECT *, CASE WHEN contains(u, 'EXECUTE IMMEDIATE') THEN 'EXECUTE IMMEDIATE'
  WHEN contains(u, 'EXEC SP_EXECUTESQL') THEN 'EXEC SP_EXECUTESQL'
  WHEN contains(u, 'EXECUTE SP_EXECUTESQL') THEN 'EXECUTE SP_EXECUTESQL' END AS found
FROM (SELECT *, upper({text}) AS u FROM {src}) x""",
}
MARKER = "CASE WHEN found = 'EXECUTE IMMEDIATE' THEN 'execute_immediate' WHEN found IS NOT NULL THEN 'sp_executesql' END"
EXCERPT = (
    "substring({text}, greatest(strpos(u, found) - 40, 1), strpos(u, found) + length(found) + 40 "
    "- greatest(strpos(u, found) - 40, 1))"
)
STEPS["o_resolved"] = STEPS["o_sources"].replace("{lines}", "o_kept")
STEPS["o_marked_sql"] = STEPS["o_marked"].replace("{text}", "sql").replace("{src}", "v_sql")
STEPS["o_texts"] = (
    "SELECT node_id AS id, sql AS text FROM v_sql UNION ALL SELECT 'doc.' || CAST(doc_id AS STRING), text FROM {documents}"
)
STEPS["o_marked_text"] = STEPS["o_marked"].replace("{text}", "text").replace("{src}", "o_texts")
STEPS["o_reasons"] = f"""
SELECT {K}, 1 AS section, rel_ord AS ord, src_ord, 'source_table_unknown' AS reason, target_col AS target_column, rel_type,
  source_parent_id, CAST(NULL AS BIGINT) AS line, CAST(NULL AS BIGINT) AS col, CAST(NULL AS STRING) AS parser_message,
  CAST(NULL AS STRING) AS marker, CAST(NULL AS STRING) AS fragment_preview, CAST(NULL AS STRING) AS detail
FROM o_resolved WHERE source_unknown
UNION ALL SELECT {K}, 2, NULL, NULL, reason, name, NULL, NULL, line, col, parser_message, NULL, NULL, NULL FROM o_orphans
UNION ALL SELECT {K}, 3, err_ord, NULL, 'parser_syntax_hint', NULL, NULL, NULL, line, col, message, NULL, NULL, NULL
  FROM o_diag WHERE category IS NULL
UNION ALL SELECT {K}, 4, NULL, NULL, 'dynamic_sql', NULL, NULL, NULL, NULL, NULL, NULL, {MARKER}, {EXCERPT.format(text='sql')}, NULL
  FROM o_marked_sql WHERE found IS NOT NULL"""

# evidence
STEPS["o_value"] = "SELECT * FROM v_line WHERE lower(rel_type) = 'fdd' AND src_ord IS NOT NULL"
STEPS["o_value_src"] = STEPS["o_sources"].replace("{lines}", "o_value")
STEPS["o_writes"] = f"""
SELECT s.*, t.fqn AS target_fqn FROM o_value_src s JOIN o_tables t
  ON (s.node_id, s.target_parent_id) = (t.node_id, t.table_id)
WHERE t.is_real AND target_col NOT IN ('', '*') AND NOT {SYNTHETIC.format(c='target_col')}"""
STEPS["o_hops"] = """
SELECT w.project, w.run_id, w.node_id, w.target_parent_id, w.target_fqn, w.target_col, i.up_table, i.up_column, w.rel_ord
FROM o_writes w JOIN o_value_src i ON w.node_id = i.node_id AND w.source_parent_id = i.target_parent_id AND w.source_col = i.target_col
WHERE NOT w.source_is_real AND w.source_col <> '' AND i.up_table IS NOT NULL"""
STEPS["o_write_edges"] = f"""
SELECT {K}, target_parent_id, target_fqn, target_col, up_table, up_column, rel_ord FROM o_writes WHERE up_table IS NOT NULL
UNION ALL SELECT * FROM o_hops"""
STEPS["o_subtypes"] = f"""
SELECT e.project, e.run_id, e.node_id, e.target_fqn,
  list(t.sub_type ORDER BY e.rel_ord DESC)[1] AS sub_type
FROM o_write_edges e JOIN o_tables t ON (e.node_id, e.target_parent_id) = (t.node_id, t.table_id)
GROUP BY e.project, e.run_id, e.node_id, e.target_fqn"""

STEPS["o_procedural"] = f"""
SELECT e.*, write_target_count, column_edge_count, process_count, sub_type
FROM (SELECT DISTINCT {K}, target_fqn, target_col, up_table, up_column FROM o_write_edges) e
JOIN (SELECT node_id, count(DISTINCT target_fqn) AS write_target_count, count(DISTINCT (target_fqn, target_col, up_table, up_column)) AS column_edge_count
  FROM o_write_edges GROUP BY node_id) n ON n.node_id = e.node_id
JOIN v_resp r ON r.node_id = e.node_id
JOIN o_subtypes s ON (s.node_id, s.target_fqn) = (e.node_id, e.target_fqn)
WHERE write_target_count >= 2 OR process_count >= 2"""

# selection
STEPS["o_nodes"] = """
SELECT *, lower(name) AS low, lower(fqn1 || '.' || fqn2 || '.' || fqn3) AS dotted, lower(fqn3) AS last FROM v_node"""
HIT_NAME = "({t} IN (low, dotted, last))"


def _token(token: str) -> str:
    body = token.strip("+")
    return f"(tag = {_text(body[4:])})" if body.startswith("tag:") else HIT_NAME.format(t=_text(body.lower()))


def _any(tokens: list[str]) -> str:
    return "(" + " OR ".join(_token(t) for t in tokens) + ")" if tokens else "FALSE"


def _closure(name: str, seeds: str, src: str, dst: str, origin: str) -> str:
    return (
        f"{name} AS (SELECT {dst} AS id FROM v_edge WHERE origin = '{origin}' AND {src} IN ({seeds}) "
        f"UNION SELECT {dst} FROM v_edge JOIN {name} ON {src} = id WHERE origin = '{origin}')"
    )


def steps(text: str, also: str = "") -> str:
    """``text`` with the steps and views it uses before it."""
    import re

    out: list[str] = []

    def need(t: str) -> None:
        for name in re.findall(r"\bo_\w+", t):
            if name in STEPS and name not in out:
                need(STEPS[name])
                if name not in out:
                    out.append(name)

    need(also + " " + text)
    ctes = [f"{n} AS ({STEPS[n].strip()})" for n in out] + ([also] if also else [])
    if not ctes:
        return duckdb_sql(text)
    head = "WITH RECURSIVE " if also else "WITH "
    return duckdb_sql(head + ", ".join(ctes) + " " + text)


ORACLES: dict[str, str] = {}


def oracle(name: str, text: str, also: str = "") -> None:
    ORACLES[name] = steps(text, also)


# --- sources --------------------------------------------------------------------------------

_O = "o_orderkey"
_GOOD = f"FROM {{orders}} WHERE {_O} % 13 NOT IN (1, 2, 3)"
_RUN = f"'p' || CAST({_O} % 4 AS STRING) AS project, 'r' || CAST({_O} AS STRING) AS run_id"
_THIS, _THAT = f"'order.' || CAST({_O} AS STRING)", "'customer.' || CAST(o_custkey AS STRING)"
_FILE = f"'/in/' || CAST({_O} AS STRING) || '.json'"
oracle("read_manifests", f"""
SELECT {_RUN}, 'node' AS kind, {_THIS} AS node_id,
  concat_ws('|', 'Order_' || CAST({_O} AS STRING), o_orderpriority, 'select ' || CAST({_O} AS STRING), 'sales.' || o_orderstatus,
    CASE WHEN {_O} % 9 > 0 THEN o_orderpriority END) AS content {_GOOD}
UNION ALL SELECT {_RUN}, 'parent_map', {_THIS}, p FROM (SELECT *, unnest([{_THAT}, 'source.s']) AS p {_GOOD} AND {_O} % 10 > 0) x
UNION ALL SELECT {_RUN}, 'child_map', {_THIS}, {_THAT} {_GOOD}
UNION ALL SELECT {_RUN}, 'meta', '', concat_ws('|', CASE WHEN {_O} % 4 > 0 THEN '1.7' ELSE 'unknown' END,
    'https://schemas.example.org/manifest/v' || CAST({_O} % 14 AS STRING) || '.json', 'unknown',
    CASE WHEN {_O} % 2 > 0 THEN 'duckdb' END) {_GOOD}
UNION ALL SELECT {_RUN}, 'reject', {_FILE}, CASE {_O} % 13 WHEN 1 THEN 'manifest not found'
    WHEN 2 THEN 'manifest is not valid JSON' ELSE 'manifest is not a JSON object' END
  FROM {{orders}} WHERE {_O} % 13 IN (1, 2, 3)""")
oracle("manifest_schema_version", """
SELECT page_id, CASE WHEN page_id % 4 > 0 THEN 'v' || CAST(page_id % 15 AS STRING) END AS schema_token,
  page_id % 4 > 0 AND page_id % 15 BETWEEN 9 AND 12 AS is_known FROM {pages}""")
oracle("read_optional_artifact", f"SELECT {_RUN}, {_FILE} AS path FROM {{orders}} WHERE {_O} % 13 NOT IN (1, 2)")
STEPS["o_sql_of"] = """
SELECT n.*, coalesce(nullif(compiled_code, ''), nullif(compiled_sql, ''), f.text) AS sql FROM v_node n
LEFT JOIN v_file f ON f.path = CASE WHEN compiled_path LIKE '/%' THEN compiled_path
  WHEN compiled_path <> '' THEN '/work/target/' || compiled_path END"""
oracle("resolve_compiled_sql", "SELECT node_id, sql FROM o_sql_of")
_LINE = "'line.' || concat_ws('.', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS node_id"
_COL = "'C' || CAST(l_partkey % 5 AS STRING)"
oracle("normalize_response", f"SELECT {_LINE}, {_COL} AS first_target, TRUE AS has_flow FROM {{lineitem}}")
oracle("classify_response", """
SELECT node_id, CASE WHEN reason IS NULL THEN 'ok' ELSE 'failed' END AS outcome, reason,
  CASE WHEN reason IS NOT NULL THEN detail END AS detail
FROM (SELECT *, CASE WHEN http_status = 429 AND mode = 'anonymous' THEN 'quota_limited'
  WHEN http_status >= 400 OR code <> '200' THEN 'parser_error' END AS reason FROM v_resp) x""")
_DB = "CASE WHEN l_suppkey % 3 > 0 THEN 'db.' ELSE '' END || 'sch.'"
oracle("explode_dbobjs", f"""
SELECT {_LINE}, CAST(l_suppkey AS STRING) AS table_id, 'tables' AS collection, {_DB} || 'tab_' || CAST(l_suppkey AS STRING) AS fqn,
  CASE WHEN l_suppkey % 2 = 0 THEN 'temp_table' END AS sub_type, TRUE AS is_real FROM {{lineitem}}
UNION ALL SELECT {_LINE}, '-1', 'others', {_DB} || 'RS-' || CAST(l_linenumber AS STRING), NULL, FALSE FROM {{lineitem}}""")
oracle("explode_relationships", f"""
SELECT {_LINE}, 0 AS rel_ord, l_returnflag AS rel_type, '-1' AS target_parent_id, {_COL} AS target_col, 0 AS src_ord,
  CAST(l_suppkey AS STRING) AS source_parent_id, 'k' || CAST(l_partkey % 7 AS STRING) AS source_col FROM {{lineitem}}
UNION ALL SELECT {_LINE}, 0, l_returnflag, '-1', {_COL}, 1, '404', '' FROM {{lineitem}}
UNION ALL SELECT {_LINE}, 1, 'fdr', CAST(l_suppkey AS STRING), '*', NULL, NULL, NULL FROM {{lineitem}}""")
oracle("explode_diagnostics", f"""
SELECT {_LINE}, 4 AS err_ord, 'SyntaxHint' AS type, 'orphan_column' AS category, {_COL} AS near_column,
  CAST(l_linenumber AS BIGINT) AS line, l_suppkey AS col,
  'find orphan column(10500) near: [' || {_COL} || '](' || CAST(l_linenumber AS STRING) || ', ' || CAST(l_suppkey AS STRING) || ')' AS message
FROM {{lineitem}} WHERE l_suppkey % 11 > 0
UNION ALL SELECT {_LINE}, 5, CASE WHEN l_suppkey % 2 = 0 THEN 'Note' ELSE 'Hint' END, NULL, NULL, l_linenumber, NULL, 'odd token'
FROM {{lineitem}} WHERE l_suppkey % 11 > 0""")

# --- sinks ----------------------------------------------------------------------------------

def _json(c: str) -> str:
    return f"CAST(to_json({c}) AS STRING)"


def _member(name: str, c: str, number: bool = False) -> str:
    return f"'\"{name}\":' || " + (f"CAST({c} AS STRING)" if number else _json(c))


STEPS["o_doc_columns"] = f"""
SELECT c.project, c.run_id, c.node_id, '[' || string_agg('{{' || concat_ws(',', {_member('confidence', 'confidence')},
  {_member('name', 'name')}, {_member('transform', 'transform')}, '"upstream":[' || coalesce(ups, '') || ']') || '}}', ',' ORDER BY name) || ']' AS cols
FROM o_columns c LEFT JOIN (SELECT {K}, "column", string_agg('{{' || concat_ws(',', {_member('column', 'up_column')},
  {_member('table', 'up_table')}) || '}}', ',' ORDER BY up_table, up_column) AS ups FROM o_edges GROUP BY {K}, "column") e
ON (c.node_id, c.name) = (e.node_id, e."column") GROUP BY c.project, c.run_id, c.node_id"""
_fields = [("col", True), ("detail", False), ("fragment_preview", False), ("line", True), ("marker", False), ("parser_message", False),
           ("reason", False), ("rel_type", False), ("source_parent_id", False), ("target_column", False)]
STEPS["o_doc_reasons"] = (
    f"SELECT {K}, '[' || string_agg('{{' || concat_ws(',', "
    + ", ".join(_member(f, f, n) for f, n in _fields)
    + ") || '}', ',' ORDER BY section, ord NULLS FIRST, src_ord NULLS FIRST, target_column NULLS FIRST) || ']' AS reasons "
    f"FROM o_reasons GROUP BY {K}"
)
_diag_fields = [("category", False), ("col", True), ("line", True), ("message", False), ("near_column", False), ("type", False)]
STEPS["o_doc_diags"] = (
    "SELECT node_id, '\"parser_diagnostics\":[' || string_agg('{' || concat_ws(',', "
    + ", ".join(_member(f, f, n) for f, n in _diag_fields)
    + ") || '}', ',' ORDER BY err_ord) || ']' AS diags FROM o_diag GROUP BY node_id"
)
STEPS["o_doc_targets"] = f"""
SELECT node_id, target_fqn, write_target_count, column_edge_count, process_count,
  '{{"columns":[' || array_to_string(list_distinct_in_order, ',') || '],"edges":[' || edges || '],"from":[' || froms || ']'
  || CASE WHEN sub_type <> '' THEN ',"subType":' || {_json('sub_type')} ELSE '' END || ',"table":' || {_json('target_fqn')} || '}}' AS target
FROM (SELECT node_id, target_fqn, any_value(sub_type) AS sub_type, any_value(write_target_count) AS write_target_count,
    any_value(column_edge_count) AS column_edge_count, any_value(process_count) AS process_count,
    list_sort(list(DISTINCT {_json('target_col')})) AS list_distinct_in_order,
    string_agg('{{"from":{{' || {_member('column', 'up_column')} || ',' || {_member('table', 'up_table')} || '}},' || {_member('target_column', 'target_col')} || '}}', ','
      ORDER BY target_col, up_table, up_column) AS edges,
    string_agg(DISTINCT {_json('up_table')}, ',' ORDER BY {_json('up_table')}) AS froms
  FROM o_procedural GROUP BY node_id, target_fqn) x"""
STEPS["o_doc_evidence"] = f"""
SELECT node_id, '"evidence":{{' || concat_ws(',', diags, procs) || '}},' AS evidence
FROM o_doc_diags FULL JOIN (
  SELECT node_id, '"procedural":{{"column_edge_count":' || any_value(column_edge_count) || ',"process_count":' || any_value(process_count)
    || ',"write_target_count":' || any_value(write_target_count) || ',"write_targets":[' || string_agg(target, ',' ORDER BY target_fqn) || ']}}' AS procs
  FROM o_doc_targets GROUP BY node_id) w USING (node_id)"""
STEPS["o_docs"] = f"""
SELECT s.project, s.run_id, s.node_id,
  '{{"columns":' || coalesce(cols, '[]') || ',' || concat_ws(',', {_member('confidence', 's.confidence')}, {_member('dialect', 'r.dialect')})
  || ',"downstream":[' || coalesce(kids, '') || '],' || coalesce(evidence, '') || {_member('node_id', 's.node_id')} || ',' || {_member('status', 's.status')}
  || ',"unresolved":' || coalesce(reasons, '[]')
  || ',"upstream_tables":[' || coalesce(tabs, '') || '],"warnings":[]}}' AS doc
FROM o_status s JOIN v_resp r ON s.node_id = r.node_id
LEFT JOIN (SELECT node_id, string_agg({_json('child_id')}, ',' ORDER BY child_id) AS kids FROM v_child GROUP BY node_id) k ON k.node_id = s.node_id
LEFT JOIN o_doc_evidence v ON v.node_id = s.node_id
LEFT JOIN o_doc_columns c ON c.node_id = s.node_id LEFT JOIN o_doc_reasons x ON x.node_id = s.node_id
LEFT JOIN (SELECT node_id, string_agg({_json('fqn')}, ',' ORDER BY fqn) AS tabs FROM o_upstream GROUP BY node_id) t ON t.node_id = s.node_id"""
oracle("render_lineage_doc", "SELECT * FROM o_docs")
STEPS["o_node_stats"] = f"""
SELECT project, run_id, {', '.join(f"count(*) FILTER (status = '{s}') AS {s}" for s in S.STATUSES)},
  CAST(sum(total_columns) AS BIGINT) AS total_columns, CAST(sum(resolved_columns) AS BIGINT) AS resolved_columns,
  round_even(sum(resolved_columns) / nullif(sum(total_columns), 0), 4) AS coverage FROM o_status GROUP BY ALL"""
oracle("deterministic_order", f"""
SELECT project, run_id, 0 AS section, '' AS node_id, '{{"backend":{{"mode":"none"}},"generator":"colweave","manifest_metadata":{{"project_name":"'
  || project || '"}},"nodes":[' AS line FROM o_node_stats
UNION ALL SELECT project, run_id, 1, node_id, CASE WHEN node_id = min(node_id) OVER (PARTITION BY project, run_id) THEN '' ELSE ',' END || doc FROM o_docs
UNION ALL SELECT project, run_id, 2, '', '],"schema_version":"0.2.x","stats":{{' || concat_ws(',', '"coverage":' || CAST(coalesce(coverage, 0.0) AS STRING),
  {', '.join(_member(s, s, True) for s in sorted([*S.STATUSES, 'resolved_columns', 'total_columns']))}) || '}}}}' FROM o_node_stats""")
def _content(*fields: str) -> str:
    return "concat_ws('|', " + ", ".join(f"CAST({f} AS STRING)" for f in fields) + ")"


oracle("read_lineage_docs", f"""
SELECT project, run_id, '' AS node_id, 'header' AS kind, '0.2.x|colweave|none|' || project || '|' || parsed || '|' || total_columns AS content FROM o_node_stats
UNION ALL SELECT s.project, s.run_id, s.node_id, 'node', {_content('status', 'confidence', 'dialect')} FROM o_status s JOIN v_resp r ON r.node_id = s.node_id
UNION ALL SELECT {K}, 'column', {_content('name', 'transform', 'confidence')} FROM o_columns
UNION ALL SELECT {K}, 'edge', {_content('"column"', 'up_table', 'up_column')} FROM o_edges
UNION ALL SELECT {K}, 'table', fqn FROM o_upstream
UNION ALL SELECT c.project, c.run_id, c.node_id, 'child', child_id FROM v_child c JOIN o_status s ON s.node_id = c.node_id
UNION ALL SELECT {K}, 'reason', {_content('reason', 'target_column', 'source_parent_id', 'line', 'col', 'parser_message', 'marker')} FROM o_reasons
UNION ALL SELECT {K}, 'diagnostic', {_content('type', 'category', 'near_column', 'line', 'col', 'message')} FROM o_diag
UNION ALL SELECT {K}, 'write', {_content('target_fqn', 'target_col', 'up_table', 'up_column', "nullif(sub_type, '')", 'write_target_count', 'process_count')} FROM o_procedural""")
_PLATFORM = _case("dialect", S.DIALECT_PLATFORMS | {"dbvpresto": "presto_db"}, "coalesce(nullif(replace(dialect, 'dbv', ''), ''), 'external')")
STEPS["o_platform"] = f"""
SELECT s.project, s.run_id, s.node_id, {_PLATFORM} AS p FROM o_status s JOIN v_resp r ON s.node_id = r.node_id
WHERE status IN ('parsed', 'partial')"""


def _urn(name: str) -> str:
    return f"('urn:li:dataset:(urn:li:dataPlatform:' || p || ',' || {name} || ',PROD)')"


oracle("emit_datahub", f"""
SELECT n.node_id, '{{"aspect":{{"json":{{"fineGrainedLineages":[' || coalesce(fine, '') || '],"upstreams":[' || coalesce(coarse, '')
  || ']}}}},"aspectName":"upstreamLineage","changeType":"UPSERT","entityType":"dataset","entityUrn":"' || {_urn('n.node_id')}
  || '","systemMetadata":{{"lastObserved":0,"registryName":"colweave","registryVersion":"colweave","runId":"colweave"}}}}' AS payload
FROM o_platform n
LEFT JOIN (SELECT e.node_id, string_agg('{{"downstreamType":"FIELD","downstreams":["urn:li:schemaField:(' || {_urn('e.node_id')} || ',' || "column"
    || ')"],"transformOperation":"' || transform || '","upstreamType":"FIELD_SET","upstreams":["urn:li:schemaField:(' || {_urn('up_table')} || ',' || up_column
    || ')"]}}', ',' ORDER BY "column", up_table, up_column) AS fine
  FROM o_edges e JOIN o_columns c ON (e.node_id, e."column") = (c.node_id, c.name) JOIN o_platform p ON p.node_id = e.node_id GROUP BY e.node_id) f
  ON f.node_id = n.node_id
LEFT JOIN (SELECT u.node_id, string_agg('{{"auditStamp":{{"actor":"urn:li:corpuser:colweave","time":0}},"dataset":"' || {_urn('fqn')}
    || '","type":"TRANSFORMED"}}', ',' ORDER BY fqn) AS coarse FROM o_upstream u JOIN o_platform p ON p.node_id = u.node_id GROUP BY u.node_id) t
  ON t.node_id = n.node_id""")
_SERVICE = _case("dialect", S.DIALECT_PLATFORMS, "replace(coalesce(nullif(dialect, ''), 'external'), 'dbv', '')")
oracle("emit_openmetadata", f"""
SELECT n.node_id, n.fqn AS up_table, '{{"edge":{{"fromEntity":{{"fullyQualifiedName":"' || src || '","type":"table"}}'
  || CASE WHEN cols IS NULL THEN '' ELSE ',"lineageDetails":{{"columnsLineage":[' || cols || ']}}' END
  || ',"toEntity":{{"fullyQualifiedName":"' || svc || '.' || n.node_id || '","type":"table"}}}}}}' AS payload
FROM (SELECT u.node_id, fqn, svc, svc || '.' || fqn AS src FROM o_upstream u JOIN (SELECT s.node_id, {_SERVICE} AS svc FROM o_status s
    JOIN v_resp r ON s.node_id = r.node_id WHERE status IN ('parsed', 'partial')) v ON u.node_id = v.node_id) n
LEFT JOIN (SELECT node_id, up_table, string_agg('{{"fromColumns":[' || ups || '],"toColumn":"' || svc || '.' || node_id || '.' || "column" || '"}}', ',' ORDER BY "column") AS cols
  FROM (SELECT e.node_id, up_table, svc, "column", string_agg('"' || svc || '.' || up_table || '.' || up_column || '"', ',' ORDER BY up_column) AS ups
    FROM o_edges e JOIN (SELECT node_id, {_SERVICE} AS svc FROM v_resp) v ON e.node_id = v.node_id GROUP BY ALL) x GROUP BY ALL) c
  ON (c.node_id, c.up_table) = (n.node_id, n.fqn)""")

_SPACE = _text(WHITESPACE.replace(r"\x0B", r"\x{0B}").replace(r"\x1C-\x1F", r"\x{1C}-\x{1F}"))


def _normal(c: str) -> str:
    return f"trim(regexp_replace({c}, {_SPACE}, ' ', 'g'))"


_KEY_OF = f"sha256(concat_ws('|', {_normal('sql')}, dialect, 'anonymous', 'unknown', '1.0'))"
STEPS["o_requests"] = f"SELECT *, {_KEY_OF} AS cache_key FROM v_request"
STEPS["o_cached"] = "SELECT DISTINCT cache_key FROM o_requests WHERE o_custkey % 3 = 0 AND o_custkey % 4 > 0"
oracle("write_response_cache", f"""
SELECT DISTINCT left(cache_key, 2) AS bucket, cache_key, CASE WHEN o_custkey % 4 > 0 THEN '{{"sql":"' || {_normal('sql')} || '"}}' ELSE '{{"sql":"?"}}' END AS payload
FROM o_requests""")

_RT = "resource_type"
_REASON = (
    f"CASE WHEN {_RT} IS NULL THEN 'missing resource_type' WHEN {_RT} IN ({_list(S.ELIGIBLE_TYPES)}) THEN NULL "
    f"ELSE coalesce({_case(_RT, S.SKIP_REASONS)}, 'unsupported resource_type ''' || {_RT} || '''') END"
)
_KNOWN = _case("lower(trim(adapter_type))", S.ADAPTER_DIALECTS)
_NAMES = "[" + ", ".join(f"'{n}'" for n in sorted(S.ADAPTER_DIALECTS)) + "]"
_UNKNOWN = f"'dialect: unknown adapter_type ' || coalesce('''' || adapter_type || '''', 'None') || {_text('; pass --dialect to override. Known: ' + _NAMES)}"
STEPS["o_planned"] = f"""
SELECT *, skip_reason IS NULL AS eligible FROM (SELECT *, CASE WHEN dialect IS NULL THEN {_UNKNOWN} WHEN reason IS NOT NULL THEN reason
  WHEN coalesce(sql, '') = '' THEN 'missing compiled SQL' END AS skip_reason
FROM (SELECT *, {_KNOWN} AS dialect, {_REASON} AS reason FROM o_sql_of) x) y"""
oracle("plan_report", f"""
SELECT node_id, name, resource_type, dialect, coalesce(nullif(compiled_path, ''), path) AS sql_path, eligible, skip_reason,
  CASE WHEN reason IS NULL THEN coalesce(length(sql), 0) ELSE 0 END AS chars FROM o_planned""")
STEPS["o_stats"] = f"""
SELECT project, run_id, {', '.join(f"count(*) FILTER (status = '{s}') AS {s}" for s in S.STATUSES)},
  CAST(sum(total_columns) AS BIGINT) AS total_columns, CAST(sum(resolved_columns) AS BIGINT) AS resolved_columns,
  count(*) FILTER (status <> 'skipped') AS eligible_count,
  coalesce(round_even(sum(resolved_columns) / nullif(sum(total_columns), 0), 4), 0.0) AS coverage
FROM v_run GROUP BY project, run_id"""
oracle("run_summary", """
SELECT project, run_id, 'wrote lineage — ' || concat_ws(', ', CAST(parsed AS STRING) || ' parsed', CAST(partial AS STRING) || ' partial',
  CAST(failed AS STRING) || ' failed', CAST(skipped AS STRING) || ' skipped', 'coverage ' || CAST(CAST(round_even(coverage * 100, 0) AS INT) AS STRING) || '%') AS summary
FROM o_stats""")

# --- column rules ---------------------------------------------------------------------------

oracle("normalize_sql", f"SELECT id, {_normal('text')} AS sql FROM o_texts")
oracle("cache_key", "SELECT cache_key, count(*) AS n, min(node_id) AS first_node FROM o_requests GROUP BY cache_key")
_Q, _STR, _NUM = _text(QUOTED.replace('\\"', '"')), _text(STRING), _text(NUMBER)
_HOLD = "chr(1) || 'IDENT([0-9]+)' || chr(1)"
oracle("redact_literals", f"""
SELECT id, array_to_string(list_transform(range(1, len(pieces) + 1), lambda i: pieces[i] || coalesce(ids[CAST(rest[i] AS INT) + 1], '')), '') AS masked
FROM (SELECT *, string_split_regex(done, chr(1) || 'IDENT[0-9]+' || chr(1)) AS pieces, regexp_extract_all(done, {_HOLD}, 1) AS rest
FROM (SELECT *, regexp_replace(regexp_replace(stashed, {_STR}, '''<REDACTED>''', 'g'), {_NUM}, '0', 'g') AS done
FROM (SELECT id, ids, array_to_string(list_transform(range(1, len(gaps) + 1), lambda i: gaps[i]
    || CASE WHEN i <= len(ids) THEN chr(1) || 'IDENT' || CAST(i - 1 AS STRING) || chr(1) ELSE '' END), '') AS stashed
FROM (SELECT id, regexp_extract_all(text, {_Q}) AS ids, string_split_regex(text, {_Q}) AS gaps FROM o_texts) a) b) c) d""")
oracle("dynamic_sql_marker", f"SELECT id, {MARKER} AS marker FROM o_marked_text")
oracle("marker_excerpt", f"SELECT id, {EXCERPT.format(text='text')} AS excerpt FROM o_marked_text")
_CANON = "CASE WHEN {c} LIKE 'dbv%' THEN {c} ELSE coalesce({known}, 'dbv' || {c}) END"
_ADAPTER = "lower(trim(coalesce(adapter_type, 'DBVx')))"
oracle("canonical_dialect", f"SELECT node_id, {_CANON.format(c=_ADAPTER, known=_case(_ADAPTER, S.ADAPTER_DIALECTS))} AS dialect FROM v_node")
oracle("resolve_dialect", f"""
SELECT node_id, dialect, CASE WHEN dialect IS NULL THEN {_UNKNOWN} END AS error
FROM (SELECT *, CASE WHEN name LIKE '%7' THEN 'dbvtrino' ELSE {_KNOWN} END AS dialect FROM v_node) x""")
_P8 = _case("dialect", S.DIALECT_PLATFORMS | {"dbvmssql": "tsql"}, "coalesce(nullif(replace(dialect, 'dbv', ''), ''), 'external')")
oracle("dialect_platform", f"SELECT node_id, {_P8} AS platform FROM v_resp")
oracle("dataset_urn", """
SELECT node_id, table_id, 'urn:li:dataset:(urn:li:dataPlatform:' || CASE WHEN is_real THEN 'bigquery' ELSE 'external' END || ',' || fqn || ',DEV)' AS urn
FROM o_tables""")
oracle("schema_field_urn", """
SELECT node_id, rel_ord, 'urn:li:schemaField:(urn:li:dataset:(urn:li:dataPlatform:spark,' || target_parent_id || ',PROD),' || target_col || ')' AS urn FROM v_line""")
oracle("service_fqn", """
SELECT node_id, table_id, CASE WHEN is_real THEN 'spark' WHEN db = '' THEN '' ELSE 'external' END || '.' || fqn AS fqn FROM o_tables""")
oracle("table_fqn", "SELECT node_id, table_id, fqn FROM o_tables")
oracle("is_real_table", "SELECT node_id, table_id, is_real FROM o_tables")
oracle("is_synthetic_column", f"SELECT node_id, rel_ord, {SYNTHETIC.format(c='target_col')} AS is_synthetic FROM v_line")
oracle("classify_relationship", f"SELECT node_id, rel_ord, {TRANSFORM} AS transform, lower(rel_type) <> 'fdr' AS is_value FROM v_line")
oracle("parse_orphan_diagnostic", "SELECT node_id, err_ord, type, category, near_column, line, col, message FROM o_diag")
oracle("lineage_eligibility", f"SELECT node_id, {_REASON} IS NULL AS eligible, {_REASON} AS skip_reason FROM v_node")
oracle("eligibility_with_sql", "SELECT node_id, dialect, eligible, skip_reason FROM o_planned")
oracle("emit_status_filter", f"SELECT {K}, status FROM v_run WHERE status IN ('parsed', 'partial')")
oracle("drop_star_targets", "SELECT node_id, rel_ord, target_fqn, target_col FROM o_kept")

# --- joins ----------------------------------------------------------------------------------

oracle("join_relationship_targets", f"SELECT {K}, rel_ord, target_fqn, target_is_real, target_col FROM o_targets")
oracle("join_relationship_sources", f"""
SELECT {K}, rel_ord, target_fqn, target_col, up_table, up_column, source_unknown, source_parent_id FROM o_resolved""")
oracle("resolve_one_hop", f"SELECT DISTINCT {K}, target_fqn, target_col, up_table, up_column FROM o_hops")
oracle("attach_orphan_reason", "SELECT * FROM o_orphans")
oracle("attach_downstream", """
SELECT n.node_id, e.child_id FROM v_node n LEFT JOIN v_edge e ON e.parent_id = n.node_id AND e.origin = 'child_map'""")
oracle("split_cached", """
SELECT node_id, CASE WHEN cache_key IN (SELECT cache_key FROM o_cached) THEN 'cached' ELSE 'to_parse' END AS state FROM o_requests""")
oracle("attach_write_subtype", "SELECT * FROM o_subtypes")
_URGENT = "SELECT node_id FROM v_node WHERE tag = '1-URGENT'"
oracle("known_nodes_only", "SELECT id AS node_id FROM up_walk WHERE id IN (SELECT node_id FROM v_node)",
       _closure("up_walk", _URGENT, "child_id", "parent_id", "parent_map"))

# --- aggregates -----------------------------------------------------------------------------

oracle("accumulate_target_columns", f"SELECT {K}, target_fqn, target_col, first_ord, transform, first_is_value, n_upstream FROM o_groups")
oracle("column_confidence", f"SELECT {K}, target_fqn, target_col, confidence FROM o_rated")
oracle("merge_columns_by_name", """
SELECT c.project, c.run_id, c.node_id, c.name, c.transform, c.confidence, e.up_table, e.up_column
FROM o_columns c LEFT JOIN o_edges e ON (c.node_id, c.name) = (e.node_id, e."column")""")
oracle("upstream_tables", "SELECT * FROM o_upstream")
oracle("node_status", "SELECT * FROM o_status")
oracle("unresolved_rows", "SELECT * FROM o_reasons")
oracle("procedural_write_targets", "SELECT * FROM o_procedural")
oracle("compute_node_confidence", f"SELECT {K}, confidence FROM o_status")
oracle("run_stats", "SELECT * FROM o_stats")
_NODE_COV = "coalesce((parsed + partial) / nullif(eligible_count, 0), 1.0)"
oracle("node_coverage", f"SELECT project, run_id, round({_NODE_COV}, 9) AS node_coverage FROM o_stats")
oracle("column_coverage", "SELECT project, run_id, coverage AS column_coverage FROM o_stats")
oracle("edge_counts", """
SELECT r.project, r.run_id, r.node_id, count(e.node_id) AS n_edges FROM v_resp r LEFT JOIN o_edges e ON e.node_id = r.node_id GROUP BY ALL""")
oracle("cache_hit_stats", """
SELECT project, run_id, hits, misses, CAST(floor(100 * hits / (hits + misses)) AS BIGINT) AS hit_rate_pct
FROM (SELECT project, run_id, count(*) - count(DISTINCT CASE WHEN cache_key NOT IN (SELECT cache_key FROM o_cached) THEN cache_key END) AS hits,
  count(DISTINCT CASE WHEN cache_key NOT IN (SELECT cache_key FROM o_cached) THEN cache_key END) AS misses
FROM o_requests GROUP BY project, run_id) x""")
oracle("apply_dynamic_sql", """
SELECT s.project, s.run_id, s.node_id, CASE WHEN found IS NOT NULL AND status = 'parsed' THEN 'partial' ELSE status END AS status,
  CASE WHEN found IS NOT NULL THEN 'low' ELSE confidence END AS confidence
FROM o_status s LEFT JOIN o_marked_sql m ON m.node_id = s.node_id""")

# --- ordinals and sets ----------------------------------------------------------------------

oracle("quota_cut", f"""
SELECT {K}, CASE WHEN calls > 50 THEN 'failed' ELSE 'answered' END AS outcome, CASE WHEN calls > 50 THEN 'quota_limited' END AS reason,
  CASE WHEN calls = 51 AND is_new = 1 THEN 'anonymous tier rate-limited' WHEN calls > 50 THEN 'anonymous tier exhausted earlier in this run' END AS detail
FROM (SELECT *, sum(is_new) OVER (PARTITION BY project, run_id ORDER BY node_id) AS calls
FROM (SELECT *, CASE WHEN row_number() OVER (PARTITION BY project, run_id, cache_key ORDER BY node_id) = 1
    AND cache_key NOT IN (SELECT cache_key FROM o_cached) THEN 1 ELSE 0 END AS is_new
  FROM o_requests WHERE o_custkey % 5 > 0) x) y""")


def _preview(where: str, keys: str, source: str = "v_run") -> str:
    return (
        f"SELECT {keys}, count(*) AS n, array_to_string(list(node_id ORDER BY node_id)[1:5], ', ') "
        f"|| CASE WHEN count(*) > 5 THEN '...' ELSE '' END AS preview FROM {source} WHERE {where} GROUP BY {keys}"
    )


oracle("failure_preview", _preview("status IN ('failed', 'unsupported')", "project, run_id, status"))
from colweave.bindings.queries import EXCLUDED, TOKENS, TYPES  # noqa: E402

_ALL = "SELECT node_id FROM o_nodes"
oracle("select_union", f"{_ALL} WHERE {_any(TOKENS)}")
oracle("select_exclude", f"{_ALL} WHERE NOT coalesce({_any(EXCLUDED)}, FALSE)")
_WANTED = f"lower(resource_type) IN ({_list([t.strip().lower() for t in TYPES])})"
oracle("select_resource_type", f"SELECT node_id, resource_type FROM v_node WHERE {_WANTED}")

# --- graph ----------------------------------------------------------------------------------

oracle("match_tag", "SELECT node_id FROM v_node WHERE tag IN ('BUILDING', '2-HIGH')")
oracle("match_name_or_fqn", f"{_ALL} WHERE {_any(['nation_3', 'geo.region.asia', 'order_11', 'customer#000000004'])}")
oracle("ancestors", "SELECT id AS node_id FROM up_walk", _closure("up_walk", _URGENT, "child_id", "parent_id", "parent_map"))
oracle("descendants", "SELECT id AS node_id FROM down_walk",
       _closure("down_walk", "SELECT node_id FROM v_node WHERE name = 'ASIA'", "parent_id", "child_id", "child_map"))


def _up(name: str, tokens: list[str]) -> str:
    return _closure(name, f"{_ALL} WHERE {_any([t for t in tokens if t.startswith('+')])}", "child_id", "parent_id", "parent_map")


def _down(name: str, tokens: list[str]) -> str:
    return _closure(name, f"{_ALL} WHERE {_any([t for t in tokens if t.endswith('+')])}", "parent_id", "child_id", "child_map")


oracle("select_nodes", f"""
SELECT node_id FROM o_nodes WHERE {_WANTED}
  AND ({_any(TOKENS)} OR node_id IN (SELECT id FROM sel_up) OR node_id IN (SELECT id FROM sel_down))
  AND NOT ({_any(EXCLUDED)} OR node_id IN (SELECT id FROM exc_up))""",
       ", ".join([_up("sel_up", TOKENS), _down("sel_down", TOKENS), _up("exc_up", EXCLUDED)]))

# --- gates and comparison -------------------------------------------------------------------


def _percent(c: str) -> str:
    return f"format('{{:.2f}}%', round_even(({c}) * 100, 2))"


def _coverage_gate(name: str, value: str, least: float) -> str:
    return (
        f"SELECT project, run_id, '{name}' AS gate, '{name.replace('_', ' ')} ' || {_percent(value)} || ' below required {least * 100:.2f}%' AS message "
        f"FROM o_stats WHERE {value} < {least}"
    )


def _status_gate(status: str) -> str:
    preview = _preview(f"status = '{status}'", "project, run_id")
    return (
        f"SELECT project, run_id, '{status}' AS gate, CAST(n AS STRING) || ' node(s) status={status}: ' || preview AS message FROM ({preview}) p_{status}"
    )


GATES = {
    "gate_node_coverage": _coverage_gate("node_coverage", _NODE_COV, 0.5),
    "gate_column_coverage": _coverage_gate("column_coverage", "coverage", 0.66),
    "gate_unsupported": _status_gate("unsupported"),
    "gate_failed": _status_gate("failed"),
}
for _name, _gate in GATES.items():
    oracle(_name, _gate)
STEPS["o_counts"] = """
SELECT r.project, r.node_id, coalesce(c.n, 0) AS cur, coalesce(b.n, 0) AS base FROM v_resp r
LEFT JOIN (SELECT node_id, count(*) AS n FROM v_cur GROUP BY ALL) c ON c.node_id = r.node_id
LEFT JOIN (SELECT node_id, count(*) AS n FROM v_base GROUP BY ALL) b ON b.node_id = r.node_id"""
STEPS["o_lost"] = "SELECT project, 'r1' AS run_id, node_id, base - cur AS edges_lost, cur AS current, base AS baseline FROM o_counts WHERE cur < base"
oracle("gate_regression", f"""
SELECT project, run_id, 'regression' AS gate, CAST(n AS STRING) || ' regression(s) vs baseline: ' || preview AS message
FROM ({_preview('TRUE', 'project, run_id', 'o_lost')}) p""")
oracle("edge_count_regressions", "SELECT * FROM o_lost")
STEPS["o_check_stats"] = STEPS["o_stats"].replace("v_run", "v_check")


def _over_check(gate: str) -> str:
    return gate.replace("o_stats", "o_check_stats").replace("FROM v_run", "FROM v_check")


_FIVE = [
    _over_check(_coverage_gate("node_coverage", _NODE_COV, 0.85)), _over_check(GATES["gate_column_coverage"]),
    _over_check(GATES["gate_unsupported"]), _over_check(GATES["gate_failed"]),
    "SELECT project, run_id, 'regression' AS gate, CAST(n AS STRING) || ' regression(s) vs baseline: ' || preview AS message "
    f"FROM ({_preview('TRUE', 'project, run_id', 'o_lost')}) p WHERE project <> 'shop3'",
]
oracle("check_run", f"""
SELECT s.project, s.run_id, gate, coalesce(message, 'OK: all check gates passed.') AS message
FROM o_check_stats s LEFT JOIN ({' UNION ALL '.join(_FIVE)}) f ON (s.project, s.run_id) = (f.project, f.run_id)
UNION ALL SELECT project, run_id, 'baseline', 'warning: baseline not found; skipping regression check' FROM o_check_stats WHERE project = 'shop3'""")
oracle("diff_report", """
SELECT project, run_id, node_id, format('  {}: {} -> {} (-{})', node_id, baseline, current, edges_lost) AS line,
  '{"node_id":"' || node_id || '","edges_lost":' || edges_lost || ',"current":' || current || ',"baseline":' || baseline || '}' AS json FROM o_lost
UNION ALL SELECT project, 'r1', NULL, CASE WHEN n = 0 THEN 'No regressions: every node has at least as many column edges as baseline.'
  ELSE CAST(n AS STRING) || ' regression(s) vs baseline:' END, NULL
FROM (SELECT p.project, count(l.node_id) AS n FROM (SELECT DISTINCT project FROM v_cur) p LEFT JOIN o_lost l ON l.project = p.project GROUP BY ALL) x""")
oracle("compare_against_stock", """
SELECT project, node_id, coalesce(cur, 0) AS ours, coalesce(base, 0) AS other, coalesce(cur, 0) > coalesce(base, 0) AS ours_exceeds FROM o_counts""")


def _side(view: str, what: str, column: str) -> str:
    return f"(SELECT node_id, count(DISTINCT {what}) AS {column} FROM {view} GROUP BY node_id)"


oracle("golden_drift", f"""
SELECT * FROM (SELECT n.project, n.node_id,
  (SELECT count(*) FROM ((SELECT up_table FROM v_cur c WHERE c.node_id = n.node_id EXCEPT SELECT up_table FROM v_base b WHERE b.node_id = n.node_id)
    UNION ALL (SELECT up_table FROM v_base b WHERE b.node_id = n.node_id EXCEPT SELECT up_table FROM v_cur c WHERE c.node_id = n.node_id)) d) AS table_diff,
  coalesce(cc.columns, 0) AS columns, coalesce(bc.columns, 0) AS golden_columns, coalesce(cur, 0) AS edges, coalesce(base, 0) AS golden_edges
FROM o_counts n LEFT JOIN {_side('v_cur', '"column"', 'columns')} cc ON cc.node_id = n.node_id
LEFT JOIN {_side('v_base', '"column"', 'columns')} bc ON bc.node_id = n.node_id) x
WHERE table_diff > 0 OR columns <> golden_columns OR edges <> golden_edges""")
oracle("missing_expected_tables", """
SELECT DISTINCT project, node_id, upper(up_table) AS fqn FROM v_base b
WHERE NOT EXISTS (SELECT 1 FROM v_cur c WHERE c.node_id = b.node_id AND lower(c.up_table) = lower(b.up_table))""")
STEPS["o_words"] = """
SELECT project, run_id, node_id, CAST('0x' || substring(md5(concat_ws(chr(31), "column", up_table, up_column)), 1, 15) AS BIGINT) AS w
FROM (SELECT * FROM v_base UNION ALL SELECT * FROM v_cur) x"""
oracle("content_fingerprint", f"""
SELECT *, count(*) OVER (PARTITION BY node_id) > 1 AND min(fingerprint) OVER (PARTITION BY node_id) <> max(fingerprint) OVER (PARTITION BY node_id) AS drifted
FROM (SELECT {K}, sha256(concat_ws('|', count(*), sum(w), bit_xor(w))) AS fingerprint FROM o_words GROUP BY {K}) x""")
# columns, statuses, state
STEPS["o_col_pairs"] = """
SELECT project, node_id, "column", up_table, up_column, max(now) AS now, max(before) AS before FROM (
  SELECT project, node_id, "column", up_table, up_column, 1 AS now, 0 AS before FROM v_cur
  UNION ALL SELECT project, node_id, "column", up_table, up_column, 0, 1 FROM v_base) x
WHERE node_id IN (SELECT node_id FROM v_cur) AND node_id IN (SELECT node_id FROM v_base) GROUP BY ALL"""
_UP_JSON = f"'{{' || concat_ws(',', {_member('table', 'up_table')}, {_member('column', 'up_column')}) || '}}'"
_UP_ORDER = "ORDER BY up_table, up_column"
oracle("column_diff", f"""
SELECT project, node_id, "column", severity, '  ' || node_id || '.' || "column" || ': ' || change
    || coalesce(' -[' || lost || ']', '') || coalesce(' +[' || added || ']', '') AS line,
  '{{"node_id":' || {_json('node_id')} || ',"column":' || {_json('"column"')} || ',"lost_upstream":[' || coalesce(lost_json, '') || '],"added_upstream":['
    || coalesce(added_json, '') || '],"change":"' || change || '","severity":"' || severity || '"}}' AS json
FROM (SELECT *, CASE WHEN n_now = 0 THEN 'column_lost' WHEN n_before = 0 THEN 'column_added' ELSE 'changed' END AS change,
    CASE WHEN lost IS NOT NULL THEN 'regression' ELSE 'addition' END AS severity
  FROM (SELECT project, node_id, "column", sum(now) AS n_now, sum(before) AS n_before,
      string_agg(up_table || '.' || up_column, ', ' {_UP_ORDER}) FILTER (now < before) AS lost,
      string_agg(up_table || '.' || up_column, ', ' {_UP_ORDER}) FILTER (now > before) AS added,
      string_agg({_UP_JSON}, ',' {_UP_ORDER}) FILTER (now < before) AS lost_json,
      string_agg({_UP_JSON}, ',' {_UP_ORDER}) FILTER (now > before) AS added_json
    FROM o_col_pairs GROUP BY project, node_id, "column") x WHERE lost IS NOT NULL OR added IS NOT NULL) y""")
_RANK = _case("status", {"parsed": "0", "partial": "1", "unsupported": "2", "failed": "3"})
oracle("status_regressions", f"""
SELECT n.project, n.run_id, n.node_id, b.status AS baseline, n.status AS current, CASE WHEN b.status = 'parsed' THEN 'high' ELSE 'medium' END AS severity
FROM v_run n JOIN v_run_before b ON b.project = n.project AND b.node_id = n.node_id
WHERE n.status <> 'skipped' AND b.status <> 'skipped' AND {_RANK.replace('status', 'n.status')} > {_RANK.replace('status', 'b.status')}""")
for _side_name, _side_view in (("o_ren_base", "v_ren_base"), ("o_ren_cur", "v_ren_cur")):
    STEPS[_side_name] = f"""
SELECT project, node_id, "column" AS name, string_agg(up_table || '.' || coalesce(up_column, '?'), ',' ORDER BY up_table, up_column) AS ups
FROM {_side_view} GROUP BY project, node_id, "column\""""
STEPS["o_ren_lost"] = """
SELECT *, row_number() OVER (PARTITION BY node_id, ups ORDER BY name) AS place FROM o_ren_base b
WHERE NOT EXISTS (SELECT 1 FROM o_ren_cur c WHERE (c.node_id, c.name, c.ups) = (b.node_id, b.name, b.ups))"""
STEPS["o_ren_new"] = """
SELECT *, row_number() OVER (PARTITION BY node_id, ups ORDER BY name) AS place FROM o_ren_cur c
WHERE NOT EXISTS (SELECT 1 FROM o_ren_base b WHERE (c.node_id, c.name, c.ups) = (b.node_id, b.name, b.ups))"""
STEPS["o_ren_match"] = """
SELECT coalesce(l.project, n.project) AS project, coalesce(l.node_id, n.node_id) AS node_id, l.name AS old_name, n.name AS new_name
FROM o_ren_lost l FULL JOIN o_ren_new n ON (l.node_id, l.ups, l.place) = (n.node_id, n.ups, n.place)"""
STEPS["o_ren_kind"] = """
SELECT m.*, CASE
  WHEN old_name IS NOT NULL AND new_name IS NOT NULL THEN CASE
    WHEN EXISTS (SELECT 1 FROM o_ren_match r WHERE (r.node_id, r.old_name, r.new_name) = (m.node_id, m.new_name, m.old_name)) THEN 'swapped'
    WHEN NOT is_old AND NOT stays THEN 'renamed' ELSE 'moved' END
  WHEN old_name IS NOT NULL THEN CASE WHEN stays THEN 'changed' ELSE 'lost' END
  WHEN NOT is_old THEN 'added'
  WHEN EXISTS (SELECT 1 FROM o_ren_match r WHERE r.node_id = m.node_id AND r.old_name = m.new_name AND r.new_name IS NOT NULL) THEN 'replaced' END AS kind
FROM (SELECT *, EXISTS (SELECT 1 FROM o_ren_base b WHERE b.node_id = x.node_id AND b.name = x.new_name) AS is_old,
    EXISTS (SELECT 1 FROM o_ren_cur c WHERE c.node_id = x.node_id AND c.name = x.old_name) AS stays FROM o_ren_match x) m"""
oracle("renamed_columns", "SELECT project, node_id, old_name, new_name, kind FROM o_ren_kind WHERE kind IS NOT NULL")
_PLACES = "CASE rank WHEN 0 THEN 'direct' WHEN 1 THEN 'expression' WHEN 2 THEN 'aggregate' WHEN 3 THEN 'control' ELSE 'unknown' END"
STEPS["o_hop_tables"] = STEPS["o_tables"].replace("v_tbl", "v_hop_tbl")
STEPS["o_hop_lines"] = """
SELECT l.project, l.run_id, l.node_id, l.target_parent_id AS tp, l.target_col AS tc, t.fqn AS target_fqn, s.fqn, s.is_real,
  CASE WHEN s.table_id IS NULL OR source_col = '' THEN NULL ELSE source_parent_id END AS sp, source_col AS sc,
  CASE lower(rel_type) WHEN 'fdd' THEN 0 WHEN 'fdc' THEN 1 WHEN 'fda' THEN 2 WHEN 'fdr' THEN 3 ELSE 4 END AS step
FROM v_hop l JOIN o_hop_tables t ON t.node_id = l.node_id AND t.table_id = l.target_parent_id
LEFT JOIN o_hop_tables s ON s.node_id = l.node_id AND s.table_id = l.source_parent_id"""
oracle("trace_multi_hop", f"""
SELECT project, run_id, node_id, target_fqn, target_col, up_table, up_column, depth::INT AS depth, {_PLACES} AS transform
FROM (SELECT w.project, w.run_id, w.node_id, t.fqn AS target_fqn, w.tc AS target_col, e.fqn AS up_table, e.sc AS up_column, w.depth + 1 AS depth, greatest(w.rank, e.step) AS rank
  FROM hop_walk w JOIN o_hop_lines e ON e.node_id = w.node_id AND e.tp = w.p AND e.tc = w.c AND e.is_real AND e.sp IS NOT NULL
  JOIN o_hop_tables t ON t.node_id = w.node_id AND t.table_id = w.tp) x
QUALIFY row_number() OVER (PARTITION BY node_id, target_fqn, target_col, up_table, up_column ORDER BY depth, rank) = 1""",
       # no least path is longer than the 14 places of a node
       "hop_walk AS (SELECT DISTINCT project, run_id, node_id, tp, tc, tp AS p, tc AS c, 0 AS depth, 0 AS rank FROM o_hop_lines UNION "
       "SELECT w.project, w.run_id, w.node_id, w.tp, w.tc, l.sp, l.sc, w.depth + 1, greatest(w.rank, l.step) FROM hop_walk w JOIN o_hop_lines l "
       "ON l.node_id = w.node_id AND l.tp = w.p AND l.tc = w.c AND l.sp IS NOT NULL AND NOT l.is_real WHERE w.depth < 14)")
oracle("propagate_tags", """
SELECT project, run_id, "table", "column", tag, min(depth)::INT AS depth FROM tag_walk GROUP BY ALL""",
       'tag_walk AS (SELECT DISTINCT project, run_id, "table", "column", tag, 0 AS depth FROM v_coltag UNION '
       "SELECT w.project, w.run_id, s.dst_table, s.dst_column, w.tag, w.depth + 1 FROM tag_walk w JOIN v_colstep s "
       "ON s.src_table = w.\"table\" AND s.src_column = w.\"column\" AND s.transform <> 'control' AND NOT (w.tag = 'pii' AND s.transform = 'aggregate') "
       "AND NOT (w.tag = 'secret' AND s.transform = 'expression') WHERE w.depth < 12)")
_SQL_OF = f"concat_ws('|', coalesce({_normal('compiled_code')}, '?'), coalesce({_normal('compiled_sql')}, '?'), coalesce(resource_type, '?'), coalesce(adapter_type, '?'), name, tag)"
STEPS["o_modified"] = f"""
SELECT n.node_id, CASE WHEN b.node_id IS NULL THEN 'added' WHEN b.state <> n.state THEN 'changed' END AS reason
FROM (SELECT node_id, {_SQL_OF} AS state FROM v_node) n LEFT JOIN (SELECT node_id, {_SQL_OF} AS state FROM v_node_before) b ON b.node_id = n.node_id"""
oracle("state_modified", """
SELECT node_id, reason FROM o_modified WHERE reason IS NOT NULL
UNION ALL SELECT node_id, 'downstream' FROM o_modified WHERE reason IS NULL AND node_id IN (SELECT id FROM mod_walk)""",
       "mod_walk AS (SELECT child_id AS id FROM v_edge_removed WHERE origin = 'child_map' AND (parent_id IN (SELECT node_id FROM o_modified WHERE reason IS NOT NULL) "
       "OR parent_id IN (SELECT node_id FROM v_node_before WHERE node_id NOT IN (SELECT node_id FROM v_node))) "
       "UNION SELECT child_id FROM v_edge_removed JOIN mod_walk ON parent_id = id WHERE origin = 'child_map')")
oracle("split_reads_writes", f"""
SELECT u.project, u.run_id, u.node_id, u.fqn, CASE WHEN w.fqn IS NULL THEN 'read' WHEN r.fqn IS NULL THEN 'write' ELSE 'read_write' END AS role
FROM o_upstream u
LEFT JOIN (SELECT DISTINCT node_id, source_fqn AS fqn FROM o_resolved WHERE source_is_real) r ON (r.node_id, r.fqn) = (u.node_id, u.fqn)
LEFT JOIN (SELECT DISTINCT node_id, target_fqn AS fqn FROM o_writes WHERE source_fqn IS NOT NULL AND source_col <> '') w ON (w.node_id, w.fqn) = (u.node_id, u.fqn)""")
STEPS["o_tokens"] = r"SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '\bE\d{2}\b')) AS id FROM v_cite"
oracle("cited_ids", "SELECT id, doc_id FROM o_tokens WHERE id IN (SELECT id FROM v_index)")
_LABEL = "coalesce(label, '<missing>')"
oracle("citation_lint", f"""
SELECT doc_id, t.id, {_LABEL} AS label, {_LABEL} IN ({_list(S.ALLOWED_LABELS)}) AS passes, t.id || ' (' || {_LABEL} || ')'
  || CASE WHEN {_LABEL} IN ({_list(S.ALLOWED_LABELS)}) THEN '' ELSE ' — must be active/framework-active/manual-active' END AS message
FROM o_tokens t JOIN v_index i ON t.id = i.id""")
oracle("selection_size_guard", """
SELECT project, run_id, count(*) AS eligible_count, 50 AS threshold FROM o_planned WHERE eligible GROUP BY ALL HAVING count(*) > 50""")
_E = "event_id"
_VALID = f"{_E} % 31 > 1"


def _violation(path: str, rule: str, where: str) -> str:
    return f"SELECT {_E}, '{path}' AS path, '{rule}' AS rule FROM {{events}} WHERE {where}"


_UP = "$.nodes.0.columns.0.upstream.0."
_PARSED = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"
oracle("validate_lineage", " UNION ALL ".join([
    _violation("$", "object", f"NOT {_VALID}"),
    _violation("$.generator", "required", f"{_VALID} AND {_E} % 17 = 0"),
    _violation("$.manifest_metadata.selected_count", "range", f"{_VALID} AND {_E} % 19 = 0"),
    _violation("$.stats.coverage", "range", f"{_VALID} AND {_PARSED} > 100"),
    _violation("$.stats.parsed", "type", f"{_VALID} AND {_E} % 23 = 0"),
    _violation("$.nodes.0.status", "enum", f"{_VALID} AND {_E} % 5 = 0"),
    _violation("$.nodes.0.columns.0.transform", "enum", f"{_VALID} AND {_E} % 11 < 2"),
    _violation("$.nodes.0.columns.0.", "additional field", f"{_VALID} AND {_E} % 7 = 0"),
    _violation(_UP + "column", "required", f"{_VALID} AND {_E} % 13 = 0"),
    _violation(_UP, "additional field", f"{_VALID} AND {_E} % 13 = 1"),
    _violation("$.nodes.0.upstream_tables.1", "type", f"{_VALID} AND {_E} % 29 = 0"),
]))

# --- streams --------------------------------------------------------------------------------

oracle("stream_new_sql", "SELECT DISTINCT sha256('SELECT ' || event_type || ' FROM ' || CAST(user_id AS STRING) || '|d|m|p|v') AS cache_key FROM {events}")
oracle("stream_unseen_sql", """
SELECT DISTINCT sha256('SELECT ' || event_type || ' FROM ' || CAST(user_id AS STRING) || '|d|m|p|v') AS cache_key, event_type, user_id
FROM {events} WHERE user_id % 3 <> 0""")
oracle("stream_run_coverage", """
SELECT day, parsed, partial, unsupported, failed, skipped, parsed + partial + unsupported + failed AS eligible_count,
  round(coalesce((parsed + partial) / nullif(parsed + partial + unsupported + failed, 0), 1.0), 9) AS node_coverage
FROM (SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) FILTER (event_type = 'view') AS parsed, count(*) FILTER (event_type = 'click') AS partial,
  count(*) FILTER (event_type = 'purchase') AS unsupported, count(*) FILTER (event_type = 'error') AS failed,
  count(*) FILTER (event_type = 'signup') AS skipped FROM {events} GROUP BY 1) x
WHERE CAST(day AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM {events}) - INTERVAL 6 HOUR""")
