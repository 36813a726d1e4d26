"""Fixed values and JSON schemas of the data model."""

from __future__ import annotations

# The domains of the lineage document.
STATUSES = ["parsed", "partial", "unsupported", "failed", "skipped"]
EMITTED_STATUSES = ["parsed", "partial"]
CONFIDENCES = ["high", "medium", "low"]
TRANSFORMS = ["direct", "aggregate", "expression", "control", "unknown"]

# Relationship type -> position in TRANSFORMS; any other type is "unknown".
TRANSFORM_OF_TYPE = {"fdd": 0, "fda": 1, "fdc": 2, "fdr": 3}
DIRECT, CONTROL, UNKNOWN = 0, 3, 4
VALUE_TYPE = "fdd"

# Names that stand for "no name" in the object tree.
DEFAULT_NAMES = ["DEFAULT_SERVER", "DEFAULT", "<default>", ""]
REAL_COLLECTIONS = ["tables", "views"]
COLLECTIONS = ["tables", "views", "others"]
RESULT_SET_PREFIX = "RS-"

# Helper columns that the parser adds.
SYNTHETIC_NAMES = ["COUNT", "RELATIONROWS"]
SYNTHETIC_PATTERN = r"^COUNT\([0-9]+\)$"

# Fixed value: the diagnostic that names a column the parser could not bind.
ORPHAN_PATTERN = (
    r"(?i)orphan\s+column\s*\(\d+\)\s*near:\s*\[?([^\]\(]+?)\]?\s*\((\d+)\s*,\s*(\d+)\)"
)

# Manifest schema versions that are known.
KNOWN_MANIFEST_VERSIONS = ["v9", "v10", "v11", "v12"]

# Adapter type -> parser dialect.
ADAPTER_DIALECTS = {
    "athena": "dbvathena",
    "bigquery": "dbvbigquery",
    "clickhouse": "dbvclickhouse",
    "databricks": "dbvdatabricks",
    "db2": "dbvdb2",
    "doris": "dbvdoris",
    "duckdb": "dbvduckdb",
    "fabric": "dbvmssql",
    "mysql": "dbvmysql",
    "oracle": "dbvoracle",
    "postgres": "dbvpostgresql",
    "redshift": "dbvredshift",
    "snowflake": "dbvsnowflake",
    "spark": "dbvsparksql",
    "sqlserver": "dbvmssql",
    "synapse": "dbvmssql",
    "teradata": "dbvteradata",
    "trino": "dbvtrino",
    "vertica": "dbvvertica",
}

# Parser dialect -> platform name in both metadata catalogs.
DIALECT_PLATFORMS = {
    "dbvathena": "athena",
    "dbvbigquery": "bigquery",
    "dbvclickhouse": "clickhouse",
    "dbvdatabricks": "databricks",
    "dbvduckdb": "duckdb",
    "dbvmssql": "mssql",
    "dbvmysql": "mysql",
    "dbvoracle": "oracle",
    "dbvpostgresql": "postgres",
    "dbvredshift": "redshift",
    "dbvsnowflake": "snowflake",
    "dbvsparksql": "spark",
    "dbvtrino": "trino",
}

# Eligibility by resource type.
ELIGIBLE_TYPES = ["model", "snapshot", "incremental"]
SKIP_REASONS = {
    "seed": "seed (no SQL body)",
    "test": "test (data-test, not data-flow)",
    "operation": "run-operation (out-of-band)",
}

# Text -> marker, tried in this order.
DYNAMIC_MARKERS = [
    ("EXECUTE IMMEDIATE", "execute_immediate"),
    ("EXEC SP_EXECUTESQL", "sp_executesql"),
    ("EXECUTE SP_EXECUTESQL", "sp_executesql"),
]

# Labels under which a cited row may appear in published text.
ALLOWED_LABELS = ["active", "framework-active", "manual-active"]

# Budget of the anonymous mode and the size guard.
ANONYMOUS_BUDGET = 50
SIZE_GUARD = 50

OBJECT_TREE = (
    "array<struct<name:string,databases:array<struct<name:string,schemas:array<struct<name:string,"
    "tables:array<struct<id:string,name:string,displayName:string,subType:string>>,"
    "views:array<struct<id:string,name:string,displayName:string,subType:string>>,"
    "others:array<struct<id:string,name:string,displayName:string,subType:string>>>>>>>>"
)
RELATIONSHIPS = (
    "array<struct<type:string,target:struct<column:string,parentId:string>,"
    "sources:array<struct<column:string,parentId:string>>>>"
)

NODE_DOCUMENT = (
    "node_id string, status string, confidence string, dialect string,"
    "upstream_tables array<string>, downstream array<string>, warnings array<string>,"
    "columns array<struct<name:string,transform:string,confidence:string,"
    "upstream:array<struct<table:string,column:string>>>>,"
    "unresolved array<struct<reason:string,target_column:string,rel_type:string,"
    "source_parent_id:string,line:bigint,col:bigint,parser_message:string,marker:string,"
    "fragment_preview:string,detail:string>>,"
    "evidence struct<"
    "parser_diagnostics:array<struct<type:string,category:string,near_column:string,line:bigint,col:bigint,message:string>>,"
    "procedural:struct<column_edge_count:bigint,process_count:bigint,write_target_count:bigint,"
    "write_targets:array<struct<table:string,subType:string,`from`:array<string>,columns:array<string>,"
    "edges:array<struct<`from`:struct<table:string,column:string>,target_column:string>>>>>>"
)
#: What a document says of its run.
HEADER = (
    "schema_version string, generator string, generated_at string,"
    "manifest_metadata struct<dbt_version:string,dbt_schema_version:string,project_name:string,"
    "adapter_type:string,selected_count:bigint,eligible_count:bigint>,"
    "backend struct<mode:string,parser_version:string,cli_version:string,"
    "cache_stats:struct<hits:bigint,misses:bigint,hit_rate_pct:bigint>>,"
    "stats struct<parsed:bigint,partial:bigint,unsupported:bigint,failed:bigint,skipped:bigint,"
    "total_columns:bigint,resolved_columns:bigint,coverage:double>"
)
DOCUMENT = f"{HEADER}, nodes array<struct<{NODE_DOCUMENT}>>"
