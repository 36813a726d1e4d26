"""Column rules: dialects, names, relationship classes, eligibility. All are JVM expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from colweave import schemas as S


def lookup(table: Mapping[str, object], key: Column) -> Column:
    """Value of ``key`` in a fixed table, or null. The table is a literal in the plan: no join."""
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.try_element_at(entries, F.coalesce(key, F.lit("")))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


# --- dialects -------------------------------------------------------------------------------


def canonical_dialect(alias: Column) -> Column:
    clean = F.trim(F.lower(alias))
    return (
        F.when(clean.startswith("dbv"), clean)
        .otherwise(F.coalesce(lookup(S.ADAPTER_DIALECTS, clean), F.concat(F.lit("dbv"), clean)))
    )


def resolve_dialect(adapter: Column, override: Column | None = None) -> Column:
    """Override first, then the adapter table; null when neither gives a dialect."""
    known = lookup(S.ADAPTER_DIALECTS, F.trim(F.lower(adapter)))
    if override is None:
        return known
    return F.coalesce(canonical_dialect(blank_to_null(override)), known)


def dialect_error(adapter: Column) -> Column:
    """Skip reason of a node whose dialect is unknown."""
    shown = F.coalesce(F.concat(F.lit("'"), adapter, F.lit("'")), F.lit("None"))
    names = ", ".join(f"'{n}'" for n in sorted(S.ADAPTER_DIALECTS))
    return F.concat(
        F.lit("dialect: unknown adapter_type "),
        shown,
        F.lit(f"; pass --dialect to override. Known: [{names}]"),
    )


def _platform(dialect: Column, overrides: Mapping[str, str] | None) -> Column:
    table = dict(S.DIALECT_PLATFORMS) | dict(overrides or {})
    return lookup(table, dialect)


def dialect_platform(dialect: Column, overrides: Mapping[str, str] | None = None) -> Column:
    rest = blank_to_null(F.replace(dialect, F.lit("dbv"), F.lit("")))
    return F.coalesce(_platform(dialect, overrides), rest, F.lit("external"))


def service_name(dialect: Column, override: str | None = None) -> Column:
    """Like ``dialect_platform``, but a dialect that is only the prefix gives an empty name."""
    if override:
        return F.lit(override)
    named = F.coalesce(blank_to_null(dialect), F.lit("external"))
    return F.coalesce(_platform(dialect, None), F.replace(named, F.lit("dbv"), F.lit("")))


# --- names ----------------------------------------------------------------------------------


def dataset_urn(platform: Column, name: Column, env: str = "PROD") -> Column:
    return F.concat(
        F.lit("urn:li:dataset:(urn:li:dataPlatform:"), platform, F.lit(","), name, F.lit(f",{env})")
    )


def schema_field_urn(dataset: Column, column: Column) -> Column:
    return F.concat(F.lit("urn:li:schemaField:("), dataset, F.lit(","), column, F.lit(")"))


def service_fqn(service: Column, table: Column) -> Column:
    return F.concat(service, F.lit("."), table)


def table_fqn(server: Column, database: Column, schema: Column, name: Column, table_id: Column) -> Column:
    parts = [F.when(~p.isin(*S.DEFAULT_NAMES), p) for p in (server, database, schema)]
    joined = F.concat_ws(".", *parts, blank_to_null(name))
    return F.coalesce(blank_to_null(joined), F.concat(F.lit("<id:"), table_id, F.lit(">")))


def is_real_table(collection: Column, name: Column) -> Column:
    shown = F.coalesce(name, F.lit(""))
    return (
        collection.isin(*S.REAL_COLLECTIONS) & (shown != "") & ~shown.startswith(S.RESULT_SET_PREFIX)
    )


def is_synthetic_column(name: Column) -> Column:
    upper = F.upper(name)
    return F.coalesce(
        name.startswith("@") | upper.isin(*S.SYNTHETIC_NAMES) | upper.rlike(S.SYNTHETIC_PATTERN),
        F.lit(False),
    )


# --- relationships --------------------------------------------------------------------------


def transform_code(rel_type: Column) -> Column:
    """Position in ``TRANSFORMS``; small integers keep the aggregates in hash-aggregate codegen."""
    return F.coalesce(lookup(S.TRANSFORM_OF_TYPE, F.lower(rel_type)), F.lit(S.UNKNOWN))


def transform_name(code: Column) -> Column:
    return F.element_at(F.array(*[F.lit(t) for t in S.TRANSFORMS]), code.cast("int") + 1)


def is_value_type(rel_type: Column) -> Column:
    return transform_code(rel_type) != S.CONTROL


def is_star_on_real(target_col: Column, target_is_real: Column) -> Column:
    return (target_col == "*") & target_is_real


# --- diagnostics ----------------------------------------------------------------------------


def orphan_part(message: Column, group: int) -> Column:
    """Group 1 is the column, 2 the line, 3 the position; null when the message is another one."""
    return blank_to_null(F.regexp_extract(message, S.ORPHAN_PATTERN, group))


def diagnostic_fields(error_type: Column, message: Column, line: Column, col: Column) -> dict[str, Column]:
    """Fields of one diagnostic. An orphan message carries its own coordinates."""
    near = F.trim(orphan_part(message, 1))
    orphan = near.isNotNull()
    kind = blank_to_null(error_type)
    return {
        "type": F.coalesce(kind, F.when(orphan, F.lit("SyntaxHint")).otherwise(F.lit("Hint"))),
        "category": F.when(orphan, F.lit("orphan_column")),
        "near_column": near,
        "line": F.when(orphan, orphan_part(message, 2).try_cast("bigint")).otherwise(line),
        "col": F.when(orphan, orphan_part(message, 3).try_cast("bigint")).otherwise(col),
        "message": message,
    }


# --- eligibility ----------------------------------------------------------------------------


def skip_reason(resource_type: Column) -> Column:
    """Null for an eligible resource type, else why the node is skipped."""
    return (
        F.when(resource_type.isNull(), F.lit("missing resource_type"))
        .when(resource_type.isin(*S.ELIGIBLE_TYPES), F.lit(None).cast("string"))
        .otherwise(
            F.coalesce(
                lookup(S.SKIP_REASONS, resource_type),
                F.concat(F.lit("unsupported resource_type '"), resource_type, F.lit("'")),
            )
        )
    )


def skip_reason_with_sql(resource_type: Column, sql: Column, adapter: Column, dialect: Column) -> Column:
    """Type first, then missing SQL; an unknown dialect overrides both."""
    return (
        F.when(dialect.isNull(), dialect_error(adapter))
        .when(skip_reason(resource_type).isNotNull(), skip_reason(resource_type))
        .when(blank_to_null(sql).isNull(), F.lit("missing compiled SQL"))
    )
