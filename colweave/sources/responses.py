"""Parser responses, read as tables: envelope, outcome, objects, relationships, diagnostics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colweave import schemas as S
from colweave.functions.rules import blank_to_null, diagnostic_fields, is_real_table, table_fqn
from colweave.session import KEY

ENVELOPES = ["$.body.data.sqlflow", "$.data.sqlflow", "$.sqlflow"]


def normalize_responses(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``flow``, the dataflow object inside any of the four envelopes.

    An object without an envelope is the dataflow itself.
    """
    doc = F.try_parse_json(payload)
    inner = [F.try_variant_get("_doc", path, "variant") for path in ENVELOPES]
    wrapped = F.coalesce(*[F.try_variant_get("_doc", f"$.{k}", "variant") for k in ("body", "data")])
    bare = F.when(wrapped.isNull(), F.col("_doc"))
    return raw.withColumn("_doc", doc).withColumn("flow", F.coalesce(*inner, bare)).drop("_doc")


def classify_responses(raw: DataFrame, mode: Column | None = None) -> DataFrame:
    """Add ``outcome`` and ``reason`` from http_status, code and detail.

    Only the anonymous mode has a quota, so HTTP 429 elsewhere is a plain parser error.
    """
    mode = F.col("mode") if mode is None else mode
    http = F.coalesce(F.col("http_status"), F.lit(200))
    fine = (http < 400) & (F.col("code").isNull() | (F.col("code") == "200"))
    reason = (
        F.when((http == 429) & (mode == "anonymous"), "quota_limited")
        .when(~fine, "parser_error")
    )
    return raw.withColumns(
        {
            "outcome": F.when(reason.isNull(), "ok").otherwise("failed"),
            "reason": reason,
            "detail": F.when(reason.isNotNull(), F.col("detail")),
        }
    )


def explode_dbobjs(flows: DataFrame) -> DataFrame:
    """One row per table id of a node. Of two tables with one id, the last in the tree stays.

    A response holds the whole tree of its node, so this is settled inside the row: the tree becomes one
    array, sorted by id and place, of which those entries stay whose id does not come again. Nothing is
    shuffled. A node comes once in ``flows``.
    """

    def entries(server: Column, db: Column, schema: Column) -> Column:
        def listed(collection: str) -> Column:
            return F.transform(
                F.coalesce(schema[collection], F.array()),
                lambda t: F.struct(
                    F.coalesce(t["id"], F.lit("None")).alias("table_id"), F.lit(collection).alias("collection"),
                    server["name"].alias("server"), db["name"].alias("db"), schema["name"].alias("schema_name"),
                    F.coalesce(blank_to_null(t["name"]), t["displayName"], F.lit("")).alias("name"), t["subType"].alias("sub_type"),
                ),
            )

        return F.concat(*[listed(c) for c in S.COLLECTIONS])

    def within(items: Column, name: str, shape) -> Column:
        return F.flatten(F.transform(F.coalesce(items[name], F.array()), shape))

    servers = F.try_variant_get("flow", "$.dbobjs.servers", S.OBJECT_TREE)
    tree = F.flatten(F.transform(servers, lambda s: within(s, "databases", lambda d: within(d, "schemas", lambda c: entries(s, d, c)))))
    # by id and place; the last place of an id is the one whose successor has another id
    placed = F.sort_array(F.transform(tree, lambda t, i: F.struct(t["table_id"].alias("id"), i.alias("i"), t.alias("t"))))
    # an outer generator: for an inner one the planner adds a filter that builds the array a second time
    listed = flows.select(*KEY, placed.alias("ts"))
    pairs = F.arrays_zip(F.col("ts").alias("x"), F.slice("ts", F.lit(2), F.greatest(F.size("ts") - 1, F.lit(0))).alias("after"))
    rows = listed.select(*KEY, F.inline_outer(pairs))
    last = rows.where(F.col("x").isNotNull() & ~F.col("x.id").eqNullSafe(F.col("after.id")))
    return describe_tables(last.select(*KEY, "x.t.*"))


def describe_tables(tables: DataFrame) -> DataFrame:
    """Add the full name and whether the table is a real one."""
    c = F.col
    return tables.withColumns(
        {
            "fqn": table_fqn(c("server"), c("db"), c("schema_name"), c("name"), c("table_id")),
            "is_real": is_real_table(c("collection"), c("name")),
        }
    )


def explode_relationships(flows: DataFrame) -> DataFrame:
    """One row per (relationship, source) with both ordinals.

    A relationship without sources keeps one row, with a null ``src_ord``. Target fields are
    repeated on each row, so no later join has to bring them together.
    """
    rels = flows.select(
        *KEY, F.posexplode(F.try_variant_get("flow", "$.relationships", S.RELATIONSHIPS)).alias("rel_ord", "r")
    )
    lines = rels.select(*KEY, "rel_ord", "r", F.posexplode_outer("r.sources").alias("src_ord", "x"))
    has_source = F.col("src_ord").isNotNull()
    return lines.select(
        *KEY,
        F.col("rel_ord").cast("bigint").alias("rel_ord"),
        F.col("r.type").alias("rel_type"),
        F.coalesce(F.col("r.target.parentId"), F.lit("")).alias("target_parent_id"),
        F.coalesce(F.col("r.target.column"), F.lit("")).alias("target_col"),
        F.col("src_ord").cast("bigint").alias("src_ord"),
        F.when(has_source, F.coalesce(F.col("x.parentId"), F.lit(""))).alias("source_parent_id"),
        F.when(has_source, F.coalesce(F.col("x.column"), F.lit(""))).alias("source_col"),
    )


def process_counts(flows: DataFrame) -> DataFrame:
    found = F.try_variant_get("flow", "$.processes", "array<variant>")
    return flows.select(*KEY, F.coalesce(F.size(found), F.lit(0)).cast("bigint").alias("process_count"))


def _only(kind: str, root: str, field: str, value_type: str) -> Column:
    """The field if it has this JSON type; a number is not taken for a string."""
    found = F.try_variant_get(root, field, "variant")
    return F.when(F.schema_of_variant(found) == kind, F.try_variant_get(root, field, value_type))


def explode_diagnostics(flows: DataFrame) -> DataFrame:
    """One row per usable diagnostic of a node.

    ``errors`` that is no list, entries that are no objects and messages that are no text or
    blank are skipped; the other entries stay. Coordinates come as a list or a single object.
    """
    errors = flows.select(
        *KEY, F.posexplode(F.try_variant_get("flow", "$.errors", "array<variant>")).alias("err_ord", "e")
    )
    at = F.coalesce(
        F.try_variant_get("e", "$.originCoordinates[0]", "variant"),
        F.try_variant_get("e", "$.originCoordinates", "variant"),
    )
    blanks = "(?U)^\\s+|\\s+$"
    rows = errors.withColumn("at", at).select(
        *KEY,
        F.col("err_ord").cast("bigint").alias("err_ord"),
        _only("STRING", "e", "$.errorType", "string").alias("error_type"),
        F.regexp_replace(_only("STRING", "e", "$.errorMessage", "string"), blanks, "").alias("message"),
        _only("BIGINT", "at", "$.x", "bigint").alias("line"),
        _only("BIGINT", "at", "$.y", "bigint").alias("col"),
    )
    return read_diagnostics(rows)


def read_diagnostics(rows: DataFrame) -> DataFrame:
    """Fields of raw diagnostics (error_type, message, line, col); blank messages are dropped."""
    fields = diagnostic_fields(F.col("error_type"), F.col("message"), F.col("line"), F.col("col"))
    return rows.where(F.trim("message") != "").select(
        *KEY, "err_ord", *[value.alias(name) for name, value in fields.items()]
    )
