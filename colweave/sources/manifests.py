"""Model manifests and optional artifacts, read as tables.

A manifest is parsed once into a variant, so a field of an unexpected type gives a null for that
field and nothing else.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave import schemas as S
from colweave.functions.rules import blank_to_null
from colweave.session import RUN, cut_lineage


class Manifests(NamedTuple):
    nodes: DataFrame
    edges: DataFrame
    meta: DataFrame
    rejects: DataFrame


def read_texts(spark: SparkSession, paths: list[str], expected: DataFrame | None = None) -> DataFrame:
    """One row per file: path and whole text.

    ``expected`` lists files that must be there, as full URIs in ``path``; the result then has
    these files, and null text for those not found. One or three slashes after the scheme are
    the same file.
    """
    found = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    if expected is None:
        return found
    uri = F.regexp_replace("path", "^(\\w+):/+", "$1:/").alias("_uri")
    return expected.select("path", uri).distinct().join(found.select(uri, "value"), "_uri", "left").drop("_uri")


def _text(root: str, field: str) -> Column:
    return F.try_variant_get(root, f"$.{field}", "string")


def parse_manifests(texts: DataFrame) -> Manifests:
    """``texts``: project, run_id, path, value -> nodes, edges, metadata and rejects.

    A null text (missing file), broken JSON or a root that is no object goes to ``rejects``.
    Maps that are null or absent are empty. Texts are parsed once and the variants are written, so that
    the four outputs do not parse them again.
    """
    return describe_manifests(cut_lineage(_parsed(texts)))


def _parsed(texts: DataFrame) -> DataFrame:
    """``texts`` with ``doc``, the parsed value, in its place, and why it was rejected, if it was."""
    docs = texts.withColumn("doc", F.try_parse_json("value"))
    error = (
        F.when(F.col("value").isNull(), "manifest not found")
        .when(F.col("doc").isNull(), "manifest is not valid JSON")
        .when(~F.schema_of_variant("doc").startswith("OBJECT"), "manifest is not a JSON object")
    )
    return docs.withColumn("error", error).drop("value")


def describe_manifests(parsed: DataFrame) -> Manifests:
    """The tables of parsed manifests: project, run_id, path, doc and error."""
    rejects = parsed.where("error is not null").select(*RUN, "path", "error")
    good = parsed.where("error is null")

    def entries(name: str, value_type: str) -> DataFrame:
        return good.select(
            *RUN, F.explode(F.try_variant_get("doc", f"$.{name}", f"map<string,{value_type}>"))
        )

    nodes = entries("nodes", "variant").select(
        *RUN,
        F.col("key").alias("node_id"),
        *[
            _text("value", f).alias(f)
            for f in ("name", "resource_type", "compiled_code", "compiled_sql", "compiled_path", "path")
        ],
        F.try_variant_get("value", "$.fqn", "array<string>").alias("fqn"),
        F.try_variant_get("value", "$.tags", "array<string>").alias("tags"),
    )
    up = entries("parent_map", "array<string>").select(
        *RUN,
        F.lit("parent_map").alias("origin"),
        F.explode("value").alias("parent_id"),
        F.col("key").alias("child_id"),
    )
    down = entries("child_map", "array<string>").select(
        *RUN,
        F.lit("child_map").alias("origin"),
        F.col("key").alias("parent_id"),
        F.explode("value").alias("child_id"),
    )
    meta = good.select(
        *RUN,
        "path",
        F.coalesce(_text("doc", "metadata.dbt_version"), F.lit("unknown")).alias("dbt_version"),
        F.coalesce(blank_to_null(_text("doc", "metadata.dbt_schema_version")), F.lit("unknown")).alias(
            "dbt_schema_version"
        ),
        F.coalesce(_text("doc", "metadata.project_name"), F.lit("unknown")).alias("project_name"),
        _text("doc", "metadata.adapter_type").alias("adapter_type"),
        _text("doc", "metadata.generated_at").alias("generated_at"),
    )
    return Manifests(nodes, up.unionByName(down), meta, rejects)


def read_manifests(
    spark: SparkSession, paths: list[str], run_id: str, expected: DataFrame | None = None
) -> Manifests:
    """Manifest files of many projects; the project is the one each manifest names.

    Manifests without a name are told apart by their files: their project is ``unknown:`` and the path.
    """
    parsed = _parsed(read_texts(spark, paths, expected))
    named = F.coalesce(blank_to_null(_text("doc", "metadata.project_name")), F.concat(F.lit("unknown:"), "path"))
    return describe_manifests(cut_lineage(parsed.select(named.alias("project"), F.lit(run_id).alias("run_id"), "path", "doc", "error")))


def schema_version(url: Column) -> Column:
    """``vN`` of a manifest schema URL, without trailing slashes, query and fragment."""
    bare = F.regexp_replace(F.regexp_replace(url, "/+$", ""), r"[?#][\s\S]*$", "")
    return blank_to_null(F.regexp_extract(bare, r"(?:^|/)(v[^/]*)\.json$", 1))


def manifest_schema_version(meta: DataFrame, url: str = "dbt_schema_version") -> DataFrame:
    version = schema_version(F.col(url))
    return meta.withColumn("schema_token", version).withColumn(
        "is_known", F.coalesce(F.col("schema_token").isin(*S.KNOWN_MANIFEST_VERSIONS), F.lit(False))
    )


def parse_optional_artifacts(texts: DataFrame) -> DataFrame:
    """Documents that parse; a missing or broken optional artifact is no row and no error."""
    return texts.withColumn("doc", F.try_parse_json("value")).where(F.col("doc").isNotNull()).drop("value")


def read_optional_artifact(spark: SparkSession, paths: list[str]) -> DataFrame:
    return parse_optional_artifacts(read_texts(spark, paths))


def resolve_compiled_sql(nodes: DataFrame, files: DataFrame, target_dir: str) -> DataFrame:
    """Add ``sql``: compiled_code, else compiled_sql, else the file at compiled_path.

    Only nodes that need a file take part in the join with ``files`` (path, text).
    """
    inline = F.coalesce(blank_to_null(F.col("compiled_code")), blank_to_null(F.col("compiled_sql")))
    relative = blank_to_null(F.col("compiled_path"))
    full = F.when(relative.startswith("/"), relative).otherwise(
        F.concat(F.lit(target_dir.rstrip("/") + "/"), relative)
    )
    # a node with its text, or without a path, has nothing to look for, and null is no key to shuffle by
    known = nodes.withColumns({"sql": inline, "_path": full})
    wanted = F.col("sql").isNull() & F.col("_path").isNotNull()
    texts = files.select(F.col("path").alias("_path"), F.col("text").alias("_text"))
    found = known.where(wanted).join(texts, "_path", "left").withColumn("sql", F.col("_text"))
    return known.where(~wanted).drop("_path").unionByName(found.drop("_path", "_text"))
