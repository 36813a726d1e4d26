"""Run statistics, coverage, gates and document validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colweave import schemas as S
from colweave.operators.compare import edge_count_regressions
from colweave.session import KEY, RUN

# Texts of the check.
ALL_PASSED = "OK: all check gates passed."
NO_BASELINE = "warning: baseline not found; skipping regression check"


def run_stats(nodes: DataFrame) -> DataFrame:
    """Per run: nodes by status, columns, resolved columns, coverage, eligible nodes.

    ``nodes`` has status, total_columns and resolved_columns. Coverage has four decimals,
    rounded half to even, and is 0 without columns.
    """
    total, resolved = F.sum("total_columns"), F.sum("resolved_columns")
    out = nodes.groupBy(*RUN).agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in S.STATUSES],
        F.coalesce(total, F.lit(0)).alias("total_columns"),
        F.coalesce(resolved, F.lit(0)).alias("resolved_columns"),
        F.count_if(F.col("status") != "skipped").alias("eligible_count"),
    )
    ratio = F.bround(F.col("resolved_columns") / F.nullif(F.col("total_columns"), F.lit(0)), 4)
    return out.withColumn("coverage", F.coalesce(ratio, F.lit(0.0)))


def run_summary(stats: DataFrame, out: str = "lineage") -> DataFrame:
    percent = F.bround(F.col("coverage") * 100, 0).cast("int")
    return stats.select(
        *RUN,
        F.format_string(
            f"wrote {out} — %d parsed, %d partial, %d failed, %d skipped, coverage %d%%",
            "parsed", "partial", "failed", "skipped", percent,
        ).alias("summary"),
    )


def node_coverage(stats: DataFrame) -> DataFrame:
    """Parsed and partial nodes over eligible ones; 1 when none is eligible."""
    done = F.col("parsed") + F.col("partial")
    ratio = done / F.nullif(F.col("eligible_count"), F.lit(0))
    return stats.withColumn("node_coverage", F.coalesce(ratio, F.lit(1.0)))


def column_coverage(stats: DataFrame) -> DataFrame:
    """The coverage a document states; 1 when it states none."""
    return stats.withColumn("column_coverage", F.coalesce(F.col("coverage"), F.lit(1.0)))


def _percent(value: Column) -> Column:
    return F.concat(F.format_string("%.2f", F.bround(value * 100, 2)), F.lit("%"))


def _coverage_gate(covered: DataFrame, name: str, value: str, least: float) -> DataFrame:
    c = F.col(value)
    low = covered.where(c < least)
    shown = F.concat(
        F.lit(f"{name.replace('_', ' ')} "), _percent(c), F.lit(" below required "), _percent(F.lit(least))
    )
    return low.select(*RUN, F.lit(name).alias("gate"), shown.alias("message"))


def gate_node_coverage(stats: DataFrame, least: float) -> DataFrame:
    return _coverage_gate(node_coverage(stats), "node_coverage", "node_coverage", least)


def gate_column_coverage(stats: DataFrame, least: float) -> DataFrame:
    return _coverage_gate(column_coverage(stats), "column_coverage", "column_coverage", least)


def failure_preview(nodes: DataFrame, keys: list[str], shown: int = 5) -> DataFrame:
    """Per key: how many nodes, and the first ids in order with ``...`` if there are more.

    The row number is filtered by a constant, so each task keeps only its first rows of a key
    before the shuffle.
    """
    first = W.partitionBy(*keys).orderBy("node_id")
    head = (
        nodes.select(*keys, "node_id")
        .withColumn("rn", F.row_number().over(first))
        .where(F.col("rn") <= shown)
        .groupBy(*keys)
        .agg(F.array_join(F.sort_array(F.collect_list("node_id")), ", ").alias("ids"))
    )
    counts = nodes.groupBy(*keys).agg(F.count("*").alias("n"))
    more = F.when(F.col("n") > shown, "...").otherwise("")
    return counts.join(head, keys).select(*keys, "n", F.concat("ids", more).alias("preview"))


def _status_gate(nodes: DataFrame, status: str) -> DataFrame:
    found = failure_preview(nodes.where(F.col("status") == status), RUN)
    text = F.concat(F.col("n").cast("string"), F.lit(f" node(s) status={status}: "), F.col("preview"))
    return found.select(*RUN, F.lit(status).alias("gate"), text.alias("message"))


def gate_unsupported(nodes: DataFrame) -> DataFrame:
    return _status_gate(nodes, "unsupported")


def gate_failed(nodes: DataFrame) -> DataFrame:
    return _status_gate(nodes, "failed")


def gate_regression(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """``current`` and ``baseline`` are edge counts per node. A run whose project has no baseline is not
    failed, but has a row that says so: gate ``baseline``, a warning."""
    lost = failure_preview(edge_count_regressions(current, baseline), RUN)
    text = F.concat(F.col("n").cast("string"), F.lit(" regression(s) vs baseline: "), F.col("preview"))
    failed = lost.select(*RUN, F.lit("regression").alias("gate"), text.alias("message"))
    known = baseline.select("project").distinct()
    without = current.select(*RUN).distinct().join(known, "project", "left_anti")
    return failed.unionByName(without.select(*RUN, F.lit("baseline").alias("gate"), F.lit(NO_BASELINE).alias("message")))


def check_run(
    stats: DataFrame,
    nodes: DataFrame,
    min_node_coverage: float | None = None,
    min_column_coverage: float | None = None,
    fail_on_unsupported: bool = False,
    fail_on_failed: bool = False,
    counts: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """One row per failed gate of a run, and one per warning; a run that fails no gate has one row with
    ``OK``, beside its warnings."""
    gates = []
    if min_node_coverage is not None:
        gates.append(gate_node_coverage(stats, min_node_coverage))
    if min_column_coverage is not None:
        gates.append(gate_column_coverage(stats, min_column_coverage))
    if fail_on_unsupported:
        gates.append(gate_unsupported(nodes))
    if fail_on_failed:
        gates.append(gate_failed(nodes))
    if counts is not None:
        gates.append(gate_regression(*counts))
    if not gates:
        return stats.select(*RUN, F.lit(None).cast("string").alias("gate"), F.lit(ALL_PASSED).alias("message"))
    found = reduce(DataFrame.unionByName, gates)
    runs = stats.select(*RUN)
    warnings = found.where("gate = 'baseline'").join(runs, RUN, "left_semi")
    failures = runs.join(found.where("gate <> 'baseline'"), RUN, "left")
    return failures.select(*RUN, "gate", F.coalesce("message", F.lit(ALL_PASSED)).alias("message")).unionByName(warnings)


# --- validation -----------------------------------------------------------------------------


def _get(root: Column, field: str) -> Column:
    return F.try_variant_get(root, f"$.{field}", "variant")


def _kind(value: Column) -> Column:
    """JSON type of a variant: STRING, BIGINT, DOUBLE, OBJECT, ...; null when the field is absent."""
    return F.substring_index(F.substring_index(F.schema_of_variant(value), "<", 1), "(", 1)


NUMBERS = ["BIGINT", "DOUBLE", "DECIMAL"]
VIOLATIONS = "array<struct<path:string,rule:string>>"


class _Rules:
    """Violations of one object, as an array of (path, rule)."""

    def __init__(self, root: Column, path: Column):
        self.root, self.path, self.found = root, path, []

    def add(self, field: str, rule: str, broken: Column) -> None:
        path = F.concat(self.path, F.lit(field)) if field else self.path
        self.found.append(F.when(broken, F.struct(path.alias("path"), F.lit(rule).alias("rule"))))

    def required(self, *fields: str) -> None:
        for f in fields:
            self.add(f, "required", _get(self.root, f).isNull())

    def typed(self, field: str, *kinds: str) -> None:
        self.add(field, "type", ~_kind(_get(self.root, field)).isin(*kinds))  # null if absent

    def one_of(self, field: str, domain: list[str]) -> None:
        text = F.try_variant_get(self.root, f"$.{field}", "string")
        self.add(field, "enum", (_kind(_get(self.root, field)) != "STRING") | ~text.isin(*domain))

    def in_range(self, field: str, least: float, most: float | None = None, whole: bool = False) -> None:
        self.typed(field, *(["BIGINT"] if whole else NUMBERS))
        number = F.try_variant_get(self.root, f"$.{field}", "double")
        outside = (number < least) if most is None else (number < least) | (number > most)
        self.add(field, "range", outside & _kind(_get(self.root, field)).isin(*NUMBERS))

    def closed(self, allowed: list[str]) -> None:
        fields = F.try_variant_get(self.root, "$", "map<string,variant>")
        extra = F.array_except(F.map_keys(fields), F.array(*[F.lit(a) for a in allowed]))
        self.add("", "additional field", F.size(extra) > 0)

    def violations(self, *below: Column) -> Column:
        """Those of the object and of the arrays that its members give."""
        own = F.array_compact(F.array(*self.found))
        return F.concat(own, *below) if below else own


def _each(root: Column, field: str, path: Column, rules) -> Column:
    """Violations of all entries of an array field; ``rules`` takes an entry and its path."""
    entries = F.try_variant_get(root, f"$.{field}", "array<variant>")
    found = F.flatten(F.transform(entries, lambda e, i: rules(e, F.concat(path, F.lit(f"{field}."), i.cast("string")))))
    return F.coalesce(found, F.array().cast(VIOLATIONS))


def _upstream_rules(up: Column, at: Column) -> Column:
    r = _Rules(up, F.concat(at, F.lit(".")))
    r.required("table", "column")
    r.typed("table", "STRING")
    r.typed("column", "STRING")
    r.closed(["table", "column"])
    return r.violations()


def _column_rules(column: Column, at: Column) -> Column:
    path = F.concat(at, F.lit("."))
    r = _Rules(column, path)
    r.required("name")
    r.typed("name", "STRING")
    r.typed("upstream", "ARRAY")
    r.one_of("confidence", S.CONFIDENCES)
    r.one_of("transform", S.TRANSFORMS)
    r.closed(["name", "upstream", "confidence", "transform"])
    return r.violations(_each(column, "upstream", path, _upstream_rules))


def _item_rules(kind: str):
    def rules(item: Column, at: Column) -> Column:
        r = _Rules(item, at)
        r.add("", "type", F.coalesce(_kind(item) != kind, F.lit(True)))
        return r.violations()

    return rules


def _node_rules(node: Column, at: Column) -> Column:
    path = F.concat(at, F.lit("."))
    r = _Rules(node, path)
    r.required("node_id", "status")
    r.typed("node_id", "STRING")
    r.one_of("status", S.STATUSES)
    r.one_of("confidence", S.CONFIDENCES)
    r.typed("dialect", "STRING", "VOID")
    for f in ("upstream_tables", "downstream", "columns", "unresolved", "warnings"):
        r.typed(f, "ARRAY")
    texts = [_each(node, f, path, _item_rules("STRING")) for f in ("upstream_tables", "downstream", "warnings")]
    return r.violations(_each(node, "columns", path, _column_rules), *texts, _each(node, "unresolved", path, _item_rules("OBJECT")))


def _document_rules(doc: Column) -> Column:
    path = F.lit("$.")
    r = _Rules(doc, path)
    r.required("schema_version", "generator", "manifest_metadata", "backend", "stats", "nodes")
    for f in ("schema_version", "generator", "generated_at"):
        r.typed(f, "STRING")
    for f in ("manifest_metadata", "backend", "stats"):
        r.typed(f, "OBJECT")
    r.typed("nodes", "ARRAY")
    for f in ("dbt_version", "project_name", "selected_count", "eligible_count"):
        r.add(f"manifest_metadata.{f}", "required", _get(doc, "manifest_metadata").isNotNull() & _get(doc, f"manifest_metadata.{f}").isNull())
    r.add("backend.mode", "required", _get(doc, "backend").isNotNull() & _get(doc, "backend.mode").isNull())
    for f in ("dbt_version", "dbt_schema_version", "project_name"):
        r.typed(f"manifest_metadata.{f}", "STRING")
    r.typed("manifest_metadata.adapter_type", "STRING", "VOID")
    for f in ("mode", "parser_version", "cli_version"):
        r.typed(f"backend.{f}", "STRING")
    for f in ("selected_count", "eligible_count"):
        r.in_range(f"manifest_metadata.{f}", 0, whole=True)
    for f in (*S.STATUSES, "total_columns", "resolved_columns"):
        r.in_range(f"stats.{f}", 0, whole=True)
    r.in_range("stats.coverage", 0, 1)
    return r.violations(_each(doc, "nodes", path, _node_rules))


def validate_lineage(docs: DataFrame, doc: str = "doc", keys: list[str] | None = None) -> DataFrame:
    """All violations (path, rule) of lineage documents, given as JSON text.

    Objects are open, except a column and its upstream entries, where an unknown field would
    mean lineage that readers silently miss. A text is parsed once and all levels of it are checked in
    the row where it stands, by one expression and one explode.
    """
    keys = keys or RUN
    parsed = docs.select(*keys, F.try_parse_json(doc).alias("_doc"))
    no_object = F.array(F.struct(F.lit("$").alias("path"), F.lit("object").alias("rule")))
    is_object = F.coalesce(_kind(F.col("_doc")) == "OBJECT", F.lit(False))
    found = F.when(is_object, _document_rules(F.col("_doc"))).otherwise(no_object)
    # an outer generator: for an inner one the planner adds a filter that works all rules a second time
    return parsed.select(*keys, F.explode_outer(found).alias("v")).where("v is not null").select(*keys, "v.path", "v.rule")
