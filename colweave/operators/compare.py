"""Comparison of lineage between runs, tools and goldens."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colweave.operators.mapper import union_counts
from colweave.session import KEY, cut_lineage, held_names

NODE = ["project", "node_id"]


def edge_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges per node, 0 for a node without any."""
    return union_counts([nodes, edges.select(*KEY, F.lit(1).alias("n_edges"))], ["n_edges"])


def edge_count_regressions(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """Nodes in both documents with fewer edges now. New and deleted nodes do not count.

    Nodes match by project and id; the run of the current side is kept. If the baseline lists a
    node more than once, its last entry by ``node_ord`` counts.
    """
    order = F.col("node_ord") if "node_ord" in baseline.columns else F.lit(0)
    base = (
        baseline.groupBy(*NODE)
        .agg(F.max(F.struct(order.alias("o"), "n_edges"))["n_edges"].alias("baseline"))
    )
    joined = current.select(*KEY, F.col("n_edges").alias("current")).join(base, NODE)
    return joined.where(F.col("current") < F.col("baseline")).select(
        *KEY, (F.col("baseline") - F.col("current")).alias("edges_lost"), "current", "baseline"
    )


def diff_report(regressions: DataFrame) -> DataFrame:
    """Each regression as a line of text and as JSON."""
    line = F.format_string("  %s: %d -> %d (-%d)", "node_id", "baseline", "current", "edges_lost")
    return regressions.select(
        *KEY, line.alias("line"), F.to_json(F.struct("node_id", "edges_lost", "current", "baseline")).alias("json")
    )


def diff_headline(runs: DataFrame, regressions: DataFrame) -> DataFrame:
    """First line of the report of each run."""
    run = ["project", "run_id"]
    n = regressions.groupBy(*run).agg(F.count("*").alias("n"))
    none = "No regressions: every node has at least as many column edges as baseline."
    return runs.select(*run).distinct().join(n, run, "left").select(
        *run,
        F.when(F.col("n").isNull(), none)
        .otherwise(F.concat(F.col("n").cast("string"), F.lit(" regression(s) vs baseline:")))
        .alias("line"),
    )


def compare_against_stock(ours: DataFrame, other: DataFrame) -> DataFrame:
    """Per node our edges, the other tool's, and whether ours are strictly more."""
    both = union_counts(
        [
            ours.select(*NODE, F.col("n_edges").alias("ours")),
            other.select(*NODE, F.col("n_edges").alias("other")),
        ],
        ["ours", "other"],
        NODE,
    )
    return both.withColumn("ours_exceeds", F.col("ours") > F.col("other"))


def golden_drift(
    tables: DataFrame, columns: DataFrame, edges: DataFrame,
    golden_tables: DataFrame, golden_columns: DataFrame, golden_edges: DataFrame,
) -> DataFrame:
    """Nodes whose upstream tables, column count or edge count differ from the golden.

    The table sets are compared as rows: a table on one side only is a difference of one.
    """
    side = union_counts(
        [
            tables.select(*NODE, "fqn").distinct().select(*NODE, "fqn", F.lit(1).alias("ours")),
            golden_tables.select(*NODE, "fqn").distinct().select(*NODE, "fqn", F.lit(1).alias("golden")),
        ],
        ["ours", "golden"],
        [*NODE, "fqn"],
    )
    one = F.lit(1)
    totals = union_counts(
        [
            side.where(F.col("ours") != F.col("golden")).select(*NODE, one.alias("table_diff")),
            columns.select(*NODE, one.alias("columns")),
            golden_columns.select(*NODE, one.alias("golden_columns")),
            edges.select(*NODE, one.alias("edges")),
            golden_edges.select(*NODE, one.alias("golden_edges")),
        ],
        ["table_diff", "columns", "golden_columns", "edges", "golden_edges"],
        NODE,
    )
    return totals.where(
        (F.col("table_diff") > 0)
        | (F.col("columns") != F.col("golden_columns"))
        | (F.col("edges") != F.col("golden_edges"))
    )


def missing_expected_tables(expected: DataFrame, tables: DataFrame) -> DataFrame:
    """Expected upstream tables that were not found, in any case of letters."""
    found = tables.select(*NODE, F.lower("fqn").alias("_low")).distinct()
    return (
        expected.withColumn("_low", F.lower("fqn"))
        .join(found, [*NODE, "_low"], "left_anti")
        .select(*NODE, "fqn")
        .distinct()
    )


def _words(fields: list[str], *seeds: str) -> list[Column]:
    """60 bits of a digest of the fields for each seed, as longs."""
    text = F.concat_ws("\u001f", *[F.coalesce(F.col(f).cast("string"), F.lit("\u0000")) for f in fields])
    return [F.conv(F.substring(F.md5(F.concat(F.lit(s), text)), 1, 15), 16, 10).cast("bigint") for s in seeds]


def content_fingerprint(rows: DataFrame, fields: list[str]) -> DataFrame:
    """Digest of each node's rows that does not depend on their order.

    Row digests are combined by count, sum and exclusive or, all of which are partial
    aggregates, so no node's rows are ever put in one list.
    """
    sums = rows.select(*KEY, _words(fields, "")[0].alias("w")).groupBy(*KEY).agg(
        F.count("*").alias("n"),
        F.sum(F.col("w").cast("decimal(20,0)")).cast("string").alias("s"),
        F.bit_xor("w").cast("string").alias("x"),
    )
    return sums.select(*KEY, F.sha2(F.concat_ws("|", F.col("n").cast("string"), "s", "x"), 256).alias("fingerprint"))


def fingerprint_drift(prints: DataFrame) -> DataFrame:
    """Nodes whose content differs between runs."""
    return prints.groupBy(*NODE).agg(
        F.count("*").alias("runs"), F.count_distinct("fingerprint").alias("versions")
    ).where("versions > 1")


# --- columns --------------------------------------------------------------------------------

COLUMN = [*NODE, "column"]
EDGE = ["up_table", "up_column"]


def column_diff(columns: DataFrame, edges: DataFrame, base_columns: DataFrame, base_edges: DataFrame) -> DataFrame:
    """Columns whose upstreams differ from the baseline, with those lost and those added.

    ``columns``: project, node_id, name; ``edges``: project, node_id, column, up_table, up_column. Nulls
    are values like others. Nodes of one side only do not count. ``change`` is column_lost, column_added
    or changed; ``severity`` is regression where an upstream or a column was lost, else addition.

    Both sides meet as rows of one aggregate, so an edge that stayed is gone before lists are made, and
    the lists hold what differs.
    """
    both_nodes = columns.select(*NODE).distinct().join(base_columns.select(*NODE).distinct(), NODE, "left_semi")

    held = held_names(NODE)

    def side(df: DataFrame, column: str, flag: str, is_edge: bool) -> DataFrame:
        ups = [F.col(c) if is_edge else F.lit(None).cast("string").alias(c) for c in EDGE]
        return df.select(*[F.col(c).alias(h) for c, h in held.items()], F.col(column).alias("column"), F.lit(is_edge).alias("is_edge"), *ups, *[F.lit(int(f == flag)).alias(f) for f in ("now", "before")])

    parts = [side(columns, "name", "now", False), side(edges, "column", "now", True)]
    parts += [side(base_columns, "name", "before", False), side(base_edges, "column", "before", True)]
    rows = reduce(DataFrame.unionByName, parts).groupBy(*held.values(), "column", "is_edge", *EDGE).agg(F.max("now").alias("now"), F.max("before").alias("before"))
    rows = rows.withColumnsRenamed({h: c for c, h in held.items()})
    pair = F.struct(F.col("up_table").alias("table"), F.col("up_column").alias("column"))
    listed = lambda keep: F.sort_array(F.collect_list(F.when(F.col("is_edge") & keep, pair)))
    per_column = rows.where("not is_edge or now <> before").groupBy(*COLUMN).agg(
        listed(F.col("now") < F.col("before")).alias("lost_upstream"),
        listed(F.col("now") > F.col("before")).alias("added_upstream"),
        # an edge speaks for its column too, should the columns not list it
        F.max("now").alias("now"), F.max("before").alias("before"),
    )
    lost, added = F.size("lost_upstream") > 0, F.size("added_upstream") > 0
    change = F.when((F.col("now") == 0), "column_lost").when(F.col("before") == 0, "column_added").otherwise("changed")
    worse = lost | (change == "column_lost")
    return per_column.where(lost | added | (F.col("now") != F.col("before"))).join(both_nodes, NODE, "left_semi").select(
        *COLUMN, "lost_upstream", "added_upstream", change.alias("change"), F.when(worse, "regression").otherwise("addition").alias("severity")
    )


def column_diff_report(diff: DataFrame) -> DataFrame:
    """Each column as a line of text and as JSON, for a review comment."""
    names = lambda c: F.array_join(F.transform(c, lambda u: F.concat_ws(".", u["table"], u["column"])), ", ")
    part = lambda sign, c: F.when(F.size(c) > 0, F.concat(F.lit(f" {sign}["), names(c), F.lit("]"))).otherwise("")
    line = F.concat(F.lit("  "), "node_id", F.lit("."), F.coalesce("column", F.lit("?")), F.lit(": "), "change", part("-", "lost_upstream"), part("+", "added_upstream"))
    shown = F.struct("node_id", "column", "lost_upstream", "added_upstream", "change", "severity")
    return diff.select(*NODE, "column", "severity", line.alias("line"), F.to_json(shown).alias("json"))


#: Statuses from best to worst; a skipped node has no status to lose.
STATUS_RANK = {"parsed": 0, "partial": 1, "unsupported": 2, "failed": 3}


def status_regressions(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """Nodes whose status is worse than in the baseline; one that was parsed is of high severity.

    A node that the baseline lists more than once counts with its best status there.
    """
    rank = F.coalesce(*[F.when(F.col("status") == s, F.lit(r)) for s, r in STATUS_RANK.items()])
    names = F.array(*[F.lit(s) for s in STATUS_RANK])
    before = baseline.select(*NODE, rank.alias("before")).where("before is not null").groupBy(*NODE).agg(F.min("before").alias("before"))
    worse = current.select(*KEY, rank.alias("now")).join(before, NODE).where("now > before")
    return worse.select(
        *KEY, F.element_at(names, F.col("before") + 1).alias("baseline"), F.element_at(names, F.col("now") + 1).alias("current"),
        F.when(F.col("before") == 0, "high").otherwise("medium").alias("severity"),
    )


def column_prints(edges: DataFrame) -> DataFrame:
    """A fingerprint of the set of upstreams of each column, whatever their order."""
    first, second = _words(EDGE, "a", "b")
    rows = edges.select(*COLUMN, *EDGE).distinct().select(*COLUMN, first.alias("a"), second.alias("b"))
    sums = rows.groupBy(*COLUMN).agg(F.count("*").alias("n"), F.sum(F.col("a").cast("decimal(20,0)")).alias("a"), F.sum(F.col("b").cast("decimal(20,0)")).alias("b"))
    return sums.select(*COLUMN, F.concat_ws("|", *[F.col(c).cast("string") for c in ("n", "a", "b")]).alias("print"))


def renamed_columns(edges: DataFrame, base_edges: DataFrame) -> DataFrame:
    """What became of the columns of nodes in both sides whose upstreams are not where they were.

    A column of the baseline and one of now match if they are of one node and have the same set of
    upstreams; columns that are as they were match nothing else. Where several could match, the first
    lost by name goes to the first new by name, and so on, so each has one partner at most. ``kind``:

    * renamed: the new name was not there before and the old one is gone;
    * swapped: the old and the new name have changed places;
    * moved: any other match, such as a cycle of three, or a name that is reused;
    * changed: the name stayed and its upstreams are others; lost, added: no partner at all;
    * replaced: a name whose upstreams went to another name and that has got new ones.

    Columns without upstreams have nothing to be known by and are left out.
    """
    now, before = (cut_lineage(column_prints(e)) for e in (edges, base_edges))
    both = now.select(*NODE).distinct().join(before.select(*NODE).distinct(), NODE, "left_semi")

    def apart(these: DataFrame, those: DataFrame, name: str) -> DataFrame:
        left = these.join(those, [*COLUMN, "print"], "left_anti").join(both, NODE, "left_semi")
        place = F.row_number().over(W.partitionBy(*NODE, "print").orderBy("column"))
        return left.select(*NODE, "print", F.col("column").alias(name), place.alias("place"))

    matched = cut_lineage(apart(before, now, "old_name").join(apart(now, before, "new_name"), [*NODE, "print", "place"], "full").drop("print", "place"))
    pairs = matched.where("old_name is not null and new_name is not null")
    back = pairs.select(*NODE, F.col("new_name").alias("old_name"), F.col("old_name").alias("new_name"), F.lit(True).alias("returns"))
    was = before.select(*NODE, F.col("column").alias("new_name"), F.lit(True).alias("was"))
    stays = now.select(*NODE, F.col("column").alias("old_name"), F.lit(True).alias("stays"))
    gone = pairs.select(*NODE, F.col("old_name").alias("new_name"), F.lit(True).alias("gone"))
    known = (
        matched.join(back, [*NODE, "old_name", "new_name"], "left").join(was, [*NODE, "new_name"], "left")
        .join(gone, [*NODE, "new_name"], "left").join(stays, [*NODE, "old_name"], "left")
    )
    old, new = F.col("old_name").isNotNull(), F.col("new_name").isNotNull()
    kind = (
        F.when(old & new & F.col("returns"), "swapped").when(old & new & F.col("was").isNull() & F.col("stays").isNull(), "renamed").when(old & new, "moved")
        .when(old & F.col("stays"), "changed").when(old, "lost").when(F.col("was").isNull(), "added").when(F.col("gone"), "replaced")
    )
    # else a new set of upstreams under an old name, which its old row tells as changed
    return known.select(*NODE, "old_name", "new_name", kind.alias("kind")).where("kind is not null")
