"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs in full and its rows go to the no-op sink, so the time is Spark's own.
Names on the command line choose other queries; ``all`` runs every one.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from colweave.bindings.queries import QUERIES  # noqa: E402
from colweave.session import local_session  # noqa: E402

HEADLINE = [
    "merge_columns_by_name",
    "unresolved_rows",
    "procedural_write_targets",
    "node_status",
    "render_lineage_doc",
    "emit_datahub",
    "emit_openmetadata",
    "explode_dbobjs",
    "explode_relationships",
    "explode_diagnostics",
    "redact_literals",
    "normalize_sql",
    "cache_hit_stats",
    "quota_cut",
    "select_nodes",
    "descendants",
    "check_run",
    "edge_count_regressions",
    "golden_drift",
    "validate_lineage",
    "cited_ids",
    "stream_run_coverage",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    names = list(QUERIES) if names == ["all"] else names
    spark = local_session(cpus)
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
