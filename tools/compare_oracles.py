"""Run queries and their SQL side by side: python tools/compare_oracles.py SF_DIR [NAME ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from colweave.bindings.oracles import ORACLES  # noqa: E402
from colweave.bindings.queries import QUERIES  # noqa: E402
from colweave.bindings.views import TABLES  # noqa: E402
from colweave.session import local_session  # noqa: E402


def _value(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(round(x, 9))
    return repr(x)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name):
    started = time.time()
    df = QUERIES[name](spark, sf_dir)
    ours = _rows(df.columns, df.collect())
    took = time.time() - started
    if name not in ORACLES:
        return name, "rows only", len(ours), None, took, None
    result = con.sql(ORACLES[name])
    columns = result.columns
    theirs = _rows(columns, result.fetchall())
    same = sorted(columns) == sorted(df.columns) and ours == theirs
    diff = None
    if not same:
        a, b = set(ours) - set(theirs), set(theirs) - set(ours)
        diff = (sorted(df.columns), sorted(columns), len(a), sorted(a)[:2], len(b), sorted(b)[:2])
    return name, "ok" if same else "DIFFERENT", len(ours), len(theirs), took, diff


def main():
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    bad = 0
    for name in names:
        try:
            name, verdict, n, m, took, diff = compare(spark, con, sf_dir, name)
        except Exception as e:  # report and go on
            name, verdict, n, m, took, diff = name, "ERROR", None, None, 0, str(e)[:1500]
        bad += verdict not in ("ok", "rows only")
        print(f"{verdict:9} {name} rows={n}/{m} {took:.2f}s", flush=True)
        if diff:
            print("   ", str(diff)[:3000], flush=True)
    print(f"{bad} of {len(names)} differ")


if __name__ == "__main__":
    main()
