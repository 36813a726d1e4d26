import itertools

import pytest

from colweave.operators import cache, graph, select

#: A diamond (load feeds left and right, both feed join) with a snapshot after it and one test.
NODES = [
    ("model.zoo.load", "load", "model", ["zoo", "in", "load"], ["raw"]),
    ("model.zoo.left", "left", "model", ["zoo", "mid", "left"], ["mid", "slow"]),
    ("model.zoo.right", "right", "model", ["zoo", "mid", "right"], ["mid"]),
    ("model.zoo.join", "join", "model", ["zoo", "out", "join"], ["out"]),
    ("snapshot.zoo.kept", "kept", "snapshot", ["zoo", "kept"], None),
    ("test.zoo.not_null", "not_null", "test", ["zoo", "checks", "not_null"], None),
]
LOAD, LEFT, RIGHT, JOIN, KEPT, TEST = (n[0] for n in NODES)
LINKS = [(LOAD, LEFT), (LOAD, RIGHT), (LEFT, JOIN), (RIGHT, JOIN), (JOIN, KEPT)]
EDGES = [(kind, *link) for kind in ("parent_map", "child_map") for link in LINKS] + [("parent_map", "source.animals", LOAD)]


@pytest.fixture(scope="module")
def demo(spark):
    nodes = spark.createDataFrame(
        [("p", "r", *n) for n in NODES],
        "project string, run_id string, node_id string, name string, resource_type string, fqn array<string>, tags array<string>",
    )
    edges = spark.createDataFrame(
        [("p", "r", *e) for e in EDGES], "project string, run_id string, origin string, parent_id string, child_id string"
    )
    return nodes, edges


@pytest.mark.parametrize(
    "kwargs, expected",
    [
        ({}, {LOAD, LEFT, RIGHT, JOIN, KEPT, TEST}),
        ({"select": ["right"]}, {RIGHT}),
        ({"select": ["ZOO.mid.Left", " tag:out "]}, {LEFT, JOIN}),
        ({"select": ["tag:Slow"]}, set()),
        ({"select": ["left+"]}, {LEFT, JOIN, KEPT}),
        ({"select": ["+join"]}, {LOAD, LEFT, RIGHT, JOIN}),
        ({"select": ["load+"]}, {LOAD, LEFT, RIGHT, JOIN, KEPT}),
        ({"select": ["tag:mid"], "exclude": ["right"]}, {LEFT}),
        ({"exclude": ["+left", "tag:out"]}, {RIGHT, KEPT, TEST}),
        ({"resource_types": [" Snapshot "]}, {KEPT}),
        ({"select": ["  "]}, set()),
    ],
)
def test_select_nodes(demo, kwargs, expected):
    assert {r.node_id for r in select.select_nodes(*demo, **kwargs).collect()} == expected


def test_closure_on_cycles_equals_brute_force(spark):
    pairs = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "d"), ("e", "a"), ("f", "g")]
    pairs += [(f"n{i}", f"n{i + 1}") for i in range(12)]
    edges = spark.createDataFrame([("p", "r", *p) for p in pairs], "project string, run_id string, parent_id string, child_id string")
    seeds = [("one", "a"), ("two", "f"), ("two", "n0"), ("one", "d")]
    df = spark.createDataFrame([(s, "p", "r", n) for s, n in seeds], "side string, project string, run_id string, node_id string")
    for walk, src in ((graph.descendants, 0), (graph.ancestors, 1)):
        got = {(r.side, r.node_id) for r in walk(df, edges, ["side"]).collect()}
        expected = set()
        for side in ("one", "two"):
            todo, seen = [n for s, n in seeds if s == side], set()
            while todo:
                at = todo.pop()
                for p in pairs:
                    if p[src] == at and p[1 - src] not in seen:
                        seen.add(p[1 - src])
                        todo.append(p[1 - src])
            expected |= {(side, n) for n in seen}
        assert got == expected


def test_quota_cut_equals_walk(spark):
    planned = [
        ("p", run, f"n{i:03d}", f"k{(i * 7 + len(run)) % 23}", i % 5 != 0) for run, i in itertools.product(("r1", "run2"), range(60))
    ]
    cached = {"k3", "k8"}
    df = spark.createDataFrame(planned, "project string, run_id string, node_id string, cache_key string, eligible boolean")
    entries = [(k, "{}") for k in cached] + [("k1", "{broken"), ("k12", "")]  # a broken entry spends a call
    known = spark.createDataFrame(entries, "cache_key string, payload string")
    for budget in (0, 4, 100):
        got = {(r.run_id, r.node_id): (r.outcome, r.detail) for r in cache.quota_cut(df, known, budget, "limit").collect()}
        for run in ("r1", "run2"):
            spent, seen, over = 0, set(cached), False
            for _, _, node, key, ok in sorted(p for p in planned if p[1] == run):
                if not ok:
                    assert (run, node) not in got
                    continue
                first = False
                if not over and key not in seen:
                    if spent == budget:
                        over = first = True
                    else:
                        spent += 1
                        seen.add(key)
                detail = None if not over else "limit" if first else "anonymous tier exhausted earlier in this run"
                assert got[(run, node)] == ("failed" if over else "answered", detail)


def test_eligibility(spark):
    rows = [
        ("a", "model", "s", "bigquery"), ("b", "seed", None, "bigquery"), ("c", None, "s", "bigquery"),
        ("d", "model", "", "bigquery"), ("e", "macro", "s", "nope"), ("f", "Model", "s", "spark"),
    ]
    df = spark.createDataFrame(rows, "node_id string, resource_type string, sql string, adapter_type string")
    got = {r.node_id: (r.eligible, r.skip_reason, r.dialect) for r in select.eligibility_with_sql(df).collect()}
    assert got["a"] == (True, None, "dbvbigquery")
    assert got["b"][1] == "seed (no SQL body)"
    assert got["c"][1] == "missing resource_type"
    assert got["d"][1] == "missing compiled SQL"
    assert got["e"][1].startswith("dialect: unknown adapter_type 'nope'") and got["e"][2] is None
    assert got["f"][1] == "unsupported resource_type 'Model'"
    forced = {r.node_id: r.dialect for r in select.eligibility_with_sql(df, "presto").collect()}
    assert set(forced.values()) == {"dbvpresto"}


def test_size_guard(spark):
    df = spark.createDataFrame([("p", "r", i < 51) for i in range(60)], "project string, run_id string, eligible boolean")
    assert select.selection_size_guard(df, "anonymous").count() == 1
    assert select.selection_size_guard(df, "anonymous", 51).count() == 0
    assert select.selection_size_guard(df, "authenticated").count() == 0


def test_cache(spark, tmp_path):
    requests = spark.createDataFrame(
        [("p", "r", "a", "k1"), ("p", "r", "b", "k2"), ("p", "r", "c", "k2"), ("p", "r", "d", "k3")],
        "project string, run_id string, node_id string, cache_key string",
    )
    answers = spark.createDataFrame([("k1", '{"code": 200}'), ("k3", "{broken")], "cache_key string, payload string")
    path = str(tmp_path / "cache")
    cache.write_response_cache(answers, path)
    stored = cache.read_response_cache(spark, path)
    hits, todo = cache.split_cached(requests, stored)
    assert {r.node_id for r in hits.collect()} == {"a"}
    assert {r.node_id for r in todo.collect()} == {"b", "c", "d"}
    (stats,) = cache.cache_hit_stats(requests, stored).collect()
    assert (stats.hits, stats.misses, stats.hit_rate_pct) == (2, 2, 50)
    later = spark.createDataFrame([("k3", '{"code": 201}'), ("k4", "{}")], "cache_key string, payload string")
    cache.write_response_cache(later, path)
    again = {r.cache_key: r.payload for r in cache.read_response_cache(spark, path).collect()}
    assert again == {"k1": '{"code": 200}', "k3": '{"code": 201}', "k4": "{}"}
    assert cache.read_response_cache(spark, path).count() == 3
