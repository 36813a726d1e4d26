"""The conversation trie against a plain dictionary of prefixes, and against its SQL."""

import collections
import hashlib
import zlib

import duckdb
import numpy as np
import pytest

from colweave.llm import prefix_trie as P

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, path string, n long, first long"


def plain_nodes(sequences):
    """Nodes of {conv_id: [(role, text)]}."""
    members = collections.defaultdict(list)
    for c, seq in sequences.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, cs in members.items():
        cost = (len(cs) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += cost
    out = []
    for p, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(sequences[c]) == len(p))
        up = min(members[p[:-1]]) if p else None
        out.append((min(cs), len(p), up, len(cs), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def plain_rebuilt(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - c % 5, [])[:h] + turns[c][h:]
    return out


def made_rows():
    rng = np.random.default_rng(9)
    rows = []
    for c in range(160):
        first = "Hello" if c % 3 == 0 else f"tör {c % 11}"  # a third begin alike
        n = int(rng.integers(0, 9))
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", first if t == 0 else f"x{rng.integers(3)}" * int(rng.integers(1, 3))) for t in range(n)]
    for c in range(200, 260):  # copies, and copies with more turns
        rows += [(c, t, "user", f"copy {t}") for t in range(4 + (c % 20 == 0))]
    rows += [(300, None, None, None), (300, 0, "user", "late"), (301, 1, "", ""), (None, 0, "user", "lost"), (302, 0, "a", "bc"), (303, 0, "ab", "c")]
    rows += [(304, 0, "user", "same"), (304, 0, "user", "same"), (305, 5, "user", "long " * 3000), (10**12, 0, "user", "Hello")]
    return rows


@pytest.fixture(scope="module")
def conversations(spark):
    rows = [(*r, "p", 1, 2) for r in made_rows()]
    order = np.random.default_rng(1).permutation(len(rows))
    return spark.createDataFrame([rows[i] for i in order], SCHEMA).repartition(5)


def nodes_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("container, size, ids", [(4096, 4 << 20, 65536), (1, 4 << 20, 7), (6, 4 << 20, 3), (4096, 300, 65536)])
def test_trie_equals_plain_prefixes(conversations, container, size, ids, monkeypatch):
    monkeypatch.setattr(P, "CONTAINER", container)
    monkeypatch.setattr(P, "CONTAINER_BYTES", size)
    monkeypatch.setattr(P, "ID_RANGE", ids)
    got = nodes_of(P.build(P.rebuilt(conversations)))
    want = plain_nodes(plain_rebuilt(made_rows()))
    assert got == want


def test_root_holds_conversations_without_turns(spark):
    # conversation 5 has no turns beyond those it takes from itself; 6 to 9 have none to take
    rows = [(c, 0, "user", f"t{c}", "", 0, 0) for c in (6, 7, 8, 9, 21, 22)]
    got = nodes_of(P.build(P.rebuilt(spark.createDataFrame(rows, SCHEMA))))
    assert got == plain_nodes(plain_rebuilt([r[:4] for r in rows]))
    assert any(not s for s in plain_rebuilt([r[:4] for r in rows]).values())


def test_empty_tables_have_no_node(spark, conversations):
    assert P.build(P.rebuilt(conversations.limit(0))).count() == 0
    assert P.build(P.rebuilt(conversations.where("conv_id is null"))).count() == 0


def test_query_and_sql_agree(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF_DIR}/conversations.parquet'")
    theirs = con.sql(P.TRIE_SQL)
    ours = P.op11_prefix_trie(spark, SF_DIR)
    assert ours.columns == theirs.columns
    assert nodes_of(ours) == sorted(theirs.fetchall(), key=str)
