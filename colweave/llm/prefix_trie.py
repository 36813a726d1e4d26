"""Conversation prefix trie, built as a burst trie spread over Spark tasks.

A conversation is a path of turn ids, each the digest of role and text with the text's bytes, of one
width, so that a prefix of turns is a prefix of the path. Equal paths are brought together first, with
their number, least conversation and the digest of all their conversations. The trie then begins as one
container of all paths. A container with too many paths bursts: its prefix becomes a head of the trie,
and its paths go to containers by their next turn id, until all containers are small. Each remaining
container is sorted and swept once, in one task: neighbouring paths tell which nodes end and begin.
Heads get their totals from the containers and heads below them, the deepest first.

A container is bounded by CONTAINER paths and CONTAINER_BYTES of ids, or is one path; what a task holds
of a conversation is its turn ids. Copies of a conversation cost one path. Their ids are listed in
parts of ID_RANGE ids and digested in a stream, so no group is ever held as a whole.

Edge cases: rows without conv_id belong to no conversation; null role or text is empty; turns go null
first, ties by role and then by content; repeated rows are turns of their own; a conversation that is
rebuilt without turns ends at the root; an empty table has no node; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave.llm import tables as B
from colweave.session import cut_lineage

#: Bytes of a turn id: 16 of digest, 4 of the text's size.
WIDTH = 20
#: Paths and bytes of ids in a container that is swept as it is.
CONTAINER, CONTAINER_BYTES = 4096, 4 << 20
#: Conversation ids that are listed at a time.
ID_RANGE = 65536
#: A node; `above` is the prefix of the head above, where the node is the top of a container.
NODE = "conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, above binary"
RESULT = [c.split()[0] for c in NODE.split(", ")][:-1]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def prefix(path: str | Column, depth: Column | int) -> Column:
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.substring(path, F.lit(1), (depth * WIDTH).cast("int"))


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, ids): the turn ids of every conversation in order, as an array of binaries."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    size = F.octet_length(text)
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    turn_id = F.unhex(F.concat(digest, F.lpad(F.hex(size), 8, "0")))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.struct(F.col("turn").alias("at"), role.alias("role"), turn_id.alias("id")).alias("t")
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts")).select("conv_id", F.col("ts.id").alias("ids"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, path) of the contract's conversations: the first turns of conversation c - c % 5,
    then the own ones after as many."""
    own = turns(conversations)
    heads = own.where("conv_id % 5 = 0").select(F.col("conv_id").alias("base"), F.slice("ids", 1, 8).alias("first"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(9)).cast("int")
    none = F.array().cast("array<binary>")
    both = own.withColumn("base", F.expr("conv_id - conv_id % 5")).join(heads, "base", "left").withColumn("h", h)
    ids = F.concat(F.slice(F.coalesce("first", none), F.lit(1), F.col("h")), F.slice("ids", F.col("h") + 1, F.greatest(F.size("ids"), F.lit(1))))
    return both.select("conv_id", F.unhex(F.array_join(F.transform(ids, F.hex), "")).alias("path"))


def paths(conversations: DataFrame) -> DataFrame:
    """`conv_id, path` rows brought together: (path, n, first, ends) for each distinct path."""
    part = F.floor(F.col("conv_id") / ID_RANGE)
    listed = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    parts = conversations.groupBy("path", part.alias("part")).agg(F.count("*").alias("n"), F.min("conv_id").alias("first"), listed.alias("listed"))
    spread = parts.repartition("path").sortWithinPartitions("path", "part")
    return spread.select("path", "n", "first", "listed").mapInArrow(_digest, "path binary, n long, first long, ends string")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each path from its parts, which come in order of the ids."""
    now = None
    for batch in batches:
        out = []
        for path, n, first, listed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now[0] != path:
                if now is not None:
                    out.append((*now[:3], now[3].hexdigest()))
                now = [path, 0, first, hashlib.sha256()]
            else:
                now[3].update(b",")
            now[1] += n
            now[3].update(listed.encode())
        yield _path_rows(out)
    if now is not None:
        yield _path_rows([(*now[:3], now[3].hexdigest())])


def _path_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["path", "n", "first", "ends"])


class Sweep:
    """Nodes of one container from its sorted paths. Node 0 is the top, at depth `top`."""

    def __init__(self, top: int, path: bytes):
        self.top, self.path = top, path[: top * WIDTH]
        self.nodes: list[list] = []  # first, depth, parent, n, children, leaves, saved, ends, bytes
        self.open: list[int] = []
        self._open(self.path, top)

    def _open(self, path: bytes, depth: int) -> None:
        """The node of the first `depth` turns of a path."""
        size = int.from_bytes(path[depth * WIDTH - 4 : depth * WIDTH], "big") if depth else 0
        self.nodes.append([None, depth, self.open[-1] if self.open else None, 0, 0, 0, 0, NO_ENDS, size])
        self.open.append(len(self.nodes) - 1)

    def _close(self) -> None:
        node = self.nodes[self.open.pop()]
        node[5] = node[5] or 1
        node[6] += (node[3] - 1) * node[8]
        if self.open:
            above = self.nodes[self.open[-1]]
            above[0] = node[0] if above[0] is None else min(above[0], node[0])
            above[3] += node[3]
            above[4] += 1
            above[5] += node[5]
            above[6] += node[6]

    def add(self, path: bytes, n: int, first: int, ends: str) -> None:
        same, at = self.top, self.top * WIDTH
        most = min(len(path), len(self.path)) // WIDTH
        while same < most and path[at : at + WIDTH] == self.path[at : at + WIDTH]:
            same, at = same + 1, at + WIDTH
        while self.nodes[self.open[-1]][1] > same:
            self._close()
        for depth in range(same + 1, len(path) // WIDTH + 1):
            self._open(path, depth)
        self.path = path
        last = self.nodes[self.open[-1]]
        last[0] = first if last[0] is None else min(last[0], first)
        last[3] += n
        last[7] = ends

    def rows(self) -> list[tuple]:
        while self.open:
            self._close()
        above = self.path[: (self.top - 1) * WIDTH] if self.top else None
        return [(x[0], x[1], None if x[2] is None else self.nodes[x[2]][0], *x[3:8], above if x[2] is None else None) for x in self.nodes]


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of all containers; rows (top, path, n, first, ends) come sorted by container and path."""
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string(), pa.binary()]
    names = [c.split()[0] for c in NODE.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(list(zip(*rows, strict=True)) or [[]] * len(kinds), kinds, strict=True)], names=names)

    now, key = None, None
    for batch in batches:
        out: list[tuple] = []
        for top, path, n, first, ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != (top, path[: top * WIDTH]):
                if now is not None:
                    out += now.rows()
                now, key = Sweep(top, path), (top, path[: top * WIDTH])
            now.add(path, n, first, ends)
        yield batch_of(out)
    if now is not None:
        yield batch_of(now.rows())


def burst(found: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Paths with the depth of their container's prefix (`top`), and by depth the heads: prefix, and
    n, first and ends of the path that ends there (0, null, none without one)."""
    small: list[DataFrame] = []
    heads: list[DataFrame] = []
    state = found
    while True:
        depth = len(heads)
        ending = F.octet_length("path") == depth * WIDTH
        sizes = state.groupBy(prefix("path", depth).alias("prefix")).agg(F.count("*").alias("rows"), F.sum(F.octet_length("path")).alias("bytes"))
        big = cut_lineage(sizes.where(f"rows > 1 and (rows > {CONTAINER} or bytes > {CONTAINER_BYTES})").select("prefix"))
        if big.isEmpty():
            small.append(state.withColumn("top", F.lit(depth)))
            return reduce(DataFrame.unionByName, small), heads
        marked = cut_lineage(state.withColumn("prefix", prefix("path", depth)).join(big.withColumn("bursts", F.lit(True)), "prefix", "left"))
        small.append(marked.where("bursts is null").drop("bursts", "prefix").withColumn("top", F.lit(depth)))
        state = marked.where(F.col("bursts") & ~ending).drop("bursts", "prefix")
        ended = marked.where(F.col("bursts") & ending).select("prefix", "n", "first", "ends")
        heads.append(big.join(ended, "prefix", "left").select("prefix", F.coalesce("n", F.lit(0)).alias("n"), "first", F.coalesce("ends", F.lit(NO_ENDS)).alias("ends")))


def build(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of `conv_id, path` rows, see RESULT."""
    containers, heads = burst(cut_lineage(paths(conversations)))
    spread = containers.select("top", "path", "n", "first", "ends", prefix("path", F.col("top")).alias("prefix"))
    spread = spread.repartition("top", "prefix").sortWithinPartitions("top", "prefix", "path").drop("prefix")
    swept = spread.mapInArrow(sweep, NODE)
    if not heads:
        return swept.select(RESULT)
    swept = cut_lineage(swept)
    tops = swept.where("above is not null")
    out = [swept.where("above is null")]
    below = None  # the heads one level deeper, as rows of NODE with their prefix
    for depth in reversed(range(len(heads))):
        children = tops.where(F.col("depth") == depth + 1)
        if below is not None:
            children = children.unionByName(below.drop("prefix"))
        children = children.withColumnRenamed("above", "prefix")
        sums = children.groupBy("prefix").agg(
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.count("*").alias("n_children"),
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"),
        )
        size = F.conv(F.hex(F.substring("prefix", -4, 4)), 16, 10).cast("long") if depth else F.lit(0)
        total = F.col("n_convs") + F.col("n")
        joined = heads[depth].join(sums, "prefix").select(
            "prefix", F.least("conv_id", "first").alias("conv_id"), F.lit(depth).alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
            total.alias("n_convs"), "n_children", "n_leaves", (F.col("saved") + (total - 1) * size).alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
            (prefix("prefix", depth - 1) if depth else F.lit(None).cast("binary")).alias("above"),
        )
        level = cut_lineage(joined)
        parents = level.select("prefix", F.col("conv_id").alias("head"))
        out.append(children.drop("parent_conv_id").join(parents, "prefix").withColumn("parent_conv_id", F.col("head")).withColumn("above", F.col("prefix")))
        below = level
    out.append(below)
    return reduce(DataFrame.unionByName, [x.select(RESULT) for x in out])


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = B.read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return build(rebuilt(conversations))


#: The CRC of a text's bytes, bit by bit.
_CRC = """
xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda c, x: list_reduce(list_prepend(xor(c, x), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda b, z: CASE WHEN b % 2 = 1 THEN xor(b // 2, 3988292384::BIGINT) ELSE b // 2 END)), 4294967295::BIGINT)"""
TRIE_SQL = f"""
WITH original AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(strlen(role) || ':' || role || text)) AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL) x),
convs AS (SELECT conv_id, ({_CRC}) % 9 AS h FROM (SELECT DISTINCT conv_id FROM original) x),
taken AS (
  SELECT c.conv_id, 0 AS part, o.pos, o.role, o.text FROM convs c JOIN original o ON o.conv_id = c.conv_id - c.conv_id % 5 AND o.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, o.pos, o.role, o.text FROM convs c JOIN original o ON o.conv_id = c.conv_id AND o.pos > c.h),
turn_rows AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth FROM taken),
prefixes AS (
  SELECT conv_id, depth, strlen(text) AS bytes,
    string_agg(sha256(strlen(role) || ':' || role || text), '' ORDER BY depth) OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS prefix
  FROM turn_rows UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
members AS (SELECT *, max(depth) OVER (PARTITION BY conv_id) AS last FROM prefixes),
nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    coalesce(string_agg(CASE WHEN depth = last THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '') AS ends
  FROM members GROUP BY prefix, depth),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, p.prefix AS above,
    (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND left(c.prefix, 64 * n.depth::INT) = n.prefix) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = left(n.prefix, 64 * (n.depth::INT - 1))),
below AS (
  SELECT m.prefix AS up, m.depth AS up_depth, l.n_children, (l.n_convs - 1) * l.bytes AS saved
  FROM linked l JOIN members m ON m.conv_id = l.conv_id AND m.depth <= l.depth)
SELECT conv_id, depth::INT AS depth, parent_conv_id, n_convs, l.n_children, b.n_leaves, b.saved_tokens, sha256(ends) AS ends_sha256
FROM linked l JOIN (
  SELECT up, up_depth, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM below GROUP BY up, up_depth) b
  ON b.up = l.prefix AND b.up_depth = l.depth
"""
