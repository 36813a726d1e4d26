"""Exact join of similar sets between the members of different classes.

Rows are (doc_id, home, class_id, keys): a set as bytes of its distinct 64-bit hashes, and the class
it is known to be in. Found are links between classes: for every two classes with a pair of sets of
Jaccard similarity `least` or more, such links that the two end in one component. No pair that may
count is left out, whatever the size of a group.

Similar sets share a key in their prefixes, the len - ceil(least * len) + 1 rarest keys of each. Any
one order of the keys makes this true, so rarity is counted by BINS bins of the hash, which is a
table of fixed size. Rows are put into blocks by home; a class larger than a block has blocks of its
own. Two blocks meet in a task only if a prefix key is in both, with different classes; so a group
that is one class already costs nothing, and neither do texts that share frequent keys alone. A task
holds two blocks, counts common keys by matrix products and returns a spanning forest of classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave.llm import textops as T
from colweave.session import cut_lineage

#: Rows and bytes of keys that a block holds, about.
BLOCK, BLOCK_BYTES = 512, 4 << 20
BINS, PARTS = 1 << 18, 256
#: Blocks of one key that are looked at together, about; a key with more is split.
LIST = 256
#: Keys that one matrix product counts.
CHUNK = 4096


def _keys(column) -> tuple[np.ndarray, np.ndarray]:
    """All keys and where each row's begin (one more than rows)."""
    data, offsets = T.texts(column)
    return np.frombuffer(data.tobytes(), np.uint64), offsets // 8


def _bins(keys: np.ndarray) -> np.ndarray:
    return (keys % np.uint64(BINS)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BINS, np.int64)
    for batch in batches:
        for group in T.groups(batch, "keys"):
            counts += np.bincount(_bins(_keys(group.column("keys"))[0]), minlength=BINS)
    parts = [(i, p.tobytes()) for i, p in enumerate(counts.reshape(PARTS, -1)) if p.any()]
    yield pa.record_batch({"part": pa.array([i for i, _ in parts], pa.int32()), "counts": pa.array([c for _, c in parts], pa.binary())})


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c, np.int64) for c in table.column("counts").to_pylist())
    return pa.table({"part": table.column("part").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})


def frequencies(rows: DataFrame) -> np.ndarray:
    """How many keys of all rows fall into each bin."""
    schema = "part int, counts binary"
    out = np.zeros((PARTS, BINS // PARTS), np.int64)
    for r in rows.select("keys").mapInArrow(_count, schema).groupBy("part").applyInArrow(_add, schema).collect():  # at most PARTS rows
        out[r.part] = np.frombuffer(r.counts, np.int64)
    return out.ravel()


def prefixes(keys: np.ndarray, bounds: np.ndarray, often: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The prefix keys of all rows that may be in another row too, and their rows."""
    row, count = T.rows_of(bounds), often[_bins(keys)]
    order = np.lexsort((keys, count, row))
    size = np.diff(bounds)
    most = size - np.ceil(least * size - 1e-9).astype(np.int64) + 1
    in_row = np.arange(len(keys)) - np.repeat(bounds[:-1], size)
    order = order[(in_row < most[row]) & (count[order] > 1)]
    return keys[order], row[order]


def blocks(rows: DataFrame) -> DataFrame:
    """Rows with their block."""
    sizes = rows.groupBy("home", "class_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("keys")).alias("bytes"))
    own = (F.col("n") > BLOCK) | (F.col("bytes") > BLOCK_BYTES)
    sizes = cut_lineage(sizes.withColumn("pile", F.when(own, F.xxhash64("home", "class_id")).otherwise(F.xxhash64("home"))))
    parts = sizes.groupBy("pile").agg(F.ceil(F.sum("n") / BLOCK + F.sum("bytes") / BLOCK_BYTES).alias("parts"))
    piles = sizes.join(parts, "pile").select("home", "class_id", "pile", "parts")
    block = F.xxhash64("pile", F.pmod(F.xxhash64("doc_id"), F.col("parts")))
    return cut_lineage(rows.join(piles, ["home", "class_id"]).select(block.alias("block"), "doc_id", "class_id", "keys"))


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of blocks (a <= b) of each list whose classes differ, the one from `left` and the other from `right`."""
    held = np.zeros((0, 2), np.int64)
    new: list[np.ndarray] = []
    count = 0

    def record(pairs: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    for batch in batches:
        lists = batch.column("members")
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        own, block, lo, hi = (lists.flatten().field(c).to_numpy() for c in ("own", "block", "lo", "hi"))
        sides = zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True)
        for at, end, (left, right) in zip(ends[:-1], ends[1:], sides, strict=True):
            if left == right:
                a, b = np.triu_indices(end - at)
            else:
                x, y = np.flatnonzero(own[at:end] == left), np.flatnonzero(own[at:end] == right)
                a, b = np.repeat(x, len(y)), np.tile(y, len(x))
            a, b = a + at, b + at
            apart = np.where(a == b, lo[a] != hi[a], (lo[a] != hi[a]) | (lo[b] != hi[b]) | (lo[a] != lo[b]))
            a, b = block[a[apart]], block[b[apart]]
            new.append(np.stack([np.minimum(a, b), np.maximum(a, b)], 1))
            count += len(a)
            if count > 1 << 20:
                held, new, count = np.unique(np.concatenate([held, *new]), axis=0), [], 0
                if len(held) > 1 << 20:
                    yield record(held)
                    held = held[:0]
    yield record(np.unique(np.concatenate([held, *new]), axis=0))


def meetings(entries: DataFrame) -> DataFrame:
    """Distinct pairs of blocks (a <= b) that have a key in common and classes that differ, of entries
    (key, block, lo, hi) with the least and greatest class that has the key in the block.

    The blocks of a key are split by hash into parts of about `LIST`, and every two parts meet in a
    list of their own, so no list grows with the number of blocks that share a key.
    """
    sizes = entries.groupBy("key").agg(F.count("*").alias("n"), F.min("lo").alias("first"), F.max("hi").alias("last")).where("first != last")
    parted = entries.join(sizes.select("key", F.ceil(F.col("n") / LIST).cast("int").alias("parts")), "key")
    own = F.pmod(F.xxhash64("block"), F.col("parts")).cast("int")
    sent = parted.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    sent = sent.select("key", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), F.struct("own", "block", "lo", "hi").alias("member"))
    lists = sent.repartition("key", "left", "right").groupBy("key", "left", "right").agg(F.collect_list("member").alias("members"))
    return lists.select("left", "right", "members").mapInArrow(_meet, "a long, b long").distinct()


def common_keys(keys: np.ndarray, bounds: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many keys each of the rows `left` has in common with each of the rows `right`."""
    row = T.rows_of(bounds)
    order = np.argsort(keys, kind="stable")
    keys, row = keys[order], row[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    begin = np.flatnonzero(new)
    several = np.repeat(np.diff(np.append(begin, len(keys))) > 1, np.diff(np.append(begin, len(keys))))
    row, number = row[several], np.cumsum(new[several]) - 1
    kind = np.float32 if len(keys) < 1 << 24 else np.float64  # sums stay exact
    out = np.zeros((len(left), len(right)), kind)
    cuts = np.searchsorted(number, np.arange(0, (number[-1] if len(number) else -1) + 1 + CHUNK, CHUNK))
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        has = np.zeros((len(bounds) - 1, CHUNK), kind)
        has[row[a:b], number[a:b] - k * CHUNK] = 1
        out += has[left] @ has[right].T
    return out


def forest(pairs: np.ndarray) -> list[tuple[int, int]]:
    """The pairs without those that the ones before have connected."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = parent[x]
        return x

    out = []
    for a, b in pairs.tolist():
        x, y = root(a), root(b)
        if x != y:
            parent[x] = y
            out.append((a, b))
    return out


def between_classes(rows: DataFrame, least: float) -> DataFrame:
    """Links (a, b) of class ids."""
    rows = blocks(rows)
    sent = rows.sparkSession.sparkContext.broadcast(frequencies(rows))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in T.groups(batch, "keys"):
                found, row = prefixes(*_keys(group.column("keys")), sent.value, least)
                yield pa.record_batch({"key": pa.array(found.view(np.int64)), "block": group.column("block").take(pa.array(row)), "class_id": group.column("class_id").take(pa.array(row))})

    def join(table: pa.Table) -> pa.Table:
        block, kind = (table.column(c).to_numpy() for c in ("block", "class_id"))
        keys, bounds = _keys(table.column("keys"))
        left, right = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
        size = np.diff(bounds)
        common = common_keys(keys, bounds, left, right).astype(np.float64)
        i, j = np.nonzero((kind[left][:, None] != kind[right]) & (common / (size[left][:, None] + size[right] - common) >= least))
        a, b = kind[left][i], kind[right][j]
        found = forest(np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0))
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})

    posted = rows.select("block", "class_id", "keys").mapInArrow(post, "key long, block long, class_id long")
    entries = posted.groupBy("key", "block").agg(F.min("class_id").alias("lo"), F.max("class_id").alias("hi"))
    jobs = cut_lineage(meetings(entries)).select(F.xxhash64("a", "b").alias("job"), F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))
    return rows.join(jobs, "block").groupBy("job").applyInArrow(join, "a long, b long").distinct()
