"""Benchmark decontamination by greedy string tiling.

Texts are lower-cased and cut into tokens (runs of letters, digits and other characters beyond
ASCII). The benchmark is the stated query set: it goes to the tasks in blocks of at most
BLOCK_TOKENS tokens, which bounds what is broadcast, and every document is read once a block. In a
task a document meets the items that share a seed with it, a run of SEED tokens (a shorter item: all
its tokens). Each such pair is tiled: the longest common runs of still unmarked tokens are found by
running Karp-Rabin, marked longest first without overlap, and sought again at smaller lengths down
to the seed's. The share of an item's tokens under tiles does not depend on their order, so
reordered passages count in full.

Edge cases: null and empty texts match nothing; items without a token match nothing; repeated items
and rows are each judged, with an id or without; an empty benchmark or table gives no pair; extra
columns are ignored; a pair of a document and an item is reported once per row of the document.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave.llm import tables as B
from colweave.llm import textops as T

SEED = 5
COVERAGE = 0.5
BLOCK_TOKENS = 1_000_000
_IS_TOKEN = np.zeros(256, bool)
_IS_TOKEN[0x80:] = True
_IS_TOKEN[ord("0") : ord("9") + 1] = True
_IS_TOKEN[ord("a") : ord("z") + 1] = True
PAIR = "doc_id long, item_id long, n_tokens long, covered long, n_tiles long, coverage double"


def tokens(column) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all rows, and where each row's tokens begin (one more than rows)."""
    data, offsets = T.texts(pc.utf8_lower(column))
    at, to = T.runs(_IS_TOKEN[data], offsets)
    return T.keys(data, at, to), T.per_row(at, offsets)


def run_hashes(sums: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of `length` tokens; `sums` as from `prefix_hashes`."""
    at = np.arange(max(len(sums) - length, 0))
    return T.span_hashes(sums, at, at + length)


def tile(text: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: tiles (place in text, place in item, length >= least), none of which
    overlap in either."""
    text_sums, item_sums = T.prefix_hashes(text), T.prefix_hashes(item)
    text_used, item_used = np.zeros(len(text), bool), np.zeros(len(item), bool)
    tiles: list[tuple[int, int, int]] = []
    length = len(item)
    while length >= least:
        found = _matches(text, item, text_sums, item_sums, text_used, item_used, length)
        for n, a, b in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
            if not text_used[a : a + n].any() and not item_used[b : b + n].any():
                text_used[a : a + n] = item_used[b : b + n] = True
                tiles.append((a, b, n))
        # what is left is shorter than `length`, or was cut by a tile: look again for its rest
        length = length // 2 if length >= 2 * least else (least if length > least else (least if _left(found, text_used, item_used, least) else 0))
    return tiles


def _left(found: list[tuple[int, int, int]], text_used: np.ndarray, item_used: np.ndarray, least: int) -> bool:
    """Whether a match that lost to a tile still has `least` free tokens in a row on both sides."""
    for n, a, b in found:
        free = ~(text_used[a : a + n] | item_used[b : b + n])
        if least <= n and (np.convolve(free, np.ones(least, int), "valid") == least).any():
            return True
    return False


def _matches(text, item, text_sums, item_sums, text_used, item_used, length: int) -> list[tuple[int, int, int]]:
    """Maximal common runs of unmarked tokens, of `length` or more."""
    here = run_hashes(item_sums, length)
    places = defaultdict(list)
    for b, h in enumerate(here.tolist()):
        if not item_used[b : b + length].any():
            places[h].append(b)
    runs_ = run_hashes(text_sums, length)
    hits = np.flatnonzero(np.isin(runs_, np.fromiter(places, np.uint64, len(places))))
    out, done = [], set()
    for a in hits.tolist():
        if text_used[a : a + length].any():
            continue
        for b in places[int(runs_[a])]:
            if (a - 1, b - 1) in done:  # inside a longer run that began before
                done.add((a, b))
                continue
            if not np.array_equal(text[a : a + length], item[b : b + length]):
                continue  # equal hashes of different runs
            n = length
            while a + n < len(text) and b + n < len(item) and text[a + n] == item[b + n] and not text_used[a + n] and not item_used[b + n]:
                n += 1
            done.add((a, b))
            out.append((n, a, b))
    return out


class Benchmark:
    """Items of one block with the index of their seeds."""

    def __init__(self, ids: list[int | None], hashes: np.ndarray, bounds: np.ndarray):
        self.items = [(i, hashes[a:b]) for i, a, b in zip(ids, bounds[:-1], bounds[1:], strict=True) if b > a]
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        pairs = defaultdict(list)
        for k, (_, item) in enumerate(self.items):
            n = min(SEED, len(item))
            found = np.unique(run_hashes(T.prefix_hashes(item), n))
            pairs[n].append((found, np.full(len(found), k)))
        for n, parts in pairs.items():
            keys, owners = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(keys, kind="stable")
            self.seeds[n] = (keys[order], owners[order])

    def candidates(self, hashes: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int]]:
        """Pairs (row, item) that share a seed."""
        out = set()
        sums = T.prefix_hashes(hashes)
        row = T.rows_of(bounds)
        for n, (keys, owners) in self.seeds.items():
            runs_ = run_hashes(sums, n)
            inside = np.flatnonzero(row[: len(runs_)] == row[n - 1 :]) if len(runs_) else np.zeros(0, int)
            place = np.minimum(np.searchsorted(keys, runs_[inside], "left"), len(keys) - 1)
            hit = keys[place] == runs_[inside]
            first, last = place[hit], np.searchsorted(keys, runs_[inside][hit], "right")
            for r, a, b in zip(row[inside][hit].tolist(), first.tolist(), last.tolist(), strict=True):
                out.update((r, int(k)) for k in owners[a:b])
        return sorted(out)


def item_blocks(items: DataFrame, most: int = BLOCK_TOKENS) -> list[DataFrame]:
    """The benchmark in parts of about `most` tokens at most, by hash of the item."""
    n = items.agg(F.sum(F.size(F.split(F.coalesce("text", F.lit("")), r"\s+")))).first()[0] or 0
    parts = 1 + int(n) // most
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k) for k in range(parts)]


def _sent(items: DataFrame) -> Iterator[Broadcast]:
    """The blocks of the benchmark, each sent to the tasks."""
    items = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    for part in item_blocks(items):
        found = part.orderBy("item_id", "text").collect()  # one block: bounded by BLOCK_TOKENS
        yield items.sparkSession.sparkContext.broadcast(Benchmark([r.item_id for r in found], *tokens(pa.array([r.text for r in found], pa.string()))))


def _found(bench: Benchmark, column, coverage: float) -> list[tuple[int, int | None, int, int, int, float]]:
    """Rows of a group with the items that they hold: row, item, its tokens, those covered, tiles, share."""
    hashes, bounds = tokens(column)
    rows = []
    for r, k in bench.candidates(hashes, bounds):
        item_id, item = bench.items[k]
        tiles = tile(hashes[bounds[r] : bounds[r + 1]], item, min(SEED, len(item)))
        covered = sum(t[2] for t in tiles)
        if covered >= coverage * len(item):
            rows.append((r, item_id, len(item), covered, len(tiles), covered / len(item)))
    return rows


def pairs(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Documents and benchmark items of whose tokens they hold a share of `coverage` or more."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = None
    for block in _sent(items):

        def work(group: pa.RecordBatch, block=block) -> pa.RecordBatch:
            ids = group.column("doc_id").to_pylist()
            rows = [(ids[r], *rest) for r, *rest in _found(block.value, group.column("text"), coverage)]
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [pa.int64()] * 5 + [pa.float64()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "item_id", "n_tokens", "covered", "n_tiles", "coverage"])

        one = B.over_groups(docs, work, PAIR)
        out = one if out is None else out.unionByName(one)
    return out


def clean(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Documents, with all their columns, that hold no benchmark item, whatever their id: each row is
    judged by its own text, where it is read."""
    places = {c: c if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.toDF(*places.values())
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    for block in _sent(items):

        def work(group: pa.RecordBatch, block=block) -> pa.RecordBatch:
            kept = np.ones(group.num_rows, bool)
            kept[[r for r, *_ in _found(block.value, group.column("text").cast(pa.string()), coverage)]] = False
            return group.filter(pa.array(kept))

        rows = B.over_groups(rows, work, schema)
    return rows.select([F.col(p).alias(c) for c, p in places.items()])


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(B.read(spark, sf_dir, "documents"), B.read(spark, sf_dir, "benchmark"))
