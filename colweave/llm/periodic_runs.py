"""Periodic runs: stretches of words that repeat with a period, found by dyadic square catchers.

A catcher belongs to a completed block of 2**j words, aligned in its text. It waits for squares of a
period p in [2 * 2**j, 4 * 2**j) whose first half holds the block (p from 1 on for single words; any
first half of such a length holds an aligned block whole): when later words complete the block's
content again p words on, it begins a comparison of the two places, which further words advance, and
which the words before extend backwards, until they differ. If p words or more agree, it has caught
squares, and all squares of one period and stretch merge into one run, the stretch that no word can
extend. A run found with several periods has the smallest.

A catcher depends on nothing but its block and the words after it, so the catchers of one size, over
all texts of a group, are worked at the same time: their contents get names (equal blocks of a text
have equal names, told apart by the names of their halves, never by a hash), waiting is a search in
the sorted places of a name, and a comparison advances by whole named blocks, the largest first. Names
that a text has once are dropped on the way, so prose without repeats costs a few sorts. A group is
about 1 MB of text or one longer text; its memory is some 4 bytes a word for each block size.

Edge cases: null, empty and blank texts have no words and no runs; null ids stay null; repeated rows
are each judged; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave.llm import tables as B
from colweave.llm import textops as T

#: A run counts from this length on, and from this many periods on.
LEAST_LENGTH, LEAST_PERIODS = 6, 4
#: Comparisons that are advanced together, at most, but those of one catcher.
BATCH = 1 << 20
RESULT = (
    "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)
#: For every word which word of its group stands there, from ids, counts and begins of the rows.
Order = Callable[[list, np.ndarray], np.ndarray]


class Names:
    """Names of the blocks of 1, 2, 4 ... words that a text holds twice or more; -1 for others."""

    def __init__(self, words: np.ndarray, rows: np.ndarray):
        self.n = len(words)
        self.levels: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        at = np.arange(self.n)
        kinds = int(words.max()) + 1 if self.n else 1
        key = rows.astype(np.int64) * kinds + words
        while len(at):
            at = self._add(at, key)
            size = 1 << (len(self.levels) - 1)
            now = self.levels[-1]
            at = at[at + size < self.n]
            at = at[now[at + size] >= 0]
            key = now[at].astype(np.int64) * (self.n + 1) + now[at + size]

    def _add(self, at: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Names the blocks at the ascending places `at` by their keys; the named places, ascending.

        `places` has name * n + place of all named blocks, ascending."""
        order = np.argsort(key, kind="stable")
        key, sorted_at = key[order], at[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        name = np.cumsum(new) - 1
        several = np.bincount(name)[name] > 1
        name, sorted_at = name[several], sorted_at[several]
        level = np.full(self.n + 1, -1, np.int32)
        level[sorted_at] = name
        self.levels.append(level)
        self.places.append(name.astype(np.int64) * self.n + sorted_at)
        return np.sort(sorted_at)

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a and from b > a on, of one text, agree."""
        n = np.zeros(len(a), np.int64)
        for j in reversed(range(len(self.levels))):
            level, size, live = self.levels[j], 1 << j, np.arange(len(a))
            while len(live):
                name = level[a[live] + n[live]]
                live = live[(name >= 0) & (name == level[b[live] + n[live]])]
                n[live] += size
                live = live if j == len(self.levels) - 1 else live[:0]
        return n

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a and before b > a, of one text, agree."""
        n = np.zeros(len(a), np.int64)
        for j in reversed(range(len(self.levels))):
            level, size, live = self.levels[j], 1 << j, np.arange(len(a))
            while len(live):
                live = live[a[live] - n[live] >= size]
                name = level[a[live] - n[live] - size]
                live = live[(name >= 0) & (name == level[b[live] - n[live] - size])]
                n[live] += size
                live = live if j == len(self.levels) - 1 else live[:0]
        return n


def waiting(names: Names, j: int, begins: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For the catchers of size 2**j: the places of blocks and of the same content p words on."""
    size = 1 << j
    least, most = (1 if j == 0 else 2 * size), 4 * size
    at = np.flatnonzero(names.levels[j][:-1] >= 0)
    at = at[(at - begins[at]) % size == 0]
    base = names.levels[j][at].astype(np.int64) * names.n
    # beyond the last place no name goes on: the end of one name's places is the next name's begin
    first = np.searchsorted(names.places[j], base + np.minimum(at + least, names.n), "left")
    last = np.searchsorted(names.places[j], base + np.minimum(at + most, names.n), "left")
    met = np.flatnonzero(last > first)
    at, first, many = at[met], first[met], (last - first)[met]
    ends = np.cumsum(many)
    begin = 0
    while begin < len(at):
        to = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + BATCH, "right")))
        count = many[begin:to]
        place = np.repeat(first[begin:to], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        yield np.repeat(at[begin:to], count), names.places[j][place] % names.n
        begin = to


def runs(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs of two periods or more of all texts: start, end and smallest period, by start and
    then period. `words` are numbers, `bounds` where each text begins (one more than texts)."""
    rows = T.rows_of(bounds)
    names = Names(words, rows)
    begins = bounds[:-1][rows]
    caught = [np.zeros((0, 3), np.int64)]
    for j in range(len(names.levels)):
        for a, b in waiting(names, j, begins):
            after, before = names.forward(a, b), names.backward(a, b)
            square = after + before >= b - a
            found = np.stack([a - before, b + after, b - a], 1)[square]
            caught.append(np.unique(found, axis=0))
    found = np.unique(np.concatenate(caught), axis=0)
    # rows come sorted by stretch and then period: the first of a stretch has its smallest period
    first = np.ones(len(found), bool)
    first[1:] = (found[1:, :2] != found[:-1, :2]).any(1)
    found = found[first]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    return found[:, 0], found[:, 1], found[:, 2]


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans one after the other, a blank after each, and where each begins (one more than spans)."""
    size = ends - starts
    at = np.concatenate([[0], np.cumsum(size + 1)])
    out = np.full(at[-1], 0x20, np.uint8)
    shift = np.cumsum(size) - size
    within = np.arange(size.sum()) - np.repeat(shift, size)
    out[np.repeat(at[:-1], size) + within] = data[np.repeat(starts, size) + within]
    return out, at


def describe(group: pa.RecordBatch, order: Order | None = None) -> pa.RecordBatch:
    """Runs of every row of a group, and the digests of its runs and of what is left of its words."""
    data, offsets = T.texts(group.column("text"))
    starts, ends = T.words(data, offsets)
    bounds = T.per_row(starts, offsets)
    number = T.numbered(data, starts, ends)
    ids = group.column("doc_id").to_pylist()
    if order is not None:
        stands = order(ids, bounds)
        starts, ends, number = starts[stands], ends[stands], number[stands]
    begin, end, period = runs(number, bounds)
    counts = (end - begin >= LEAST_LENGTH) & (end - begin >= LEAST_PERIODS * period)
    begin, end, period = begin[counts], end[counts], period[counts]
    # words after the first period of some run
    depth = np.zeros(len(number) + 1, np.int64)
    np.add.at(depth, begin + period, 1)
    np.add.at(depth, end, -1)
    kept = np.cumsum(depth)[:-1] == 0
    text, at = joined(data, starts[kept], ends[kept])
    kept_bounds = np.concatenate([[0], np.cumsum(kept)])[bounds]
    raw = text.tobytes()
    cuts = at[kept_bounds]
    run_bounds = np.searchsorted(begin, bounds, "left")
    out: dict[str, list] = {name.split()[0]: [] for name in RESULT.split(", ")}
    for r, doc_id in enumerate(ids):
        mine = slice(run_bounds[r], run_bounds[r + 1])
        s, n, p = begin[mine] - bounds[r], (end - begin)[mine], period[mine]
        best = min(range(len(s)), key=lambda k: (-n[k], s[k], p[k])) if len(s) else None
        listed = "".join(f"{a},{b},{c}\n" for a, b, c in zip(s.tolist(), n.tolist(), p.tolist(), strict=True))
        values = [None] * 4 if best is None else [int(s[best]), int(n[best]), int(p[best]), int(1000 * n[best] // p[best])]
        left = raw[cuts[r] : max(cuts[r + 1] - 1, cuts[r])]
        row = [doc_id, int(bounds[r + 1] - bounds[r]), len(s), *values, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest()]
        for name, value in zip(out, row, strict=True):
            out[name].append(value)
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    return pa.record_batch([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))


def detect(docs: DataFrame, order: Order | None = None) -> DataFrame:
    """One row for each row of docs (doc_id, text): its runs of LEAST_LENGTH words and LEAST_PERIODS
    periods or more, the longest of them, and digests of all and of the words without repeats."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return B.over_groups(docs, lambda group: describe(group, order), RESULT)


def with_planted_periods(ids: list, bounds: np.ndarray) -> np.ndarray:
    """The contract's texts: of every tenth document by crc32 of its id, the words from some place on
    repeat with a period. A null id counts as empty text."""
    stands = np.arange(bounds[-1])
    for r, doc_id in enumerate(ids):
        h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), int(bounds[r + 1] - bounds[r])
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            stands[bounds[r] + a : bounds[r + 1]] = bounds[r] + a + np.arange(n - a) % p
    return stands


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(B.read(spark, sf_dir, "documents"), with_planted_periods)
