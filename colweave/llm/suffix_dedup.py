"""Removal of byte strings that occurred before, by blockwise suffix sorting with a difference cover.

Every LENGTH-byte prefix of a suffix is in the bucket of its least GRAM-byte hash (its minimizer), so
equal strings share a bucket, and the suffixes of one bucket that follow each other in a text form a
segment. Only what can repeat is sorted:

1. A segment whose whole bytes came before (its hash, in its bucket) is repeated throughout; only the
   first of each content goes on, and only where a bucket has several contents.
2. Those segments are brought together by bucket and sorted bucket by bucket, in blocks of bounded
   size. Suffixes are ordered by their first COVER and last COVER bytes; ties, equal in both, are
   resolved by ranks of the middle, computed beforehand for the positions in a difference cover
   modulo COVER only: of any two suffixes some offset below COVER has both in the cover, so they are
   equal if and only if they agree in rank at such an offset. All of these are orders of the bytes
   themselves, read as big-endian words. The first in (doc_id, place) of equal suffixes stays, the
   others are repeats.
3. A bucket of more than HOT contents (a passage in very many documents, cut by different
   surroundings) is not sorted in one task: its suffixes are spread by the hash of their LENGTH bytes,
   where equal ones meet again.

Equal contents within a task's group of texts are settled before any shuffle, so a string that fills
the table sends a row per few MB of text. Bytes under a repeat are removed from each document.

Edge cases: a null text is empty; texts shorter than LENGTH keep every byte; matches never cross
documents; rows that share an id are separate documents, ordered by the SHA-256 of their texts, so of
repeated rows one stays whole; rows without id come after all others, ordered in the same way; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave.llm import tables as B
from colweave.llm import textops as T
from colweave.session import cut_lineage

LENGTH = 100
GRAM = 32
COVER = 31
#: A perfect difference set modulo 31: every residue is a difference of two of these.
COVER_SET = np.array([1, 5, 11, 24, 25, 27])
#: Contents of one bucket that are sorted in one task, and bytes of a sorted block.
HOT = 2000
BLOCK_BYTES = 2 << 20
#: Bytes handled at a time within one very long text.
PIECE = 4 << 20
#: Places are packed with the number of suffixes of their segment, which is below this.
_PACK = 128
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Segments of all rows: bucket, hash of their bytes, row, place in the row, suffixes."""
    parts = []
    for a, b, row, place in _pieces(offsets):
        inner = offsets[(offsets >= a) & (offsets <= b)] if b - a > PIECE + LENGTH or row is None else np.array([a, b])
        parts.append(_segments(data[a:b], inner - a, row, place))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else tuple(np.zeros(0, k) for k in (np.uint64, np.uint64, np.int64, np.int64, np.int64))


def _pieces(offsets: np.ndarray) -> Iterator[tuple[int, int, int | None, int]]:
    """The whole group, or of a single longer text overlapping pieces whose suffixes do not."""
    if offsets[-1] <= PIECE + LENGTH:
        yield 0, int(offsets[-1]), None, 0
        return
    for row in range(len(offsets) - 1):
        for a in range(int(offsets[row]), int(offsets[row + 1]), PIECE):
            yield a, min(a + PIECE + LENGTH - 1, int(offsets[row + 1])), row, a - int(offsets[row])


def _segments(data: np.ndarray, offsets: np.ndarray, only: int | None, place: int) -> tuple[np.ndarray, ...]:
    n = len(data) - LENGTH + 1
    if n <= 0:
        return tuple(np.zeros(0, k) for k in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    sums = T.prefix_hashes(T.BYTE_CODES[data])
    at = np.arange(len(data) - GRAM + 1)
    grams = T.span_hashes(sums, at, at + GRAM)
    least = (grams >> np.uint64(24) << np.uint64(24)) | at.astype(np.uint64)  # the leftmost of equal ones
    width, span = LENGTH - GRAM + 1, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    where = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
    row = np.searchsorted(offsets, np.arange(n), "right") - 1 if len(offsets) > 2 else np.zeros(n, np.int64)
    valid = np.arange(n) + LENGTH <= offsets[row + 1]
    begin = np.ones(n, bool)
    begin[1:] = (where[1:] != where[:-1]) | (row[1:] != row[:-1])
    start = np.flatnonzero(begin & valid)
    size = np.diff(np.append(np.flatnonzero(begin | ~valid), n))[np.searchsorted(np.flatnonzero(begin | ~valid), start)]
    content = T.span_hashes(sums, start, start + size + LENGTH - 1)
    owner = row[start]
    return grams[where[start]], content, owner if only is None else np.full(len(start), only), start - offsets[owner] + place, size


def _first(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by the keys, and which in that order differ from the one before in all but the last two."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys[:-2]])
    return order, new


def _runs(doc: np.ndarray, place: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Repeated suffixes as byte runs (doc, start, end), neighbours joined."""
    order = np.lexsort((place, doc))
    doc, start, end = doc[order], place[order], place[order] + size[order] + LENGTH - 1
    reach = end.copy()
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > end[:-1])
    cut = np.flatnonzero(new)
    if not len(cut):
        return doc, start, end
    reach = np.maximum.reduceat(end, cut)
    return doc[cut], start[cut], reach


ROWS = "bucket long, content long, doc_id long, place long"


def _scan(group: pa.RecordBatch) -> pa.RecordBatch:
    """First segments of each content, and repeats within the group as runs (content null, place the
    start, bucket minus the end)."""
    bucket, content, row, place, size = segments(*T.texts(group.column("text")))
    doc = group.column("doc_id").to_numpy()[row] if len(row) else row
    order, new = _first(bucket, content, doc, place)
    first, again = order[new], order[~new]
    d, s, e = _runs(doc[again], place[again], size[again])
    return pa.record_batch({
        "bucket": pa.array(np.concatenate([bucket[first].view(np.int64), e])),
        "content": pa.array(np.concatenate([content[first].view(np.int64), s]), mask=np.arange(len(first) + len(s)) >= len(first)),
        "doc_id": pa.array(np.concatenate([doc[first], d])),
        "place": pa.array(np.concatenate([place[first] * _PACK + size[first], s])),
    })


SETTLED = "kind string, bucket long, doc_id long, place long, size long"


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket, content, doc_id, place. Repeats go out as runs, first contents of
    buckets with several as segments to sort."""
    last_bucket = last_content = held = None
    for batch in batches:
        known = batch.column("content").is_valid().to_numpy(zero_copy_only=False)
        done = batch.filter(pa.array(~known))
        if done.num_rows:
            start = done.column("place").to_numpy()
            yield _settled("run", np.zeros(len(start), np.int64), done.column("doc_id").to_numpy(), start, done.column("bucket").to_numpy() - start)
        batch = batch.filter(pa.array(known))
        if not batch.num_rows:
            continue
        bucket, content, doc, packed = (batch.column(c).to_numpy() for c in ("bucket", "content", "doc_id", "place"))
        place, size = packed // _PACK, packed % _PACK
        new_bucket = np.append(last_bucket is None or bucket[0] != last_bucket, bucket[1:] != bucket[:-1])
        new_content = new_bucket | np.append(last_content is None or content[0] != last_content, content[1:] != content[:-1])
        d, s, e = _runs(doc[~new_content], place[~new_content], size[~new_content])
        yield _settled("run", np.zeros(len(s), np.int64), d, s, e - s)
        # of the contents that begin here, those not alone in their bucket; the one held from before waits for a second
        at = np.flatnonzero(new_content)
        if len(at):
            opens = new_bucket[at]
            followed = np.append(~opens[1:], False)
            out = at[~opens | followed]
            if held is not None and not opens[0]:
                yield _settled("sort", *held)
            held = None
            yield _settled("sort", bucket[out], doc[out], place[out], size[out])
            if opens[-1]:
                k = at[-1:]
                held = bucket[k], doc[k], place[k], size[k]
        last_bucket, last_content = bucket[-1], content[-1]


def _settled(kind: str, bucket, doc, place, size) -> pa.RecordBatch:
    return pa.record_batch({"kind": pa.array([kind] * len(doc), pa.string()), "bucket": pa.array(bucket), "doc_id": pa.array(doc), "place": pa.array(place), "size": pa.array(size)})


def byte_words(text: np.ndarray, begin: np.ndarray, n: int) -> list[np.ndarray]:
    """The n bytes from each place as numbers that order like the bytes, eight bytes each."""
    windows = np.lib.stride_tricks.sliding_window_view(np.append(text, np.zeros(8, np.uint8)), 8)
    out = []
    for at in range(0, n, 8):
        word = windows[begin + at].view(">u8")[:, 0].astype(np.uint64)
        out.append(word >> np.uint64(8 * max(at + 8 - n, 0)))
    return out


def ranks(*keys: np.ndarray) -> np.ndarray:
    """Places in the order by the keys, from 0; equal ones share a place."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def repeated(text: np.ndarray, begin: np.ndarray, bucket: np.ndarray, place: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which suffixes of a block repeat an earlier one of their bucket in LENGTH bytes.

    begin: where a suffix begins in `text`; place: its place in its document, which gives its residue
    modulo COVER; rank: its order by (doc_id, place)."""
    middle = LENGTH - COVER
    group = ranks(bucket, *byte_words(text, begin, COVER), *byte_words(text, begin + middle, COVER))
    count = np.bincount(group)
    out = np.zeros(len(begin), bool)
    tie = np.flatnonzero(count[group] > 1)
    if not len(tie):
        return out
    begin, group, residue, rank = begin[tie], group[tie], place[tie] % COVER, rank[tie]
    # ranks of the middles at the positions of the cover that a tied suffix reaches
    offset = (COVER_SET - residue[:, None]) % COVER
    spot = begin[:, None] + offset
    distinct, where = np.unique(spot, return_inverse=True)
    middles = ranks(*byte_words(text, distinct, middle))
    key = (group[:, None] * len(distinct) + middles[where.reshape(spot.shape)]) * COVER + offset
    _, same = np.unique(key, return_inverse=True)
    same = same.reshape(spot.shape)
    first = np.full(same.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(first, same, rank[:, None])
    least = first[same].min(1)
    out[tie] = least < rank
    return out


RUN, NAMED, SORTED = 0, 1, 2
CUT = "kind int, bucket long, doc_id long, place long, size long, bytes binary"


def _cut(group: pa.RecordBatch) -> pa.RecordBatch:
    """The bytes of a document's segments that are to be sorted (`asked`: bucket, place, size, hot).
    Suffixes of hot buckets go singly, named by the hash of their LENGTH bytes; of equal ones in the
    group the first goes and the others are repeats."""
    data, offsets = T.texts(group.column("text"))
    asked = group.column("asked")
    rows = np.repeat(np.arange(group.num_rows), np.diff(asked.offsets.to_numpy()))
    asked = pa.RecordBatch.from_struct_array(asked.flatten())
    bucket, place, size = (asked.column(c).to_numpy() for c in ("bucket", "place", "size"))
    hot = asked.column("hot").to_numpy(zero_copy_only=False)
    doc = group.column("doc_id").to_numpy()[rows]
    begin = offsets[:-1][rows] + place
    raw = data.tobytes()
    whole = [raw[b : b + n + LENGTH - 1] for b, n in zip(begin[~hot].tolist(), size[~hot].tolist(), strict=True)]
    # suffixes of hot buckets
    seg = np.repeat(np.flatnonzero(hot), size[hot])
    within = np.arange(len(seg)) - np.repeat(np.cumsum(size[hot]) - size[hot], size[hot])
    name = T.span_hashes(T.prefix_hashes(T.BYTE_CODES[data]), begin[seg] + within, begin[seg] + within + LENGTH) if len(seg) else np.zeros(0, np.uint64)
    at, owner = place[seg] + within, doc[seg]
    order, new = _first(name, owner, at)
    one, again = order[new], order[~new]
    d, s, e = _runs(owner[again], at[again], np.ones(len(again), np.int64))
    kind = np.repeat([SORTED, NAMED, RUN], [len(whole), len(one), len(d)]).astype(np.int32)
    join = lambda *x: pa.array(np.concatenate(x))
    return pa.record_batch({
        "kind": pa.array(kind), "bucket": join(bucket[~hot], name[one].view(np.int64), T.mix((d * 31 + s).view(np.uint64)).view(np.int64)), "doc_id": join(doc[~hot], owner[one], d),
        "place": join(place[~hot], at[one], s), "size": join(size[~hot], np.ones(len(one), np.int64), e - s), "bytes": pa.array(whole + [None] * (len(one) + len(d)), pa.binary()),
    })


def _sort_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of CUT sorted by kind, bucket, doc_id, place: repeats as runs. Segments are sorted in
    blocks of whole buckets."""
    held: list[pa.RecordBatch] = []
    last_name = None

    def block(table: pa.Table) -> pa.RecordBatch:
        data, offsets = T.texts(table.column("bytes"))
        size = table.column("size").to_numpy()
        seg = np.repeat(np.arange(len(size)), size)
        within = np.arange(len(seg)) - np.repeat(np.cumsum(size) - size, size)
        doc, bucket = table.column("doc_id").to_numpy()[seg], table.column("bucket").to_numpy()[seg]
        place = table.column("place").to_numpy()[seg] + within
        rank = np.empty(len(seg), np.int64)
        rank[np.lexsort((place, doc))] = np.arange(len(seg))
        hit = repeated(data, offsets[:-1][seg] + within, bucket, place, rank)
        return runs(doc[hit], place[hit], np.ones(hit.sum(), np.int64))

    def runs(doc, place, size) -> pa.RecordBatch:
        d, s, e = _runs(doc, place, size)
        return pa.record_batch({"doc_id": pa.array(d), "place": pa.array(s), "size": pa.array(e - s)})

    for batch in batches:
        kind = batch.column("kind").to_numpy()
        done, named, batch = (batch.filter(pa.array(kind == k)) for k in (RUN, NAMED, SORTED))
        if done.num_rows:
            yield done.select(["doc_id", "place", "size"])
        if named.num_rows:
            name = named.column("bucket").to_numpy()
            later = np.append(last_name is not None and name[0] == last_name, name[1:] == name[:-1])
            last_name = name[-1]
            yield runs(named.column("doc_id").to_numpy()[later], named.column("place").to_numpy()[later], np.ones(later.sum(), np.int64))
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            bucket = part.column("bucket").to_numpy()
            if sum(h.nbytes for h in held) > BLOCK_BYTES:
                # a bucket ends where the next begins: the first change after what is held
                tail = held[-1].column("bucket")[held[-1].num_rows - 1].as_py()
                change = np.flatnonzero(bucket != tail)
                if len(change):
                    yield block(pa.Table.from_batches([*held, part.slice(0, int(change[0]))]))
                    held, part = [], part.slice(int(change[0]))
            held.append(part)
    if held:
        yield block(pa.Table.from_batches(held))


def _removed(group: pa.RecordBatch) -> pa.RecordBatch:
    """Lengths, removed bytes and checksum of what stays, from a document's repeated runs."""
    data, offsets = T.texts(group.column("text"))
    raw = data.tobytes()
    out = []
    for row, found in enumerate(group.column("runs").to_pylist()):
        text = raw[offsets[row] : offsets[row + 1]]
        kept, spans, at, gone = hashlib.sha256(), 0, 0, 0
        reach = -1
        for run in sorted((r["place"], r["place"] + r["size"]) for r in found or ()):
            if run[0] > reach:
                spans += 1
                kept.update(text[max(at, 0) : run[0]])
                gone += run[1] - run[0]
                reach = run[1]
            elif run[1] > reach:
                gone += run[1] - reach
                reach = run[1]
            at = reach
        kept.update(text[at:])
        out.append((len(text), gone, spans, kept.hexdigest()))
    columns = list(zip(*out, strict=True)) or [[]] * 4
    return pa.record_batch({"doc_id": group.column("own_id"), **{n: pa.array(c, t) for n, c, t in zip(("n_bytes", "n_removed", "n_spans", "kept_sha256"), columns, [pa.int64()] * 3 + [pa.string()], strict=True)}})


def repeats(docs: DataFrame) -> DataFrame:
    """Byte runs (doc_id, place, size) covered by LENGTH bytes that occurred before; runs may overlap.
    Ids must be unique and not null."""
    rows = B.over_groups(docs, _scan, ROWS)
    key = F.when(F.col("content").isNull(), F.xxhash64("doc_id", "place")).otherwise(F.col("bucket"))
    spread = rows.withColumn("part", key).repartition("part").sortWithinPartitions("part", "content", "doc_id", "place").drop("part")
    settled = cut_lineage(spread.mapInArrow(_settle, SETTLED))
    asked = settled.where("kind = 'sort'")
    hot = cut_lineage(asked.groupBy("bucket").count().where(F.col("count") > HOT).select("bucket", F.lit(True).alias("is_hot")))
    asked = asked.join(hot, "bucket", "left").select("doc_id", F.struct("bucket", "place", "size", F.coalesce("is_hot", F.lit(False)).alias("hot")).alias("one"))
    asked = asked.groupBy("doc_id").agg(F.collect_list("one").alias("asked"))
    cut = B.over_groups(docs.join(asked, "doc_id"), _cut, CUT)
    found = cut.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket", "doc_id", "place").mapInArrow(_sort_blocks, "doc_id long, place long, size long")
    return settled.where("kind = 'run'").select("doc_id", "place", "size").unionByName(found)


def in_order(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text) with the id as `own_id` and in `doc_id` a number of each row that orders them:
    the id itself if every row has its own, else numbers given along one sort of the table."""
    shared = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    if shared.isEmpty():
        return docs.select("doc_id", F.col("doc_id").alias("own_id"), "text")
    # the last key tells only rows apart that are alike, so that a large group of them is spread
    keyed = docs.withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256)).withColumn("tie", F.monotonically_increasing_id())
    ordered = keyed.orderBy(F.col("doc_id").asc_nulls_last(), "digest", "tie")
    return cut_lineage(ordered.select(F.monotonically_increasing_id().alias("doc_id"), F.col("doc_id").alias("own_id"), "text"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Every document's size, removed bytes and runs, and the SHA-256 of what stays."""
    docs = in_order(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    runs = repeats(docs).groupBy("doc_id").agg(F.collect_list(F.struct("place", "size")).alias("runs"))
    return B.over_groups(docs.join(runs, "doc_id", "left"), _removed, RESULT)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(B.read(spark, sf_dir, "documents"))
