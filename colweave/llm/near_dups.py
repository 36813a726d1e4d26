"""MinHash near-duplicates: ProbMinHash signatures of word shingles, banding, verification.

A document is the set of its 5-word shingles (lower-cased, split at white space; a shorter text is
one shingle). Each shingle of weight w sends a Poisson process of rate w into the signature's
registers and stops as soon as its next arrival is later than every register's earliest, so two
signatures agree in a register with the probability Jaccard similarity of the weighted sets. All
shingles weigh the same here: then that is the Jaccard similarity of the sets, by which pairs are
verified, and how often a text repeats a passage does not matter to either.

Candidates come from bands of 4 registers. In a bucket of at most BUCKET members all pairs are
compared by signature, and those with an estimate of HOPELESS or more are verified on the whole texts:
Jaccard similarity of the shingle sets of SIMILARITY or more. Members of larger buckets are joined
exactly (`set_join`), without estimates: each is first verified against one leading member, which
gives classes to begin with, and then all pairs of different classes that can be similar are compared
on their sets. Classes are the connected components of the links together with equal sets, by star
contraction.

Edge cases: null, empty and blank texts have no shingle and form one class; documents without id are
left out of the result (`first_of_class` judges them by their text); an id that comes several times is one document, its texts' classes joined;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave.llm import set_join
from colweave.llm import tables as B
from colweave.llm import textops as T
from colweave.session import cut_lineage

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4
REGISTERS = BANDS * ROWS
#: Up to how many members a bucket's pairs are listed one by one; estimates below HOPELESS (2.5
#: standard deviations under SIMILARITY) are no candidates.
BUCKET = 32
HOPELESS = 0.69


def shingles(column) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, ascending within each row, and where each row's begin
    (one more than rows)."""
    data, offsets = T.texts(pc.utf8_lower(column))
    at, to = T.words(data, offsets)
    bounds = T.per_row(at, offsets)
    words = T.keys(data, at, to)
    counts = np.diff(bounds)
    many = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(counts)), many)
    first = bounds[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    keys = T.span_hashes(T.prefix_hashes(words), first, first + np.minimum(SHINGLE, counts[row]))
    order = np.lexsort((keys, row))
    keys, row = keys[order], row[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])
    return keys[new], np.searchsorted(row[new], np.arange(len(counts) + 1))


def signatures(keys: np.ndarray, weights: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """ProbMinHash: for every row and register the hash of the shingle that arrives first."""
    n = len(bounds) - 1
    time = np.full((n, REGISTERS), np.inf)
    winner = np.zeros((n, REGISTERS), np.uint64)
    row, now, step = T.rows_of(bounds), np.zeros(len(keys)), 0
    while len(keys):
        step += 1
        draw = T.mix(keys + np.uint64(step * 0xD1342543DE82EF95 % 2**64))
        now = now - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / weights
        register = row * REGISTERS + (T.mix(draw ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(REGISTERS)).astype(np.int64)
        np.minimum.at(time.reshape(-1), register, now)
        first = now == time.reshape(-1)[register]
        winner.reshape(-1)[register[first]] = keys[first]
        rows = np.unique(row)
        latest = np.zeros(n)
        latest[rows] = time[rows].max(1)
        on = now < latest[row]
        keys, weights, row, now = keys[on], weights[on], row[on], now[on]
    return T.mix(winner)


def _sign(group: pa.RecordBatch) -> pa.RecordBatch:
    keys, bounds = shingles(group.column("text"))
    full = signatures(keys, np.ones(len(keys)), bounds)
    bands = np.zeros((len(full), BANDS), np.uint64)
    for k in range(ROWS):
        bands = T.mix(bands + full[:, k::ROWS]) + np.uint64(k)
    bands = T.mix(bands + np.arange(1, BANDS + 1, dtype=np.uint64)).view(np.int64)
    short = np.ascontiguousarray((full >> np.uint64(40)).astype(np.uint8))
    total = lambda v: T.sums_by_row(v.view(np.int64), bounds)  # noqa: E731  wraps around
    return pa.record_batch({
        "doc_id": group.column("doc_id"), "key_1": pa.array(total(T.mix(keys))), "key_2": pa.array(total(T.mix(keys ^ np.uint64(0x5851F42D4C957F2D)))),
        "filled": pa.array(np.diff(bounds) > 0), "bands": pa.ListArray.from_arrays(pa.array(np.arange(len(full) + 1) * BANDS, pa.int32()), pa.array(bands.ravel())),
        "sig": pa.FixedSizeBinaryArray.from_buffers(pa.binary(REGISTERS), len(full), [None, pa.py_buffer(short)]).cast(pa.binary()),
    })


def sign(docs: DataFrame) -> DataFrame:
    """Signature, band keys and set key of every document with an id."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id is not null")
    return B.over_groups(docs, _sign, "doc_id long, key_1 long, key_2 long, filled boolean, bands array<long>, sig binary")


def _matrix(column) -> np.ndarray:
    return T.texts(column)[0].reshape(-1, REGISTERS)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of all buckets with an estimate of HOPELESS or more; rows come sorted by bucket."""
    held = None
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def edges(table: pa.Table) -> pa.RecordBatch:
        bucket = table.column("bucket").to_numpy()
        ids, sigs = table.column("doc_id").to_numpy(), _matrix(table.column("sig"))
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        for begin, end in zip([0, *cuts], [*cuts, len(bucket)], strict=True):
            for k in range(begin + 1, end):
                near = begin + np.flatnonzero((sigs[begin:k] == sigs[k]).mean(1) >= HOPELESS)
                a.append(ids[near])
                b.append(np.full(len(near), ids[k]))
        a, b = np.concatenate(a), np.concatenate(b)
        return pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], schema=schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        bucket = table.column("bucket").to_numpy()
        before = np.flatnonzero(bucket != bucket[-1])
        cut = int(before[-1]) + 1 if len(before) else 0  # the last bucket may go on in the next batch
        held = table.slice(cut)
        if cut:
            yield edges(table.slice(0, cut))
    if held is not None:
        yield edges(held)


def candidates(reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct candidate pairs (a < b) of the signed documents, and the members of large buckets with
    the largest bucket of each as its home.

    Of large buckets the pairs are only those with the home's lead: the id that is least after xor
    with the bucket's hash, so that buckets of the same documents have different leads."""
    light = reps.select("doc_id", F.explode("bands").alias("bucket"))
    sizes = light.groupBy("bucket").agg(F.count("*").alias("n"), F.min(F.col("doc_id").bitwiseXOR(F.col("bucket"))).alias("x")).where("n > 1")
    members = cut_lineage(light.join(sizes.select("bucket", "n", F.col("x").bitwiseXOR(F.col("bucket")).alias("lead")), "bucket"))
    small = members.where(F.col("n") <= BUCKET).select("bucket", "doc_id").join(reps.select("doc_id", "sig"), "doc_id")
    found = small.repartition("bucket").sortWithinPartitions("bucket", "doc_id").mapInArrow(_pairs, "a long, b long")
    home = F.max(F.struct("n", "bucket", "lead")).alias("home")
    crowd = cut_lineage(members.where(F.col("n") > BUCKET).groupBy("doc_id").agg(home).select("doc_id", F.col("home.bucket").alias("home"), F.col("home.lead").alias("lead")))
    seeds = crowd.select(F.least("doc_id", "lead").alias("a"), F.greatest("doc_id", "lead").alias("b"))
    return found.unionByName(seeds).where("a != b").distinct(), crowd.select("doc_id", "home")


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of distinct hashes; 1 for two empty ones."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - common
    return common / union if union else 1.0


def _sets(group: pa.RecordBatch) -> pa.RecordBatch:
    keys, bounds = shingles(group.column("text"))
    return pa.record_batch({"doc_id": group.column("doc_id"), "keys": pa.array([keys[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())})


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = ([np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(name)] for name in ("keys_a", "keys_b"))
        ok = np.array([similarity(*p) for p in zip(a, b, strict=True)]) >= SIMILARITY
        yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b")}).filter(pa.array(ok, pa.bool_()))


def shingle_sets(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, keys) of the texts with these ids."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # ids grow with the input: one plan for every size, never a broadcast
    return cut_lineage(B.over_groups(docs.join(ids.hint("merge"), "doc_id", "left_semi"), _sets, "doc_id long, keys binary"))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose whole shingle sets are similar enough. An id with several texts is similar if
    one of them is."""
    side = lambda x: sets.select(F.col("doc_id").alias(x), F.col("keys").alias(f"keys_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_verify, "a long, b long")


def links(reps: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (a, b) that connect the signed documents as all their similar pairs do."""
    pairs, crowd = candidates(reps)
    pairs = cut_lineage(pairs)
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).union(crowd.select("doc_id")).distinct()
    sets = shingle_sets(ids, docs)
    found = cut_lineage(verified(pairs, sets))
    if crowd.isEmpty():
        return found
    known = cut_lineage(components(found))
    rows = crowd.join(known, "doc_id", "left").select("doc_id", "home", F.coalesce("class_id", "doc_id").alias("class_id")).join(sets, "doc_id")
    more = set_join.between_classes(cut_lineage(rows.where("octet_length(keys) > 0")), SIMILARITY)
    return known.select(F.col("doc_id").alias("a"), F.col("class_id").alias("b")).unionByName(more)


def components(edges: DataFrame) -> DataFrame:
    """(doc_id, class_id) of every id in the edges (a, b): the least id it is connected to.

    Alternating large-star and small-star contraction; each round is written, and ends when a round
    changes nothing."""
    stamp = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    edges = cut_lineage(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = stamp(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = cut_lineage(small.unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct())
        now = stamp(edges)
        if now == seen:
            break
        seen = now
    return edges.groupBy("a").agg(F.min("b").alias("class_id")).select(F.col("a").alias("doc_id"), "class_id").unionByName(edges.select(F.col("b").alias("doc_id"), F.col("b").alias("class_id")).distinct())


def classes(docs: DataFrame) -> DataFrame:
    """doc_id and class_id (the least doc_id of its class) of every document with an id."""
    signed = cut_lineage(sign(docs))
    least = cut_lineage(signed.groupBy("key_1", "key_2").agg(F.min("doc_id").alias("rep")))
    reps = signed.where("filled").join(least.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    near = links(reps, docs)
    same = signed.select("doc_id", "key_1", "key_2").join(least, ["key_1", "key_2"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = components(near.unionByName(same.where("a != b")))
    out = signed.select("doc_id").distinct().join(found, "doc_id", "left")
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def first_of_class(docs: DataFrame) -> DataFrame:
    """Documents, with all their columns, without the later ones of each class. Of rows with one id all
    stay or go. Rows without id take part under a key of their text, beyond the ids: of equal texts one
    row stays, unless a document with an id is in their class."""
    places = {c: c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)}
    # from 2**62 on, so that ids are the lesser members of a class
    key = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62)))
    rows = docs.toDF(*places.values()).withColumn("row_key", key)
    later = classes(rows.select(F.col("row_key").alias("doc_id"), "text")).where("doc_id != class_id").select(F.col("doc_id").alias("row_key"))
    kept = rows.join(later, "row_key", "left_anti")
    nameless = kept.where("doc_id is null").dropDuplicates(["row_key"])
    return kept.where("doc_id is not null").unionByName(nameless).select([F.col(p).alias(c) for c, p in places.items()])


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(B.read(spark, sf_dir, "documents"))
