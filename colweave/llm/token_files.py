"""Token-id output in directly addressable codes, with access to any token without block decoding.

Files are Parquet; each row is one block of whole documents in ascending doc_id order, or another that
is given (a mixed corpus keeps its mixed order): shard, place
in the shard (`before`: tokens ahead of it there), ids and token counts of its documents, and the
codes. Codes hold the ids of the block in levels of 8-bit chunks, the lowest first. Level k has the
k-th chunk of every id that is long enough, a bitmap that says which of them go on in level k+1, and
a rank directory: the number of set bits before each 512 bits. The id at position i is read by
following i through the levels: chunk, bit, rank.

    codes = "DAC1" u32 levels { u64 n | n chunk bytes | bitmap, 64-byte padded | u32 rank per 512 bits }*

Documents are spread by ranges of that order, so no task or driver holds more than a share; the driver
sees one token total per shard. Edge cases: null text is empty and gets the end id only; null ids
come first; repeated ids stand side by side, ordered by text; an empty table writes no block; extra
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave.llm import tables as B
from colweave.llm import textops as T
from colweave.llm.subwords import Encoder
from colweave.session import fresh_path

MAGIC = b"DAC1"
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
#: Tokens that one key of `tokens_at` stands for.
PIECE = 1 << 16
_RANK = 512
BLOCK = "shard int, before long, doc_ids array<long>, counts array<long>, codes binary"
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"
_encoders: dict[str, Encoder] = {}


def encoder(name: str) -> Encoder:
    """The worker's encoder for a public tokenizer file."""
    if name not in _encoders:
        import public_tokenizers

        _encoders[name] = Encoder(public_tokenizers.path(name))
    return _encoders[name]


def pack(ids: np.ndarray) -> bytes:
    """Non-negative ids of up to 32 bits as directly addressable codes."""
    left = np.asarray(ids, np.uint32)
    levels = []
    while True:
        chunk, rest = (left & 0xFF).astype(np.uint8), left >> np.uint32(8)
        more = rest > 0
        bits = np.packbits(more, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % (_RANK // 8)))
        ones = np.bitwise_count(bits).reshape(-1, _RANK // 8).sum(1, dtype=np.uint32) if len(bits) else np.zeros(0, np.uint32)
        ranks = (np.cumsum(ones, dtype=np.uint32) - ones).astype("<u4")
        levels.append(np.uint64(len(chunk)).tobytes() + chunk.tobytes() + bits.tobytes() + ranks.tobytes())
        left = rest[more]
        if not len(left):
            return MAGIC + np.uint32(len(levels)).tobytes() + b"".join(levels)


class Codes:
    """Reads packed codes in place."""

    def __init__(self, codes: bytes):
        if codes[:4] != MAGIC:
            raise ValueError("not in this file format")
        self.levels = []
        at = 8
        for _ in range(int(np.frombuffer(codes, "<u4", 1, 4)[0])):
            n = int(np.frombuffer(codes, "<u8", 1, at)[0])
            blocks = -(-(-(-n // 8)) // (_RANK // 8))
            chunk = np.frombuffer(codes, np.uint8, n, at + 8)
            bits = np.frombuffer(codes, np.uint8, blocks * _RANK // 8, at + 8 + n)
            at += 8 + n + len(bits)
            self.levels.append((chunk, bits, np.frombuffer(codes, "<u4", blocks, at)))
            at += 4 * blocks

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        """The id at position i, touching one chunk, bit and rank a level."""
        out = 0
        for shift, (chunk, bits, ranks) in enumerate(self.levels):
            out |= int(chunk[i]) << 8 * shift
            byte, bit = divmod(i, 8)
            if not bits[byte] >> bit & 1:
                break
            block = byte // (_RANK // 8)
            before = bits[block * _RANK // 8 : byte]
            i = int(ranks[block]) + int(np.bitwise_count(before).sum()) + int(bits[byte] & ((1 << bit) - 1)).bit_count()
        return out

    def all(self) -> np.ndarray:
        """All ids."""
        parts = [(chunk, np.unpackbits(bits, count=len(chunk), bitorder="little").astype(bool)) for chunk, bits, _ in self.levels]
        ids = np.zeros(0, np.uint32)
        for chunk, more in reversed(parts):
            level = chunk.astype(np.uint32)
            level[more] |= ids << np.uint32(8)
            ids = level
        return ids


def write(docs: DataFrame, path: str, order: list[Column] | None = None, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> None:
    """Encodes doc_id and text of all documents into block files under `path`, in ascending order of the
    columns `order`: by doc_id, and a hash of the text for equal ids, if there are none. Equal rows of that
    order go by their text, within a task; the driver sees a sample of the order alone."""
    text = F.col("text").cast("string")
    order = order or [F.col("doc_id").cast("long"), F.xxhash64(text)]
    by = [f"order_{i}" for i in range(len(order))]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *[o.alias(n) for o, n in zip(order, by, strict=True)])
    spread = docs.repartitionByRange(*by).sortWithinPartitions(*by, "text").select("doc_id", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, before = TaskContext.get().partitionId(), 0
        encode = encoder(tokenizer)
        try:
            for batch in batches:
                for group in T.groups(batch):
                    ids, bounds = encode.encode(*T.texts(group.column("text")))
                    ids = np.insert(ids, bounds[1:], end_id)
                    counts = np.diff(bounds) + 1
                    yield pa.record_batch({
                        "shard": pa.array([shard], pa.int32()), "before": pa.array([before], pa.int64()),
                        "doc_ids": pa.array([group.column("doc_id")], pa.list_(pa.int64())), "counts": pa.array([counts], pa.list_(pa.int64())),
                        "codes": pa.array([pack(ids)], pa.binary()),
                    })
                    before += int(counts.sum())
        finally:
            encode.forget()  # the worker goes on to other stages
            T.release()

    spread.mapInArrow(work, BLOCK).write.parquet(path)


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks under `path` with the number of tokens ahead of each (`start`)."""
    found = spark.read.schema(BLOCK).parquet(path)
    size = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    totals = sorted(tuple(r) for r in found.groupBy("shard").agg(F.sum(size)).collect())
    ahead, rows = 0, []
    for shard, total in totals:
        rows.append((shard, ahead))
        ahead += total
    return found.join(F.broadcast(spark.createDataFrame(rows, "shard int, ahead long")), "shard").withColumn("start", F.col("before") + F.col("ahead")).drop("before", "ahead")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files alone: where its ids begin, how many, and their checksum."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                raw = Codes(batch.column("codes")[row].as_buffer().to_pybytes()).all().astype("<u4").tobytes()
                counts = batch.column("counts")[row].values.to_numpy()
                ends = np.cumsum(counts)
                start = batch.column("start")[row].as_py()
                sums = [zlib.crc32(memoryview(raw)[4 * a : 4 * b]) for a, b in zip(ends - counts, ends, strict=True)]
                yield pa.record_batch({"doc_id": batch.column("doc_ids")[row].values, "start": pa.array(start + ends - counts), "n_tokens": pa.array(counts), "ids_crc32": pa.array(sums, pa.int64())})

    return blocks(spark, path).select("doc_ids", "counts", "codes", "start").mapInArrow(work, RESULT)


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """The ids at `positions` (position: a number among all tokens of the files; others give no row).

    Each position goes to the block that holds it, and is read there through the levels' chunks, bits
    and ranks alone. Blocks are cut into pieces of PIECE tokens as keys of the join, so a block that many
    ask for is asked piece by piece."""
    held = blocks(spark, path).withColumn("n", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).where("n > 0")
    pieces = held.select("start", "n", "codes", F.explode(F.sequence(F.floor(F.col("start") / PIECE), F.floor((F.col("start") + F.col("n") - 1) / PIECE))).alias("piece"))
    asked = positions.select(F.col("position").cast("long")).distinct().withColumn("piece", F.floor(F.col("position") / PIECE))
    lists = asked.groupBy("piece").agg(F.collect_list("position").alias("positions"))  # PIECE at most
    met = pieces.join(lists, "piece").select("start", "n", "codes", "positions")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                start, n = batch.column("start")[row].as_py(), batch.column("n")[row].as_py()
                at = batch.column("positions")[row].values.to_numpy()
                at = at[(at >= start) & (at < start + n)]
                codes = Codes(batch.column("codes")[row].as_buffer().to_pybytes())
                yield pa.record_batch({"position": pa.array(at, pa.int64()), "token_id": pa.array([codes[int(i)] for i in at - start], pa.int64())})

    return met.mapInArrow(work, "position long, token_id long")


def file_order(docs: DataFrame) -> list[Column]:
    """The place of each row in the files that docs was read from, or in its partitions otherwise: the
    order that a mixing stage has written."""
    place = [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
    try:
        docs.select(*place).schema  # noqa: B018  resolves the columns
    except AnalysisException:
        return [F.monotonically_increasing_id()]
    return place


def encode_and_read(docs: DataFrame, order: list[Column] | None = None) -> DataFrame:
    path = fresh_path(docs.sparkSession, "tokens")
    write(docs, path, order)
    return read(docs.sparkSession, path)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_read(B.read(spark, sf_dir, "documents"))
