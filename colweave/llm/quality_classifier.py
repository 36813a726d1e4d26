"""Quality classifier: Bradley-Terry scores learned from preference pairs, cut at a score quantile.

Features are shares and counts of words, lines and signs of the whole text, each also as steps, so
that a linear score can bend. Every pair sets a document of quality 1 above one of quality 0; the
loss is logistic on the difference of their features, so no absolute level is learned. All labelled
documents take part: they are dealt into blocks, pairs meet inside a block, and the weights are the means
of those of the blocks by their documents. A kind that would be rare in a block stands in several. The level
comes from a quantile: with a share q of quality 0 among all labelled documents, the exact q-quantile of
their scores maps to CUT, and a logistic curve maps scores to 0..1.

Edge cases: null and empty texts are scored by their zero counts; documents without a label are
scored too; several labels of a document: the highest counts; several texts of an id: the least by its
first LEAD characters, then by SHA-256, is learned from; null labels are ignored; without
both kinds of label every score is 0.5; repeated rows score alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave.llm import linefeatures as L
from colweave.llm import tables as B
from colweave.llm import textops as T
from colweave.session import cut_lineage

#: Labelled documents of a block, about, and preference pairs drawn of them.
BLOCK_DOCUMENTS = 10_000
FIT_PAIRS = 60_000
#: Documents of either kind that a block has at least, if there are as many.
LEAST_OF_KIND = 256
#: Distinct scores that the driver ranks, and ranges that others are counted by.
MOST_RANKED, RANGES = 50_000, 2048
LEAD = 64
CUT = 0.3
STEPS = [0.02, 0.1, 0.25, 0.5, 0.75]


def levels(group: pa.RecordBatch) -> np.ndarray:
    """A row for each text: means of line features by words, shares of the whole, and last the number of words."""
    x = L.scan(*T.texts(group.column("text")))
    lines = L.line_features(x)[:, 1:]
    weight = np.diff(x.line_words)[:, None]
    words = np.maximum(np.diff(x.words), 1)[:, None]
    total = np.zeros((len(lines) + 1, lines.shape[1]))
    np.cumsum(lines * weight, axis=0, out=total[1:])
    mean = (total[x.lines[1:]] - total[x.lines[:-1]]) / words
    _, first = np.unique(x.word_number * x.n + x.word_row, return_index=True)
    distinct = np.bincount(x.word_row[first], minlength=x.n)
    n = np.diff(x.words)
    shares = [distinct / words[:, 0], T.sums_by_row(x.later_line, x.lines) / np.maximum(np.diff(x.lines), 1), np.minimum(np.log1p(n) / 10, 1), np.minimum(np.log1p(np.diff(x.lines)) / 8, 1)]
    return np.concatenate([mean, np.stack([*shares, n], axis=1)], axis=1)


def in_steps(level: np.ndarray) -> np.ndarray:
    """The features of rows of `levels`: the levels themselves and each also as steps."""
    level, n = level[:, :-1], level[:, -1]
    return np.concatenate([level, *[level > s for s in STEPS], np.stack([n < k for k in (10, 25, 50, 100)], axis=1)], axis=1).astype(np.float32)


def features(group: pa.RecordBatch) -> np.ndarray:
    """A row of features for each text."""
    return in_steps(levels(group))


class BradleyTerry:
    """score(x) = weights . x; `place` and `scale` set the curve to 0..1."""

    def __init__(self, weights: np.ndarray, place: float, scale: float):
        self.weights, self.place, self.scale = weights, place, scale

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, pairs: int = FIT_PAIRS, rounds: int = 300, rate: float = 0.05, decay: float = 1e-4) -> BradleyTerry:
        good, bad = x[y > 0], x[y == 0]
        if not len(good) or not len(bad):
            return cls(np.zeros(x.shape[1]), 0.0, 0.0)
        draw = np.random.default_rng(11)
        w, m, v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
        batch = max(1, pairs // 30)
        for step in range(1, rounds + 1):
            d = good[draw.integers(len(good), size=batch)] - bad[draw.integers(len(bad), size=batch)]
            grad = d.T @ (1 / (1 + np.exp(np.clip(d @ w, -30, 30)))) / batch - decay * w
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
            w = w + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        scores = x @ w
        return cls(w, float(np.quantile(scores, (y == 0).mean())), 1.0)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.scale:
            return np.full(len(x), 0.5)
        z = self.scale * (x @ self.weights - self.place) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def described(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Every document (key, held_out, text) with the levels of its text, and what texts of an id are ordered by."""

    def work(group: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch({**{c: group.column(c) for c in (key, "held_out", "lead", "digest")}, "levels": pa.array([a.tobytes() for a in levels(group)], pa.binary())})

    text = F.coalesce("text", F.lit(""))
    rows = docs.select(key, "held_out", "text", F.substring(text, 1, LEAD).alias("lead"), F.sha2(text, 256).alias("digest"))
    return B.over_groups(rows, work, f"{key} long, held_out boolean, lead string, digest string, levels binary")


def _features(column) -> np.ndarray:
    """The features of stored levels."""
    rows = column.to_pylist()
    return in_steps(np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)) if rows else np.zeros((0, 1), np.float32)


def fit(docs: DataFrame, labels: DataFrame, block: int = BLOCK_DOCUMENTS) -> BradleyTerry:
    """Scores learned from all given labelled documents, in blocks of about `block`."""
    return fit_described(described(docs.withColumn("held_out", F.lit(False))), labels, block)


def fit_described(rows: DataFrame, labels: DataFrame, block: int = BLOCK_DOCUMENTS) -> BradleyTerry:
    """As `fit`, from rows of `described`."""
    marks = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    one = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("lead", "digest", "levels")).alias("least"))
    known = cut_lineage(one.join(marks, "doc_id").select("doc_id", "quality", F.col("least.levels").alias("levels")))
    n, good, bad = (int(v or 0) for v in known.agg(F.count("*"), F.sum((F.col("quality") > 0).cast("long")), F.sum((F.col("quality") == 0).cast("long"))).first())
    if not n:
        return BradleyTerry(np.zeros(1), 0.0, 0.0)
    blocks = -(-n // block)
    copies = F.when(F.col("quality") > 0, _copies(good, blocks)).otherwise(_copies(bad, blocks))
    dealt = known.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    dealt = dealt.select(F.pmod(F.xxhash64("doc_id", F.lit(17)) + F.col("copy"), F.lit(blocks)).alias("block"), "quality", "levels")

    def learn(table: pa.Table) -> pa.Table:
        x, y = _features(table.column("levels")), np.array(table.column("quality").to_pylist())
        order = sorted(range(len(y)), key=lambda i: (y[i], x[i].tobytes()))
        model = BradleyTerry.fit(x[order].astype(float), y[order])
        return pa.table({"block": table.column("block").slice(0, 1), "n": pa.array([len(y) if model.scale else 0]), "place": pa.array([model.place]), "weights": pa.array([model.weights.tolist()], pa.list_(pa.float64()))})

    # one row of weights a block
    learned = dealt.groupBy("block").applyInArrow(learn, "block long, n long, place double, weights array<double>").collect()
    parts = sorted((r for r in learned if r.n), key=lambda r: r.block)
    if not parts:
        return BradleyTerry(np.zeros(1), 0.0, 0.0)
    weights = np.average([r.weights for r in parts], axis=0, weights=[r.n for r in parts])
    if blocks == 1:
        return BradleyTerry(weights, parts[0].place, 1.0)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch({"value": pa.array(_features(batch.column("levels")).astype(float) @ weights)})

    scores = known.select("levels").mapInArrow(rate, "value double")
    return BradleyTerry(weights, quantile(cut_lineage(scores.groupBy("value").agg(F.count("*").alias("n"))), bad / n), 1.0)


def _copies(n: int, blocks: int) -> Column:
    """In how many blocks a document of a kind with n documents stands."""
    return F.lit(min(blocks, -(-blocks * LEAST_OF_KIND // n)) if n else 1)


def quantile(counted: DataFrame, q: float) -> float:
    """The exact q-quantile of values that are there n times (value, n), as numpy has it, without one task that
    sorts them all: the range that holds the ranks is cut until the driver can rank what it has."""
    total, low, high = counted.agg(F.sum("n"), F.min("value"), F.max("value")).first()
    place = (total - 1) * q
    first = int(place)
    found = [_ranked(counted, rank, low, high) for rank in (first, min(first + 1, total - 1))]
    return found[0] + (found[1] - found[0]) * (place - first)


def _ranked(counted: DataFrame, rank: int, low: float, high: float) -> float:
    """The value of a rank (from 0) among values from low to high."""
    while True:
        inside = counted.where(F.col("value").between(low, high))
        if low == high or inside.count() <= MOST_RANKED:
            break
        number = F.least(F.floor((F.col("value") - low) / ((high - low) / RANGES)), F.lit(RANGES - 1)).alias("number")
        for r in inside.groupBy(number).agg(F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).orderBy("number").collect():  # at most RANGES rows
            if rank < r.n:
                low, high = r.low, r.high
                break
            rank -= r.n
    rows = sorted((r.value, r.n) for r in inside.collect())
    return rows[int(np.searchsorted(np.cumsum([n for _, n in rows]), rank, "right"))][0]


def score(docs: DataFrame, model: BradleyTerry, key: str = "doc_id") -> DataFrame:
    """Every document with its score and the verdict at CUT."""
    return score_described(described(docs, key), model, key)


def score_described(rows: DataFrame, model: BradleyTerry, key: str = "doc_id") -> DataFrame:
    """As `score`, from rows of `described`."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.score(_features(batch.column("levels")).astype(float))
            yield pa.record_batch({key: batch.column(key), "held_out": batch.column("held_out"), "score": pa.array(s), "predicted": pa.array((s >= CUT).astype(np.int32))})

    return rows.select(key, "held_out", "levels").mapInArrow(work, f"{key} long, held_out boolean, score double, predicted int")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = B.read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = cut_lineage(described(docs.withColumn("held_out", B.remainder(5) == 0)))  # read once, learned from and scored
    return score_described(rows, fit_described(rows, B.read(spark, sf_dir, "labels").where(B.remainder(5) != 0)))
