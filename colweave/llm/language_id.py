"""Language identification by a byte convolutional network trained in numpy.

Bytes are embedded, filters of widths 2, 3 and 4 slide over fixed-length windows, the maximum of
each filter goes through a softmax layer. For application the embedding and the filters are folded
into tables over byte pairs, so a filter response is a sum of two rows; windows of a group are
handled together, one position at a time. A text's probabilities are the means over its windows,
weighted by their bytes, so every byte of every text counts.

Edge cases: null texts and texts without a letter are `und` with score 0; documents without a
language are not learned from but are predicted; with no labelled document at all everything is
`und`; equal texts get equal results; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave.llm import tables as B
from colweave.llm import textops as T

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBED = 8
#: Labelled documents that the network is fitted on, at most, and windows of each.
FIT_DOCUMENTS = 3000
FIT_WINDOWS = 2
UNKNOWN = "und"
#: A text whose most probable language has less than this is rejected by `accept`.
LEAST_SCORE = 0.5
_PAD = max(WIDTHS) - 1


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all rows (windows x WINDOW + pad, 0 beyond a window's end), the row of each,
    and its bytes."""
    counts = -(-np.diff(offsets) // WINDOW)
    row = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = offsets[:-1][row] + within * WINDOW
    size = np.minimum(WINDOW, offsets[1:][row] - start)
    at = start[:, None] + np.arange(WINDOW + _PAD)
    inside = np.arange(WINDOW + _PAD) < size[:, None]
    return np.where(inside, data[np.where(inside, at, 0)] if len(data) else 0, 0).astype(np.uint8), row, size


class ByteCnn:
    """Parameters as arrays in `p`; `classes` are the learned languages, sorted."""

    def __init__(self, classes: list[str], p: dict[str, np.ndarray]):
        self.classes, self.p = classes, p
        self._tables = None

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, classes: list[str], epochs: int = 4, batch: int = 96, rate: float = 0.01) -> ByteCnn:
        """Adam on the cross-entropy of windows x with classes y."""
        draw = np.random.default_rng(5)
        p = {"embed": draw.normal(0, 0.5, (256, EMBED))} | {f"w{w}": draw.normal(0, 0.4, (w, EMBED, FILTERS)) for w in WIDTHS}
        p |= {"bias": np.zeros(FILTERS * len(WIDTHS)), "out": draw.normal(0, 0.2, (FILTERS * len(WIDTHS), len(classes))), "base": np.zeros(len(classes))}
        p = {k: v.astype(np.float32) for k, v in p.items()}
        m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
        step = 0
        for _ in range(epochs):
            order = draw.permutation(len(x))
            for k in range(0, len(order), batch):
                step += 1
                grads = cls._gradient(p, x[order[k : k + batch]], y[order[k : k + batch]])
                for name, g in grads.items():
                    m[name] = 0.9 * m[name] + 0.1 * g
                    v[name] = 0.99 * v[name] + 0.01 * g * g
                    p[name] = p[name] - rate * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.99**step)) + 1e-7)
        return cls(classes, p)

    @staticmethod
    def _gradient(p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        n, rows = len(x), np.arange(len(x))[:, None]
        emb = p["embed"][x]
        peaks, places = [], []
        for w in WIDTHS:
            r = sum(emb[:, j : j + WINDOW] @ p[f"w{w}"][j] for j in range(w))
            at = r.argmax(1)
            places.append(at)
            peaks.append(np.take_along_axis(r, at[:, None], 1)[:, 0])
        z = np.concatenate(peaks, 1) + p["bias"]
        h = np.maximum(z, 0)
        s = h @ p["out"] + p["base"]
        s = np.exp(s - s.max(1, keepdims=True))
        s /= s.sum(1, keepdims=True)
        s[np.arange(n), y] -= 1
        s /= n
        g = {"out": h.T @ s, "base": s.sum(0), "embed": np.zeros_like(p["embed"])}
        dz = (s @ p["out"].T) * (z > 0)
        g["bias"] = dz.sum(0)
        for i, w in enumerate(WIDTHS):
            d, at = dz[:, i * FILTERS : (i + 1) * FILTERS], places[i]
            g[f"w{w}"] = np.zeros_like(p[f"w{w}"])
            for j in range(w):
                bytes_ = x[rows, at + j]
                g[f"w{w}"][j] = np.einsum("nfe,nf->ef", p["embed"][bytes_], d)
                np.add.at(g["embed"], bytes_.ravel(), (d[:, :, None] * p[f"w{w}"][j].T[None]).reshape(-1, EMBED))
        return g

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Responses by the byte pair at a position and by the pair two bytes on."""
        if self._tables is None:
            one = {(w, j): self.p["embed"] @ self.p[f"w{w}"][j] for w in WIDTHS for j in range(w)}
            pair = lambda w, j: (one[w, j][:, None] + one[w, j + 1][None]).reshape(65536, FILTERS)
            self._tables = (
                np.ascontiguousarray(np.concatenate([pair(2, 0), pair(3, 0), pair(4, 0)], 1)),
                np.ascontiguousarray(np.concatenate([np.repeat(one[3, 2], 256, 0), pair(4, 2)], 1)),
            )
        return self._tables

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Class probabilities of windows."""
        near, far = self.tables()
        out = np.zeros((len(x), len(self.classes)), np.float32)
        for k in range(0, len(x), 1024):
            part = np.ascontiguousarray(x[k : k + 1024].T)
            pair = part[:-1].astype(np.intp) * 256 + part[1:]
            peak = np.full((part.shape[1], 3 * FILTERS), -np.inf, np.float32)
            a, b = np.empty_like(peak), np.empty((part.shape[1], 2 * FILTERS), np.float32)
            for t in range(WINDOW):
                np.take(near, pair[t], 0, a, "clip")
                np.take(far, pair[t + 2], 0, b, "clip")
                a[:, FILTERS:] += b
                np.maximum(peak, a, peak)
            s = np.maximum(peak + self.p["bias"], 0) @ self.p["out"] + self.p["base"]
            s = np.exp(s - s.max(1, keepdims=True))
            out[k : k + 1024] = s / s.sum(1, keepdims=True)
        return out

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Class probabilities of whole rows; empty rows have zeros."""
        x, row, size = windows(data, offsets)
        weighted = self.probabilities(x) * size[:, None]
        total = np.stack([np.bincount(row, weighted[:, c], len(offsets) - 1) for c in range(len(self.classes))], 1)
        return total / np.maximum(np.diff(offsets), 1)[:, None]


def fit(docs: DataFrame, most: int = FIT_DOCUMENTS) -> ByteCnn | None:
    """A network from at most `most` of the given documents with a language; None without any."""
    usable = docs.where("lang is not null and text is not null and text != ''")
    # one language an id, however many rows it has
    chosen = B.sample(usable.where("doc_id is not null").select("doc_id", "lang"), most).groupBy("doc_id").agg(F.min("lang").alias("lang"))
    known = B.chosen_texts(usable, chosen)

    def cut(group: pa.RecordBatch) -> pa.RecordBatch:
        x, row, _ = windows(*T.texts(group.column("text")))
        counts = np.bincount(row, minlength=group.num_rows)
        first = np.cumsum(counts) - counts
        picks = np.unique(np.concatenate([first + counts * k // FIT_WINDOWS for k in range(FIT_WINDOWS)]))
        return pa.record_batch({"lang": group.column("lang").cast(pa.string()).take(pa.array(row[picks])), "bytes": pa.array([x[i].tobytes() for i in picks], pa.binary())})

    rows = sorted((r.lang, bytes(r.bytes)) for r in B.over_groups(known, cut, "lang string, bytes binary").collect())
    if not rows:
        return None
    classes = sorted({r[0] for r in rows})
    x = np.stack([np.frombuffer(r[1], np.uint8) for r in rows])
    return ByteCnn.fit(x, np.array([classes.index(r[0]) for r in rows]), classes)


def predict(docs: DataFrame, model: ByteCnn | None, carried: str) -> DataFrame:
    """`carried` columns (a schema string), lang_pred and score of every row of docs (text)."""
    names = [c.split()[0] for c in carried.split(",")]
    schema = f"{carried}, lang_pred string, score double"
    docs = docs.withColumn("has_letter", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))

    def work(group: pa.RecordBatch) -> pa.RecordBatch:
        letter = group.column("has_letter").to_numpy(zero_copy_only=False)
        if model is None:
            langs, score = [UNKNOWN] * group.num_rows, np.zeros(group.num_rows)
        else:
            p = model.texts(*T.texts(group.column("text")))
            langs = [model.classes[i] if ok else UNKNOWN for i, ok in zip(p.argmax(1), letter, strict=True)]
            score = np.where(letter, np.minimum(p.max(1), 1), 0.0)
        return pa.record_batch({**{n: group.column(n) for n in names}, "lang_pred": pa.array(langs, pa.string()), "score": pa.array(score)})

    return B.over_groups(docs.select(*names, *[c for c in ("text", "has_letter") if c not in names]), work, schema)


def accept(docs: DataFrame, model: ByteCnn | None, least: float = LEAST_SCORE) -> DataFrame:
    """Documents, with all their columns, whose language is known with a score of `least` or more."""
    places = {c: c if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)}
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    found = predict(docs.toDF(*places.values()), model, ", ".join(f"{p} {kinds[c]}" for c, p in places.items()))
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select([F.col(p).alias(c) for c, p in places.items()])


def accept_across(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """As `accept`, with every row judged by a network that learned from other ids: the ids are dealt
    into two halves by their crc32, and each half is judged by the network of the other one."""
    half = B.remainder(2)
    first, second = (accept(docs.where(half == k), fit(docs.where(half != k)), least) for k in (0, 1))
    return first.unionByName(second)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = B.read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), F.col("text").cast("string"), "lang")
    docs = docs.withColumn("held_out", B.remainder(3) == 1)
    return predict(docs, fit(docs.where(~F.col("held_out"))), "doc_id long, held_out boolean")
