"""Quality rules: a linear-chain CRF marks each line as content or boilerplate; the share of words
in content lines decides whether a document stays.

The CRF (two labels, `LINE_FEATURES` as emissions, label-pair transitions) is trained in numpy by
forward-backward on a bounded sample of labelled documents. Labels are of documents, those of their
lines are hidden: a first model without transitions takes every line by its document's label; then, in
turns, the best label sequence that agrees with the document (at least `CONTENT_SHARE` of the words in
content lines for quality 1, less for quality 0) is filled in, and the CRF is fitted on the sequences,
so that boilerplate between content, and its transitions, are learned. Viterbi decoding then runs over
all lines of all documents of a group at once, one line position at a time.

Edge cases: null or empty text has no words, fails the base rule and is not kept; null ids stay
null; repeated rows are judged alike, each on its own; extra columns are ignored; without labelled
rows every line is content; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave.llm import linefeatures as L
from colweave.llm import tables as B
from colweave.llm import textops as T

CONTENT = 1
#: Labelled documents that the CRF is fitted on, at most, and lines of such a document.
FIT_DOCUMENTS = 4000
FIT_LINES = 64
MIN_WORDS = 50
CONTENT_SHARE = 0.3
#: Turns of filling in the labels of lines and fitting on them.
TURNS = 3
RESULT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_lines long, n_content_words long"


class Crf:
    """Weights: `emit` (features x 2) and `move` (2 x 2, from label to label)."""

    def __init__(self, emit: np.ndarray, move: np.ndarray):
        self.emit, self.move = emit, move

    @classmethod
    def all_content(cls) -> Crf:
        emit = np.zeros((len(L.LINE_FEATURES), 2))
        emit[0, CONTENT] = 1
        return cls(emit, np.zeros((2, 2)))

    @classmethod
    def fit(cls, features: list[np.ndarray], labels: list, rounds: int = 120, rate: float = 0.15, decay: float = 1e-3, chain: bool = True) -> Crf:
        """Adam on the mean log-likelihood of the label sequences: of each document one label for all
        its lines, or one a line. Without `chain` lines stand alone."""
        model = cls(np.zeros((len(L.LINE_FEATURES), 2)), np.zeros((2, 2)))
        order = np.argsort([-len(f) for f in features], kind="stable")
        sizes = np.array([len(features[i]) for i in order])
        truth = np.full((sizes.max(), len(sizes)), -1)
        x = np.zeros((sizes.max(), len(sizes), len(L.LINE_FEATURES)))
        for k, i in enumerate(order):
            x[: sizes[k], k] = features[i]
            truth[: sizes[k], k] = labels[i]
        live = [int((sizes > t).sum()) for t in range(len(x))]
        gold_emit = np.stack([x[truth == y].sum(0) for y in (0, 1)], axis=1)
        gold_move = np.array([[((truth[:-1] == a) & (truth[1:] == b)).sum() for b in (0, 1)] for a in (0, 1)], float)
        total = sizes.sum()
        moments = [np.zeros(model.emit.size + 4), np.zeros(model.emit.size + 4)]
        for step in range(1, rounds + 1):
            emit, move = model._expected(x, live)
            grad = np.concatenate([(gold_emit - emit).ravel(), chain * (gold_move - move).ravel()]) / total
            now = np.concatenate([model.emit.ravel(), model.move.ravel()])
            grad -= decay * now
            moments[0] = 0.9 * moments[0] + 0.1 * grad
            moments[1] = 0.99 * moments[1] + 0.01 * grad**2
            now = now + rate * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
            model = cls(now[:-4].reshape(model.emit.shape), now[-4:].reshape(2, 2))
        return model

    @classmethod
    def fit_documents(cls, features: list[np.ndarray], words: list[np.ndarray], labels: list[int], share: float = CONTENT_SHARE, turns: int = TURNS) -> Crf:
        """A CRF from labels of whole documents, with the features and the words of their lines."""
        model = cls.fit(features, labels, chain=False)
        for _ in range(turns):
            model = cls.fit(features, model.fill(features, words, labels, share))
        return model

    def fill(self, features: list[np.ndarray], words: list[np.ndarray], labels: list[int], share: float) -> list[np.ndarray]:
        """The best labels of each document's lines whose share of words in content agrees with the
        document's label. Where the free sequence does not agree, content is made dearer or cheaper by
        the word, twice as much each time, until it does."""
        bounds = np.cumsum([0, *map(len, words)])
        size, whole = np.concatenate(words), np.array(labels)
        line_row = T.rows_of(bounds)
        total = T.sums_by_row(size, bounds)
        relative = (size / np.maximum(total / np.maximum(np.diff(bounds), 1), 1)[line_row]) * np.where(whole > 0, 1, -1)[line_row]
        rows, pull = np.concatenate(features), 0.25
        out = self.decode(rows, bounds)
        while len(wrong := np.flatnonzero((T.sums_by_row(size * out, bounds) >= share * total) != (whole > 0))):
            again = self.decode(rows, bounds, relative * pull) if pull < 2**20 else whole[line_row].astype(np.int8)
            change = np.isin(line_row, wrong)
            out[change] = again[change]
            if pull >= 2**20:
                break
            pull *= 2
        return [out[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def _expected(self, x: np.ndarray, live: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Expected feature and transition counts under the model, by forward-backward."""
        score = x @ self.emit
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[0] = score[0]
        for t in range(1, len(x)):
            n = live[t]
            forward[t, :n] = score[t, :n] + np.logaddexp.reduce(forward[t - 1, :n, :, None] + self.move, axis=1)
        for t in range(len(x) - 2, -1, -1):
            n = live[t + 1]
            backward[t, :n] = np.logaddexp.reduce(self.move + (score[t + 1, :n] + backward[t + 1, :n])[:, None, :], axis=2)
        whole = np.logaddexp.reduce(backward[0] + forward[0], axis=1)
        emit, move = np.zeros_like(self.emit), np.zeros((2, 2))
        for t, n in enumerate(live):
            at = np.exp(forward[t, :n] + backward[t, :n] - whole[:n, None])
            emit += x[t, :n].T @ at
            if t:
                pair = forward[t - 1, :n, :, None] + self.move + (score[t, :n] + backward[t, :n])[:, None, :]
                move += np.exp(pair - whole[:n, None, None]).sum(0)
        return emit, move

    def decode(self, features: np.ndarray, bounds: np.ndarray, tilt: np.ndarray | None = None) -> np.ndarray:
        """Viterbi: the best label sequence of every row's lines; ties go to content. `tilt` is added to
        the score of content."""
        score = features @ self.emit
        if tilt is not None:
            score[:, CONTENT] += tilt
        sizes = np.diff(bounds)
        order = np.argsort(-sizes, kind="stable")
        start, sizes = bounds[:-1][order], sizes[order]
        labels = np.zeros(len(features), np.int8)
        back = np.zeros((len(features), 2), np.int8)
        best = np.zeros((len(order), 2))
        live = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), "left")
        for t, n in enumerate(live):
            at = start[:n] + t
            if t == 0:
                best[:n] = score[at]
                continue
            from_0, from_1 = best[:n, 0, None] + self.move[0], best[:n, 1, None] + self.move[1]
            back[at] = from_1 >= from_0
            best[:n] = np.maximum(from_0, from_1) + score[at]
        last = best[:, 1] >= best[:, 0]
        now = last.astype(np.int8)
        for t in range(len(live) - 1, -1, -1):
            n = live[t]
            at = start[:n] + t
            labels[at] = now[:n]
            now[:n] = back[at, now[:n]]
        return labels


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS) -> Crf:
    """A CRF from at most `most` labelled documents of at most `FIT_LINES` lines."""
    chosen = B.sample(labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality")), most)
    known = B.chosen_texts(docs, chosen)

    def lines(group: pa.RecordBatch) -> pa.RecordBatch:
        x = L.scan(*T.texts(group.column("text")))
        f = L.line_features(x).astype(np.float32)
        fits = (np.diff(x.lines) > 0) & (np.diff(x.lines) <= FIT_LINES)
        words = np.diff(x.line_words).astype(np.int32)
        rows, sizes = ([v[a:b].tobytes() if ok else None for a, b, ok in zip(x.lines[:-1], x.lines[1:], fits, strict=True)] for v in (f, words))
        return pa.record_batch({"quality": group.column("quality").cast(pa.int32()), "features": pa.array(rows, pa.binary()), "words": pa.array(sizes, pa.binary())})

    rows = B.over_groups(known, lines, "quality int, features binary, words binary").where("features is not null").collect()
    if not rows:
        return Crf.all_content()
    rows.sort(key=lambda r: (r.quality, bytes(r.features)))
    width = len(L.LINE_FEATURES)
    features = [np.frombuffer(r.features, np.float32).reshape(-1, width).astype(float) for r in rows]
    words = [np.frombuffer(r.words, np.int32).astype(np.int64) for r in rows]
    return Crf.fit_documents(features, words, [int(r.quality > 0) for r in rows])


def judge(docs: DataFrame, model: Crf, share: float = CONTENT_SHARE) -> DataFrame:
    """Base counts and the verdict for every document, over its whole text."""

    def work(group: pa.RecordBatch) -> pa.RecordBatch:
        x = L.scan(*T.texts(group.column("text")))
        out = L.base_counts(x)
        labels = model.decode(L.line_features(x), x.lines)
        content = T.sums_by_row(np.diff(x.line_words) * labels, x.lines)
        n = out["n_words"]
        failed = (n < MIN_WORDS) | (100 * out["n_repeat_words"] > 50 * n)
        out |= {"base_failed": failed, "kept": ~failed & (content >= share * n), "n_lines": np.diff(x.lines), "n_content_words": content}
        return pa.record_batch({"doc_id": group.column("doc_id"), **{k: pa.array(v) for k, v in out.items()}})

    return B.over_groups(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), work, RESULT)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = B.read(spark, sf_dir, "documents")
    return judge(docs, fit(docs, B.read(spark, sf_dir, "labels")))
