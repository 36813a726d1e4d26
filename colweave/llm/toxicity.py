"""Toxicity by weak supervision: many lexicon and pattern voters, a generative model of how they err and
go together, and a linear classifier trained on the posterior labels of that model.

Terms of the lexicon are beginnings of words (4 to 8 bytes of lower-cased letters; a shorter word as a
whole), mined from a bounded sample of labelled documents by the G2 statistic of their presence. Each
term and each pattern (exclamation marks, capitals, echoed words) becomes a voter: it votes toxic where
it stands more often, by 100 words, than its threshold, clean where it stands at all but not as often,
and abstains elsewhere. Voters that are not precise on the sample are dropped.

The label model knows no labels: a hidden class, the accuracy of each voter, and how the errors of
voters go together along a tree (the strongest dependence first), fitted by expectation maximization on
the votes over a bounded sample of documents. So a voter's accuracy is learned from how it agrees with
others, and voters that only repeat each other do not count twice. Its posteriors train a logistic
regression on how often terms and patterns stand in a text, which scores every whole text.

Edge cases: null and empty texts have no words and get the score of none; null ids are scored but not
learned from; an id counts once in the samples, however often it comes, with its highest label; null
labels are ignored; without both kinds of label every score is 0; repeated rows score alike; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave.llm import tables as B
from colweave.llm import textops as T
from colweave.session import cut_lineage

#: Labelled documents of each class that terms and voters are chosen on, at most, and documents that the
#: label model and the classifier are fitted on.
FIT_LABELLED, FIT_DOCUMENTS = 4000, 8000
#: Terms of the classifier and voters of the label model, at most.
TERMS, VOTERS = 400, 64
#: Least number of toxic documents with a term, least precision of a voter.
LEAST_SUPPORT, LEAST_PRECISION = 4, 0.85
#: Thresholds that a voter is given, in hits a 100 words.
THRESHOLDS = (0.0, 0.15, 0.3, 0.6, 1.0, 1.5, 2.5)
#: Share of toxic documents among those that no voter votes on.
SILENT_SHARE = 0.01
LENGTHS = (4, 5, 6, 7, 8)
PATTERNS = ("bangs", "capitals", "echoes")
ABSTAIN, TOXIC, CLEAN = 0, 1, 2
CUT = 0.5
RESULT = "doc_id long, held_out boolean, score double, predicted int"
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[0x80:] = True
_IS_LETTER[ord("a") : ord("z") + 1] = True
_IS_UPPER = np.zeros(256, bool)
_IS_UPPER[ord("A") : ord("Z") + 1] = True
_MASKS = {n: np.uint64((1 << 8 * n) - 1) for n in LENGTHS}


class Words(NamedTuple):
    """Words of all rows: their first 8 bytes as a number, their sizes, and where rows begin."""

    heads: np.ndarray
    sizes: np.ndarray
    bounds: np.ndarray


def read_words(column) -> Words:
    data, offsets = T.texts(pc.utf8_lower(column))
    at, to = T.runs(_IS_LETTER[data], offsets)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    heads, sizes = np.zeros(len(at), np.uint64), to - at
    for k in range(8):
        heads |= np.where(sizes > k, padded[at + k], 0).astype(np.uint64) << np.uint64(8 * k)
    return Words(heads, sizes, T.per_row(at, offsets))


def starts_of(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Words that have a term of this length, by number, and their terms. A word of no more than 8
    bytes is its own term of length 8, so shorter lengths are for longer words only."""
    if length == 8:
        return np.arange(len(words.heads)), words.heads
    longer = np.flatnonzero(words.sizes > length)
    return longer, words.heads[longer] & _MASKS[length]


def term_presence(group: pa.RecordBatch) -> pa.RecordBatch:
    """Of a group with labels (`toxic`): in how many toxic and clean rows each term stands. Length 0
    counts the rows."""
    words = read_words(group.column("text"))
    toxic = group.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
    row = T.rows_of(words.bounds)
    out = [(np.zeros(1, np.int32), np.zeros(1, np.uint64), np.array([toxic.sum()]), np.array([(~toxic).sum()]))]
    for length in LENGTHS:
        at, term = starts_of(words, length)
        pairs = np.unique(np.stack([term, row[at].astype(np.uint64)], 1), axis=0)
        keys, group_of = np.unique(pairs[:, 0], return_inverse=True)
        bad = np.bincount(group_of, toxic[pairs[:, 1].astype(np.int64)], len(keys)).astype(np.int64)
        out.append((np.full(len(keys), length, np.int32), keys, bad, np.bincount(group_of, minlength=len(keys)) - bad))
    length, keys, bad, good = (np.concatenate(x) for x in zip(*out, strict=True))
    return pa.record_batch({"length": pa.array(length, pa.int32()), "term": pa.array(keys.view(np.int64)), "bad": pa.array(bad, pa.int64()), "good": pa.array(good, pa.int64())})


def mine_terms(known: DataFrame, most: int = TERMS) -> tuple[list[tuple[int, int]], int, int]:
    """Terms (length, number) that tell toxic from clean rows best, and how many rows are of each kind."""
    counts = B.over_groups(known, term_presence, "length int, term long, bad long, good long").groupBy("length", "term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    counts = cut_lineage(counts)
    rows = counts.where("length = 0").agg(F.sum("bad"), F.sum("good")).first()
    n_bad, n_good = int(rows[0] or 0), int(rows[1] or 0)
    if not n_bad or not n_good:
        return [], n_bad, n_good
    one = F.lit(1.0)

    def part(seen, n, share):
        return F.when(seen > 0, seen * F.log(seen / (n * share))).otherwise(0.0)

    bad, good = F.col("bad") * one, F.col("good") * one
    has, lacks = (bad + good) / (n_bad + n_good), 1 - (bad + good) / (n_bad + n_good)
    g2 = part(bad, n_bad, has) + part(good, n_good, has) + part(n_bad - bad, n_bad, lacks) + part(n_good - good, n_good, lacks)
    telling = counts.where((F.col("length") > 0) & (F.col("bad") >= LEAST_SUPPORT) & (bad / n_bad > 2 * good / n_good))
    best = telling.select("length", "term", g2.alias("g2")).orderBy(F.desc("g2"), "length", "term").limit(most).collect()
    return [(r.length, r.term) for r in best], n_bad, n_good


def densities(group: pa.RecordBatch, terms: list[tuple[int, int]]) -> np.ndarray:
    """Per row, hits a 100 words of each term and then of each pattern."""
    words = read_words(group.column("text"))
    n_rows, row = len(words.bounds) - 1, T.rows_of(words.bounds)
    n = np.maximum(np.diff(words.bounds), 1)
    out = np.zeros((n_rows, len(terms) + len(PATTERNS)))
    for length in LENGTHS:
        mine = np.array([k for k, t in enumerate(terms) if t[0] == length], np.int64)
        if not len(mine):
            continue
        keys = np.array([terms[k][1] for k in mine], np.int64).view(np.uint64)
        order = np.argsort(keys)
        at, term = starts_of(words, length)
        place = np.minimum(np.searchsorted(keys[order], term), len(keys) - 1)
        hit = keys[order][place] == term
        cell = row[at[hit]] * out.shape[1] + mine[order][place[hit]]
        out += np.bincount(cell, minlength=out.size).reshape(out.shape)
    data, offsets = T.texts(group.column("text"))

    def per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return T.sums_by_row(flags.astype(np.int64), bounds)

    echo = np.zeros(len(words.heads), bool)
    echo[1:] = (words.heads[1:] == words.heads[:-1]) & (words.sizes[1:] == words.sizes[:-1])
    out[:, -3] = per_row(data == 0x21, offsets)
    out[:, -2] = per_row(_IS_UPPER[data], offsets)
    out[:, -1] = per_row(echo, words.bounds)
    return out * (100.0 / n)[:, None]


class Voters(NamedTuple):
    """Columns of the densities and the threshold of each."""

    columns: np.ndarray
    thresholds: np.ndarray

    def vote(self, x: np.ndarray) -> np.ndarray:
        seen = x[:, self.columns]
        return np.where(seen > self.thresholds, TOXIC, np.where(seen > 0, CLEAN, ABSTAIN)).astype(np.int8)


def choose_voters(x: np.ndarray, toxic: np.ndarray, weight: np.ndarray, most: int = VOTERS) -> Voters:
    """The most telling voters of enough precision, each with its best threshold; voters that vote alike
    on the whole sample count once. `weight` undoes how the classes were sampled."""
    found = []
    for c in range(x.shape[1]):
        best = None
        for t in THRESHOLDS:
            votes = x[:, c] > t
            bad, good = weight[votes & toxic].sum(), weight[votes & ~toxic].sum()
            if (votes & toxic).sum() < LEAST_SUPPORT or bad < LEAST_PRECISION * (bad + good):
                continue
            gain = bad - 4 * good
            if best is None or gain > best[0]:
                best = (gain, c, t)
        if best is not None:
            found.append(best)
    found.sort(key=lambda f: (-f[0], f[1]))
    kept, seen = [], set()
    for _, c, t in found:
        mark = (x[:, c] > t).tobytes()
        if mark not in seen and len(kept) < most:
            seen.add(mark)
            kept.append((c, t))
    return Voters(np.array([c for c, _ in kept], np.int64), np.array([t for _, t in kept], float))


class LabelModel:
    """How often each voter is right, and how its errors go with those of its parent in a tree of voters.

    `right[k, u]` is the probability that voter k, where it votes, is right, given that its parent does
    not vote (u = 0), is right (1) or is wrong (2). Whether a voter votes at all says nothing of the class
    but through this: that any voter votes. So voters for one language do not speak about texts of others.
    The share of toxic documents is given, and a voter alone is taken to be as precise as it was chosen to be.
    """

    def __init__(self, share: float):
        self.share = share

    def fit(self, votes: np.ndarray, rounds: int = 20) -> LabelModel:
        many = votes.shape[1]
        some = (votes != ABSTAIN).any(1)
        covered = max(some.mean(), 1e-6)
        self.voted_share = float(np.clip((self.share - SILENT_SHARE * (1 - covered)) / covered, 0.02, 0.95))
        votes = votes[some].astype(np.int64)
        ahead = (votes == TOXIC).sum(1) - (votes == CLEAN).sum(1)
        q = np.where(ahead > 0, 0.9, np.where(ahead < 0, 0.1, 0.5))
        self.parent = np.full(many, -1)
        for step in range(rounds):
            # 0 silent, 1 right, 2 wrong, if the document is clean and if it is toxic
            states = [np.where(votes == ABSTAIN, 0, np.where(votes == y, 1, 2)) for y in (CLEAN, TOXIC)]
            if step in (0, 4, 8):
                self.parent = self._tree(states, q)
            self._count(states, q)
            q = self._posterior(states)
        return self

    @staticmethod
    def _tree(states: list[np.ndarray], q: np.ndarray) -> np.ndarray:
        """Chow-Liu: the maximum spanning tree by mutual information of being right, where both vote."""
        n, many = states[0].shape
        joint = np.zeros((many, 2, many, 2))
        for s, w in zip(states, (1 - q, q), strict=True):
            hot = (s[:, :, None] == np.array([1, 2])).astype(float).reshape(n, many * 2)
            joint += ((hot * w[:, None]).T @ hot).reshape(many, 2, many, 2)
        p = joint.transpose(0, 2, 1, 3)
        both = np.maximum(p.sum((2, 3), keepdims=True), 1e-9)
        apart = p.sum(3, keepdims=True) * p.sum(2, keepdims=True) / both
        weight = np.where(p > 0, p * np.log(np.maximum(p, 1e-300) / np.maximum(apart, 1e-300)), 0).sum((2, 3)) / n
        weight += both[:, :, 0, 0] / n * 1e-3  # of voters that never err, those that vote together
        parent = np.full(many, -1)
        best, by, inside = np.full(many, 1e-9), np.full(many, -1), np.zeros(many, bool)
        for _ in range(many):
            k = int(np.where(inside, -np.inf, best).argmax())
            inside[k], parent[k] = True, by[k]
            nearer = ~inside & (weight[k] > best)
            best[nearer], by[nearer] = weight[k][nearer], k
        return parent

    def _count(self, states: list[np.ndarray], q: np.ndarray) -> None:
        """Rates of being right, with pseudo-counts: a voter is expected to be right, and one whose parent
        votes to be as right as that."""
        many = states[0].shape[1]
        self.right = np.zeros((many, 3))
        for k in range(many):
            seen = np.zeros((3, 3))
            for s, w in zip(states, (1 - q, q), strict=True):
                above = s[:, self.parent[k]] if self.parent[k] >= 0 else np.zeros(len(q), np.int64)
                seen += np.bincount(above * 3 + s[:, k], w, 9).reshape(3, 3)
            for u, prior in enumerate((0.8, 0.9, 0.3)):
                self.right[k, u] = (seen[u, 1] + 10 * prior) / (seen[u, 1] + seen[u, 2] + 10)
            # a voter alone was chosen to be as precise, and is no worse where its parent is right
            self.right[k, :2] = np.maximum(self.right[k, :2], (LEAST_PRECISION, 0.5))

    def _posterior(self, states: list[np.ndarray]) -> np.ndarray:
        k = np.arange(states[0].shape[1])
        log = []
        for s in states:
            above = np.where(self.parent >= 0, s[:, np.maximum(self.parent, 0)], 0)
            p = self.right[k, above]
            log.append(np.where(s == 0, 0, np.where(s == 1, np.log(p), np.log1p(-p))).sum(1))
        z = log[1] - log[0] + np.log(self.voted_share / (1 - self.voted_share))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(toxic | votes) of every row."""
        votes = votes.astype(np.int64)
        states = [np.where(votes == ABSTAIN, 0, np.where(votes == y, 1, 2)) for y in (CLEAN, TOXIC)]
        return np.where((votes != ABSTAIN).any(1), self._posterior(states), SILENT_SHARE)


def inputs(x: np.ndarray) -> np.ndarray:
    """Densities as inputs of the classifier: whether a term stands at all, and how often, up to 3."""
    return np.concatenate([x > 0, np.minimum(x, 3) / 3, np.ones((len(x), 1))], 1).astype(np.float64)


class Classifier(NamedTuple):
    terms: list[tuple[int, int]]
    weights: np.ndarray

    @classmethod
    def fit(cls, terms: list[tuple[int, int]], x: np.ndarray, q: np.ndarray, rounds: int = 600, rate: float = 0.1, decay: float = 2e-5) -> Classifier:
        """Logistic regression on posterior labels q, by Adam over all rows."""
        z = inputs(x)
        w, m, v = np.zeros(z.shape[1]), np.zeros(z.shape[1]), np.zeros(z.shape[1])
        w[-1] = np.log(max(q.mean(), 1e-4) / max(1 - q.mean(), 1e-4))
        held = np.ones_like(w)
        held[-1] = 0  # the constant is not held back
        for step in range(1, rounds + 1):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            grad = z.T @ (q - p) / len(z) - decay * held * w
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
            w = w + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return cls(terms, w)

    def score(self, group: pa.RecordBatch) -> np.ndarray:
        if not len(self.weights):
            return np.zeros(group.num_rows)
        return 1 / (1 + np.exp(-np.clip(inputs(densities(group, self.terms)) @ self.weights, -30, 30)))


class Model(NamedTuple):
    classifier: Classifier
    label_model: LabelModel | None
    voters: Voters | None


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Voters, label model and classifier from samples of the given documents and labels."""
    ids = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    sizes = {r.toxic: r["count"] for r in ids.groupBy("toxic").count().collect()}
    marked = B.sample(ids.where("toxic = 1"), FIT_LABELLED).union(B.sample(ids.where("toxic = 0"), FIT_LABELLED))
    plain = B.sample(docs.where("doc_id is not null").select("doc_id"), FIT_DOCUMENTS).distinct().withColumn("plain", F.lit(True))
    chosen = marked.join(plain, "doc_id", "full").select("doc_id", "toxic", F.coalesce("plain", F.lit(False)).alias("plain"))
    known = cut_lineage(B.chosen_texts(docs, chosen))
    terms, n_bad, n_good = mine_terms(known.where("toxic is not null"))
    if not terms:
        return Model(Classifier([], np.zeros(0)), None, None)

    def measure(group: pa.RecordBatch) -> pa.RecordBatch:
        rows = [r.tobytes() for r in densities(group, terms).astype(np.float32)]
        return pa.record_batch({"doc_id": group.column("doc_id"), "toxic": group.column("toxic"), "plain": group.column("plain"), "x": pa.array(rows, pa.binary())})

    rows = B.over_groups(known, measure, "doc_id long, toxic int, plain boolean, x binary").collect()  # bounded by the samples
    rows.sort(key=lambda r: r.doc_id)
    x = np.stack([np.frombuffer(r.x, np.float32) for r in rows]).astype(float)
    has = np.array([r.toxic is not None for r in rows])
    toxic = np.array([bool(r.toxic) for r in rows])[has]
    weight = np.where(toxic, sizes.get(1, 0) / max(n_bad, 1), sizes.get(0, 0) / max(n_good, 1))
    voters = choose_voters(x[has], toxic, weight)
    if not len(voters.columns):
        return Model(Classifier([], np.zeros(0)), None, None)
    plain_x = x[np.array([r.plain for r in rows])]
    votes = voters.vote(plain_x)
    model = LabelModel(sizes.get(1, 0) / max(sum(sizes.values()), 1)).fit(votes)
    return Model(Classifier.fit(terms, plain_x, model.posterior(votes)), model, voters)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Score and verdict of every row of docs (doc_id, text, held_out)."""

    def work(group: pa.RecordBatch) -> pa.RecordBatch:
        s = model.classifier.score(group)
        return pa.record_batch({"doc_id": group.column("doc_id"), "held_out": group.column("held_out"), "score": pa.array(s), "predicted": pa.array((s >= CUT).astype(np.int32))})

    return B.over_groups(docs, work, RESULT)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = B.read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    docs = docs.withColumn("held_out", B.remainder(5) == 0)
    labels = B.read(spark, sf_dir, "labels").where(B.remainder(5) != 0)
    return score(docs, fit(docs.where(~F.col("held_out")).select("doc_id", "text"), labels))
