"""Language-model scoring: a causal self-attention model over subword ids, and a word baseline.

Both score the words of a text, A-Z in lower case, and one end. The baseline is the smoothed
frequency of each word in the training documents. The model sees the words, joined by single blanks,
as subword ids of a public tokenizer. The most frequent ids are classes of their own, the others
share classes by form and frequency; one attention layer with a small feed-forward layer predicts
the next class from the classes before it, and an id's share of its class comes from the counts of
all training documents. So the scores are logarithms of a proper probability over all ids.

Windows of WINDOW ids overlap: each scores its last STRIDE ids, so every id is scored once, with at
least WINDOW - STRIDE ids of context where the text has them; what is before a text's start is
masked. All windows of all training documents are read once, in ROUNDS parts. In the first BEGUN of
them the documents are dealt over learners: each takes small steps of Adam from the common layers on all
windows of its documents, and their layers are averaged, weighted by the places they have seen. The
other parts give one step each from the sum of their gradients over all tasks. Few documents are gone
over several times by their learners. Counts cover all documents too.

Word counts reach the texts by blocks of documents: each block's distinct words are joined with the
counts and come back to the block. A frequent word is one row a block, and no task holds more than
a block.

Edge cases: null and empty texts are one end; rows with equal ids are scored each; a null id counts
as empty text for the split and is kept; without training documents all counts are 0 and the model
is uniform over classes; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave.llm import tables as B
from colweave.llm import textops as T
from colweave.llm.token_files import TOKENIZER, encoder
from colweave.session import cut_lineage, fresh_path

VOCABULARY = 50_257
CLASSES, SINGLE = 192, 160
WINDOW, STRIDE = 48, 32
WIDTH, HIDDEN = 16, 32
FIT_STEPS, FIT_BATCH = 900, 96
#: Parts of the training documents, and how many of them begin the layers by small steps of learners.
ROUNDS, BEGUN = 24, 20
FIT_RATE, ROUND_RATE = 0.01, 0.003
#: Learners of a round: up to ROUND_TASKS if each gets LEARNER_BYTES of text, and one more for ROUND_BYTES.
ROUND_TASKS, LEARNER_BYTES, ROUND_BYTES = 8, 64 << 10, 4 << 20
#: Documents whose ids have fewer bytes than this together are gone over again, at most MOST_PASSES times.
PASS_BYTES, MOST_PASSES = 16 << 20, 8
#: Parts of the gradient that are summed apart.
PARTS = 16
SMOOTH = 0.1
BLOCK_BYTES = 24 << 20
#: Distinct words that a counting task holds before it sends them on.
MOST_WORDS = 1_000_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: The key of the end among the keys of words, none of which is empty.
END = int(np.array([xxhash.xxh3_64_intdigest(b"")], np.uint64).view(np.int64)[0])
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


class Words:
    """The words of a group of texts: hashes, bounds by row, and the normal form in bytes."""

    def __init__(self, column):
        data, offsets = T.texts(column)
        data = _LOWER[data]
        at, to = T.words(data, offsets)
        self.bounds = T.per_row(at, offsets)
        self.hashes = T.keys(data, at, to).view(np.int64)
        self._parts = data, at, to

    def normal(self) -> tuple[np.ndarray, np.ndarray]:
        """Words joined by single blanks, as bytes and row offsets."""
        data, at, to = self._parts
        lead = np.ones(len(at), np.int64)
        lead[self.bounds[:-1][np.diff(self.bounds) > 0]] = 0
        size = to - at + lead
        ends = np.cumsum(size)
        out = data[np.minimum(np.repeat(at - lead - (ends - size), size) + np.arange(size.sum()), max(len(data) - 1, 0))] if len(at) else np.zeros(0, np.uint8)
        out[(ends - size)[lead > 0]] = 0x20
        return out, np.append(0, ends)[self.bounds]


def _count(batches: Iterator[pa.RecordBatch], encode: bool = True) -> Iterator[pa.RecordBatch]:
    """Counts of words (kind 0) and, if asked to `encode`, of subword ids (kind 1) in a task's texts."""
    index, counts = T.HashIndex(18), np.zeros(0, np.int64)
    keys: list[np.ndarray] = []
    ids = np.zeros(VOCABULARY, np.int64)
    ends = 0

    def send() -> pa.RecordBatch:
        return _counted(0, np.concatenate([np.zeros(0, np.int64), *keys]), counts)

    for batch in batches:
        for group in T.groups(batch):
            words = Words(group.column("text"))
            ends += group.num_rows
            if encode:
                ids += np.bincount(encoder(TOKENIZER).encode(*words.normal())[0], minlength=VOCABULARY)
            number = index.find(words.hashes.view(np.uint64))
            new = np.unique(words.hashes[number < 0])
            if len(new):
                index.add(new.view(np.uint64))
                keys.append(new)
                number = index.find(words.hashes.view(np.uint64))
            counts = np.pad(counts, (0, index.size - len(counts)))
            counts += np.bincount(number, minlength=index.size)
            if index.size > MOST_WORDS:
                yield send()
                index, keys, counts = T.HashIndex(18), [], np.zeros(0, np.int64)
    yield send()
    yield _counted(0, np.array([END]), np.array([ends]))
    yield _counted(1, np.flatnonzero(ids), ids[ids > 0])


def _counted(kind: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch({"kind": pa.array(np.full(len(keys), kind, np.int32)), "key": pa.array(keys), "n": pa.array(counts)})


def counts(docs: DataFrame, encode: bool = True) -> DataFrame:
    """(kind, key, n): counts of words and, if asked to `encode`, of subword ids over all given documents."""
    found = docs.select("text").mapInArrow(lambda batches: _count(batches, encode), "kind int, key long, n long")
    return found.groupBy("kind", "key").agg(F.sum("n").alias("n")).where("n > 0")


class Attention:
    """The trained model. `kind`: class of each id; `share`: log of an id's part of its class."""

    def __init__(self, p: dict[str, np.ndarray], kind: np.ndarray, share: np.ndarray, end_share: float):
        self.p, self.kind, self.share, self.end_share = p, kind, share, end_share

    @classmethod
    def begin(cls, counted: np.ndarray) -> Attention:
        """Classes from the counts of all ids; class 0 is the end, CLASSES stands for the start."""
        counted = counted.astype(np.float64)
        order = np.argsort(-counted, kind="stable")
        kind = np.zeros(len(counted), np.int64)
        kind[order[:SINGLE]] = np.arange(1, SINGLE + 1)
        rest = order[SINGLE:]
        left = CLASSES - SINGLE - 1
        mass = np.cumsum(counted[rest] + SMOOTH)
        kind[rest] = SINGLE + 1 + np.minimum((mass * left / mass[-1]).astype(int), left - 1)
        weight = counted + SMOOTH
        share = np.log(weight) - np.log(np.maximum(np.bincount(kind, weight, CLASSES), SMOOTH))[kind]
        draw = np.random.default_rng(3)
        shape = {"embed": (CLASSES + 1, WIDTH), "place": (WINDOW, WIDTH), "q": (WIDTH, WIDTH), "k": (WIDTH, WIDTH), "v": (WIDTH, WIDTH), "o": (WIDTH, WIDTH), "in": (WIDTH, HIDDEN), "in_bias": (HIDDEN,), "out": (HIDDEN, WIDTH), "head": (WIDTH, CLASSES), "bias": (CLASSES,)}
        p = {n: (np.zeros(s) if n.endswith("bias") else draw.normal(0, 0.3 if n in ("embed", "place") else s[0] ** -0.5, s)).astype(np.float32) for n, s in shape.items()}
        total = np.bincount(kind, counted, CLASSES) + 1
        p["bias"] = np.log(total / total.sum()).astype(np.float32)
        return cls(p, kind, share.astype(np.float32), 0.0)

    def windows(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        """All windows of all rows: input classes (-1 before the start), targets (ids, -1 for the end,
        -2 beyond it) of the last STRIDE inputs, and the row of each window."""
        inputs = np.diff(bounds) + 1
        many = -(-inputs // STRIDE)
        row = np.repeat(np.arange(len(inputs)), many)
        first = (np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)) * STRIDE
        at = first[:, None] + np.arange(STRIDE - WINDOW, STRIDE)  # input position; input 0 is the start
        size = inputs[row][:, None]
        classes = self.kind[ids] if len(ids) else np.zeros(0, np.int64)
        x = np.where((at > 0) & (at < size), np.append(classes, 0)[np.clip(bounds[:-1][row][:, None] + at - 1, 0, len(ids))], np.where(at == 0, CLASSES, -1))
        at = at[:, -STRIDE:]
        y = np.where(at < size - 1, np.append(ids, 0)[np.clip(bounds[:-1][row][:, None] + at, 0, len(ids))], np.where(at == size - 1, -1, -2))
        return x, y, row

    def forward(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """Hidden states and logits of the last STRIDE places of windows x, by masked attention."""
        p, s = self.p, {}
        s["x"] = p["embed"][x] + p["place"]
        s["tail"] = s["x"][:, -STRIDE:]
        s["q"], s["k"], s["v"] = s["tail"] @ p["q"], s["x"] @ p["k"], s["x"] @ p["v"]
        return self._layers(s, x)

    def tables(self) -> np.ndarray:
        """State, query, key and value of every class at every place, for `lookup`."""
        x = self.p["embed"][:, None] + self.p["place"]
        return np.concatenate([x, *(x @ self.p[n] for n in "qkv")], -1)

    def lookup(self, x: np.ndarray, tables: np.ndarray) -> dict[str, np.ndarray]:
        """As `forward`, with the first layer's products read from tables."""
        got = tables[x, np.arange(WINDOW)]
        state, q, k, v = (got[:, :, i * WIDTH : (i + 1) * WIDTH] for i in range(4))
        return self._layers({"tail": state[:, -STRIDE:], "q": q[:, -STRIDE:], "k": k, "v": v}, x)

    def _layers(self, s: dict[str, np.ndarray], x: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        a = s["q"] @ s["k"].transpose(0, 2, 1) * np.float32(WIDTH**-0.5)
        seen = np.arange(WINDOW) <= np.arange(WINDOW - STRIDE, WINDOW)[:, None]
        a += np.where(seen, np.float32(0), np.float32(-1e9))
        a += np.where(x >= 0, np.float32(0), np.float32(-1e9))[:, None, :]
        a -= a.max(-1, keepdims=True)
        np.exp(a, a)
        a /= a.sum(-1, keepdims=True)
        s["a"], s["c"] = a, a @ s["v"]
        flat = lambda a: a.reshape(-1, a.shape[-1])
        shape = s["tail"].shape
        h = flat(s["tail"]) + flat(s["c"]) @ p["o"]
        f = np.maximum(h @ p["in"] + p["in_bias"], 0)
        g = h + f @ p["out"]
        s["h"], s["f"], s["g"] = h.reshape(shape), f.reshape(*shape[:2], -1), g.reshape(shape)
        s["logits"] = g @ p["head"] + p["bias"]
        return s

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = FIT_STEPS, batch: int = FIT_BATCH, rate: float = 0.01) -> Attention:
        """Adam on the cross-entropy of next classes."""
        draw = np.random.default_rng(9)
        moments = self.moments()
        for step in range(1, steps + 1):
            pick = draw.integers(len(x), size=batch)
            self.step(self._gradient(x[pick], y[pick]), moments, step, rate * (1 - step / (steps + 1)) + rate / 50)
        return self

    def moments(self) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
        return {n: np.zeros_like(a) for n, a in self.p.items()}, {n: np.zeros_like(a) for n, a in self.p.items()}

    def step(self, grads: dict[str, np.ndarray], moments: tuple[dict[str, np.ndarray], dict[str, np.ndarray]], step: int, rate: float) -> None:
        m, v = moments
        for n, g in grads.items():
            m[n] = 0.9 * m[n] + 0.1 * g
            v[n] = 0.99 * v[n] + 0.01 * g * g
            self.p[n] = (self.p[n] - rate * (m[n] / (1 - 0.9**step)) / (np.sqrt(v[n] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)

    def gradient_sum(self, ids: np.ndarray, bounds: np.ndarray, most: int = 64) -> tuple[int, np.ndarray]:
        """Number of places that count in all windows of the rows, and the sum of their gradients, all
        layers in one array."""
        x, y, _ = self.windows(ids, bounds)
        n, out = 0, np.zeros(sum(a.size for a in self.p.values()))
        for k in range(0, len(x), most):
            here = int((y[k : k + most] >= -1).sum())
            grads = self._gradient(x[k : k + most], y[k : k + most])
            n += here
            out += here * self.flat(grads)
        return n, out

    def flat(self, layers: dict[str, np.ndarray]) -> np.ndarray:
        """All layers in one array."""
        return np.concatenate([layers[name].ravel() for name in self.p])

    def split(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """The layers of such an array."""
        cuts = np.cumsum([a.size for a in self.p.values()])[:-1]
        return {n: part.reshape(self.p[n].shape) for n, part in zip(self.p, np.split(flat, cuts), strict=True)}

    def _gradient(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, s = self.p, self.forward(x)
        counted = (y >= -1).ravel()
        target = np.where(y >= 0, self.kind[np.maximum(y, 0)], 0).ravel()
        d = np.exp(s["logits"] - s["logits"].max(-1, keepdims=True))
        d /= d.sum(-1, keepdims=True)
        d[np.arange(len(d)), target] -= 1
        d *= (counted / max(counted.sum(), 1))[:, None].astype(np.float32)
        flat = lambda a: a.reshape(-1, a.shape[-1])
        g = {"head": flat(s["g"]).T @ d, "bias": d.sum(0)}
        dg = (d @ p["head"].T).reshape(s["g"].shape)
        g["out"] = flat(s["f"]).T @ flat(dg)
        df = (dg @ p["out"].T) * (s["f"] > 0)
        g["in"], g["in_bias"] = flat(s["h"]).T @ flat(df), flat(df).sum(0)
        dh = dg + df @ p["in"].T
        g["o"] = flat(s["c"]).T @ flat(dh)
        dc = dh @ p["o"].T
        da = dc @ s["v"].transpose(0, 2, 1)
        dv = s["a"].transpose(0, 2, 1) @ dc
        da = s["a"] * (da - (da * s["a"]).sum(-1, keepdims=True)) * np.float32(WIDTH**-0.5)
        dq, dk = da @ s["k"], da.transpose(0, 2, 1) @ s["q"]
        g["q"], g["k"], g["v"] = flat(s["tail"]).T @ flat(dq), flat(s["x"]).T @ flat(dk), flat(s["x"]).T @ flat(dv)
        dx = dk @ p["k"].T + dv @ p["v"].T
        dx[:, -STRIDE:] += dh + dq @ p["q"].T
        dx *= (x >= 0)[:, :, None]
        g["place"] = dx.sum(0)
        at = np.where(x >= 0, x, CLASSES).ravel()  # before the start dx is 0
        g["embed"] = np.stack([np.bincount(at, column, CLASSES + 1) for column in flat(dx).T], 1)
        return g

    def score(self, ids: np.ndarray, bounds: np.ndarray, most: int = 80) -> np.ndarray:
        """log10 probability of every row's ids and its end."""
        x, y, row = self.windows(ids, bounds)
        out = np.zeros(len(bounds) - 1)
        slope, tables = np.abs(self.p["head"]).sum(0).max(), self.tables()
        for k in range(0, len(x), most):
            state = self.lookup(x[k : k + most], tables)
            logits = state["logits"]
            target = y[k : k + most].ravel()
            kind = np.where(target >= 0, self.kind[np.maximum(target, 0)], 0)
            own = logits[np.arange(len(logits)), kind]
            if np.abs(state["g"]).max() * slope > 60:  # else exp cannot overflow
                top = logits.max(-1, keepdims=True)
                logits, own = logits - top, own - top[:, 0]
            np.exp(logits, logits)
            got = own - np.log(logits.sum(-1)) + np.where(target >= 0, self.share[np.maximum(target, 0)], 0)
            got = np.where(target > -2, got, 0).astype(np.float64).reshape(-1, STRIDE).sum(1)
            out += np.bincount(row[k : k + most], got, len(out))
        return out / np.log(10)


def train(docs: DataFrame, counted: DataFrame, begun: int = BEGUN) -> Attention:
    """Classes and shares from the counts of all training documents, layers from all their windows: the
    first `begun` rounds by learners, the others by summed gradients. The ids are counted as they are
    stored, so `counted` may have words alone."""
    stored = in_rounds(docs)
    model = Attention.begin(id_counts(stored))
    return fit_all(begin_layers(docs, model, begun, stored), docs, begun, stored)


def id_counts(stored: DataFrame) -> np.ndarray:
    """How often each subword id is in the stored documents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = np.zeros(VOCABULARY, np.int64)
        for batch in batches:
            ids += np.bincount(np.frombuffer(T.texts(batch.column("ids"))[0].tobytes(), np.uint16), minlength=VOCABULARY)
        yield _counted(1, np.flatnonzero(ids), ids[ids > 0])

    seen = np.zeros(VOCABULARY)
    for r in stored.select("ids").mapInArrow(work, "kind int, key long, n long").groupBy("key").agg(F.sum("n").alias("n")).collect():  # at most the vocabulary
        seen[r.key] = r.n
    return seen


class Learner:
    """Layers and moments that go on by small steps on some documents."""

    def __init__(self, model: Attention, moments: tuple[dict[str, np.ndarray], dict[str, np.ndarray]], step: int):
        self.model = Attention(dict(model.p), model.kind, model.share, model.end_share)
        self.moments, self.step, self.places = tuple(dict(m) for m in moments), step, 0
        self.draw = np.random.default_rng(step)

    def take(self, ids: np.ndarray, bounds: np.ndarray, rate: float, passes: int) -> None:
        """Steps on all windows of the rows, `passes` times over."""
        x, y, _ = self.model.windows(ids, bounds)
        self.places += int((y >= -1).sum())
        for _ in range(passes):
            order = self.draw.permutation(len(x))
            for k in range(0, len(order), FIT_BATCH):
                self.step += 1
                pick = order[k : k + FIT_BATCH]
                self.model.step(self.model._gradient(x[pick], y[pick]), self.moments, self.step, rate)

    def flat(self) -> np.ndarray:
        """Layers, moments and the number of steps in one array."""
        return np.concatenate([*(self.model.flat(a) for a in (self.model.p, *self.moments)), [self.step]]).astype(np.float64)


def begin_layers(docs: DataFrame, model: Attention, rounds: int = BEGUN, stored: DataFrame | None = None) -> Attention:
    """The layers after the learners' steps on all windows of the first rounds of documents (as `in_rounds` has
    `stored` them)."""
    stored = in_rounds(docs) if stored is None else stored
    size = stored.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    passes = min(MOST_PASSES, 1 + PASS_BYTES // size) if size else 1
    moments, step = model.moments(), 0
    for k in range(rounds):
        n, total = learn(stored.where(F.col("round") == k), model, moments, step, FIT_RATE * (1 - k / ROUNDS), passes)
        if n:
            *layers, steps = np.split(total / n, [sum(a.size for a in model.p.values()) * i for i in (1, 2, 3)])
            model.p, *moments = ({name: a.astype(np.float32) for name, a in model.split(part).items()} for part in layers)
            step = round(float(steps[0]))
    return model


def learn(rows: DataFrame, model: Attention, moments: tuple[dict[str, np.ndarray], dict[str, np.ndarray]], step: int, rate: float, passes: int) -> tuple[int, np.ndarray]:
    """Places in all rows (ids, part), and the sum of what the learners of the parts end with, weighted by
    their places. A part is one file."""
    sent = rows.sparkSession.sparkContext.broadcast((model, moments))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, learner = None, None
        for batch in batches:
            parts = batch.column("part").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1), len(parts)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a < b and part != parts[a]:
                    if learner and learner.places:
                        yield _parts_of(learner.places, learner.places * learner.flat())
                    part, learner = parts[a], Learner(*sent.value, step)
                for group in T.groups(batch.slice(a, b - a), "ids"):
                    learner.take(*_ids(group), rate, passes)
        if learner and learner.places:
            yield _parts_of(learner.places, learner.places * learner.flat())

    try:
        return _summed(rows.select("ids", "part").mapInArrow(work, SUMS))
    finally:
        sent.unpersist()


def _encode(group: pa.RecordBatch) -> pa.RecordBatch:
    ids, bounds = encoder(TOKENIZER).encode(*Words(group.column("text")).normal())
    ids = ids.astype(np.uint16)  # the vocabulary is smaller than 2**16
    return pa.record_batch({"doc_id": group.column("doc_id"), "ids": pa.array([ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())})


def _ids(group: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids and row bounds of stored rows."""
    data, offsets = T.texts(group.column("ids"))
    return np.frombuffer(data.tobytes(), np.uint16).astype(np.int64), offsets // 2


def in_rounds(docs: DataFrame) -> DataFrame:
    """The ids of all documents, each in one round and one part of it, in one file a part and in an order that
    depends on ids and texts alone."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = min(ROUND_TASKS, 1 + size // (ROUNDS * LEARNER_BYTES)) + size // (ROUNDS * ROUND_BYTES)
    keyed = docs.select(F.coalesce("doc_id", F.monotonically_increasing_id()).alias("doc_id"), "text")  # rows without an id are spread too
    rows = B.over_groups(keyed, _encode, "doc_id long, ids binary").withColumn("h", F.xxhash64("doc_id", "ids"))
    rows = rows.select("ids", "h", F.pmod("h", F.lit(ROUNDS)).cast("int").alias("round"), F.pmod(F.xxhash64("h"), F.lit(tasks)).alias("part"))
    path = fresh_path(docs.sparkSession, "rounds")
    rows.repartition("round", "part").sortWithinPartitions("round", "part", "h", "ids").drop("h").write.partitionBy("round", "part").parquet(path)
    return docs.sparkSession.read.schema("ids binary, round int, part long").parquet(path)


SUMS = "part int, n long, sums binary"


def _parts_of(n: int, total: np.ndarray) -> pa.RecordBatch:
    parts = [a.tobytes() for a in np.array_split(total, PARTS)]
    return pa.record_batch({"part": pa.array(range(PARTS), pa.int32()), "n": pa.array([n] * PARTS, pa.int64()), "sums": pa.array(parts, pa.binary())})


def _sum(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(v, np.float64) for v in sorted(table.column("sums").to_pylist()))
    return pa.table({"part": table.column("part").slice(0, 1), "n": pa.array([sum(table.column("n").to_pylist())], pa.int64()), "sums": pa.array([total.tobytes()], pa.binary())})


def _summed(found: DataFrame) -> tuple[int, np.ndarray]:
    """The sums over all tasks of what `_parts_of` sent, 0 and an empty array if nothing was."""
    rows = sorted(found.groupBy("part").applyInArrow(_sum, SUMS).collect(), key=lambda r: r.part)  # at most PARTS rows
    return (rows[0].n if rows else 0), np.concatenate([np.zeros(0), *(np.frombuffer(r.sums, np.float64) for r in rows)])


def gradient(rows: DataFrame, model: Attention) -> tuple[int, np.ndarray]:
    """`gradient_sum` over all rows (ids)."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            for group in T.groups(batch, "ids"):
                here, sums = sent.value.gradient_sum(*_ids(group))
                n, total = n + here, sums if total is None else total + sums
        if n:
            yield _parts_of(n, total)

    n, total = _summed(rows.select("ids").mapInArrow(work, SUMS))
    sent.unpersist()
    return n, total if n else np.zeros(sum(a.size for a in model.p.values()))


def fit_all(model: Attention, docs: DataFrame, begun: int = 0, stored: DataFrame | None = None) -> Attention:
    """The layers after one step for each round of all documents but the first `begun` ones."""
    stored, moments, step = in_rounds(docs) if stored is None else stored, model.moments(), 0
    for k in range(begun, ROUNDS):
        n, total = gradient(stored.where(F.col("round") == k), model)
        if n:
            step += 1
            model.step(model.split(total / n), moments, step, ROUND_RATE * (1 - k / ROUNDS))
    return model


def _vocabulary(table: pa.Table) -> pa.Table:
    """The distinct words of a block."""
    found = [np.unique(Words(g.column("text")).hashes) for batch in table.to_batches() for g in T.groups(batch)]
    keys = np.unique(np.concatenate([np.array([END]), *found]))
    return pa.table({"block": pa.array(np.full(len(keys), table.column("block")[0].as_py(), np.int64)), "key": pa.array(keys)})


def score(docs: DataFrame, model: Attention, counted: DataFrame) -> DataFrame:
    """Every document (doc_id, text, held_out) with its counts and both scores."""
    total = counted.where("kind = 0").agg(F.sum("n"), F.count("*")).first()
    n_train, level = int(total[0] or 0), np.log10((total[0] or 0) + SMOOTH * (total[1] + 1))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    block = F.pmod(F.xxhash64("doc_id", F.substring("text", 1, 64)), F.lit(1 + size // BLOCK_BYTES))
    keyed = docs.select("doc_id", "text", "held_out", block.alias("block"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(texts: pa.Table, known: pa.Table) -> pa.Table:
        keys = known.column("key").to_numpy()
        order = np.argsort(keys)
        keys, c = keys[order], known.column("n").to_numpy()[order]
        logs = np.log10(c + SMOOTH) - level
        end = np.searchsorted(keys, END)
        out = []
        for batch in texts.to_batches():
            for g in T.groups(batch):
                words = Words(g.column("text"))
                at = np.searchsorted(keys, words.hashes)
                base = T.sums_by_row(logs[at], words.bounds) + logs[end]
                found = T.sums_by_row(c[at] > 0, words.bounds) + int(c[end] > 0)
                scored = sent.value.score(*encoder(TOKENIZER).encode(*words.normal()))
                out.append(pa.record_batch({"doc_id": g.column("doc_id"), "held_out": g.column("held_out"), "n_tokens": pa.array(np.diff(words.bounds) + 1), "n_known": pa.array(found), "train_tokens": pa.array(np.full(g.num_rows, n_train)), "base_score": pa.array(base), "score": pa.array(scored)}))
        return pa.Table.from_batches(out)

    words = keyed.groupBy("block").applyInArrow(_vocabulary, "block long, key long")
    known = words.join(counted.where("kind = 0").select("key", "n"), "key", "left").select("block", "key", F.coalesce("n", F.lit(0)).alias("n"))
    return keyed.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(work, RESULT)


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = B.read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), (B.remainder(10) == 0).alias("held_out"))
    training = docs.where(~F.col("held_out"))
    counted = cut_lineage(counts(training, encode=False))
    return score(docs, train(training, counted), counted)
