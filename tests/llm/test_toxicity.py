"""Toxicity: voters, label model and classifier on made tables, and the query's held-out accuracy."""

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from colweave.llm import toxicity as X

GOOD = "river stone valley garden window letter summer winter bridge island copper silver".split()
BAD = {"en": "vileword grimname slurring".split(), "xx": "zürnkopf schmäh".split()}


def made(n, rng):
    """Texts of two languages; every fifth is toxic, and a few clean ones have one such word."""
    rows, toxic = [], []
    for i in range(n):
        lang = "xx" if i % 3 == 0 else "en"
        words = [w + ("ö" if lang == "xx" else "") for w in rng.choice(GOOD, int(rng.integers(20, 160)))]
        bad = i % 5 == 0
        hits = int(rng.integers(3, 6)) * max(1, len(words) // 40) if bad else int(rng.random() < 0.02)
        for w in rng.choice(BAD[lang], hits):
            words[int(rng.integers(len(words)))] = w.capitalize() if rng.random() < 0.3 else w
        rows.append((i, " ".join(words) + "."))
        toxic.append(int(bad))
    return rows, toxic


def held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0


def test_densities_equal_a_plain_count():
    texts = [None, "", "Idiot! idiot idiotic, ID", "ümlaut ÜMLAUT üml", "abcdefghij abcdefgh abcdefg", "1 2 !! 3"]
    terms = ["idiot", "idio", "ümla", "abcdefgh", "abcdefg", "abcd", "id"]
    as_term = lambda t: (len(t.encode()) if t in ("idio", "abcd", "ümla") else 8, int(np.frombuffer(t.encode().ljust(8, b"\0"), np.int64)[0]))
    keys = [as_term(t) for t in terms]
    got = X.densities(pa.record_batch({"text": pa.array(texts)}), keys)
    for r, t in enumerate(texts):
        words = [w.encode() for w in re.findall(r"[^\W\d_]+", (t or "").lower())]
        n = max(len(words), 1)
        for k, (term, (length, _)) in enumerate(zip(terms, keys, strict=True)):
            b = term.encode()
            hits = sum(w[:8] == b if length == 8 else len(w) > length and w.startswith(b) for w in words)
            assert got[r, k] == pytest.approx(100 * hits / n), (t, term)
        echoes = sum(a == b for a, b in zip(words, words[1:], strict=False))
        assert got[r, -3:].tolist() == pytest.approx([100 * (t or "").count("!") / n, 100 * len(re.findall("[A-Z]", t or "")) / n, 100 * echoes / n])


def simulated(n=6000):
    """Votes of voters of known accuracy, the last three of them copies of one with few changes."""
    rng = np.random.default_rng(3)
    toxic = rng.random(n) < 0.3
    right = [0.9, 0.85, 0.8, 0.75, 0.8]
    votes = np.zeros((n, 7), np.int8)
    for k, p in enumerate(right):
        says = np.where(rng.random(n) < p, toxic, ~toxic)
        votes[:, k] = np.where(rng.random(n) < 0.6, np.where(says, X.TOXIC, X.CLEAN), X.ABSTAIN)
    for k in (5, 6):
        votes[:, k] = np.where(rng.random(n) < 0.97, votes[:, 4], X.ABSTAIN)
    return votes, toxic, right


def test_label_model_learns_accuracies_and_dependence_without_labels():
    votes, toxic, right = simulated()
    model = X.LabelModel(0.3).fit(votes)
    some = (votes != X.ABSTAIN).any(1)
    q = model.posterior(votes)
    assert ((q > 0.5) == toxic)[some].mean() > 0.85
    # copies hang on each other in the tree, and then add next to nothing
    chained = {k for k in (4, 5, 6) if model.parent[k] in (4, 5, 6)}
    assert len(chained) == 2
    assert all(model.right[k, 1] > 0.95 and model.right[k, 2] < 0.2 for k in chained)
    assert all(abs(model.right[k, 0] - right[k]) < 0.12 for k in range(4))
    # one lone voter and its copies are hardly surer than the voter alone
    alone, copied = np.zeros((1, 7), np.int8), np.zeros((1, 7), np.int8)
    alone[0, 4] = X.TOXIC
    copied[0, 4:] = X.TOXIC
    assert model.posterior(copied)[0] - model.posterior(alone)[0] < 0.15
    assert model.posterior(np.zeros((1, 7), np.int8))[0] == X.SILENT_SHARE


def test_query_tells_held_out_documents_apart(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows, toxic = made(900, rng)
    edges = [(2000, None), (2001, ""), (2002, " \n"), (None, rows[0][1]), (5, rows[5][1]), (2003, "vileword " * 4000), (2004, "...")]
    docs = [(i, t, None, None) for i, t in rows + edges]
    schema = "doc_id long, text string, score string, toxic string"
    spark.createDataFrame(docs, schema).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, y) for i, y in enumerate(toxic) if i % 7] + [(3, None), (None, 1), (4, 0), (4, 0), (99999, 1)]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = X.op13_toxicity(spark, str(tmp_path)).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == held_out(r.doc_id) for r in got)
    unseen = [r for r in got if r.doc_id is not None and r.doc_id < 900 and r.held_out]
    assert np.mean([r.predicted == toxic[r.doc_id] for r in unseen]) > 0.97
    found = {r.doc_id: r.predicted for r in got}
    assert [found[i] for i in (2000, 2001, 2002, 2003, 2004, None)] == [0, 0, 0, 1, 0, toxic[0]]
    assert len({r.score for r in got if r.doc_id == 5}) == 1


def test_fitting_takes_one_row_an_id_and_covers_edges(spark):
    rows, toxic = made(300, np.random.default_rng(6))
    docs = spark.createDataFrame(rows + [rows[1]] * 500, "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    many, once = (X.fit(d, labels) for d in (docs, docs.distinct()))
    assert many.classifier.terms == once.classifier.terms and np.allclose(many.classifier.weights, once.classifier.weights)
    none = X.fit(docs, labels.where("toxic = 0"))
    table = docs.limit(3).withColumn("held_out", F.lit(True))
    assert [r.score for r in X.score(table, none).collect()] == [0.0] * 3
    assert [r.score for r in X.score(table, X.fit(docs.limit(0), labels)).collect()] == [0.0] * 3
    assert X.score(table.limit(0), many).count() == 0
