"""Periodic runs against a plain search over all periods."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from colweave.llm import periodic_runs as R

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words):
    """Every stretch of two periods or more that cannot be extended, with its smallest period."""
    best, n = {}, len(words)
    for p in range(1, n // 2 + 1):
        x = 0
        while x < n - p:
            if words[x] != words[x + p]:
                x += 1
                continue
            begin = x
            while x < n - p and words[x] == words[x + p]:
                x += 1
            if x - begin >= p:
                best.setdefault((begin, x + p), p)
    return sorted((s, e, p) for (s, e), p in best.items())


def expected(doc_id, text, planted):
    words = WORD.findall(text or "")
    n = len(words)
    if planted:
        h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a, original = g % n, list(words)
            p = 1 + (n - a) // (3 + g % 8)
            for i in range(a, n):
                words[i] = original[a + (i - a) % p]
    found = [(s, e - s, p) for s, e, p in plain_runs(words) if e - s >= max(6, 4 * p)]
    found.sort(key=lambda r: (r[0], r[2]))
    gone = {k for s, m, p in found for k in range(s + p, s + m)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{m},{p}\n" for s, m, p in found)
    left = " ".join(w for k, w in enumerate(words) if k not in gone)
    four = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, n, len(found), *four, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


def made_texts():
    rng = np.random.default_rng(21)
    out = [None, "", " \t\n ", "one", "la " * 5, "la " * 6, "la " * 700, "a b " * 3 + "a", "Ünï cödé " * 9, "x" * 500]
    for _ in range(60):  # few letters: runs of all kinds, nested and overlapping
        out.append(" ".join(rng.choice(list("abc")[: rng.integers(1, 4)], int(rng.integers(1, 90)))))
    for _ in range(25):  # repeats of a random piece, cut and disturbed
        piece = rng.choice(list("abcdefgh"), int(rng.integers(1, 40))).tolist()
        words = (piece * int(rng.integers(2, 9)))[int(rng.integers(0, 3)) :]
        words[int(rng.integers(len(words)))] = "z"
        out.append(" ".join(["p", "q", *words, "r"]))
    fib = ["a", "b"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    out.append(" ".join(fib[-1]))
    thue = "a"
    while len(thue) < 256:
        thue += thue.translate(str.maketrans("ab", "ba"))
    out += [" ".join(thue), " ".join(thue * 5)]
    # words that only a weak hash takes for equal
    turned = thue.translate(str.maketrans("ab", "ba"))
    long = [x * 8 for x in (thue, turned)]
    out += [f"{long[0]} {long[1]} " * 4, f"{long[0]} {long[0]} {long[1]} {long[0]} {long[0]} {long[0]}"]
    return out


def test_all_runs_equal_a_plain_search():
    texts = made_texts()
    words = [WORD.findall(t or "") for t in texts]
    kinds = {w: k for k, w in enumerate(sorted({w for ws in words for w in ws}))}
    bounds = np.cumsum([0, *map(len, words)])
    found = R.runs(np.array([kinds[w] for ws in words for w in ws]), bounds)
    got = list(zip(*(x.tolist() for x in found), strict=True))
    want = [(s + b, e + b, p) for ws, b in zip(words, bounds, strict=False) for s, e, p in plain_runs(ws)]
    assert sorted(got) == sorted(want) and len(want) > 500


@pytest.mark.parametrize("batch", [R.BATCH, 7])
def test_batches_do_not_change_runs(batch, monkeypatch):
    monkeypatch.setattr(R, "BATCH", batch)
    words = np.array([0, 1] * 40 + [2] + [0, 1, 1] * 9)
    got = sorted(zip(*(x.tolist() for x in R.runs(words, np.array([0, len(words)]))), strict=True))
    assert got == sorted(plain_runs(words.tolist()))


@pytest.mark.parametrize("planted", [False, True])
def test_detection_equals_a_plain_search(spark, planted):
    texts = made_texts()
    rows = [(i, t, "x", i) for i, t in enumerate(texts)] + [(None, "la " * 9, "y", 1), (3, "one", "z", 2), (6, texts[6], "z", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, period long").repartition(3)
    got = [tuple(r) for r in R.detect(docs, R.with_planted_periods if planted else None).collect()]
    want = [expected(r[0], r[1], planted) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(1 for r in want if r[2]) > 30
    assert R.detect(docs.limit(0)).count() == 0


def test_query_reads_whole_documents(spark, tmp_path):
    rows = [(i, f"w{i} " + "b c " * (i % 7) + f"v{i}") for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in R.op12_periodic_runs(spark, str(tmp_path)).collect())
    assert got == [expected(*r, True) for r in rows]


def test_a_text_of_one_word_repeated_ends_soon():
    n = 60_000
    group = pa.record_batch({"doc_id": pa.array([1]), "text": pa.array(["la " * n])})
    out = R.describe(group).to_pylist()[0]
    assert (out["n_runs"], out["start"], out["length"], out["period"], out["exponent_milli"]) == (1, 0, n, 1, 1000 * n)
