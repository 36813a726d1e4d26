"""run() of the corpus pipeline against a plain version, on a folder of small tables."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from colweave.llm.subwords import Encoder

P = pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaked_id long, later_id long, row_key long, mix_copy string"
EN = "the river and stone of a valley with garden window over letter summer".split()
DE = "der Fluß und Stein im Tal mit Garten Fenster über Brief Sommer".split()


def sentences(rng, words, n):
    return " ".join(rng.choice(words) + rng.choice(list("abcdefgh")) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.default_rng(30)
    texts = [sentences(rng, DE if i % 3 == 0 else EN, int(rng.integers(30, 90))) for i in range(240)]
    items = [sentences(rng, EN, 40) for _ in range(3)]
    rows = [(i, t, "de" if i % 3 == 0 else "en", f"s{i % 3}" if i % 5 else None) for i, t in enumerate(texts)]
    near = texts[7].split()
    near[3] = "other"
    rows += [
        (1000, texts[3], "de", "s0"), (1001, " ".join(near), "en", "s1"), (1001, " ".join(near), "en", "s1"), (1002, texts[9], None, None),
        (1003, texts[11] + " " + items[0], "en", "s1"), (1004, " ".join(items[1].split()[20:] + ["x"] + items[1].split()[:20]), "en", "s2"),
        (1005, "12 34 !", "en", "s1"), (1006, None, "de", "s1"), (1007, "", None, "s2"),
        (None, texts[5], "en", "s1"), (None, texts[20] + " " + items[2], "en", "s1"), (None, sentences(rng, EN, 50), "en", "s1"),
    ]
    alone = sentences(rng, EN, 60)
    rows += [(None, alone, "en", "s0"), (None, alone, "en", "s0")]
    path = tmp_path_factory.mktemp("corpus")
    full = [(i, t, lang, s, len(t or ""), k, k % 7, k, f"m{k}") for k, (i, t, lang, s) in enumerate(rows)]
    spark.createDataFrame(full, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, t) for k, t in enumerate(items)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows, items


def shingles(text):
    w = WORD.findall(text.lower())
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}


def poisson_count(rate, doc_id):
    u = int(hashlib.md5(f"42|{'' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16) / 2**52
    k, p, total = 0, math.exp(-rate), math.exp(-rate)
    while total <= u:
        k += 1
        p *= rate / k
        total += p
    return k


def plain(rows, items):
    """Rows that each stage keeps, and how often the mixing repeats each."""
    kept = [r for r in rows if r[1] and re.search(r"[^\W\d_]", r[1])]
    # near-duplicates: of documents with ids, the least id of a class; a row without id if none with one is near
    sets = [shingles(r[1]) for r in kept]
    parent = list(range(len(kept)))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0))
    for x, i in enumerate(order):
        for j in order[:x]:
            same_id = kept[i][0] is not None and kept[i][0] == kept[j][0]
            if same_id or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)), key=order.index)
                parent[b] = a
    kept = [r for i, r in enumerate(kept) if root(i) == i or (r[0] is not None and kept[root(i)][0] == r[0])]
    tokens = lambda t: re.findall(r"[^\W_]+", t.lower())

    def holds(text, item):
        words, wanted = tokens(text), tokens(item)
        runs = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        covered = {k + j for k in range(len(wanted) - 4) if tuple(wanted[k : k + 5]) in runs for j in range(5)}
        return len(covered) >= 0.5 * len(wanted)

    kept = [r for r in kept if not any(holds(r[1], i) for i in items)]
    size = collections.Counter()
    for r in kept:
        size[r[3]] += len(r[1].encode())
    rates = {s: sum(size.values()) / len(size) / n for s, n in size.items()}
    return [r for r in kept for _ in range(poisson_count(rates[r[3]], r[0]))]


def test_run_equals_a_plain_version(spark, folder):
    path, rows, items = folder
    want = plain(rows, items)
    assert 150 < len(want) < 400
    got = sorted(corpus_pipeline.run(spark, path).collect(), key=lambda r: r.start)
    encode = Encoder(P.path("byte_bpe_50k.json")).tokenizer.encode
    ids = lambda t: [*encode(t, add_special_tokens=False).ids, 2]
    as_rows = [(i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ((r[0], ids(r[1])) for r in want)]
    assert sorted(map(str, as_rows)) == sorted(str((r.doc_id, r.n_tokens, r.ids_crc32)) for r in got)
    # the files follow each other without gap, in mixed order: neither by id nor copy beside copy
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()
    order = [r.doc_id for r in got]
    repeats = len(order) - len(set(order))
    beside = sum(a == b for a, b in zip(order, order[1:], strict=False))
    assert repeats > 40 and beside < 8
    known = [i for i in order if i is not None]
    assert sum(a < b for a, b in zip(known, known[1:], strict=False)) < 0.65 * len(known)


def test_stages_keep_columns_and_take_effect(spark, folder, tmp_path):
    path, rows, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, path)
        assert out.columns == columns, name
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if name == "language id":
            assert docs.where("doc_id in (1005, 1006, 1007)").count() == 0
            assert docs.count() == len(rows) - 3
        if name == "near-duplicates":
            assert docs.where("doc_id in (1000, 1001, 1002)").count() == 0
            assert docs.where("doc_id is null").count() == 3
            assert docs.where("doc_id = 7 and leaked_id = 7 and mix_copy = 'm7'").count() == 1
        if name == "decontamination":
            assert docs.where("doc_id in (1003, 1004)").count() == 0
            assert docs.where("doc_id is null").count() == 2


def test_empty_corpus_passes_through(spark, folder, tmp_path):
    path, _, _ = folder
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    none = spark.read.parquet(f"{path}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.known_language(spark, none, path).count() == 0
