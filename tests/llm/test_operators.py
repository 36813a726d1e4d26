"""The operators against brute force, round trips and edge cases, on small tables."""

import collections
import hashlib
import itertools
import math
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from colweave.llm import decontaminate, language_id, lm_score, mixing, near_dups, quality_classifier, quality_rules
from colweave.llm import set_join, subwords, suffix_dedup, textops, token_files, url_filter
from colweave.llm.subwords import Encoder

P = pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, sig int, bucket int, text_1 string"


def sentence(rng, n, words="alder birch cedar elm fir hazel larch maple oak pine rowan spruce willow yew".split()):
    return " ".join(rng.choice(words) + rng.choice(list("abcdefghij")) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(4)
    out = [sentence(rng, int(n)) for n in rng.integers(1, 120, 60)]
    long = sentence(rng, 9000)
    out += [None, "", " \n\t ", "...", out[3], out[3], out[5] + " " + out[6], long, long[:400] + "x" + long[400:], "é" * 300, "<|endoftext|> it's 'll", "a b c"]
    words = out[30].split()
    out += [" ".join(words[:10] + ["new"] + words[11:]), "line one\nline two\nline one\n\nline one", "la " * 200]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    langs = ["en", "de", None]
    rows = [(i, t, langs[i % 3], f"s{i % 4}" if i % 7 else None, 1, "x", 1, 2, "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark, texts):
    return spark.createDataFrame([(i, i % 2, i % 5 == 0 and 1 or 0) for i in range(0, len(texts), 2)] + [(1, None, None), (0, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def removed(rows):
    seen, out = set(), {}
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                gone[p : p + 100] = True
            seen.add(b[p : p + 100])
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1)
        out[i] = (len(b), int(gone.sum()), len(edge), hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest())
    return out


@pytest.mark.parametrize("hot", [2000, 1])
def test_suffix_dedup_equals_brute_force(docs, texts, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == removed(enumerate(texts))


def test_suffix_dedup_of_rows_that_share_an_id(spark, texts):
    t = "abcdefghij" * 30
    rows = [(1, t), (1, t), (None, t), (2, t), (None, None), (1, texts[0] + t), (3, texts[5]), (None, texts[5] * 3), (3, texts[5])]
    rows += [(7, x) for x in texts] + [(None, x) for x in texts[:20]]
    got = [tuple(r)[:5] for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    want = [(rows[k][0], *v) for k, v in removed((k, x) for k, (_, x) in enumerate(rows)).items()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_byte_words_order_like_bytes():
    rng = np.random.default_rng(2)
    text = rng.integers(0, 3, 400).astype(np.uint8) * 127
    begin = np.concatenate([np.arange(360), [5, 5, 17]])
    for n in (7, 8, 31, 40):
        got = suffix_dedup.ranks(*suffix_dedup.byte_words(text, begin, n))
        cut = [text[b : b + n].tobytes() for b in begin]
        order = {x: k for k, x in enumerate(sorted(set(cut)))}
        assert got.tolist() == [order[x] for x in cut]


def test_segments_of_a_very_long_text_do_not_depend_on_pieces(monkeypatch):
    data, offsets = textops.texts(pa.array([sentence(np.random.default_rng(1), 3000)]))
    whole = suffix_dedup.segments(data, offsets)
    monkeypatch.setattr(suffix_dedup, "PIECE", 4000)
    cut = suffix_dedup.segments(data, offsets)
    at = lambda s: {p + k: b for b, _, _, p, n in zip(*s, strict=True) for k in range(n)}
    assert at(whole) == at(cut) and len(at(whole)) == len(data) - 99


def test_url_parts_rules_and_mined_rules(spark):
    rows = [
        (0, "HTTP://WWW.Example.COM/en/x?a=1"), (1, "http://a.example.com/en/x"), (2, "http://b.net/es/"), (3, "http://c.org/en"), (4, None),
        (5, "no scheme"), (6, "http://d.com"), (7, "https://e.org#/x?y"), (8, "ftp://f.net/fr/1#z"), (9, "http://c.org/en"),
    ]
    bad = [(100 + i, f"http://x{i}.bad.org/p/{i}") for i in range(30)] + [(200 + i, f"http://y{i}.good.org/p/{i}") for i in range(30)]
    pages = spark.createDataFrame(rows + bad, "page_id long, url string")
    labels = spark.createDataFrame([(100 + i, 0, 0) for i in range(20)] + [(200 + i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in url_filter.judge(pages, url_filter.mine(pages, labels)).collect()}
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(10)] == [
        ("www.example.com", "/en/x", "www.example.com/en/", "allow"), ("a.example.com", "/en/x", "example.com/en/", "block"),
        ("b.net", "/es/", "net/es/", "block"), ("c.org", "/en", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("d.com", "", None, "allow"), ("e.org", "", None, "allow"), ("f.net", "/fr/1", "net/fr/", "block"), ("c.org", "/en", None, "allow"),
    ]
    assert all(got[100 + i].verdict == "block" and "bad" in got[100 + i].mined_rule for i in range(30))
    assert all(got[200 + i].verdict == "allow" for i in range(30))
    assert url_filter.judge(pages.limit(0), url_filter.mine(pages.limit(0), labels)).count() == 0


def blocked_by_any_subset(pages, bad):
    """Pages some subset of whose tokens is on enough labelled pages, enough of them bad."""
    out = set()
    for page, mine in pages.items():
        for k in range(1, len(mine) + 1):
            for some in itertools.combinations(sorted(mine), k):
                on = [p for p in bad if set(some) <= pages[p]]
                n = sum(bad[p] for p in on)
                if n >= url_filter.MIN_PAGES and n / len(on) >= url_filter.MIN_CONFIDENCE:
                    out.add(page)
    return out


def test_mined_rules_block_what_the_rules_of_all_subsets_do(spark):
    rng = np.random.default_rng(5)
    words = np.array(["aa", "bb", "cc", "dd", "ee"])
    urls = {i: "http://h.io/" + "/".join(w for w, on in zip(words, rng.random(5) < 0.5, strict=True) if on for w in ([w, w + "x"] if w in "aa bb" else [w])) for i in range(160)}
    urls |= {200: "http://h.io/aax/bb", 201: "http://other.io/aax/bbx/q", 202: "http://h.io/cc", 203: "http://z.net/a"}
    bad = {i: int(("/aa" in urls[i]) and ("/bb" in urls[i]) and rng.random() < 0.9 or rng.random() < 0.2) for i in range(120)}
    pages = spark.createDataFrame(list(urls.items()), "page_id long, url string")
    labels = spark.createDataFrame([(i, 1 - b, 0) for i, b in bad.items()], "doc_id long, quality int, toxic int")
    sets = {r.page_id: set(r.t) for r in pages.select("page_id", url_filter.tokens(F.col("url")).alias("t")).collect()}
    mined = url_filter.mine(pages, labels)
    found = {r.page_id for r in url_filter.judge(pages, mined).collect() if r.verdict == "block"}
    assert found == blocked_by_any_subset(sets, bad) and {200, 201} <= found and not {202, 203} & found
    names = {r.token: r.name for r in mined.names.collect()}
    assert names["path:aax"] == names["path:aa"] and names["path:cc"] != names["path:dd"]


def test_a_long_url_in_several_copies_is_one_item(spark):
    far = "http://spam.io/" + "/".join("w" + chr(97 + i % 26) + chr(97 + i // 26) for i in range(60))
    pages = spark.createDataFrame([(i, far) for i in range(12)] + [(20 + i, f"http://n{i}.io/ok") for i in range(12)], "page_id long, url string")
    labels = spark.createDataFrame([(i, 0, 0) for i in range(10)] + [(20 + i, 1, 0) for i in range(10)], "doc_id long, quality int, toxic int")
    mined = url_filter.mine(pages, labels)
    assert 0 < mined.rules.count() < 10
    assert {r.page_id for r in url_filter.judge(pages, mined).collect() if r.verdict == "block"} == set(range(12))


def test_mixing_follows_poisson_and_weights(spark, docs, none):
    big = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("ten chars!").alias("text"), F.when(F.col("id") < 4500, "a").when(F.col("id") < 5900, "b").alias("source"))
    n = collections.Counter(r.source for r in mixing.mix(big, {"a": 1, "b": 2, None: 1}).select("source").collect())
    for source, share in (("a", 0.25), ("b", 0.5), (None, 0.25)):
        assert abs(n[source] - 6000 * share) < 5 * math.sqrt(6000 * share)
    once = mixing.mix(docs).collect()
    assert once == mixing.mix(docs).collect() and [r.mix_order for r in once] == sorted(r.mix_order for r in once)
    assert set(docs.columns) < set(mixing.mix(docs).columns) and mixing.mix(none).count() == 0


def test_a_tiny_source_is_drawn_in_parts_as_the_sql_says(spark):
    rows = [(i, "z" * 4000, "big") for i in range(100)] + [(500, "z" * 10, "tiny"), (501, "z" * 30, "tiny"), (501, "z" * 30, "tiny"), (None, "z", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    rate = {r.mix_source: r.mix_rate for r in mixing.rates(docs).collect()}
    table = {r.mix_source: r for r in mixing.distributions(mixing.rates(docs)).collect()}
    assert rate["tiny"] > 1900 and rate[None] > 130000 and table["big"].mix_parts == 1
    assert all(len(r.mix_cdf) < mixing.MEAN + 10 * math.sqrt(mixing.MEAN) + 23 and r.mix_cdf[-1] > 1 - 1e-9 for r in table.values())
    mixed = mixing.mix(docs)
    n = collections.Counter(r.source for r in mixed.select("source").collect())
    assert abs(n["tiny"] - 3 * rate["tiny"]) < 9 * math.sqrt(3 * rate["tiny"])  # the repeated row draws the same twice
    assert abs(n[None] - rate[None]) < 5 * math.sqrt(rate[None]) and abs(n["big"] - 100 * rate["big"]) < 5 * math.sqrt(100 * rate["big"])
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist([dict(zip(("doc_id", "text", "source"), r, strict=True)) for r in rows], pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("source", pa.string())])))
    key = lambda r: (r[2], r[3])
    theirs = con.sql(f"SELECT doc_id, source, mix_copy, mix_order FROM ({mixing.MIX_SQL})").fetchall()
    ours = [tuple(r) for r in mixed.select("doc_id", "source", "mix_copy", "mix_order").collect()]
    assert sorted(ours, key=key) == sorted(theirs, key=key)


def test_mixing_keeps_columns_named_like_its_own(docs):
    own = ("mix_source", "mix_cdf", "mix_copies", "mix_copy", "mix_order")
    named = docs.select("*", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in own])
    plain, kept, only = mixing.mix(docs).collect(), mixing.mix(named).collect(), mixing.repeat(named)
    assert [(r.doc_id, r.mix_copy, r.mix_order) for r in kept] == [(r.doc_id, r.mix_copy, r.mix_order) for r in plain]
    assert all(r[c] == f"{c}{r.doc_id}" for r in kept for c in own[:3])
    rows = only.collect()
    assert only.columns == named.columns and [r.doc_id for r in rows] == [r.doc_id for r in plain]
    assert all(r[c] == f"{c}{r.doc_id}" for r in rows for c in own)


def test_tiling_finds_moved_passages(spark, docs, texts, none):
    item = texts[20].split()
    assert len(item) > 30
    moved = " ".join(item[15:] + ["x"] + item[:15]).upper().replace(" ", ", ")
    part = " ".join(item[: len(item) // 3])
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(900, moved), (901, part), (None, moved)], "doc_id long, text string"))
    items = spark.createDataFrame([(7, texts[20]), (8, "..."), (9, None), (10, "two words")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.covered, r.n_tokens) for r in decontaminate.pairs(more, items).collect()}
    assert set(got) == {(20, 7), (900, 7), (None, 7)} and got[900, 7] == (len(item), len(item))
    clashing = more.withColumns({"leaked_id": F.lit(1), "c0": F.lit("x")})
    kept = decontaminate.clean(clashing, items)
    assert kept.columns == clashing.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {*range(len(texts)), 901} - {20}
    assert decontaminate.pairs(none, items).count() == 0 and decontaminate.pairs(more, items.limit(0)).count() == 0


def test_tiles_are_greedy_and_do_not_overlap():
    item = np.arange(60, dtype=np.uint64)
    text = np.concatenate([item[50:60], item[20:33], item[0:20], item[0:20]])
    assert decontaminate.tile(text, item, 5) == [(23, 0, 20), (10, 20, 13), (0, 50, 10)]


def test_lm_base_score_is_exact_and_model_is_a_distribution(spark, docs, texts):
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("held_out", F.col("doc_id") % 4 == 0)
    training = rows.where(~F.col("held_out"))
    counted = lm_score.counts(training).cache()
    model = lm_score.Attention.begin(np.ones(lm_score.VOCABULARY))
    got = {r.doc_id: r for r in lm_score.score(rows, model, counted).collect()}
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    words = {i: [*WORD.findall((t or "").translate(lower)), None] for i, t in enumerate(texts)}
    seen = collections.Counter(w for i, ws in words.items() if i % 4 for w in ws)
    n = sum(seen.values())
    for i, ws in words.items():
        base = sum(math.log10((seen[w] + 0.1) / (n + 0.1 * (len(seen) + 1))) for w in ws)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(ws), sum(seen[w] > 0 for w in ws), n)
        assert got[i].base_score == pytest.approx(base) and got[i].score < 0
    # over all next ids the probabilities of a text of one id and its end sum to at most 1
    ids = np.arange(lm_score.VOCABULARY)
    p = 10.0 ** model.score(ids, np.arange(len(ids) + 1))
    end = 10.0 ** model.score(np.zeros(0, np.int64), np.zeros(2, np.int64))[0]
    assert 0 < p.sum() + end <= 1.0001


def test_lm_layers_learn_from_every_window(spark, docs, texts):
    training = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counted = lm_score.counts(training).cache()
    ids, bounds = lm_score.encoder(lm_score.TOKENIZER).encode(*lm_score.Words(pa.array([t or "" for t in texts])).normal())
    model = lm_score.Attention.begin(np.bincount(ids, minlength=lm_score.VOCABULARY))
    n, total = model.gradient_sum(ids, bounds)
    assert n == len(ids) + len(texts)
    stored = lm_score.in_rounds(training)
    parts = [lm_score.gradient(stored.where(F.col("round") == k), model) for k in range(lm_score.ROUNDS)]
    assert sum(p[0] for p in parts) == n and np.allclose(sum(p[1] for p in parts), total, atol=1e-2)
    x, y, _ = model.windows(ids, bounds)
    whole = model._gradient(x, y)
    assert all(np.allclose(g, whole[name], atol=1e-4) for name, g in model.split(total / n).items())
    # with one document to begin with, the layers still learn from the others
    first = lm_score.begin_layers(training, lm_score.Attention.begin(np.bincount(ids, minlength=lm_score.VOCABULARY)), 1)
    assert lm_score.train(training, counted, 1).score(ids, bounds).sum() > first.score(ids, bounds).sum()


def test_lm_layers_begin_from_all_documents(spark, docs, texts, monkeypatch):
    monkeypatch.setattr(lm_score.B, "sample", lambda *a: pytest.fail("a sample is drawn"))
    training = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ids, _ = lm_score.encoder(lm_score.TOKENIZER).encode(*lm_score.Words(pa.array([t or "" for t in texts])).normal())
    stored = lm_score.in_rounds(training)
    counted = lm_score.id_counts(stored)
    assert counted.tolist() == np.bincount(ids, minlength=lm_score.VOCABULARY).tolist()
    model = lm_score.Attention.begin(counted)
    seen = [lm_score.learn(stored.where(F.col("round") == k), model, model.moments(), 0, 0.01, 1)[0] for k in range(lm_score.ROUNDS)]
    assert sum(seen) == len(ids) + len(texts)
    begun = lm_score.begin_layers(training, lm_score.Attention.begin(counted), lm_score.ROUNDS, stored)
    assert begun.score(ids, np.array([0, len(ids)])).sum() > model.score(ids, np.array([0, len(ids)])).sum()


def test_attention_gradient_and_lookup():
    rng = np.random.default_rng(0)
    model = lm_score.Attention.begin(np.ones(lm_score.VOCABULARY))
    x, y, _ = model.windows(rng.integers(0, 50257, 90), np.array([0, 50, 50, 90]))
    assert np.allclose(model.forward(x)["logits"], model.lookup(x, model.tables())["logits"], atol=1e-4)

    def loss():
        s = model.forward(x)["logits"].astype(np.float64)
        keep = (y >= -1).ravel()
        kind = np.where(y >= 0, model.kind[np.maximum(y, 0)], 0).ravel()
        return (np.log(np.exp(s).sum(1)) - s[np.arange(len(s)), kind])[keep].mean()

    grads = model._gradient(x, y)
    for name in ("q", "k", "v", "o", "in", "out", "head", "place"):
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        old = model.p[name][at]
        model.p[name][at] = old + 1e-2
        up = loss()
        model.p[name][at] = old - 1e-2
        down = loss()
        model.p[name][at] = old
        assert (up - down) / 2e-2 == pytest.approx(grads[name][at], rel=0.1, abs=1e-4), name


def test_quality_scores_separate_and_cover_edges(spark, docs, labels, none):
    rng = np.random.default_rng(2)
    rows = [(i, "lo " * 60 if i % 4 == 0 else sentence(rng, 60) + ".") for i in range(400)]
    table = spark.createDataFrame([*rows, (None, None), (500, "")], "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(300)], "doc_id long, quality int")
    model = quality_classifier.fit(table, marks)
    got = quality_classifier.score(table.withColumn("held_out", F.lit(True)), model).collect()
    assert len(got) == 402 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.predicted == int(r.doc_id % 4 > 0) for r in got if r.doc_id is not None and r.doc_id < 400)
    assert quality_classifier.fit(none, labels).score(np.zeros((2, 1)))[0] == 0.5
    assert quality_classifier.score(docs.withColumn("held_out", F.lit(False)).select("doc_id", "text", "held_out"), model).count() == docs.count()


def test_quality_learns_from_all_labelled_documents(spark):
    rng = np.random.default_rng(6)
    rare = {40, 150, 260}
    rows = [(i, "lo " * 60 if i in rare else sentence(rng, 60) + ".") for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i not in rare)) for i in range(400)], "doc_id long, quality int")
    model = quality_classifier.fit(table, marks, 20)
    got = quality_classifier.score(table.withColumn("held_out", F.lit(True)), model).collect()
    low = max(r.score for r in got if r.doc_id in rare)
    assert low < min(r.score for r in got if r.doc_id not in rare)


def test_quantile_is_exact(spark, monkeypatch):
    monkeypatch.setattr(quality_classifier, "MOST_RANKED", 5)
    monkeypatch.setattr(quality_classifier, "RANGES", 4)
    rng = np.random.default_rng(8)
    values = np.concatenate([rng.normal(0, 1, 300), np.full(200, 0.25), [1e6, -1e6]])
    counted = spark.createDataFrame([(float(v),) for v in values], "value double").groupBy("value").agg(F.count("*").alias("n")).cache()
    for q in (0.0, 0.2, 0.5, 0.61, 1.0):
        assert quality_classifier.quantile(counted, q) == pytest.approx(float(np.quantile(values, q)), abs=1e-12)


def jaccard(a, b):
    def shingles(t):
        w = WORD.findall((t or "").lower())
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_near_duplicate_classes_equal_brute_force(spark, docs, texts, none):
    parent = list(range(len(texts)))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for i in range(len(texts)):
        for j in range(i):
            if jaccard(texts[i], texts[j]) >= 0.8:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    got = {r.doc_id: r.class_id for r in near_dups.classes(docs).collect()}
    assert got == {i: root(i) for i in range(len(texts))}
    assert near_dups.classes(none).count() == 0
    kept = near_dups.first_of_class(docs.withColumn("doc_id", F.when(F.col("doc_id") != 1, F.col("doc_id"))))
    assert kept.columns == docs.columns and kept.where("doc_id is null").count() == 1


def test_large_buckets_are_split_without_losing_classes(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BUCKET", 8)
    rng = np.random.default_rng(8)
    base = sentence(rng, 150).split()
    rows = []
    for i in range(60):
        words = list(base)
        words[int(rng.integers(150))] = f"w{i}"
        rows.append((i, " ".join(words)))
    got = near_dups.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == {0} and len(got) == 60


def test_crowded_buckets_are_joined_exactly(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BUCKET", 8)
    monkeypatch.setattr(set_join, "BLOCK", 16)
    monkeypatch.setattr(set_join, "CHUNK", 64)
    rng = np.random.default_rng(12)
    texts, parent = [], list(range(400))
    for g in range(2):
        base = sentence(rng, 90).split()
        for i in range(200):  # similarities between members go from 0.3 to 1
            words = list(base)
            for k in rng.integers(90, size=int(rng.integers(0, 4))):
                words[k] = f"w{g}x{rng.integers(6)}"
            texts.append(" ".join(words))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for i in range(400):
        for j in range(i):
            if root(i) != root(j) and jaccard(texts[i], texts[j]) >= 0.8:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    want = {i: root(i) for i in range(400)}
    assert len(set(want.values())) > 20
    assert {r.doc_id: r.class_id for r in near_dups.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()} == want


def test_common_keys_and_prefixes_equal_brute_force():
    rng = np.random.default_rng(13)
    sets = [np.unique(rng.integers(0, 60, int(n)).astype(np.uint64)) for n in rng.integers(1, 80, 40)]
    keys, bounds = np.concatenate(sets), np.cumsum([0, *map(len, sets)])
    got = set_join.common_keys(keys, bounds, np.arange(40), np.arange(40))
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(40) for j in range(40))
    often = np.bincount(keys.astype(int), minlength=set_join.BINS)
    key, row = set_join.prefixes(keys, bounds, often, 0.8)
    heads = [set(key[row == i]) for i in range(40)]
    assert all(heads[i] & heads[j] for i in range(40) for j in range(i) if near_dups.similarity(sets[i], sets[j]) >= 0.8)


def test_blocks_meet_by_every_key_whatever_its_share(spark):
    rng = np.random.default_rng(8)
    rows = {}  # key 0 is in nearly every block, key 1 in few, key 2 in one class alone; block 900 has one class only
    for block in range(900):
        for key in range(6):
            if rng.random() < (0.95, 0.3, 0.1, 0.02, 0.5, 0.01)[key]:
                lo, more = (5, 0) if key == 2 else (int(rng.integers(3)), int(rng.integers(2)))
                rows[key, block] = (lo, lo + more)
    rows |= {(7, 900): (1, 1), (8, 900): (1, 2)}
    want = set()
    for key in range(9):
        on = sorted((b, *c) for (k, b), c in rows.items() if k == key)
        want |= {(a[0], b[0]) for i, a in enumerate(on) for b in on[i:] if len({*a[1:], *b[1:]}) > 1}
    entries = spark.createDataFrame([(k, b, *c) for (k, b), c in rows.items()], "key long, block long, lo long, hi long")
    found = [tuple(r) for r in set_join.meetings(entries).collect()]
    assert len(found) == len(set(found)) and set(found) == want
    assert set_join.meetings(entries.limit(0)).count() == 0


def test_repeated_passages_do_not_part_near_duplicates(spark):
    rng = np.random.default_rng(11)
    rows = []
    for k in range(6):
        passage, rest = sentence(rng, 60), sentence(rng, 140)
        other = " ".join(["new", *rest.split()[1:]])
        rows += [(3 * k, f"{passage} {passage} {rest}"), (3 * k + 1, f"{passage} " * 50 + rest), (3 * k + 2, f"{passage} " * 50 + other)]
        assert jaccard(rows[-3][1], rows[-2][1]) == 1 and 0.8 < jaccard(rows[-3][1], rows[-1][1]) < 1
    got = near_dups.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: i - i % 3 for i in range(18)}


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(3)
    keys = rng.integers(1, 2**63, 900, dtype=np.uint64)
    a, b = np.sort(keys[:600]), np.sort(keys[300:])
    wa, wb = rng.integers(1, 5, 600).astype(float), rng.integers(1, 5, 600).astype(float)
    x, y = dict(zip(a, wa, strict=True)), dict(zip(b, wb, strict=True))
    true = sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in {*x, *y}) for d in {*x} & {*y})
    s = near_dups.signatures(np.concatenate([a, b]), np.concatenate([wa, wb]), np.array([0, 600, 1200]))
    assert abs((s[0] == s[1]).mean() - true) < 0.17


def test_language_is_learned_and_edges_are_und(spark, none):
    rng = np.random.default_rng(6)
    de = "und der ist über schön nicht auch zwei wir können".split()
    en = "and the is over nice not also two we could".split()
    rows = [(i, " ".join(rng.choice(de if i % 2 else en, 60)), "de" if i % 2 else "en") for i in range(300)] + [(900, None, "en"), (901, "12 !", "de"), (902, "Ж", None), (None, "the nice", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(table.where("doc_id % 3 != 1"))
    got = {r.doc_id: r for r in language_id.predict(table, model, "doc_id long").collect()}
    right = [got[i].lang_pred == ("de" if i % 2 else "en") for i in range(300) if i % 3 == 1]
    assert np.mean(right) > 0.95 and got[900].lang_pred == got[901].lang_pred == "und" and got[902].lang_pred in ("de", "en")
    assert language_id.accept(table.withColumn("score", F.lit(1)), model).columns == ["doc_id", "text", "lang", "score"]
    assert {r.lang_pred for r in language_id.predict(table, language_id.fit(none), "doc_id long").collect()} == {"und"}


def test_encoder_equals_the_library(texts):
    rng = np.random.default_rng(5)
    parts = ["'s", "'t", "'re", "'ll", "'", " ", "  ", "\n", "\t", "\r\n", "a", "É", "ñ", "x1", "12", "!", "$$", "«", "×", "€", "<|endoftext|>", "漢", "\x1c", "\x0b", "it", " ", " "]
    made = [t or "" for t in texts] + ["".join(rng.choice(parts, int(n))) for n in rng.integers(0, 10, 5000)]
    encode = Encoder(P.path("byte_bpe_50k.json"))
    ids, bounds = encode.encode(*textops.texts(pa.array(made)))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [encode.tokenizer.encode(t, add_special_tokens=False).ids for t in made]


def test_encoder_learns_the_pieces_of_a_column_at_once(monkeypatch):
    encode = Encoder(P.path("byte_bpe_50k.json"))
    groups = [["one two\n\nthree four", "é ñ two", "", "\tfive  six"], ["two seven", "one one"], ["eight é", "two"]]
    for most in (1, 3, 1000):
        monkeypatch.setattr("colweave.llm.subwords.MOST_PIECES", most)
        encode.forget()
        for group in groups:
            pieces = textops.texts(pa.array(group))
            ids, bounds = encode.encode(*pieces)
            assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [encode.tokenizer.encode(t, add_special_tokens=False).ids for t in group]
            assert len(encode.known) <= most
    got = [None]
    encode._learn([bytes(range(256))], got)
    assert got[0] == np.array([t.id for t in encode.model.tokenize("".join(map(chr, map(int, subwords.BYTE_SIGNS))))], np.int32).tobytes()


def test_spans_side_by_side_are_cut_out_without_a_number_for_each_byte():
    data = np.frombuffer(b"0123456789" * 100_000, np.uint8)
    cuts = np.concatenate([[3, 3], np.arange(7, len(data), 1000)])
    tracemalloc.start()
    found = textops.cut_out(data, cuts[:-1], cuts[1:])
    assert tracemalloc.get_traced_memory()[1] < 2 * len(data)
    tracemalloc.stop()
    assert found.to_pylist() == [data[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    assert textops.cut_out(data, np.array([4, 2]), np.array([6, 2])).to_pylist() == [b"45", b""]


def test_a_worker_keeps_no_powers_after_a_task():
    assert textops.powers(3).tolist() == [1, textops.BASE, textops.BASE**2 % 2**64]
    textops.release()
    assert not textops._powers
    assert textops.powers(2).tolist() == [1, textops.BASE]


def thue_morse(n):
    """A word of n letters and the same with the letters exchanged: a weak modulus takes them for equal."""
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_spans_are_told_apart_by_their_bytes(spark, n):
    one, two = thue_morse(n)
    encode = Encoder(P.path("byte_bpe_50k.json"))
    group = pa.array([f"{one} {two}", two, one])
    ids, bounds = encode.encode(*textops.texts(group))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [encode.tokenizer.encode(t, add_special_tokens=False).ids for t in group.to_pylist()]
    rows = spark.createDataFrame([(1, f"{one}\n{two}\n{one}"), (2, f"{one} x y {two} x y")], "doc_id long, text string")
    got = {r.doc_id: (r.n_dup_lines, r.n_repeat_words) for r in quality_rules.judge(rows, quality_rules.Crf.all_content()).collect()}
    assert got == {1: (1, 0), 2: (0, 0)}
    (key_1, key_2), _ = near_dups.shingles(pa.array([one, two]))
    assert key_1 != key_2
    assert decontaminate.tokens(pa.array([one]))[0] != decontaminate.tokens(pa.array([two]))[0]
    letters = {"a": 5, "b": 9}
    runs = [np.array([letters[c] for c in w], np.uint64) for w in (one, two)]
    assert all(t[2] < n for t in decontaminate.tile(runs[0], runs[1], n // 2))


def test_any_token_is_read_from_the_files(spark, docs, texts, monkeypatch):
    monkeypatch.setattr(token_files, "PIECE", 64)
    path = token_files.fresh_path(spark, "test-tokens")
    token_files.write(docs, path)
    encode = Encoder(P.path("byte_bpe_50k.json")).tokenizer.encode
    ids = [i for t in texts for i in [*encode(t or "", add_special_tokens=False).ids, 2]]
    asked = [0, 1, 1, 63, 64, 65, len(ids) // 2, len(ids) - 1, len(ids), -1, *range(200, 400)]
    positions = spark.createDataFrame([(p, "x") for p in asked], "position long, token_id string")
    got = {r.position: r.token_id for r in token_files.tokens_at(spark, path, positions).collect()}
    assert got == {p: ids[p] for p in asked if 0 <= p < len(ids)}
    every = spark.range(len(ids)).withColumnRenamed("id", "position")
    assert [r.token_id for r in token_files.tokens_at(spark, path, every).orderBy("position").collect()] == ids


def test_codes_give_every_id_without_decoding():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 1 << 31, 3000) >> rng.integers(0, 31, 3000)
    codes = token_files.Codes(token_files.pack(ids))
    assert codes.all().tolist() == ids.tolist() == [codes[i] for i in range(len(codes))]
    assert len(token_files.Codes(token_files.pack(np.zeros(0, int)))) == 0


def test_token_files_round_trip(docs, texts, none):
    got = sorted((tuple(r) for r in token_files.encode_and_read(docs).collect()))
    tokenizer, start, want = Encoder(P.path("byte_bpe_50k.json")).tokenizer, 0, []
    for i, t in enumerate(texts):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    assert token_files.encode_and_read(none).count() == 0


def test_base_quality_counts_equal_brute_force(docs, texts, none):
    got = {r.doc_id: r for r in quality_rules.judge(docs, quality_rules.Crf.all_content()).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        words = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        windows = collections.Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        repeated = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeated))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and r.kept == (not r.base_failed)
    assert quality_rules.judge(none, quality_rules.Crf.all_content()).count() == 0


def test_crf_decoding_equals_brute_force_and_training_helps():
    rng = np.random.default_rng(7)
    width = len(quality_rules.L.LINE_FEATURES)
    model = quality_rules.Crf(rng.normal(size=(width, 2)), rng.normal(size=(2, 2)))
    sizes = [3, 0, 5, 1]
    f = rng.normal(size=(sum(sizes), width))
    got = model.decode(f, np.cumsum([0, *sizes]))
    at = 0
    for n in sizes:
        s = f[at : at + n] @ model.emit
        value = lambda y, s=s: sum(s[k, y[k]] for k in range(len(y))) + sum(model.move[a, b] for a, b in zip(y, y[1:], strict=False))
        best = max(([int(c) for c in np.binary_repr(k, n)] for k in range(2**n)), key=value) if n else []
        assert got[at : at + n].tolist() == best
        at += n
    good, bad = ([rng.normal(m, 0.3, (6, width)) for _ in range(40)] for m in (0.5, -0.5))
    learned = quality_rules.Crf.fit(good + bad, [1] * 40 + [0] * 40)
    assert learned.decode(np.concatenate(good), np.arange(41) * 6).mean() > 0.95
    assert learned.decode(np.concatenate(bad), np.arange(41) * 6).mean() < 0.05


def test_crf_finds_boilerplate_inside_documents_from_labels_of_documents():
    rng = np.random.default_rng(9)
    width = len(quality_rules.L.LINE_FEATURES)
    centre = {1: np.full(width, 0.5), 0: np.full(width, -0.5)}

    def document(good):
        # good: content with a block of boilerplate at either end; bad: boilerplate with a line of content
        truth = np.array([0, 0] + [1] * 8 + [0, 0] if good else [0, 0, 0, 1, 0, 0, 0])
        words = np.where(truth, 10, 4) if good else np.full(7, 10)
        return truth, words, np.array([rng.normal(centre[t], 0.5) for t in truth])

    labels = [k % 2 for k in range(160)]
    truth, words, features = zip(*map(document, labels), strict=True)
    bounds = np.cumsum([0, *map(len, truth)])
    model = quality_rules.Crf.fit_documents(features, words, labels)
    whole = np.concatenate(truth)
    assert (model.decode(np.concatenate(features), bounds) == whole).mean() > 0.97
    assert model.move[0, 0] + model.move[1, 1] > model.move[0, 1] + model.move[1, 0]
    for y, w, line in zip(labels, words, model.fill(features, words, [1 - y for y in labels], 0.3), strict=True):
        assert (w @ line >= 0.3 * w.sum()) == (y == 0)
