"""Quality, toxicity and language: held-out accuracy, the fitted parts against direct computation, odd input."""

import itertools
import math
import pickle
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerspark.llm import fits, langid, quality, toxicity
from ledgerspark.llm.fits import fold
from ledgerspark.llm.words import BLANK, NOT_WORD, Texts, slices

SF = "/root/testdata/sf0.01"
ODD = [(None, "some text"), (900_001, None), (900_002, ""), (900_003, "!!"), (900_004, "é"), (900_005, "word " * 30_000), (900_005, "word " * 30_000)]


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def crc(i):
    return zlib.crc32(str(i).encode())


def odd(spark):
    return spark.createDataFrame([(*r, "en", 1.0, False) for r in ODD], "doc_id long, text string, lang string, score double, held_out boolean")


@pytest.mark.parametrize("blank", [BLANK, NOT_WORD])
def test_words_equal_a_plain_split(blank):
    rng = random.Random(1)
    alphabet = "aB1 é\t\n-.ß漢\x7f\x0b"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(200)] + ["", None, " ", "a"]
    found = Texts(pa.array(texts), blank)
    assert found.n == len(texts)
    h, seen = found.hashes(), {}
    for i, t in enumerate(texts):
        data = (t or "").translate({c: c + 32 for c in range(65, 91)}).encode()
        want = [bytes(g) for k, g in itertools.groupby(data, lambda c: not blank[c]) if k]
        own = range(found.word_bounds[i], found.word_bounds[i + 1])
        assert [found.data[found.starts[w] : found.ends[w]].tobytes() for w in own] == want
        for w, word in zip(own, want):
            assert seen.setdefault(word, h[w]) == h[w]
    assert len(set(seen.values())) == len(seen)


def test_slices_cover_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (10, 3_000_000, 5, 0)] + [None] * 9000})
    pieces = list(slices([batch, batch.slice(0, 0)]))
    assert sum(p.num_rows for p in pieces) == batch.num_rows
    assert max(p.num_rows for p in pieces) <= 4096


@pytest.mark.parametrize("op, label, folds, held", [(quality, "quality", 4, 2), (toxicity, "toxic", 5, 0)])
def test_held_out_accuracy_and_folds(spark, tables, op, label, folds, held):
    docs, labels = tables
    rows = op.score(docs, op.train(docs, labels)).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (crc(r["doc_id"]) % folds == held) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= op.THRESHOLD) for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r[label] for r in out) / len(out) > 0.85


@pytest.mark.parametrize("op, label", [(quality, "quality"), (toxicity, "toxic")])
def test_held_out_labels_teach_nothing(spark, tables, op, label):
    docs, labels = tables
    folds, held = (4, 2) if op is quality else (5, 0)
    changed = labels.withColumn(label, 1 - labels[label]).where(fold(folds) == held).unionByName(labels.where(fold(folds) != held))
    a = {r["doc_id"]: r["score"] for r in op.score(docs, op.train(docs, labels)).collect()}
    b = {r["doc_id"]: r["score"] for r in op.score(docs, op.train(docs, changed)).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 0.05 for k in a)


@pytest.mark.parametrize("op", [quality, toxicity])
def test_odd_rows_and_empty_tables(spark, tables, op):
    docs, labels = tables
    model = op.train(docs, labels)
    got = op.score(odd(spark), model).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert op.score(docs.limit(0), model).count() == 0
    assert op.train(docs, labels.limit(0)) == b""
    assert op.train(docs.limit(0), labels) == b""
    assert len({r["score"] for r in op.score(odd(spark), b"").collect()}) == 1


def test_dual_descent_separates():
    rng = np.random.default_rng(3)
    y = np.arange(200) % 2
    places = np.stack([np.where(y == 1, 1, 2), rng.integers(3, 30, 200)], 1).ravel()
    weight, bias = quality.dual_descent(np.ones(400), places, np.arange(0, 401, 2), y)
    margin = weight[places].reshape(-1, 2).sum(1) + bias
    assert ((margin > 0) == (y == 1)).all()


def test_features_are_distinct_trigrams():
    places, bounds = quality.features(pa.array(["abcabc", "ab", "", None, "xyzw"]))
    assert np.diff(bounds).tolist() == [3, 0, 0, 0, 2]
    assert len(places) == 5


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(5)
    lengths = np.array([3, 0, 1, 5, 4])
    emission, trans = rng.normal(size=lengths.sum()), rng.normal(size=(2, 2))
    steps = toxicity.Steps(lengths)
    got = toxicity.marginals(emission, steps, trans)
    expected = np.zeros((2, 2))
    at = 0
    for n in lengths:
        e, total, hit = emission[at : at + n], 0.0, np.zeros(n)
        count = np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(e[i] for i in range(n) if path[i]) + sum(trans[a, b] for a, b in zip(path, path[1:])))
            total += w
            hit += w * np.array(path)
            for a, b in zip(path, path[1:]):
                count[a, b] += w
        assert got[at : at + n] == pytest.approx(hit / total)
        expected += count / total
        at += n
    ahead, back, e = toxicity.forward_backward(emission, steps, trans)
    assert toxicity.pairs(ahead, back, e, steps, trans) == pytest.approx(expected)


def test_toxic_spans_are_byte_offsets():
    texts = Texts(pa.array(["é bad word", "ok"]))
    assert toxicity.spans(np.array([0.1, 0.9, 0.8, 0.0]), texts) == [[{"start": 3, "end": 11, "p": 0.9}], []]


def test_language_accuracy_and_rejects(spark, tables):
    docs, _ = tables
    model = langid.train(docs)
    rows = langid.score(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (crc(r["doc_id"]) % 3 == 1) for r in rows)
    assert sum(r["lang_pred"] == r["lang"] for r in out) / len(out) > 0.95
    got = langid.score(odd(spark), model).collect()
    assert len(got) == len(ODD)
    assert [r["lang_pred"] for r in got if r["doc_id"] in (900_001, 900_002, 900_003)] == ["und"] * 3
    assert all(r["lang_pred"] != "und" for r in got if r["doc_id"] in (900_004, 900_005))
    assert langid.score(docs.limit(0), model).count() == 0
    assert langid.train(docs.limit(0)) == b""
    assert {r["lang_pred"] for r in langid.score(odd(spark), b"").collect()} == {"und"}


def test_code_lengths_equal_plain_ppm():
    sample = pa.table({"text": ["abracadabra", "abba", "xyzzy xyz"], "lang": ["a", "a", "b"]})
    trees = langid.Trees(langid.learn(sample))

    def bits(text, lang):
        counts = {}
        for t, x in zip(sample["text"].to_pylist(), sample["lang"].to_pylist()):
            if x == lang:
                padded = "   " + t
                for i in range(3, len(padded)):
                    for k in range(4):
                        at = counts.setdefault(padded[i - k : i], {})
                        at[padded[i]] = at.get(padded[i], 0) + 1
        total, padded = 0.0, "   " + text
        for i in range(3, len(padded)):
            for k in (3, 2, 1, 0, -1):
                if k < 0:
                    total += 8
                    break
                at = counts.get(padded[i - k : i])
                if at:
                    n, d = sum(at.values()), len(at)
                    if padded[i] in at:
                        total += np.log2((n + d) / at[padded[i]])
                        break
                    total += np.log2((n + d) / d)
        return total

    for text in ("abra", "xyz", "zzab", "q", "brxy x"):
        gram, _ = langid.grams(pa.array([text]))
        assert trees.lengths(gram).astype(float).sum(0) == pytest.approx([bits(text, "a"), bits(text, "b")], rel=1e-4)


def test_table_finds_what_it_holds():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 32, 5000, dtype=np.uint64)).astype(np.uint32)
    table = langid.Table(keys[::2])
    assert (table.find(keys[::2]) == np.arange(len(keys[::2]))).all()
    assert (table.find(keys[1::2]) == -1).all()
    assert (langid.Table(keys[:0]).find(keys) == -1).all()


def test_samples_are_bounded_in_rows(spark):
    """One id has most rows, alike and not: the sample stays small, and alike for every order of the rows."""
    rows = [(7, f"text {i % 50}", "en") for i in range(3000)] + [(i, f"other {i}", "en" if i % 2 else "de") for i in range(100, 140)] + [(None, "x", "en"), (1, None, "en")]
    samples = []
    for parts in (1, 4):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(parts)
        got = fits.first_rows(docs.where("doc_id IS NOT NULL AND text IS NOT NULL"), "lang", 30).collect()
        assert len(got) == 50 and len({(r["doc_id"], r["text"]) for r in got}) == 50
        labels = spark.createDataFrame([(i, int(i % 2)) for i in [7, *range(100, 140)]], "doc_id long, toxic int")
        sample = fits.labelled_sample(docs, labels.unionByName(labels), "toxic", 15, fold(5) != 4)
        assert max(r["count"] for r in sample.groupBy("label").count().collect()) <= 15
        samples.append(sorted((r["text"], r["label"]) for r in sample.collect()))
    assert samples[0] == samples[1]


def test_few_labels_teach(spark):
    """Two of four toxic texts share a word that no clean one has."""
    clean = [f"a quiet day number {i} by the river" for i in range(120)]
    bad = ["you zorgle person", "what a zorgle thing", "zorgle again and again", "such zorgle talk", "one zorgle more"]
    docs = spark.createDataFrame(list(enumerate(clean + bad)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 120)) for i in range(125)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, folds=1000, held=999)
    new = spark.createDataFrame([(1, "a zorgle here"), (2, "a quiet day by the river")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.score(new, model).collect()}
    assert got[1]["predicted"] == 1 and got[2]["predicted"] == 0 and got[1]["spans"][0]["start"] == 2


def test_document_score_is_the_chance_of_a_toxic_word():
    """Brute force over one document: marginals by enumeration, the doubt of those that count."""
    p = np.array([0.01, 0.2, 0.9, 0.5, 0.04, 1.0])
    bounds = np.array([0, 2, 2, 5, 6])
    chance = [1 - 0.8, 0.0, 1 - 0.1 * 0.5, 1.0]
    got = 1 - np.exp(-toxicity.doubts(p, bounds))
    assert np.allclose(got, chance, atol=1e-5)


def plain_features(text):
    """Distinct places of trigrams and of pairs of word shapes, one byte and word at a time."""
    data = (text or "").encode()
    codes = {a << 16 | b << 8 | c for a, b, c in zip(data, data[1:], data[2:])}
    shapes, before = [], None
    for word in re.split(rb"[\x20\x09-\x0D]+", data):
        if word:
            capitals = sum(65 <= x < 91 for x in word)
            letters = sum(97 <= x < 123 or x >= 128 for x in word)
            signs = sum(33 <= x < 48 or 58 <= x < 65 or 91 <= x < 97 or 123 <= x < 127 for x in word)
            shapes.append(min(capitals, 2) * 16 + (letters > 0) * 8 + min(signs, 3) * 2 + (word == before))
            before = word
    codes |= {(a * 48 + b) | 1 << 30 for a, b in zip(shapes, shapes[1:])}
    return {(c * 2654435769 % (1 << 32)) >> (32 - quality.BITS) for c in codes}


def test_quality_scores_equal_brute_force(spark, tables):
    docs, labels = tables
    model = quality.train(docs, labels)
    fitted = pickle.loads(model)
    texts = [r["text"] for r in docs.limit(40).collect()] + [None, "", "ab", "É é é!! ABC", "a a a a"]
    got = quality.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    for r in got:
        places = sorted(plain_features(texts[r["doc_id"]]))
        norm = math.sqrt(sum(float(fitted["ratio"][p]) ** 2 for p in places))
        margin = sum(float(fitted["weight"][p]) for p in places) / max(norm, fitted["usual"]) + fitted["bias"]
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-(fitted["slope"] * margin + fitted["shift"]))), abs=1e-6)
