"""The language model and its Elias-Fano sequences against direct computation."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import elias_fano, lm
from ledgerspark.llm.fits import fold


@pytest.mark.parametrize("values", [[], [0], [5, 5, 5], [0, 1, 2, 3], sorted(int(x) for x in np.random.default_rng(1).integers(0, 1 << 60, 70_001)), list(range(0, 3000, 7))])
def test_elias_fano_round_trip(values):
    values = np.array(values, np.uint64)
    block = elias_fano.dump(elias_fano.named(elias_fano.encode(values), "x") | {"other": np.arange(3)})
    arrays = elias_fano.views(block)
    assert (elias_fano.decode(elias_fano.within(arrays, "x")) == values).all()
    assert arrays["other"].tolist() == [0, 1, 2]


def test_a_block_can_be_mapped_from_a_file(tmp_path):
    (tmp_path / "block").write_bytes(elias_fano.dump(elias_fano.encode(np.array([3, 9, 10], np.uint64))))
    assert elias_fano.decode(elias_fano.views(np.memmap(tmp_path / "block", np.uint8, "r"))).tolist() == [3, 9, 10]


def test_elias_fano_is_compact():
    values = np.sort(np.random.default_rng(2).integers(0, 1 << 40, 100_000).astype(np.uint64))
    assert len(elias_fano.dump(elias_fano.encode(values))) < 100_000 * 4


@pytest.mark.parametrize("top", [0, 7, 1 << 12, 1 << 40, 1 << 63])
def test_search_in_the_encoded_form(top):
    rng = np.random.default_rng(top % 97)
    values = np.sort(rng.integers(0, top + 1, 3000, dtype=np.uint64))
    for n in (1, 2, 70, 3000):
        own = values[:n]
        sequence = elias_fano.Sequence(elias_fano.encode(own))
        assert (sequence.get(np.arange(n)) == own).all()
        wanted = np.concatenate([own, rng.integers(0, top + 1, 500, dtype=np.uint64), np.array([0, top], np.uint64)])
        at, there = sequence.find(wanted)
        assert (there == np.isin(wanted, own)).all() and (at[there] == np.searchsorted(own, wanted[there])).all()
    empty = elias_fano.Sequence(elias_fano.encode(values[:0]))
    assert not empty.find(values)[1].any()


def test_successors_are_sought_between_their_contexts_pointers():
    context = np.repeat(np.array([5, 9, 1 << 39], np.uint64), [3, 1, 2])
    word = np.array([1, 7, 1 << 35, 7, 2, 7], np.uint64)
    trie = lm.Trie(lm.Trie.build(context, word, np.array([4, 2, 1, 3, 1, 5]), lm.Hot([], 0)))
    asked = [(5, 1), (5, 2), (5, 7), (9, 1), (9, 7), (10, 7), (1 << 39, 2), (1 << 39, 7), (1 << 39, 8)]
    logs, seen = trie.look(*np.array(asked, np.uint64).T)
    assert seen.tolist() == [True, False, True, False, True, False, True, True, False]
    assert np.allclose(logs[[0, 4, 7]], np.log10([3.25 / 7, 2.25 / 3, 4.25 / 6])) and np.allclose(logs[[1, 3, 5]], [np.log10(0.75 * 3 / 7), np.log10(0.25), 0])


def brute(rows, held, discount=lm.DISCOUNT):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = [[*(w for w in (t or "").translate(low).replace("\t", " ").replace("\n", " ").split(" ") if w), None] for _, t in rows]
    words, pairs = Counter(), Counter()
    for (i, _), w in zip(rows, tokens):
        if not held(i):
            words.update(w)
            pairs.update(zip([None, *w], w))
    kinds, n, v = Counter(a for a, _ in pairs), sum(words.values()), len(words)
    out = []
    for (i, _), w in zip(rows, tokens):
        alone = [math.log10((words[x] + 1) / (n + v + 1)) for x in w]
        chain = 0.0
        for before, x, p in zip([None, *w], w, alone):
            if pairs[before, x]:
                chain += math.log10((pairs[before, x] - discount) / words[before])
            else:
                chain += p + (math.log10(discount * kinds[before] / words[before]) if words[before] else 0)
        base = sum(alone)
        out.append((i, held(i), len(w), sum(words[x] > 0 for x in w), n, base, chain))
    return out


TEXTS = ["the cat sat", "The cat\tsat on  the mat", "the dog sat on the log", None, "", "zebra crossing", "the cat sat", "a\n\nb", "the " * 50]


@pytest.mark.parametrize("hot", [lm.HOT, 4])
def test_scores_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(lm, "HOT", hot)
    monkeypatch.setattr(lm, "HOT_PER_SHARD", 1)
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(40)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, key string, score int").repartition(3)
    got = sorted(lm.score(docs, fold(7) != 2).drop("score").collect())
    want = sorted(brute(rows, lambda i: zlib.crc32(str(i).encode()) % 7 == 2))
    assert [tuple(g)[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g["base_score"] == pytest.approx(w[5], abs=1e-9)
        assert g["chain_score"] == pytest.approx(w[6], abs=1e-9)


def test_score_is_the_even_mixture(spark):
    docs = spark.createDataFrame([(i, TEXTS[i % len(TEXTS)]) for i in range(30)], "doc_id long, text string")
    for r in lm.score(docs, fold(7) != 2).collect():
        assert 10 ** r["score"] == pytest.approx(0.5 * 10 ** r["base_score"] + 0.5 * 10 ** r["chain_score"], rel=1e-9)
        assert r["score"] >= r["base_score"] + math.log10(0.5) - 1e-9


def test_repeated_rows_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c"), (None, None)], "doc_id long, text string")
    rows = lm.score(docs, F.lit(True)).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in rows) == [(0, 1), (1, 2), (1, 3), (1, 3)]
    assert {r["train_tokens"] for r in rows} == {9}
    assert lm.score(docs.limit(0), F.lit(True)).count() == 0
    assert {r["train_tokens"] for r in lm.score(docs, F.lit(False)).collect()} == {0}


def test_longer_unigram_and_pair_batches_change_nothing(spark, monkeypatch):
    docs = spark.createDataFrame([(i, TEXTS[i % len(TEXTS)]) for i in range(60)], "doc_id long, text string").coalesce(1)
    whole = sorted(map(tuple, lm.score(docs, fold(7) != 2).collect()))
    monkeypatch.setattr(lm, "BATCH_TOKENS", 10)
    for a, b in zip(whole, sorted(map(tuple, lm.score(docs, fold(7) != 2).collect()))):
        assert a == pytest.approx(b, rel=1e-9)
