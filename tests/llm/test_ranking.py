"""The K2-treap, and ranked search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerspark.llm import ranking, treap

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain(docs, items, k=50):
    own = [(i, Counter(terms(t))) for i, t in docs]
    own = [(i, w) for i, w in own if w]
    n_docs, length = len(own), sum(sum(w.values()) for _, w in own)
    df = Counter(t for _, w in own for t in w)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own_terms in wanted.items():
        rows = []
        for i, w in own:
            m = 50 + (50 * sum(w.values()) * n_docs) // length
            weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in own_terms & set(w)}
            score = sum(weight[t] * ((10**9 * w[t]) // (1000 * w[t] + 20 * m)) for t in weight)
            if score > 0:
                rows.append((-score, i is None, i or 0, i, score))
        out += [(item, rank, r[3], r[4]) for rank, r in enumerate(sorted(rows, key=lambda r: r[:3])[:k], 1)]
    return sorted(out, key=str)


def test_treap_finds_every_point_and_maximum():
    rng = np.random.default_rng(1)
    for depth in (1, 3, 6):
        side = 1 << depth
        cells = np.flatnonzero(rng.random(side * side) < 0.1) if depth > 1 else np.array([2])
        row, column, value = cells // side, cells % side, rng.integers(0, 1000, len(cells))
        tree, parts = treap.unpack(treap.pack(row, column, value, depth, more=np.arange(3)))
        grid = np.full((side, side), -1)
        grid[row, column] = value
        assert parts["more"].tolist() == [0, 1, 2] and tree.root == value.max()
        cell, best = np.zeros((1, 1), np.int32), np.full((1, 1), tree.root)
        span = [(0, 0, cell, best)]
        for level in range(depth):
            size = side >> level + 1
            span = [
                (r + a * size, c + b * size, *quarter) for r, c, cell, best in span for a in (0, 1) for b, quarter in enumerate(tree.below(level, cell, best, np.array([a])))
            ]
            for r, c, cell, best in span:
                part = grid[r : r + size, c : c + size].max()
                assert (cell[0, 0] >= 0) == (part >= 0) and best[0, 0] == max(part, 0)


def made(seed, n=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Überall", "ÉCOLE", "a1b2", "don't", "日本語"]
    text = lambda n: rng.choice([" ", ", ", "\x7f"]).join(rng.choices(words, weights=[1 / (i + 1) for i in range(len(words))], k=n))
    docs = [(i, text(rng.randint(1, 60))) for i in range(n)]
    docs += [(3, docs[5][1]), (None, docs[5][1]), (None, "w1"), (n, None), (n + 1, ""), (n + 2, "... ---"), (n + 3, docs[7][1]), (n + 4, "W1 " * 30_000), docs[0], docs[0]]
    items = [(i, text(rng.randint(1, 15))) for i in range(12)] + [(20, None), (21, ""), (22, "unheard of"), (23, "w0 w0 w0"), (None, "w2 w3"), (1, "w50 w51"), (23, "w0")]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    docs, items = made(seed)
    got = ranking.search(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = plain(docs, items)
    assert sorted(map(tuple, got.collect()), key=str) == want and len(want) > 400


def test_small_blocks_few_states_and_many_passes(spark, monkeypatch):
    docs, items = made(3)
    monkeypatch.setattr(ranking, "STATES", 3)
    frame = spark.createDataFrame(docs, DOCS).coalesce(2)
    for name, value in (("BLOCK_BYTES", 500), ("BLOCK_DOCS", 4100)):
        monkeypatch.setattr(ranking, name, value)
    monkeypatch.setattr(ranking.index, "__kwdefaults__", {"block_bytes": 500, "block_docs": 4100})
    monkeypatch.setattr(ranking, "slices", lambda batches: (b.slice(i, 20) for b in batches for i in range(0, b.num_rows, 20)))
    for pass_terms in (40, 1 << 20):
        got = ranking.search(frame, spark.createDataFrame(items, ITEMS), k=5, pass_terms=pass_terms)
        assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items, 5)


def test_nothing_and_clashing_columns(spark):
    docs, items = made(4, 30)
    clash = spark.createDataFrame([(*d, 1, "2", 3, 4) for d in docs], DOCS + ", score int, block string, item_id int, rank int")
    wanted = spark.createDataFrame([(*i, 5, "6") for i in items], ITEMS + ", doc_id int, texts string")
    assert sorted(map(tuple, ranking.search(clash, wanted).collect()), key=str) == plain(docs, items)
    assert ranking.search(clash, wanted.limit(0)).collect() == []
    assert ranking.search(clash.limit(0), wanted).collect() == []
    assert ranking.search(clash.where("text IS NULL"), wanted).collect() == []


def test_most_columns_are_never_reached():
    """Bounds rule ranges out: the walk must not look at every column of a large block."""
    rng = np.random.default_rng(2)
    n = 1 << 13
    row, column = np.repeat(np.arange(4), n), np.tile(np.arange(n), 4)
    value = np.sort(rng.integers(1, 1000, (4, n)) + np.arange(n) // 8, axis=1).ravel()
    tree, _ = treap.unpack(treap.pack(row, column, value, 13))
    seen = []
    below = tree.below

    def counted(level, cell, *rest):
        seen.append(len(cell))
        return below(level, cell, *rest)

    tree.below = counted
    weights = np.array([3, 1, 4, 1])
    at, scores = ranking.best_of(tree, np.arange(4), weights, n, 50, 1)
    whole = weights @ value.reshape(4, n)
    assert sorted(scores.tolist())[-50:] == sorted(whole.tolist())[-50:] and (whole[at] == scores).all()
    assert sum(seen) < n
