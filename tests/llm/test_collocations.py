"""Collocations against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerspark.llm import collocations

SCHEMA = "text string, lang string"


def plain(rows, least, max_words=5):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    counts[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        often = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        rows = []
        for g, a in often.items():
            if any(len(y) > len(g) and b >= a and any(y[i : i + len(g)] == g for i in range(len(y))) for y, b in often.items()):
                continue
            score, _, left, right = min((1000 * a * totals[lang] // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            rows.append((score, a, " ".join(g), left, right))
        rows.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i, phrase, a, left, right, totals[lang], score) for i, (score, a, phrase, left, right) in enumerate(rows, 1)]
    return sorted(out)


def made(seed, n=120):
    rng = random.Random(seed)
    words = ["Как", "и", "the", "of", "a", "GDP", "x\x00y", " ", "é", "longword" * 5, "b", "c"]
    rows = []
    for _ in range(n):
        w = rng.choices(words, weights=range(1, len(words) + 1), k=rng.randint(0, 40))
        rows.append(("".join(x + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ? ", "\x0b"]) for x in w), rng.choice(["en", "ru", None, ""])))
    return [*rows, (None, "en"), ("", "de"), (" . ", None), ("solo", "fr"), rows[0], rows[0]]


@pytest.mark.parametrize("seed, least", [(1, 2), (3, 8)])
def test_equals_brute_force(spark, seed, least):
    rows = made(seed)
    got = collocations.mine(spark.createDataFrame(rows, SCHEMA).repartition(3), least=least, top=None)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain(rows, least)
    assert sorted(map(tuple, got.collect())) == want and want


def test_few_ranks_and_dense_tiles_change_nothing(spark, monkeypatch):
    rows = made(4)
    for name, value in (("RANKED", 3), ("TILE_BITS", 1), ("DENSE", 1000), ("FILTER_SHARE", 1e-9), ("BATCH_WORDS", 50)):
        monkeypatch.setattr(collocations, name, value)
    got = collocations.mine(spark.createDataFrame(rows, SCHEMA).coalesce(1), least=4, top=None)
    assert sorted(map(tuple, got.collect())) == plain(rows, 4)


def test_top_of_each_language_clashing_columns_and_no_rows(spark):
    rows = made(5)
    docs = spark.createDataFrame([(*r, "1", "2", 3, 4) for r in rows], SCHEMA + ", word string, phrase string, h int, rank int")
    got = collocations.mine(docs, least=3, top=2)
    assert sorted(map(tuple, got.collect())) == [r for r in plain(rows, 3) if r[1] <= 2]
    assert collocations.mine(spark.createDataFrame([], SCHEMA)).collect() == []
    assert collocations.mine(spark.createDataFrame([("a b a b", "en")], SCHEMA)).collect() == []


def test_long_repetitive_text(spark):
    rows = [("so it goes " * 60_000, "en"), ("word" * 50_000 + " x", "en")]
    got = sorted(map(tuple, collocations.mine(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert {r[2]: r[3] for r in got} == {"so it goes": 60_000} | {"so it goes so it": 59_999, "it goes so it goes": 59_999, "goes so it goes so": 59_998}
    assert {r[6] for r in got} == {180_002}


def test_tiles_count_as_sorting_does():
    rng = np.random.default_rng(3)
    left, right = rng.zipf(1.3, 50_000) % 3000, rng.zipf(1.3, 50_000) % 3000
    lang = rng.integers(0, 3, 50_000).astype(np.int32)
    places, counts = collocations.tiled(left, right, lang)
    got = {(int(left[p]), int(right[p]), int(lang[p])): int(c) for p, c in zip(places, counts)}
    assert got == Counter(zip(left.tolist(), right.tolist(), lang.tolist())) and len(got) == len(places)
