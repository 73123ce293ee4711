"""The prefix-tree join and connected components against all pairs."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerspark.llm import components, near
from ledgerspark.llm.trie import Trie, need


def brute_sets(text):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = [x for x in (text or "").translate(low).replace("\t", " ").replace("\n", " ").split(" ") if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [brute_sets(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def corpus(seed, families=4, members=14):
    """Families of edited copies, with edits of all sizes around the threshold, and lone texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = [rng.choice(words) for _ in range(40)]
    texts = []
    for _ in range(families):
        base = [rng.choice(words) for _ in range(rng.randint(30, 80))]
        for _ in range(members):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
        texts += [" ".join(base + passage), " ".join(passage + base[:20]), " ".join(base).upper(), " ".join(base)]
    texts += ["a b c", "A b  c", "a b", None, "", " \n", "a b c d e", "a b c d e f", "x " * 500]
    texts += [" ".join(rng.choice(words) for _ in range(50)) for _ in range(10)]
    rng.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_all_pairs(spark, monkeypatch, seed):
    monkeypatch.setattr(near, "BLOCK", 8)
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n long, component_id string").repartition(3)
    assert sorted(map(tuple, near.join(docs, shard_bytes=1000).collect())) == brute(rows)


def test_one_document_of_each_component_stays(spark):
    rows = corpus(3, families=1, members=5)
    docs = spark.createDataFrame([*rows, rows[0], rows[0]], "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in near.distinct(docs).collect())
    assert kept == sorted({c for _, _, c in brute(rows)})


def test_nulls_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "p q r s t u"), (None, None), (5, "p q r s t u"), (5, "other"), (5, "other")], "doc_id long, text string")
    got = sorted(map(str, near.join(docs).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == sorted(
        ["Row(doc_id=5, n_shingles=1, component_id=5)"] * 2
        + ["Row(doc_id=5, n_shingles=2, component_id=5)", "Row(doc_id=None, n_shingles=2, component_id=5)", "Row(doc_id=None, n_shingles=0, component_id=None)"]
    )
    assert near.join(docs.limit(0)).count() == 0


def test_slices_full_of_short_texts(spark):
    rows = [(i, [f"t{i} x", f"t{i // 7} a b c d e f g", None][i % 3]) for i in range(5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    same = {}
    for i, t in rows:
        same.setdefault(frozenset(brute_sets(t)), i)
    # no two different sets of these link
    want = [(i, len(brute_sets(t)), same[frozenset(brute_sets(t))] if t else i) for i, t in rows]
    assert sorted(map(tuple, near.join(docs).collect())) == want


def test_rows_of_one_id_are_told_apart(spark):
    base = [f"w{i}" for i in range(40)]
    copied, clean, lone = " ".join(base), "a text of nothing else at all", "and yet another text of this id"
    rows = [(3, " ".join([*base, "end"]), "a"), (5, copied, "b"), (5, clean, "c"), (5, lone, "d"), (5, lone, "d"), (5, lone, "e"), (7, clean, "f"), (5, "", "g"), (5, "", "g"), (5, None, "h"), (None, copied, "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = sorted({(r["doc_id"], r["component_id"]) for r in near.join(docs.where(F.col("text").isin(rows[0][1], copied, clean))).where("doc_id is not null").collect()})
    assert found == [(3, 3), (5, 3), (5, 5), (7, 5)]
    kept = near.distinct(docs)
    assert kept.columns == docs.columns
    got = sorted((str(r["doc_id"]), r["text"] or "", r["source"]) for r in kept.collect())
    repeat = next(s for d, t, s in got if t == lone)
    assert repeat in ("d", "e")
    assert got == sorted([("3", rows[0][1], "a"), ("5", clean, "c"), ("5", lone, repeat), ("5", "", "g"), ("5", "", "g"), ("5", "", "h"), ("None", copied, "i")])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.frozensets(st.integers(0, 14), min_size=1), min_size=1, max_size=12), st.frozensets(st.integers(0, 14), min_size=1))
def test_trie_finds_all_similar_sets(sets, probe):
    trie = Trie()
    for i, s in enumerate(sets):
        trie.add(tuple(sorted(s)), len(s), i)
    got = sorted(trie.similar(tuple(sorted(probe)), len(probe)))
    want = sorted((i, len(s & probe)) for i, s in enumerate(sets) if 100 * len(s & probe) >= 75 * len(s | probe))
    assert got == want


def test_need():
    for a in range(1, 30):
        for b in range(1, 30):
            assert need(a, b) == min(k for k in range(100) if 100 * k >= 75 * (a + b - k))


@pytest.mark.parametrize("seed", range(2))
def test_smallest_reachable_node(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(200 + i, 201 + i) for i in range(20)] + [(300, 300)]
    root = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(root[a], root[b])
            changed |= root[a] != m or root[b] != m
            root[a] = root[b] = m
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {r["node"]: r["component"] for r in components.smallest(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root[x] for x in linked}
