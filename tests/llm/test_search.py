"""Notices and vectors against brute force; the pipeline."""

import math
import random
import time

import pytest

import corpus_pipeline
from ledgerspark.llm import langid, notices, vectors
from ledgerspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c.isascii() and (c.isdigit() or "a" <= c <= "z") or not c.isascii() else " " for c in low).split(" ")


NOTES = [
    "Licensed under CC BY-NC 4.0. All rights reserved.", "cc by cc by", "CC_BY", "General Public License", "the GNU Genral Public License v2", "all right reserved",
    "ALL RIGHTS RESERVED all rights reserved", "gall rights reserved", None, "", "...", "é cc by ü", "permission is herby granted, free of charge", "nothing here " * 2000 + "cc by",
    "all\x7frights{reserved", "cc  by", "Licenced under the Apache licence", "rights reserved all rights",
]


def test_base_places_equal_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*NOTES, NOTES[0]])], "doc_id long, text string, labels string")
    for r in notices.scan(docs).collect():
        w = [x for x in plain_words([*NOTES, NOTES[0]][r["doc_id"]]) if x]
        places = [(i, label) for phrase, label in notices.BASE.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
        assert (r["n_words"], r["n_base"]) == (len(w), len(places))
        assert (r["first_word"], r["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1


@pytest.mark.parametrize("text, label", [("the GNU Genral Public License v2", "gpl"), ("all right reserved", "reserved"), ("permission is herby granted, free of charge", "mit"), ("Licenced under the Apache licence", "apache")])
def test_edits_are_found(spark, text, label):
    row = notices.scan(spark.createDataFrame([(1, f"x y {text} z")], "doc_id long, text string")).first()
    assert row["n_base"] == 0 and label in row["labels"].split(",") and 0 < row["score"] < 1
    assert all(s["edits"] > 0 and s["first_word"] >= 2 for s in row["spans"])


def test_occurrences_side_by_side_are_all_found(spark):
    text = "genral public license general public license x generl publik license all right reserved all rights reserved"
    row = notices.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    found = sorted({(s["first_word"], s["end_word"]) for s in row["spans"] if s["label"] == "gpl"})
    assert found == [(0, 3), (3, 6), (7, 10)]
    assert {(s["first_word"], s["end_word"], s["edits"]) for s in row["spans"] if s["label"] == "reserved"} == {(10, 13, 1), (13, 16, 0)}


def test_spans_equal_brute_force():
    """Every stretch of whole words against every notice, by edit distance."""

    def distance(a, b):
        last = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            now = [i]
            for j, y in enumerate(b, 1):
                now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
            last = now
        return last[-1]

    rng = random.Random(9)
    _, near = notices.notices()
    for notice in near[5:]:
        parts = []
        for _ in range(6):
            edited = list(notice.words)
            for _ in range(rng.randint(0, notice.edits)):
                edited[rng.randrange(1, len(edited) - 1)] = "q"
            parts += ["".join(edited), *rng.sample(["x", "some", "license", "rights"], rng.randint(0, 2))]
        text = " " + " ".join(parts) + " "
        words = text.split()
        at, matches = 1, {}
        places = []
        for w in words:
            places.append((at, at + len(w)))
            at += len(w) + 1
        for i in range(len(words)):
            for j in range(i, min(len(words), i + 9)):
                span = text[places[i][0] : places[j][1]]
                if abs(len(span) - len(notice.words)) <= notice.edits and distance(span, notice.words) <= notice.edits:
                    matches[places[i][0], places[j][1]] = distance(span, notice.words)
        got = notices.spans(text, notice)
        want = notices.apart(matches)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert all(e >= matches[a, b] for a, b, e in got) and len(got) >= 6


def test_a_long_repetitive_text_takes_linear_time(spark):
    text = "genral public license " * 95_000
    start = time.time()
    row = notices.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert len(text) > 2_000_000 and len(row["spans"]) >= 95_000 and time.time() - start < 20


def test_seeds_lose_no_match():
    import regex

    rng = random.Random(4)
    _, near = notices.notices()
    for notice in near:
        for _ in range(60):
            text = list(notice.words)
            for _ in range(rng.randint(0, notice.edits)):
                at = rng.randrange(1, len(text) - 1)
                kind = rng.randrange(3)
                if kind == 0:
                    text[at] = "q"
                elif kind == 1:
                    del text[at]
                else:
                    text.insert(at, "q")
            whole = " zz " + "".join(text) + " zz "
            assert regex.search(notice.pattern.pattern, whole, regex.BESTMATCH)
            assert notices.spans(whole, notice)


def brute_top(rows, every=50, k=5):
    ok = [(i, [math.floor(256 * c) for c in x]) for i, x in rows if i is not None and x is not None and all(c is not None and math.isfinite(c) for c in x)]
    out = []
    for q, x in dict(reversed([r for r in ok if r[0] % every == 0])).items():
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in ok if i != q and len(y) == len(x))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 16])
def test_search_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, [0.5] * 6) for i in range(90)] + [(2000, None), (2050, [None] * 6), (2100, [float("nan")] + [0.0] * 5), (2150, [float("inf")] * 6), (2200, [0.0] * 6), (None, [0.1] * 6)]
    rows += [(3000, [1.0, 2.0]), (3001, [2.0, 1.0]), (3050, [])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int").repartition(4)
    got = vectors.search(df)
    assert sorted(map(tuple, got.collect())) == brute_top([(i, None if x is None else [None if c is None else float(__import__("numpy").float32(c)) for c in x]) for i, x in rows])


def test_clustered_vectors_are_mostly_skipped(spark):
    rng = random.Random(5)
    centres = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(12)]
    rows = [(i, [c + rng.gauss(0, 0.02) for c in centres[i % 12]]) for i in range(2400)]
    effort = {}
    got = vectors.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), effort=effort)
    assert sorted(map(tuple, got.collect())) == brute_top(rows)
    assert effort["pairs"] == 48 * 2400 and effort["scored"] < effort["pairs"] / 2


def test_search_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vectors.search(df).count() == 0
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert vectors.search(one).count() == 0


def test_queries_run_over_whole_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name in ("op3_notices", "op5_sharding"):
        assert QUERIES[name](spark, SF).count() == docs.count()


def test_pipeline_equals_its_stages_and_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "deduplicate", "decontaminate", "mix", "shard"]
    kept = docs
    for name, step in corpus_pipeline.STAGES:
        before, kept = kept, step(spark, kept, SF)
        if name != "shard":
            assert kept.columns == docs.columns
        kept = kept.cache()
        if name == "language":
            assert kept.count() == docs.count()  # every text has letters
        if name == "mix":
            assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {r["doc_id"] for r in before.select("doc_id").collect()}
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, kept.collect()))


def test_rejected_languages_go(spark):
    rows = [(1, "the cat", "en", "s", 7), (2, "12 34", "en", "s", 5), (3, None, "en", "s", 0), (4, "le chat", "fr", "s", 7), (4, "...", "fr", "s", 3), (None, "the dog", "en", "s", 7)]
    docs = spark.createDataFrame(rows * 3, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.language(spark, docs, SF)
    assert sorted(str(r["doc_id"]) + r["text"] for r in kept.collect()) == sorted(["1the cat", "4le chat", "Nonethe dog"] * 3)
    assert langid.train(docs) != b""
