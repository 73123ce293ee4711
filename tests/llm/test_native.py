"""Sharding, mixing and decontamination against brute force."""

import math
import struct
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerspark.llm import decontaminate, mixing, sharding

SF = "/root/testdata/sf0.01"


def draw(key, node):
    seed = xxhash.xxh64_intdigest(node.name.encode(), 42)
    h = xxhash.xxh64_intdigest(struct.pack("<q", key), seed) if key is not None else seed
    return -math.log(((h >> 12) + 0.5) / (1 << 52)) / node.total()


def descend(key, node):
    while node.children:
        node = min(node.children, key=lambda c: draw(key, c)) if len(node.children) > 1 else node.children[0]
    return node.shard


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_shards_equal_a_plain_descent(spark, docs):
    root = sharding.tree()
    more = sharding.grown(root, 8)
    rows = sharding.shard(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["shard"] == descend(r["doc_id"], root)
        assert r["grown_shard"] == descend(r["doc_id"], more)
        assert r["grown_shard"] in (r["shard"], 8)
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    assert set(by) == set(range(8)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sum(r["grown_shard"] == 8 for r in rows) == pytest.approx(len(rows) / 9, rel=0.35)


def test_changed_weights_move_rows_only_within_their_subtrees(spark):
    keys = spark.range(4000)
    root, heavier = sharding.tree(), sharding.tree()
    heavier.children[1].children[0].children[1].weight = 2.0
    rows = keys.select(sharding.descend(F.col("id"), root).alias("a"), sharding.descend(F.col("id"), heavier).alias("b")).collect()
    for a, b in rows:
        # region 1 (shards 4 to 7) gains, its rack of shards 4 and 5 gains, shard 5 gains
        if a // 4 == b // 4 == 0:
            assert a == b
        elif a // 4 == 1:
            assert b // 4 == 1 and (a == b or (b in (4, 5) and (a // 2 != 2 or b == 5)))
    assert sum(a != b for a, b in rows) < 1000
    shares = Counter(b for _, b in rows)
    assert shares[5] / len(rows) == pytest.approx(2 / 9, abs=0.03)


def test_slots_over_many_buckets(spark):
    rows = spark.range(5000).select((F.col("id") % 3).alias("g"), (F.col("id") % 700).alias("k"))
    got = defaultdict(list)
    for r in sharding.number(rows, "g", "k", "slot", 100).collect():
        got[r["g"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in got.values())


def test_shards_of_odd_rows(spark):
    docs = spark.createDataFrame([(None, None, 1), (None, "a", 2), (3, "é", 3), (3, "é", 4), (3, None, 5)], "doc_id long, text string, size int")
    rows = sharding.shard(docs).collect()
    assert len(rows) == 5 and len({(r["shard"], r["slot"]) for r in rows}) == 5
    assert sorted((r["size"], r["text_crc32"]) for r in rows)[:2] == [(1, 0), (1, 0)]
    assert sharding.shard(docs.limit(0)).count() == 0


def mix_rows(spark, hot=300):
    rows = [(i, "hot", "w " * (i % 7 + 1)) for i in range(hot)] + [(1000 + i, "cold", "w x y") for i in range(20)] + [(2000 + i, None, "w") for i in range(30)]
    return spark.createDataFrame([*rows, (3000, "cold", None), (3001, "silent", ""), (3001, "silent", "")], "doc_id long, source string, text string")


def shares(rows):
    tokens = Counter()
    for r in rows:
        tokens[r["source"]] += r["n_tokens"]
    total = sum(tokens.values())
    return {k: v / total for k, v in tokens.items()}


def test_every_document_is_used_and_weights_are_met(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 16)
    docs = mix_rows(spark)
    rows = mixing.mix(docs, entropy=0.8, repeats=50.0).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}
    weights = {r["source"]: r["weight"] for r in rows if r["n_tokens"]}
    assert -sum(w * math.log(w) for w in weights.values()) / math.log(3) == pytest.approx(0.8, abs=1e-3)
    for source, share in shares(rows).items():
        if source != "silent":
            assert share == pytest.approx(weights[source], abs=0.01)
    uses = Counter((r["doc_id"], r["pass"]) for r in rows)
    assert all(n == 1 for (d, _), n in uses.items() if d != 3001) and uses[3001, 0] == 2
    # in whole passes every document of the source is used
    full = {s: math.floor(max(r["passes"] for r in rows if r["source"] == s and r["passes"])) for s in weights}
    sizes = Counter(r["source"] for r in docs.where("length(text) > 0").collect())
    for s, n in full.items():
        for p in range(n):
            assert sum(r["source"] == s and r["pass"] == p and r["n_tokens"] > 0 for r in rows) == sizes[s]


def test_repeats_are_limited(spark):
    rows = mixing.mix(mix_rows(spark), entropy=1.0, repeats=2.0).collect()
    assert max(r["passes"] for r in rows if r["passes"]) == pytest.approx(2.0)
    assert min(r["passes"] for r in rows if r["passes"]) == pytest.approx(1.0)


def test_a_budget_is_kept(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 16)
    rows = mixing.mix(mix_rows(spark), budget=500).collect()
    assert 480 <= sum(r["n_tokens"] for r in rows) <= 500
    assert all(0 <= r["position"] < 1 for r in rows)


def test_exponent_equals_plain_bisection(spark):
    tokens = [50, 20, 20, 7, 3]
    shares = [t / sum(tokens) for t in tokens]

    def entropy(t):
        w = [s**t for s in shares]
        w = [x / sum(w) for x in w]
        return -sum(x * math.log(x) for x in w)

    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if entropy(middle) >= 0.9 * math.log(5) else (low, middle)
    totals = spark.createDataFrame([(x,) for x in shares], "share double")
    assert mixing.exponent(totals, 5, 0.9, 1e9) == pytest.approx(low, abs=1e-6)


def test_mixing_nothing(spark):
    assert mixing.mix(mix_rows(spark).limit(0)).count() == 0
    assert mixing.mix(mix_rows(spark).where("source = 'silent'")).count() == 2
    clash = mix_rows(spark).withColumn("pass", F.lit("x")).withColumn("weight", F.lit("x"))
    assert mixing.mix(clash).count() >= 300


SF = "/root/testdata/sf0.001"
ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma"


def find_overlaps(docs, items, masks=decontaminate.MASKS):
    """Every window of every text against every window, and every rule by itself."""
    split = lambda t: (t or "").lower().split()
    out = set()
    shortest = min(map(len, masks))
    for d, t in docs:
        w = split(t)
        for i, b in items:
            b = split(b)
            used = [*masks, *(["1" * len(b)] if 0 < len(b) < shortest else [])]
            agreeing = {}
            for m in used:
                for x in range(len(w) - len(m) + 1):
                    for y in range(len(b) - len(m) + 1):
                        if all(w[x + k] == b[y + k] for k, bit in enumerate(m) if bit == "1"):
                            agreeing[x - y] = [0 <= x - y + k < len(w) and w[x - y + k] == b[k] for k in range(len(b))]
            half = math.ceil(len(b) / 2)
            for at, same in agreeing.items():
                quoted = any(same[k] and same[k + 12] and sum(same[k : k + 13]) >= 11 for k in range(len(b) - 12))
                halves = [[o for p, o in agreeing.items() if (p + shift) // 16 == (at + shift) // 16] for shift in (0, 8)]
                if quoted or any(sum(map(any, zip(*together))) >= half for together in halves):
                    out.add((d, i))
    return out


def test_partial_quotes_are_reported(spark):
    item = lambda name, n: [f"{name}{i}" for i in range(n)]
    a, b, c, noise = item("a", 60), item("b", 600), item("c", 36), item("n", 200)
    parts = [
        noise[:40] + a[20:49] + noise[40:], noise[:10] + b[100:350], [*c[:12], "new", *c[12:24], "new", "new", *c[24:]], a[:13], a[3:9] + ["X"] + a[10:16], noise, a[:10], a[:12] + noise + a[12:24],
        c[:10] + noise + c[10:20], a[5:11] + ["X"] + a[12:14] + ["Y"] + a[15:30],
    ]
    docs = [(i, " ".join(w)) for i, w in enumerate(parts)]
    items = [(k, " ".join(w)) for k, w in enumerate((a, b, c))]
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(got) == find_overlaps(docs, items)
    assert {(0, 0), (1, 1), (2, 2), (3, 0), (4, 0)} <= set(got) and not {5, 6, 8} & {d for d, _ in got}
    assert (got[0, 0]["agree"], got[0, 0]["item_words"], got[0, 0]["first_word"]) == (29, 60, 20)
    assert got[1, 1]["agree"] == 250


def test_words_are_not_shuffled_with_the_windows(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    plans = []
    stage = decontaminate.Staging.__call__
    monkeypatch.setattr(decontaminate.Staging, "__call__", lambda self, df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or stage(self, df))
    docs, items = spark.createDataFrame([(1, f"x y {ITEM}")], "doc_id long, text string"), spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    decontaminate.overlaps(docs, items)
    joined = next(p for p in plans if "offset" in p and "seed" in p)
    for block in joined.split("Exchange hashpartitioning(seed")[1:]:
        below = next(line for line in block.splitlines() if "Project [" in line)
        assert " w#" not in below and "[w#" not in below


def test_overlaps_equal_brute_force(spark):
    words = ITEM.split()
    noise = "one two three four five six seven eight nine ten"
    changed = lambda *at: " ".join("X" if i in at else w for i, w in enumerate(words))
    docs = [
        (1, f"{noise} {ITEM} {noise}"), (2, f"{noise} {changed(4)}"), (3, f"{changed(2, 9)} {noise}"), (4, changed(*range(0, 18, 2))), (5, noise * 20),
        (6, " ".join(words[:10])), (7, " ".join(words[6:])), (8, " ".join(words[3:15])), (9, None), (10, ""), (11, f"see short one here {noise}"), (12, ITEM.upper()),
        (13, "see short two here"), (None, ITEM), (14, changed(3, 7, 11, 15)), (15, f"{ITEM} {ITEM}"),
    ]
    items = [(100, ITEM), (101, "short one here"), (102, None), (103, ""), (100, ITEM)]
    got = decontaminate.overlaps(
        spark.createDataFrame([(*d, 1) for d in [*docs, docs[0]]], "doc_id long, text string, item_id int"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in got) == sorted((d or 0, i) for d, i in find_overlaps(docs, items))
    assert {(2, 100), (3, 100), (11, 101)} <= {(r["doc_id"], r["item_id"]) for r in got}
    first = next(r for r in got if r["doc_id"] == 2)
    assert (first["agree"], first["item_words"], first["first_word"], first["last_word"]) == (17, 18, 10, 27)


def test_beyond_the_broadcast_bound_the_result_is_the_same(spark, monkeypatch):
    docs, items = spark.createDataFrame([(1, f"x y {ITEM}"), (2, "x y z")], "doc_id long, text string"), spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    near = sorted(decontaminate.overlaps(docs, items).collect())
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert sorted(decontaminate.overlaps(docs, items).collect()) == near != []


def test_clean_documents_stay(spark):
    docs = spark.createDataFrame([(1, f"x {ITEM}", 1), (2, "x y z", 2), (1, "other", 3), (None, None, 4), (2, "x y z", 5), (None, ITEM, 6)], "doc_id long, text string, fingerprint int")
    items = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r["fingerprint"] for r in kept.collect()) == [2, 3, 4, 5]
    assert decontaminate.clean(docs, items.limit(0)).count() == 6
    assert decontaminate.clean(docs.limit(0), items).count() == 0


def test_quotes_in_part_go(spark):
    long = [f"q{i}" for i in range(60)]
    short = "one short item of just these eleven words and no more".split()
    changed = lambda w, *at: " ".join("X" if i in at else x for i, x in enumerate(w))
    bad = [" ".join(long[5:25]), changed(long[30:46], 8), *[changed(short, i) for i in range(11)], changed(short, 2, 8), changed("six words are all it has".split(), 3)]
    middle = [f"m{i}" for i in range(36)]
    bad.append(" ".join([*middle[:12], "new", *middle[12:24], "new", *middle[24:]]))
    good = [" ".join(long[5:16]), " ".join(short[:5]), "six words are", changed(short, 1, 4, 7, 10), " ".join(middle[:12])]
    docs = spark.createDataFrame([(i, f"before that {t} after that") for i, t in enumerate(bad + good)], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(short)), (3, "six words are all it has"), (4, " ".join(middle))], "item_id long, text string")
    assert sorted(r["doc_id"] for r in decontaminate.clean(docs, items).collect()) == list(range(len(bad), len(bad + good)))


CLASH = ["_id", "_hash", "_print", "_s", "_b", "_source", "_block", "pass", "block", "weight", "row", "of", "id", "number", "n_tokens", "contaminated_id", "other_of", "rejected_id"]


def test_stages_keep_columns_of_any_name(spark):
    """All stages on a table whose columns have the names that they use themselves."""
    import corpus_pipeline

    texts = [f"the cat {i} sat on the mat and then it went away {i * 7} times" for i in range(30)]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t), *[f"{c}{i}" for c in CLASH]) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"`{c}` string" for c in CLASH))
    for name, step in corpus_pipeline.STAGES:
        made = step(spark, docs, SF)
        rows = made.collect()
        if name != "shard":
            assert made.columns == docs.columns, name
            assert all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in CLASH), name
        assert {r["doc_id"] for r in rows} == set(range(30)), name


def test_rows_of_one_id_are_spread(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 50)
    n = 2000
    docs = spark.range(n).select(F.lit(7).cast("long").alias("doc_id"), F.lit("a b c").alias("text"), F.when(F.col("id") < 1900, "x").otherwise("y").alias("source"))
    used = mixing.mix(docs)
    sizes = [r["count"] for r in used.groupBy("source", "pass", "block").count().collect()]
    assert used.where("pass = 0").count() == n and len(sizes) > 20 and max(sizes) < 120
    numbered = sharding.shard(docs.withColumn("text", F.when(F.col("source") == "x", F.col("text")).otherwise(F.concat("text", F.rand(1).cast("string")))))
    slots = sorted(r["slot"] for r in numbered.collect())
    assert slots == list(range(n))


def test_the_cut_is_the_same_however_rows_lie(spark, monkeypatch):
    rows = [(i % 7, f"w{i} " * (1 + i % 5), f"s{i % 2}") for i in range(200)]
    cuts = []
    for parts in (1, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
        cuts.append(sorted((r["doc_id"], r["text"], r["pass"]) for r in mixing.mix(docs, budget=400).collect()))
    assert cuts[0] == cuts[1] and 0 < len(cuts[0]) < 200


def chain(*values):
    """The hash of several values: ints of 4 bytes given as (int,), others of 8."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(struct.pack("<i", v[0]) if isinstance(v, tuple) else struct.pack("<q", v), h)
    return h - (1 << 64) if h >= 1 << 63 else h


def test_mixing_equals_brute_force(spark, monkeypatch):
    """The permutations, the blocks and the cut, one row at a time."""
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 10)
    rows = [(i, " ".join(["w"] * (i * 7 % 9)), ["big"] * 6 + ["mid"] * 2 + ["small"]) for i in range(180)]
    rows = [(i, t, names[i % 9]) for i, t, names in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for budget in (None, 700):
        totals = Counter()
        for _, t, s in rows:
            totals[s] += len(t.split())
        whole = sum(totals.values())
        shares = spark.createDataFrame([(s, n / whole) for s, n in totals.items()], "source string, share double")
        t = mixing.exponent(shares, 3)
        raw = {s: (n / whole) ** t for s, n in totals.items()}
        spend = budget or sum(raw.values()) / min(raw[s] / totals[s] for s in totals)
        want = []
        for s, n in totals.items():
            own = [(i, len(text.split())) for i, text, x in rows if x == s]
            passes = raw[s] / sum(raw.values()) * spend / n
            blocks = defaultdict(list)
            for i, size in own:
                block = chain((1,), i) % max(1, math.ceil(len(own) / 10))
                if size:
                    blocks[block].append((i, size))
                else:
                    want.append((i, 0, block))
            for turn in range(max(math.ceil(round(passes, 9)), 1)):
                left, start = math.floor(n * (passes - turn) + 0.5), 0
                for block in sorted(blocks, key=lambda b: (chain((1,), (turn,), b), b)):
                    size = sum(x for _, x in blocks[block])
                    upto = start
                    for i, x in sorted(blocks[block], key=lambda d: (chain((1,), (turn,), d[0]), d[0])):
                        upto += x
                        if start < left and (start + size <= left or upto <= left):
                            want.append((i, turn, block))
                    start += size
        got = sorted((r["doc_id"], r["pass"], r["block"]) for r in mixing.mix(docs, budget=budget).collect())
        assert got == sorted(want) and len(got) > 60
