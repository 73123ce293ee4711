"""N-gram Jaccard join: a prefix-tree join.

A document's set is its distinct five-word shingles; two documents link when 100 * |intersection| >= 75 * |union|.

1. Documents with equal sets are one class, told apart by size and fingerprints.
2. The shingles of all classes meet by hash, packed, to be counted. A shingle of one class alone cannot be shared and
   comes first in the global order, the others by ascending count. A set that has enough lone shingles links with nothing:
   its prefix, of which any partner must share an element, holds nothing shared. That settles nearly all documents.
3. The others keep their shared shingles. In every group of sets that share a prefix element, each set is joined with the
   group's most central set, which links most groups of copies at once.
4. Groups that overlap form a cluster. In clusters of more than one component, sets outside the largest component are
   joined with all sets of the cluster, in blocks. Pairs within a component need no check, as only components are asked for.
5. Components over all links.

Joins 3 and 4 put one side into a trie in the global order and let each set of the other side descend it once. No pairs
within a group are listed, no group is in one task, and every pair that can link across components is checked.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import Staging
from .components import smallest
from .trie import Trie
from .words import Texts, mix, pack, record, slices

SHINGLE = 5
PERCENT = 75
#: Text bytes whose shingles one counting task takes.
SHARD_BYTES = 16 << 20
#: Sets of a block in the joins within clusters.
BLOCK = 256
HASH_BITS = 52
LOW = (1 << 40) - 1


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of HASH_BITS bits of each text, ascending, one text after the other; sizes; bounds."""
    texts = Texts(column)
    word, counts = texts.hashes(), texts.counts
    sizes = np.where(counts >= SHINGLE, counts - SHINGLE + 1, (counts > 0).astype(np.int64))
    h = np.zeros(max(0, len(word)), np.uint64)
    for k in range(SHINGLE):
        if len(word) > k:
            h[: len(word) - k] = mix(h[: len(word) - k] ^ word[k:]) if k else mix(word)
    # short texts are one shingle: their words alone, in order
    for i in np.flatnonzero((counts > 0) & (counts < SHINGLE)):
        a, b = texts.word_bounds[i], texts.word_bounds[i + 1]
        short = np.uint64(b - a)
        for x in word[a:b]:
            short = mix(np.array([short ^ x], np.uint64))[0]
        h[a] = short
    text = np.repeat(np.arange(texts.n, dtype=np.uint64), sizes)
    at = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(texts.word_bounds[:-1], sizes)
    key = np.sort(text << np.uint64(HASH_BITS) | h[at] >> np.uint64(64 - HASH_BITS))
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    # by text numbers: the end of the last of 4096 texts is 2^64, which no key of 64 bits can say
    bounds = np.searchsorted(key >> np.uint64(HASH_BITS), np.arange(texts.n + 1, dtype=np.uint64))
    return key & np.uint64((1 << HASH_BITS) - 1), np.diff(bounds), bounds


def prints(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit fingerprints of each set: sums of scrambled elements."""
    out = []
    for salt in (0x51ED270B, 0x2545F491):
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h + np.uint64(salt)), dtype=np.uint64)])
        out.append((running[bounds[1:]] - running[bounds[:-1]]).view(np.int64))
    return out[0], out[1]


def text_hash(text: Column | str = "text") -> Column:
    """Tells apart texts of one id; null is as the empty text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keyed(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, the columns to keep (long), n, p1, p2: size and fingerprints of every document's set."""
    names = ["doc_id", *keep]
    schema = pa.schema([(c, pa.int64()) for c in (*names, "n", "p1", "p2")])

    def run(batches):
        for piece in slices(batches):
            h, n, bounds = shingles(piece.column("text"))
            yield record(schema, *[piece.column(c) for c in names], n, *prints(h, bounds))

    return docs.select(*[F.col(c).cast("long").alias(c) for c in names], "text").mapInArrow(run, ", ".join(f"{c} long" for c in schema.names))


def dealt(docs: DataFrame, shards: int) -> DataFrame:
    """The shingles of every set, dealt by hash: a row per slice of texts and shard, packed.

    sets and sizes name the sets present, counts says how many hashes follow for each, low and high hold the hashes' last 40 bits.
    """
    schema = pa.schema([("shard", pa.int32()), *[(c, pa.binary()) for c in ("sets", "sizes", "counts", "low", "high")]])

    def run(batches):
        for piece in slices(batches):
            h, n, bounds = shingles(piece.column("text"))
            p1, _ = prints(h, bounds)
            # copies within the slice go once
            first = np.zeros(len(n), bool)
            first[np.unique(np.stack([p1, n], 1), axis=0, return_index=True)[1]] = True
            text = np.repeat(np.arange(len(n)), n)
            keep = first[text]
            h, text = h[keep], text[keep]
            shard = ((h >> np.uint64(HASH_BITS - 32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(shard.astype(np.uint16) if shards < 1 << 16 else shard, kind="stable")
            h, text, shard = h[order] & np.uint64(LOW), text[order], shard[order]
            cuts = np.searchsorted(shard, np.arange(shards + 1))
            rows = []
            for s in np.flatnonzero(np.diff(cuts)):
                own, low = text[cuts[s] : cuts[s + 1]], h[cuts[s] : cuts[s + 1]]
                at = np.flatnonzero(np.diff(own, prepend=-1))
                names = own[at]
                counts = np.diff(np.append(at, len(own)))
                rows.append((s, pack(p1[names]), pack(n[names].astype(np.int32)), pack(counts.astype(np.int32)), pack(low.astype(np.uint32)), pack((low >> np.uint64(32)).astype(np.uint8))))
            if rows:
                yield record(schema, *[list(c) for c in zip(*rows)])

    return docs.select("text").mapInArrow(run, "shard int, sets binary, sizes binary, counts binary, low binary, high binary")


def unpacked(column, kind) -> np.ndarray:
    pieces = [np.frombuffer(x, kind) for x in column.to_pylist()]
    return np.concatenate(pieces) if pieces else np.zeros(0, kind)


#: Sets with some of their shared shingles, packed: a row per shard and bucket of sets.
SHARED = pa.schema([("bucket", pa.int32()), *[(c, pa.binary()) for c in ("sets", "sizes", "counts", "ids", "held")]])
SHARED_SQL = "bucket int, sets binary, sizes binary, counts binary, ids binary, held binary"


def bucket_of(p1: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(p1.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def shared(table: pa.Table, buckets: int) -> pa.Table:
    """Of one shard: for every set, the shingles that at least two sets have, and how many have them."""
    counts = unpacked(table.column("counts"), np.int32)
    name = np.stack([unpacked(table.column("sets"), np.int64), unpacked(table.column("sizes"), np.int32).astype(np.int64)], 1)
    low = unpacked(table.column("low"), np.uint32).astype(np.uint64) | unpacked(table.column("high"), np.uint8).astype(np.uint64) << np.uint64(32)
    order = np.lexsort((name[:, 1], name[:, 0]))
    change = np.concatenate([[True], (np.diff(name[order], axis=0) != 0).any(1)])
    dense = np.empty(len(name), np.int64)
    dense[order] = np.cumsum(change) - 1
    names = name[order][change]
    entry = np.repeat(dense, counts)
    order = np.lexsort((entry, low))
    low, entry = low[order], entry[order]
    lone = np.concatenate([[True], (low[1:] != low[:-1]) | (entry[1:] != entry[:-1])])
    low, entry = low[lone], entry[lone]
    runs = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    held = np.repeat(np.diff(np.append(runs, len(low))), np.diff(np.append(runs, len(low))))
    both = held > 1
    low, entry, held = low[both], entry[both], held[both]
    # by bucket of sets, then by set
    bucket = bucket_of(names[:, 0], buckets)[entry]
    order = np.lexsort((entry, bucket))
    bucket, entry, held = bucket[order], entry[order], held[order]
    ids = low[order] | np.uint64(table.column("shard")[0].as_py()) << np.uint64(40)
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    rows = []
    for b in np.flatnonzero(np.diff(cuts)):
        own = entry[cuts[b] : cuts[b + 1]]
        at = np.flatnonzero(np.diff(own, prepend=-1))
        own_names = names[own[at]]
        counts = np.diff(np.append(at, len(own))).astype(np.int32)
        part = slice(cuts[b], cuts[b + 1])
        rows.append((b, pack(own_names[:, 0]), pack(own_names[:, 1].astype(np.int32)), pack(counts), pack(ids[part]), pack(held[part].astype(np.uint32))))
    return pa.Table.from_batches([record(SHARED, *([list(c) for c in zip(*rows)] or [[]] * len(SHARED)))])


OPEN = pa.schema([("p1", pa.int64()), ("n", pa.int64()), ("items", pa.binary()), ("prefix", pa.list_(pa.int64())), ("centre", pa.float64())])


def open_sets(table: pa.Table) -> pa.Table:
    """Of one bucket, the sets that may link: p1, n, items, prefix, centre.

    items are the shared elements in global order with their counts, prefix those that any partner must share one of,
    centre is the mean count.
    """
    counts = unpacked(table.column("counts"), np.int32)
    name = np.stack([unpacked(table.column("sets"), np.int64), unpacked(table.column("sizes"), np.int32).astype(np.int64)], 1)
    ids, held = unpacked(table.column("ids"), np.uint64), unpacked(table.column("held"), np.uint32)
    names, dense = np.unique(name, axis=0, return_inverse=True)
    entry = np.repeat(dense.ravel(), counts)
    have = np.bincount(entry, minlength=len(names))
    size = names[:, 1]
    wanted = size - -(-PERCENT * size // 100) + 1 - (size - have)
    keep = wanted[entry] > 0
    ids, held, entry = ids[keep], held[keep], entry[keep]
    order = np.lexsort((ids, held, entry))
    ids, held, entry = ids[order].view(np.int64), held[order], entry[order]
    bounds = np.searchsorted(entry, np.arange(len(names) + 1))
    rows = []
    for k in np.flatnonzero(wanted > 0):
        items, times = ids[bounds[k] : bounds[k + 1]], held[bounds[k] : bounds[k + 1]]
        rows.append((names[k, 0], size[k], pack(items) + pack(times), items[: wanted[k]].tolist(), float(times.sum() / size[k])))
    return pa.Table.from_batches([record(OPEN, *([list(c) for c in zip(*rows)] or [[]] * len(OPEN)))])


def ranked(items: bytes) -> tuple[int, ...]:
    """Elements as integers that sort in the global order: count, then hash."""
    m = len(items) // 12
    ids, held = np.frombuffer(items[: 8 * m], np.int64), np.frombuffer(items[8 * m :], np.uint32)
    return tuple((int(c) << 64) | int(x) for c, x in zip(held, ids))


def star_links(pairs: DataFrame) -> DataFrame:
    """Links a, b among rows (a, n, items, b, hub_n, hub_items): per batch and hub, the sets as a trie that the hub descends."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            tries: dict[int, tuple] = {}
            for a, n, items, b, hub_n, hub_items in zip(*(batch.column(c).to_pylist() for c in ("a", "n", "items", "b", "hub_n", "hub_items"))):
                if b not in tries:
                    tries[b] = (Trie(), ranked(hub_items), hub_n)
                tries[b][0].add(ranked(items), n, a)
            out = [(name, b) for b, (trie, hub, n) in tries.items() for name, _ in trie.similar(hub, n, PERCENT)]
            if out:
                yield record(schema, *[list(c) for c in zip(*out)])

    return pairs.mapInArrow(run, "a long, b long")


def block_links(probes: pa.Table, base: pa.Table) -> pa.Table:
    """Links between two blocks of sets (node, n, items, component), those within a component left out."""
    trie, component, out = Trie(), {}, []
    for node, n, items, c in zip(*(base.column(k).to_pylist() for k in ("node", "n", "items", "component"))):
        trie.add(ranked(items), n, node)
        component[node] = c
    if base.num_rows:
        for node, n, items, c in zip(*(probes.column(k).to_pylist() for k in ("node", "n", "items", "component"))):
            out += [(node, other) for other, _ in trie.similar(ranked(items), n, PERCENT) if component[other] != c]
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})


def links(sets: DataFrame, stage: Staging) -> DataFrame:
    """Links a, b that connect all that is connected. sets: node, n, items, prefix, centre."""
    postings = stage(sets.select("node", "n", "centre", F.explode("prefix").alias("item")))
    hubs = postings.groupBy("item").agg(F.max(F.struct("centre", (-F.col("node")).alias("back"))).alias("hub"))
    to = stage(postings.join(hubs, "item").select("node", (-F.col("hub.back")).alias("hub"), F.col("hub.centre").alias("hub_centre")).distinct())
    chosen = to.where("node <> hub").groupBy("node").agg(F.max(F.struct("hub_centre", (-F.col("hub")).alias("back"))).alias("h")).select(F.col("node").alias("a"), (-F.col("h.back")).alias("b"))
    own = sets.select(F.col("node").alias("a"), "n", "items")
    hub = sets.select(F.col("node").alias("b"), F.col("n").alias("hub_n"), F.col("items").alias("hub_items"))
    close = F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * PERCENT
    star = stage(star_links(chosen.join(own, "a").join(hub, "b").where(close)))

    found = stage(smallest(star))
    label = lambda c: F.coalesce(F.col(f"{c}_component"), F.col(c))
    named = lambda c: found.select(F.col("node").alias(c), F.col("component").alias(f"{c}_component"))
    meet = to.join(named("node"), "node", "left").join(named("hub"), "hub", "left").select(label("node").alias("a"), label("hub").alias("b")).where("a <> b").distinct()
    clusters = stage(smallest(meet).select(F.col("node").alias("of"), F.col("component").alias("cluster")))
    placed = sets.select("node", "n", "items").join(found, "node", "left").withColumn("of", F.coalesce("component", "node")).drop("component").join(clusters, "of")
    placed = stage(placed.withColumnRenamed("of", "component"))
    sizes = placed.groupBy("cluster", "component").agg(F.count("*").alias("rows"))
    largest = sizes.groupBy("cluster").agg(F.max(F.struct("rows", "component")).alias("m"), F.sum("rows").alias("all"))
    largest = largest.select("cluster", F.col("m.component").alias("main"), F.ceil(F.col("all") / BLOCK).alias("blocks"), (F.col("all") - F.col("m.rows")).alias("others"))
    cut = placed.join(largest, "cluster")
    base = cut.withColumn("block", F.pmod(F.xxhash64("node"), "blocks")).withColumn("probe_block", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("others") / BLOCK) - 1)))
    probes = cut.where("component <> main").withColumn("probe_block", F.pmod(F.xxhash64(F.lit(1), "node"), F.ceil(F.col("others") / BLOCK)))
    probes = probes.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    keys = ["cluster", "probe_block", "block"]
    columns = [*keys, "node", "n", "items", "component"]
    more = probes.select(columns).toDF(*columns).groupBy(keys).cogroup(base.select(columns).groupBy(keys)).applyInArrow(block_links, "a long, b long")
    return star.unionByName(stage(more))


def join(docs: DataFrame, shard_bytes: int = SHARD_BYTES, keep_text_hash: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs; on request text_hash, and component, which no two components share.

    A text without words, or null, has no shingle and links with nothing: its component is its own id. Rows that repeat
    are linked copies and give a row each; ids that repeat with other texts are rows of their own. A null id is in no
    component's name: a component of nothing else has a null id. Other columns are not read.
    """
    stage = Staging(docs.sparkSession)
    keep = ["text_hash"] if keep_text_hash else []
    keys = stage(keyed(docs.select("doc_id", text_hash().alias("text_hash"), "text") if keep else docs, *keep))
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    shards = max(8, -(-size // shard_bytes))
    pieces = dealt(docs, shards).groupBy("shard").applyInArrow(lambda t: shared(t, shards), SHARED_SQL)
    # named by their sets, as an id may have several; without a sign, as links() turns the order round
    classes = keys.where("n > 0").groupBy("n", "p1", "p2").agg(F.min("doc_id").alias("first")).withColumn("node", F.shiftrightunsigned(F.xxhash64("n", "p1", "p2"), 1))
    opened = stage(pieces.groupBy("bucket").applyInArrow(open_sets, "p1 long, n long, items binary, prefix array<long>, centre double"))
    sets = stage(opened.join(classes, ["p1", "n"]).select("node", "n", "items", "prefix", "centre"))
    found = stage(smallest(links(sets, stage)))
    least = stage(found.join(classes, "node").groupBy("component").agg(F.min("first").alias("least")))
    labels = found.join(least, "component")
    named = classes.join(labels, "node", "left").select("n", "p1", "p2", F.coalesce("component", "node").alias("component"), F.coalesce("least", "first").alias("component_id"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id", *([*keep, "component"] if keep else [])]
    linked = keys.where("n > 0").join(named, ["n", "p1", "p2"]).select(columns)
    empty = keys.where("n = 0").withColumns({"component_id": F.col("doc_id"), "component": F.lit(None).cast("long")}).select(columns)
    return linked.unionByName(empty)


def distinct(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, with one row of each component: of the smallest id, and there of the smallest text hash.

    Documents without words are all kept, and so are those of null id.
    """
    stage = Staging(docs.sparkSession)
    found = join(docs, keep_text_hash=True).where("n_shingles > 0 and doc_id is not null")
    # rows that repeat are one here
    rows = stage(found.groupBy("component", "doc_id", "text_hash").agg(F.count("*").alias("times")))
    chosen = stage(rows.groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("chosen"), F.count("*").alias("members")).where("members > 1"))
    gone = rows.join(chosen, "component").where(F.struct("doc_id", "text_hash") != F.col("chosen"))
    again = rows.where("times > 1")
    same = lambda d, pairs: (d["doc_id"] == pairs["_id"]) & (text_hash(d["text"]) == pairs["_hash"])
    pairs = lambda df: df.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    gone, again = pairs(gone), stage(pairs(again))
    kept = docs.join(gone, same(docs, gone), "left_anti")
    if again.isEmpty():
        return kept
    # one of the rows that repeat, a minimum for each pair: no row of a pair waits for the others in one task
    one = F.min_by(F.struct(*[kept[c] for c in kept.columns]), F.xxhash64(F.to_json(F.struct(*[kept[c] for c in kept.columns])))).alias("_row")
    repeated = kept.join(again, same(kept, again), "left_semi").groupBy("doc_id", text_hash().alias("_hash")).agg(one).select("_row.*")
    return kept.join(again, same(kept, again), "left_anti").unionByName(repeated)
