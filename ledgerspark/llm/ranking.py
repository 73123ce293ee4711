"""Ranked lexical search: a K2-treap over the grid of terms and documents.

Documents are indexed in blocks of some MB of text. A block's grid has a row for each of its terms, the most frequent
first, and a column for each document, in the order of length; the value of a point is the impact of the term in the
document, (10^9 tf) div (1000 tf + 20 m). A term's weight isn't part of it, so the index needs the corpus' totals alone.

An item descends along the rows of its terms jointly: a state is a range of columns with the cell of every term that
spans it, and its bound is the sum of weight times cell maximum. States with the highest bounds are halved first, STATES
at a time; at a single column the bound is the document's score. A block is done when no bound beats its K-th score.
The block's best K documents of each item meet in one ranking.

Terms are told apart by 64 bits.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import Staging
from . import treap
from .words import NOT_WORD, Texts, record, slices

K = 50
#: Text of a block, beyond one text, and its documents.
BLOCK_BYTES = 4 << 20
BLOCK_DOCS = 1 << 14
#: Terms of items that are searched for in one pass over the index.
PASS_TERMS = 1 << 20
#: Parts of an item's hits that are ranked by themselves.
PARTS = 64
#: States of an item that are halved together.
STATES = 512

TOTALS = pa.schema([("term", pa.int32()), ("n", pa.int64())])
BLOCKS = pa.schema([("docs", pa.int32()), ("postings", pa.int64()), ("block", pa.binary())])
HITS = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64()), ("no_id", pa.bool_())])
HITS_SQL = "item int, doc_id long, score long, no_id boolean"


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of the wanted in ascending keys, -1 where they are not."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def postings(found: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, term and number of occurrences for every distinct (text, term), by term."""
    h, text = found.hashes(), found.text_of_word()
    order = np.lexsort((text, h))
    h, text = h[order], text[order]
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])])) if len(h) else np.zeros(0, np.int64)
    return text[first], h[first], np.diff(np.append(first, len(h)))


def term_hashes(text: str | None) -> np.ndarray:
    return np.unique(Texts(pa.array([text], pa.string()), NOT_WORD).hashes())


# --- totals ---------------------------------------------------------------------------------


def totals_of(docs: DataFrame, terms: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Documents that have a term, all their terms with repeats, and the documents that hold each of the given (ascending) terms."""

    def count(batches):
        n, length, held = 0, 0, np.zeros(len(terms), np.int64)
        for piece in slices(batches):
            found = Texts(piece.column("text"), NOT_WORD)
            n, length = n + int((found.counts > 0).sum()), length + len(found.starts)
            at = find(terms, found.hashes())
            known = np.flatnonzero(at >= 0)
            pairs = np.unique(at[known] * found.n + found.text_of_word()[known])
            held += np.bincount(pairs // max(found.n, 1), minlength=len(terms))
        some = np.flatnonzero(held)
        # -1: documents with a term, -2: their terms
        yield record(TOTALS, np.concatenate([some, [-1, -2]]).astype(np.int32), np.concatenate([held[some], [n, length]]))

    found = docs.select("text").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    held = np.zeros(len(terms) + 2, np.int64)
    held[found["term"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return int(held[-1]), int(held[-2]), held[:-2]


# --- index ----------------------------------------------------------------------------------


def blocks_of(n_docs: int, length: int, block_bytes: int, block_docs: int):
    """From batches of documents to the blocks of their index."""

    def make(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        found = Texts(rows.column("text").chunk(0), NOT_WORD)
        # columns by length: documents of like impact lie side by side
        order = np.argsort(found.counts, kind="stable")
        column = np.empty(found.n, np.int64)
        column[order] = np.arange(found.n)
        text, h, tf = postings(found)
        n = found.counts.astype(np.int64)[text]
        m = 50 + 50 * n * n_docs // max(length, 1)
        impact = 1_000_000_000 * tf.astype(np.int64) // (1000 * tf + 20 * m)
        terms, first, df = np.unique(h, return_index=True, return_counts=True)
        rank = np.empty(len(terms), np.int64)
        rank[np.argsort(-df, kind="stable")] = np.arange(len(terms))
        depth = max(1, int(max(len(terms), found.n) - 1).bit_length())
        ids = rows.column("doc_id").chunk(0)
        block = treap.pack(
            np.repeat(rank, df), column[text], impact, depth, terms=terms, rows=rank.astype(np.int32),
            ids=np.asarray(ids.fill_null(0))[order], no_id=np.asarray(ids.is_null())[order].astype(np.uint8),
        )
        return record(BLOCKS, [found.n], [len(text)], [block])

    def blocks(batches):
        held, size, n = [], 0, 0
        for piece in slices(batches):
            held.append(piece)
            size, n = size + piece.column("text").nbytes, n + piece.num_rows
            if size >= block_bytes or n + 4096 > block_docs:
                yield make(held)
                held, size, n = [], 0, 0
        if held:
            yield make(held)

    return blocks


def index(docs: DataFrame, n_docs: int, length: int, *, block_bytes: int = BLOCK_BYTES, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """docs, postings, block: the index of docs (doc_id, text), whose totals are n_docs and length, in blocks."""
    return _rows(docs).mapInArrow(blocks_of(n_docs, length, block_bytes, block_docs), "docs int, postings long, block binary")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


# --- search ---------------------------------------------------------------------------------


def best_of(tree: treap.Treap, rows: np.ndarray, weights: np.ndarray, columns: int, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns and scores of the k best columns above 0 and not under the floor, ties at the k-th place all kept."""
    depth = tree.depth
    t = len(rows)
    # the frontier: level, first column and bound of each state, and its cells
    level, start = np.zeros(1, np.int64), np.zeros(1, np.int64)
    cells, best = np.zeros((1, t), np.int32), np.full((1, t), tree.root, np.int64)
    bound = best @ weights
    done_columns, done_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    while len(bound):
        least = max(floor, int(np.partition(done_scores, -k)[-k]) if len(done_scores) >= k else 1)
        alive = np.flatnonzero(bound >= least)
        if not len(alive):
            break
        take = alive[np.argpartition(-bound[alive], STATES - 1)[:STATES]] if len(alive) > STATES else alive
        rest = np.setdiff1d(alive, take, assume_unique=True)
        made = []
        for at_level in np.unique(level[take]):
            own = take[level[take] == at_level]
            shift = depth - 1 - at_level
            row_half = rows >> shift & 1
            for half, (to, most) in enumerate(tree.below(int(at_level), cells[own], best[own], row_half)):
                first = start[own] + (half << shift)
                made.append((np.full(len(own), at_level + 1), first, to, most, most @ weights))
        new = [np.concatenate(x) for x in zip(*made)]
        keep = (new[4] >= least) & (new[1] < columns)
        new = [x[keep] for x in new]
        leaf = new[0] == depth
        done_columns, done_scores = np.concatenate([done_columns, new[1][leaf]]), np.concatenate([done_scores, new[4][leaf]])
        if len(done_scores) > 4 * k:
            high = done_scores >= np.partition(done_scores, -k)[-k]
            done_columns, done_scores = done_columns[high], done_scores[high]
        level, start, cells, best, bound = (np.concatenate([old[rest], x[~leaf]]) for old, x in zip((level, start, cells, best, bound), new))
    if len(done_scores) > k:
        high = done_scores >= np.partition(done_scores, -k)[-k]
        done_columns, done_scores = done_columns[high], done_scores[high]
    return done_columns, done_scores


class Items:
    """The terms of some items: for item i those of [bounds[i], bounds[i + 1]), as places in the ascending terms."""

    def __init__(self, texts: list[list[str | None]]):
        own = [np.unique(np.concatenate([term_hashes(t) for t in of_item] or [np.zeros(0, np.uint64)])) for of_item in texts]
        self.bounds = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int64)
        every = np.concatenate([*own, np.zeros(0, np.uint64)])
        self.terms, self.place = np.unique(every, return_inverse=True)
        self.weights = np.zeros(len(self.terms), np.int64)

    def weigh(self, n_docs: int, held: np.ndarray) -> None:
        self.weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in held.tolist()], np.int64)


def search_in(items: Items, k: int):
    """From blocks to item, doc_id, score, no_id: the k best documents of each item, of each task; documents as good as the k-th too."""

    def search(batches):
        floor = np.zeros(len(items.bounds) - 1, np.int64)
        top: list[list[np.ndarray]] = [[] for _ in floor]
        for batch in batches:
            for value in batch.column("block"):
                tree, parts = treap.unpack(value.as_buffer())
                here = find(parts["terms"], items.terms)
                out = []
                for i in range(len(floor)):
                    own = items.place[items.bounds[i] : items.bounds[i + 1]]
                    own = own[(here[own] >= 0) & (items.weights[own] > 0)]
                    if not len(own):
                        continue
                    at, scores = best_of(tree, parts["rows"][here[own]].astype(np.int64), items.weights[own], len(parts["ids"]), k, max(1, int(floor[i])))
                    if not len(at):
                        continue
                    out.append((i, parts["ids"][at], scores, parts["no_id"][at]))
                    # the task's k-th score so far is a floor for its other blocks
                    top[i].append(scores)
                    known = np.concatenate(top[i])
                    top[i] = [np.sort(known)[-k:]]
                    if len(known) >= k:
                        floor[i] = top[i][0][0]
                if out:
                    number = np.repeat([o[0] for o in out], [len(o[1]) for o in out])
                    yield record(HITS, number.astype(np.int32), *[np.concatenate([o[c] for o in out]) for c in (1, 2)], np.concatenate([o[3] for o in out]) > 0)

    return search


def passes(items: DataFrame, pass_terms: int):
    """Items (item_id, texts) in portions of at most pass_terms words, beyond one item, in the order of their ids."""
    held, size = [], 0
    for row in items.toLocalIterator():
        n = sum(len((t or "").encode()) // 2 + 1 for t in row["texts"])
        if held and size + n > pass_terms:
            yield held
            held, size = [], 0
        held.append((row["item_id"], row["texts"]))
        size += n
    if held:
        yield held


def search(docs: DataFrame, items: DataFrame, *, k: int = K, pass_terms: int = PASS_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents (all, if fewer) above score 0 of every item, ties by ascending doc_id.

    An item's terms are those of all its rows, once each; repeated rows change nothing. Rows of docs that repeat are
    documents of their own. A null id of a document comes after all others among equal scores, a null item_id is an item
    of its own. Null and empty texts have no terms. Other columns are not read.

    Items go to the tasks in portions of bounded size, one pass over the index each. With one portion a task searches each
    block when it has built it; with more the index is written once, and each portion's result.
    """
    spark = docs.sparkSession
    stage = Staging(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wanted = items.select("item_id", "text").groupBy("item_id").agg(F.collect_set("text").alias("texts")).orderBy("item_id")
    kind = items.schema["item_id"].dataType
    schema = f"item_id {kind.simpleString()}, rank int, doc_id long, score long"
    results: list[DataFrame] = []
    blocks = None
    portions = passes(wanted, pass_terms)
    portion, following = next(portions, None), next(portions, None)
    while portion:
        asked = Items([t for _, t in portion])
        n_docs, length, held = totals_of(texts, asked.terms)
        asked.weigh(n_docs, held)
        find_hits = search_in(asked, k)
        if following is None and blocks is None:
            build = blocks_of(n_docs, length, BLOCK_BYTES, BLOCK_DOCS)
            hits = _rows(texts).mapInArrow(lambda batches, build=build, find_hits=find_hits: find_hits(build(batches)), HITS_SQL)
        else:
            blocks = blocks or stage(index(texts, n_docs, length))
            hits = blocks.mapInArrow(find_hits, HITS_SQL)
        # first within parts of an item's hits, so that the last ranking is among PARTS * k of them, however many tasks there are
        ranked = hits.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
        for among in (["item", "part"], ["item"]):
            order = Window.partitionBy(*among).orderBy(F.desc("score"), "no_id", "doc_id")
            ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(portion)], f"item int, item_id {kind.simpleString()}")
        found = ranked.join(names, "item").select("item_id", "rank", F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "score")
        results.append(found if blocks is None else stage(found))
        portion, following = following, next(portions, None)
    if not results:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, results)
