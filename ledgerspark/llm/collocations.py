"""Phrase collocation mining: pairs of ranked ids, counted tile by tile.

Words are ranked by frequency within their language. A pair of ranks falls into a square tile; the occurrences of a
batch in one tile are counted with a dense bincount where they fill it well enough, and otherwise sorted as coordinates
(COO). Frequent pairs are ranked anew and paired with the word that follows, and so on up to MAX_WORDS words.

Level k pairs the frequent phrase of k - 1 words at a place with the word behind it, if the k - 1 words from the next
place on are frequent too: a phrase is never more frequent than its parts, so nothing that counts is left out. Whether a
phrase is frequent is told by a bitmap of FILTER_SHARE bits for each frequent one, 2^MOST_BITS (32 MB) at most: a false
positive is counted and dropped after the sum. The RANKED most frequent phrases of a level have a rank, the others are
counted as coordinates; either way every occurrence is counted.

Words are told apart by their bytes; phrases by the 64-bit hashes of their first and last k - 1 words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.staging import Staging
from .words import Texts, mix, record, slices

MAX_WORDS = 5
LEAST = 100
TOP = 2000
RANKED = 1 << 16
FILTER_SHARE = 16
LEAST_BITS, MOST_BITS = 16, 28
#: A tile is TILE ranks wide and high; it is counted densely if it has a DENSE-th as many occurrences as cells.
TILE_BITS = 9
DENSE = 8
#: Words that a task counts together, beyond one slice of texts.
BATCH_WORDS = 1_000_000
UNKNOWN = "und"

# What parts pieces, and what parts words.
PIECE_ENDS = np.zeros(256, bool)
PIECE_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BLANKS = PIECE_ENDS.copy()
BLANKS[[0x20, 0x09]] = True

ODD = np.uint64(0x9E3779B97F4A7C15)
COUNTED = pa.schema([("prefix", pa.int64()), ("suffix", pa.int64()), ("c", pa.int64())])
COUNTED_SQL = "prefix long, suffix long, c long"
WORDS = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("c", pa.int64())])
WORDS_SQL = "lang string, word binary, c long"


# --- words of a batch -----------------------------------------------------------------------


def language_seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class Run:
    """Words of many texts: hash (of language and word), language code, whether the next word follows in the same piece."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.h, self.lang, self.joined = (np.concatenate(x) for x in zip(*parts))

    def places(self, k: int) -> np.ndarray:
        """Places from which k words stand in one piece."""
        n = len(self.h) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        ok = np.ones(n, bool)
        for j in range(k - 1):
            ok &= self.joined[j : j + n]
        return np.flatnonzero(ok)


def chained(prefix: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Hash of a phrase, from those of its first and last k - 1 words."""
    return mix(prefix * ODD + suffix)


def with_hashes(batches):
    for batch in batches:
        prefix, suffix = (np.asarray(batch.column(c)).view(np.uint64) for c in ("prefix", "suffix"))
        yield batch.append_column("h", pa.array(chained(prefix, suffix).view(np.int64)))


def read(piece: pa.RecordBatch, codes: dict[str, int]) -> tuple[Texts, np.ndarray, np.ndarray, np.ndarray]:
    """A slice's texts, and of its words: hash, language code, whether the next one follows in the same piece."""
    found = Texts(piece.column("text"), BLANKS)
    langs = piece.column("lang").to_pylist()
    own = np.array([codes.setdefault(lang, len(codes)) for lang in langs], np.int32)
    seeds = dict(zip(langs, own))
    seed = np.zeros(max(seeds.values()) + 1, np.uint64)
    seed[list(seeds.values())] = [language_seed(lang) for lang in seeds]
    of_text = found.text_of_word()
    lang = own[of_text]
    h = mix(found.hashes() + seed[lang])
    ends = np.concatenate([[0], np.cumsum(PIECE_ENDS[found.data])])
    joined = np.zeros(len(h), bool)
    if len(h) > 1:
        joined[:-1] = (ends[found.starts[1:]] == ends[found.ends[:-1]]) & (of_text[1:] == of_text[:-1])
    return found, h, lang, joined


def runs(batches):
    held, words, codes = [], 0, {}
    for piece in slices(batches):
        _, *arrays = read(piece, codes)
        held.append(arrays)
        words += len(arrays[0])
        if words >= BATCH_WORDS:
            yield Run(held)
            held, words, codes = [], 0, {}
    if held:
        yield Run(held)


# --- level one ------------------------------------------------------------------------------


def count_words(batches):
    """Distinct words of each slice with their counts, and the words of each language altogether (a null word)."""
    for piece in slices(batches):
        codes: dict[str, int] = {}
        found, h, lang, _ = read(piece, codes)
        names = list(codes)
        _, first, times = np.unique(h, return_index=True, return_counts=True)
        words = [found.data[found.starts[i] : found.ends[i]].tobytes() for i in first.tolist()]
        whole = np.bincount(lang, minlength=len(names))
        yield record(WORDS, [names[i] for i in lang[first]] + names, words + [None] * len(names), np.concatenate([times, whole]))


def with_word_hashes(batches):
    """The hash of every language and word; a word is the one word of its text."""
    for batch in batches:
        for piece in slices([batch], "word"):
            texts = pa.RecordBatch.from_arrays([piece.column("word"), piece.column("lang")], ["text", "lang"])
            yield piece.append_column("h", pa.array(read(texts, {})[1].view(np.int64)))


# --- levels two to five ---------------------------------------------------------------------


class Level:
    """The frequent phrases of one length, as tasks need them: a bitmap of all, the ranks of the most frequent."""

    def __init__(self, bits: np.ndarray, h: np.ndarray, rank: np.ndarray):
        order = np.argsort(h)
        self.bits, self.h, self.rank = bits, h[order], rank[order].astype(np.int32)
        self.shift = np.uint64(64 - 3 - (len(bits).bit_length() - 1))

    def frequent(self, h: np.ndarray) -> np.ndarray:
        at = h >> self.shift
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def ranks(self, h: np.ndarray) -> np.ndarray:
        """Rank within the language, -1 where there is none."""
        if not len(self.h):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        return np.where(self.h[at] == h, self.rank[at].astype(np.int64), -1)


def first_of(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sparse counting: a place of every distinct code, and how often it is there, by sorting."""
    order = np.argsort(code, kind="stable")
    ordered = code[order]
    at = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(code) else np.zeros(0, np.int64)
    return order[at], np.diff(np.append(at, len(code)))


def first_in_tile(cell: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Dense counting: the same through arrays as long as the tile has cells."""
    times = np.bincount(cell, minlength=cells)
    place = np.empty(cells, np.int64)
    place[cell] = np.arange(len(cell))
    full = np.flatnonzero(times)
    return place[full], times[full]


def tiled(left: np.ndarray, right: np.ndarray, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place and the count of every distinct (left rank, right rank, language), tile by tile."""
    side, cells = np.int64((1 << TILE_BITS) - 1), 1 << 2 * TILE_BITS
    tile = (lang.astype(np.int64) << 40) | (left >> TILE_BITS) << 20 | right >> TILE_BITS
    cell = (left & side) << TILE_BITS | right & side
    order = np.argsort(tile, kind="stable")
    ordered = tile[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    sizes = np.diff(np.append(starts, len(order)))
    places, counts = [], []
    for s, n in zip(starts[sizes * DENSE >= cells], sizes[sizes * DENSE >= cells]):
        own = order[s : s + n]
        at, times = first_in_tile(cell[own], cells)
        places.append(own[at])
        counts.append(times)
    rest = order[np.repeat(sizes * DENSE < cells, sizes)]
    if len(rest):
        # all sparse tiles are sorted together: number of the tile, cell
        number = np.repeat(np.arange(len(sizes)), sizes)[np.repeat(sizes * DENSE < cells, sizes)]
        at, times = first_of(number << 2 * TILE_BITS | cell[rest])
        places.append(rest[at])
        counts.append(times)
    return np.concatenate(places), np.concatenate(counts)


def count_phrases(k: int, words: Level, shorter: Level):
    """A task's counts of phrases of k words whose first and last k - 1 words are frequent."""

    def count(batches):
        for run in runs(batches):
            at = run.places(k)
            if not len(at):
                continue
            # hashes of the k - 1 words from each place on; those that run over a piece's end are not asked for
            part = run.h
            for _ in range(k - 2):
                part = chained(part[:-1], part[1:])
            likely = shorter.frequent(part)
            at = at[likely[at] & likely[at + 1]]
            if not len(at):
                continue
            prefix, suffix = part[at], part[at + 1]
            left, right = shorter.ranks(prefix), words.ranks(run.h[at + k - 1])
            ranked = (left >= 0) & (right >= 0)
            places, counts = [], []
            if ranked.any():
                own = np.flatnonzero(ranked)
                place, times = tiled(left[own], right[own], run.lang[at[own]])
                places.append(own[place])
                counts.append(times)
            if not ranked.all():
                own = np.flatnonzero(~ranked)
                place, times = first_of(chained(prefix[own], suffix[own]))
                places.append(own[place])
                counts.append(times)
            pick, times = np.concatenate(places), np.concatenate(counts)
            yield record(COUNTED, prefix[pick].view(np.int64), suffix[pick].view(np.int64), times)

    return count


def bitmap(frequent: DataFrame, bits: int) -> np.ndarray:
    """2^bits bits, those set that the hashes of a level begin with; Spark makes them block by block."""
    place = F.shiftrightunsigned(F.col("h"), 64 - bits)
    block = LEAST_BITS  # bits of a place within a block

    def make(table: pa.Table) -> pa.Table:
        marks = np.zeros(1 << block, np.uint8)
        marks[np.asarray(table.column("bit"))] = 1
        packed = np.packbits(marks, bitorder="little").tobytes()
        return pa.table({"block": table.column("block")[:1], "bits": pa.array([packed], pa.binary())})

    blocks = frequent.select(F.shiftright(place, block).cast("int").alias("block"), place.bitwiseAND(F.lit((1 << block) - 1)).cast("int").alias("bit")).distinct()
    out = np.zeros(1 << bits - 3, np.uint8)
    size = 1 << block - 3
    for row in blocks.groupBy("block").applyInArrow(make, "block int, bits binary").collect():
        out[row["block"] * size : (row["block"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return out


def level_of(frequent: DataFrame) -> Level:
    """Ranks are by frequency within a language, ties by hash; at most RANKED rows and the bitmap come to the driver."""
    bits = min(MOST_BITS, max(LEAST_BITS, int(FILTER_SHARE * frequent.count()).bit_length()))
    top = frequent.select("lang", "h", "a").orderBy(F.desc("a"), "h").limit(RANKED).toPandas()
    rank = top.groupby("lang", sort=False).cumcount().to_numpy(np.int64) if len(top) else np.zeros(0, np.int64)
    return Level(bitmap(frequent, bits), top["h"].to_numpy(np.int64).view(np.uint64), rank)


# --- phrases and scores ---------------------------------------------------------------------


def longer(counted: DataFrame, shorter: DataFrame, least: int) -> DataFrame:
    """The frequent phrases of one word more: lang, h, a, phrase, last word, counts of all beginnings and all ends.

    ``shorter`` has the same columns; every frequent phrase begins and ends with one of its rows.
    """
    sums = counted.groupBy("prefix", "suffix").agg(F.sum("c").alias("a")).where(F.col("a") >= least)
    sums = sums.mapInArrow(with_hashes, "prefix long, suffix long, a long, h long")
    left = shorter.select(F.col("h").alias("prefix"), "lang", F.col("phrase").alias("left"), F.col("begins").alias("left_begins"))
    right = shorter.select(F.col("h").alias("suffix"), F.col("last").alias("right"), F.col("ends").alias("right_ends"))
    both = sums.join(left, "prefix").join(right, "suffix")
    own = F.array("a")
    return both.select(
        "lang", "h", "a", F.concat("left", F.lit(" "), "right").alias("phrase"), F.col("right").alias("last"), "prefix", "suffix",
        F.concat("left_begins", own).alias("begins"), F.concat("right_ends", own).alias("ends"),
    )


def scored(phrases: DataFrame, k: int, totals: DataFrame) -> DataFrame:
    """The lowest-scoring cut of every phrase of k words, ties to the shortest first part; decimals hold the products."""
    wide = lambda c: c.cast("decimal(18,0)")
    joined = phrases.join(totals, "lang")
    cuts = [
        F.struct(
            F.expr("1").cast("long").alias("score"), F.lit(j).alias("cut"), F.col("begins")[j - 1].alias("l"), F.col("ends")[k - j - 1].alias("r")
        )
        for j in range(1, k)
    ]
    above = (F.col("a") * 1000).cast("decimal(18,0)") * wide(F.col("n"))
    cuts = [c.withField("score", F.call_function("div", above, wide(c["l"]) * wide(c["r"]))) for c in cuts]
    best = joined.withColumn("best", F.array_min(F.array(*cuts)))
    return best.select("lang", "h", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score"))


def mine(docs: DataFrame, *, least: int = LEAST, max_words: int = MAX_WORDS, top: int | None = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: collocations of every language, best first.

    A phrase is 2 to max_words words in a row within a piece of text, found at least ``least`` times; it is left out where
    a phrase of one word more, found as often, has it. A null text has no words, a null language is `und`; a language
    without words has no rows. Repeated rows count each. Other columns are not read. ``top=None`` returns all phrases.
    """
    spark: SparkSession = docs.sparkSession
    stage = Staging(spark)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string").alias("text"))
    words = texts.mapInArrow(count_words, WORDS_SQL).groupBy("lang", "word").agg(F.sum("c").alias("a"))
    words = stage(words.where((F.col("a") >= least) | F.col("word").isNull()))
    totals = words.where("word IS NULL").select("lang", F.col("a").alias("n"))
    named = words.where("word IS NOT NULL").select("lang", F.col("word").cast("string").alias("word"), "a")
    named = named.mapInArrow(with_word_hashes, "lang string, word string, a long, h long")
    level = named.select("lang", "h", "a", F.col("word").alias("phrase"), F.col("word").alias("last"), F.array("a").alias("begins"), F.array("a").alias("ends"))
    shorter = level_of(level)
    one = Level(np.zeros(1, np.uint8), shorter.h, shorter.rank)
    found = []
    for k in range(2, max_words + 1):
        counted = texts.mapInArrow(count_phrases(k, one, shorter), COUNTED_SQL)
        level = stage(longer(counted, level, least))
        found.append(level)
        if k < max_words:
            shorter = level_of(level)
    kept = []
    for i, phrases in enumerate(found):
        best = scored(phrases, i + 2, totals)
        if i + 1 < len(found):
            # inside a phrase of one word more that is as frequent; longer ones that are imply such a one
            last = F.size("begins") - 2
            inside = [found[i + 1].where(F.get("begins" if c == "prefix" else "ends", last) == F.col("a")).select(F.col(c).alias("h")) for c in ("prefix", "suffix")]
            best = best.join(inside[0].unionByName(inside[1]).distinct(), "h", "left_anti")
        kept.append(best.drop("h"))
    every = kept[0]
    for more in kept[1:]:
        every = every.unionByName(more)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = every.withColumn("rank", F.row_number().over(order))
    ranked = ranked if top is None else ranked.where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
