"""Benchmark decontamination: spaced-seed hashing.

A mask is a string of 1 and 0 over consecutive words; the hash of a window under it ignores the words at the
zeros, so that a substituted word there does no harm. Hashes of all windows of the benchmark's texts are
joined with those of all windows of the documents. Each hit aligns a text of the benchmark with a document;
the aligned words are compared one by one, and what agrees in enough of them is contamination.

All of it is DataFrame operations. Windows are generated and hashed where the documents are read, and meet the
benchmark's windows as rows of fixed size, without words: by broadcast as long as the benchmark has at most BROADCAST_ROWS
windows (counted), by a shuffle beyond that. What is hit, a document and an offset, goes back to the words of both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import Staging
from .names import unused

#: Fixed masks over 11 and 14 words; in a text much longer than these, one or two substitutions leave some window of one of them alone.
MASKS = ("11101101011", "11011000111011")
#: Share of a benchmark text's words that must agree with the aligned words of the document.
OVERLAP = 0.5
#: Of 40 bytes each.
BROADCAST_ROWS = 1_000_000
#: What is a quote whatever the share: so many words in a row, the first and last alike, of which so many at most differ.
STRETCH, STRETCH_CHANGES = 13, 2
#: Offsets of alignments that are taken together.
BAND = 16
#: Words of the texts that clean() also seeks by parts: one more than the substitutions allowed, so that one part is whole.
PIECES = range(6, 15)
#: Two substitutions from so many words, one below.
LONGER = 9


def allowed(n: int) -> int:
    return 2 if n >= LONGER else 1


def words(text: Column) -> Column:
    """Hashes of the lower-cased words between blanks; none for a null text."""
    parts = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[\\x20\\x09-\\x0D]+"), "")
    return F.transform(parts, lambda w: F.xxhash64(w))


def windows(rows: DataFrame, mask: str, *keep: str) -> DataFrame:
    """at (from 0) and seed of every window of column w under the mask, with the columns to keep."""
    spans = rows.where(F.size("w") >= len(mask)).select(*keep, "w", F.explode(F.sequence(F.lit(0), F.size("w") - len(mask))).alias("at"))
    chosen = [F.get(F.col("w"), F.col("at") + i) for i, bit in enumerate(mask) if bit == "1"]
    return spans.select(*keep, "at", F.xxhash64(F.lit(mask), *chosen).alias("seed"))


def alignments(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, pieces: bool = False) -> DataFrame:
    """doc_id, fingerprint, item_id, item, n, offset, hits, seeded, same: every placing of a benchmark text over a document that a hash hits.

    item tells apart texts of one item_id, n is the text's number of words; same says of each word of the text, from the first
    that has an opposite in the document, whether it agrees. With pieces, texts of PIECES words are also sought by parts of
    them; seeded says that a mask, or the whole text, was hit too.
    """
    stage = Staging(docs.sparkSession)
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0).distinct()
    items = stage(items.withColumn("item", F.xxhash64("w")))
    shortest = min(len(m) for m in masks)
    # at most one number per length under that of the masks, or of PIECES
    lengths = [r["n"] for r in items.select(F.size("w").alias("n")).where(F.col("n") < max(shortest, PIECES.stop)).distinct().collect()]
    used = [(m, items, True) for m in masks] + [("1" * n, items.where(F.size("w") == n), True) for n in sorted(lengths) if n < shortest]
    if pieces:
        used += [("1" * (n // (allowed(n) + 1)), items.where(F.size("w") == n), False) for n in sorted(lengths) if n in PIECES]
    texts = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("fingerprint"), words(F.col("text")).alias("w"))
    found = None
    for mask, of, seeded in used:
        seeds = stage(windows(of, mask, "item_id", "item").withColumnRenamed("at", "item_at"))
        side = F.broadcast(seeds) if seeds.count() <= BROADCAST_ROWS else seeds
        hits = windows(texts, mask, "doc_id", "fingerprint").join(side, "seed")
        placed = hits.select("doc_id", "fingerprint", "item_id", "item", (F.col("at") - F.col("item_at")).alias("offset"), F.lit(seeded).alias("seeded"))
        found = placed if found is None else found.unionByName(placed)
    placings = stage(found.groupBy("doc_id", "fingerprint", "item_id", "item", "offset").agg(F.count("*").alias("hits"), F.max("seeded").alias("seeded")))
    # back to the words; rows that repeat are one document
    quoting = placings.select(F.col("doc_id").alias("d"), F.col("fingerprint").alias("f")).distinct()
    hit = texts.join(quoting, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("fingerprint") == F.col("f")), "left_semi")
    hit = hit.groupBy(F.col("doc_id").alias("d"), F.col("fingerprint").alias("f")).agg(F.first("w").alias("own"))
    both = placings.join(hit, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("fingerprint") == F.col("f")))
    both = both.join(items.select(F.col("item_id").alias("i"), F.col("item").alias("t"), "w"), F.col("item_id").eqNullSafe(F.col("i")) & (F.col("item") == F.col("t")))
    low = F.greatest(F.col("offset"), F.lit(0))
    opposite = F.slice("own", low + 1, F.size("w") - (low - F.col("offset")))
    same = F.zip_with(F.slice("w", low - F.col("offset") + 1, F.size("w")), opposite, lambda a, b: F.coalesce(a == b, F.lit(False)))
    return stage(both.select("doc_id", "fingerprint", "item_id", "item", F.size("w").alias("n"), "offset", "hits", "seeded", same.alias("same")))


def agreeing() -> Column:
    return F.size(F.filter("same", lambda x: x))


def has_stretch() -> Column:
    """STRETCH words in a row, the first and last alike, of which at most STRETCH_CHANGES differ."""
    starts = F.sequence(F.lit(0), F.greatest(F.size("same") - STRETCH, F.lit(0)))
    ends = lambda i: F.get("same", i) & F.get("same", i + STRETCH - 1)
    enough = lambda i: F.size(F.filter(F.slice("same", i + 1, STRETCH), lambda x: x)) >= STRETCH - STRETCH_CHANGES
    return F.exists(starts, lambda i: ends(i) & enough(i)) & (F.size("same") >= STRETCH)


def judged(placed: DataFrame, share: float, also: Column | None = None) -> DataFrame:
    """doc_id, fingerprint, item_id, best (agree, back, item_words), hits of the texts of documents and benchmark that overlap.

    Alignments are judged alone, and together with those at most BAND / 2 words apart, as where words were inserted or
    dropped: the words of the benchmark text that agree in any of them make up its share.
    """
    agree = agreeing()
    alone = F.col("seeded") & ((agree >= F.ceil(F.col("n") * share)) | has_stretch())
    alone = alone if also is None else alone | also
    keys = ["doc_id", "fingerprint", "item_id"]
    best = F.struct(agree.alias("agree"), (-F.col("offset")).alias("back"), F.col("n").alias("item_words"))
    single = placed.select(*keys, best.alias("best"), "hits", alone.alias("found"))
    # numbers of the item's words that agree
    numbered = F.filter(F.transform("same", lambda x, i: F.when(x, i - F.least(F.col("offset"), F.lit(0)))), lambda x: x.isNotNull())
    # a band has at most BAND alignments, and any two at most BAND / 2 apart have a band in common
    bands = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.floor((F.col("offset") + k * BAND // 2) / BAND).alias("at")) for k in (0, 1)])).alias("band")
    apart = placed.where("seeded").select(*keys, "item", "n", numbered.alias("agreeing"), bands)
    union = F.size(F.array_distinct(F.flatten(F.collect_list("agreeing"))))
    joint = apart.groupBy(*keys, "item", "n", "band").agg(union.alias("agree")).where(F.col("agree") >= F.ceil(F.col("n") * share))
    none = single.schema["best"].dataType
    both = single.unionByName(joint.select(*keys, F.lit(None).cast(none).alias("best"), F.lit(0).cast("long").alias("hits"), F.lit(True).alias("found")))
    found = both.groupBy(*keys).agg(F.max("best").alias("best"), F.sum("hits").alias("hits"), F.max("found").alias("found"))
    return found.where("found").drop("found")


def overlaps(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, share: float = OVERLAP) -> DataFrame:
    """doc_id, fingerprint, item_id, agree, item_words, first_word, last_word, hits: one row per document and benchmark text that overlap.

    They overlap where, in alignments that a hash hits, the share of the benchmark text's words agrees (see judged), or a
    stretch of it (see has_stretch), however long the text is. Words are numbered from 0; the place of the largest agreement
    is given, the first where several are alike. A benchmark text shorter than the masks is sought whole, without
    substitutions; one without words, or null, is in no document. Rows that repeat give a row, not one each; fingerprint (of
    the text) tells apart documents of one id.
    """
    return judged(alignments(docs, benchmark, masks), share).select(
        "doc_id", "fingerprint", "item_id", F.col("best.agree").alias("agree"), F.col("best.item_words").alias("item_words"),
        F.greatest(-F.col("best.back"), F.lit(0)).alias("first_word"), (-F.col("best.back") + F.col("best.item_words") - 1).alias("last_word"), "hits",
    )


def quotes(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, share: float = OVERLAP) -> DataFrame:
    """doc_id, fingerprint of the documents that overlap a benchmark text, or quote one of PIECES words with any allowed() substitutions."""
    agree = agreeing()
    few = F.when(F.col("n") >= LONGER, agree >= F.col("n") - 2).otherwise(agree >= F.col("n") - 1) & F.col("n").between(PIECES.start, PIECES.stop - 1)
    return judged(alignments(docs, benchmark, masks, pieces=True), share, few).select("doc_id", "fingerprint").distinct()


def clean(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, share: float = OVERLAP) -> DataFrame:
    """The rows of docs, all columns, that no text of the benchmark overlaps and that quote none in part."""
    key, print_ = unused(docs, "contaminated_id", "contaminated_print")
    bad = quotes(docs, benchmark, masks, share).select(F.col("doc_id").alias(key), F.col("fingerprint").alias(print_))
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(print_))
    return docs.join(bad, same, "left_anti")
