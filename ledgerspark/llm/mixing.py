"""Mixing sources to target weights: temperature mixing.

A source's weight is its share of the tokens to the power t, normalised. t = 1 keeps the shares, t = 0 makes
all sources alike. Bisection finds the largest t in [0, 1] whose weights have the target entropy, but no t
under which a source would have to be repeated more often than allowed. The weights are realised without
sampling: a source's budget of tokens is spent in passes over it, each pass a permutation of its blocks, and
the last pass ends where the budget does. The default budget is the least with which every source is used
whole at least once, so no document is lost and the scarce sources repeat.

All of it is DataFrame operations; a source is never in one task. Six halvings of the exponent's interval
are one aggregation over the source totals.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import Staging

#: Share of the largest possible entropy, log(number of sources), that the weights should have.
ENTROPY = 0.9
#: Passes over a source, at most.
REPEATS = 4.0
#: Documents of a block, on average.
BLOCK_DOCS = 4096
HALVINGS = 6
ROUNDS = 5


def tokens(text: Column) -> Column:
    """Number of words between blanks (0x20, 0x09-0x0D); 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def bisect(totals: DataFrame, goal: Column, low: float = 0.0, high: float = 1.0) -> float:
    """The largest exponent t in [low, high] at which goal holds, if it holds at low and, once failed, fails from there on.

    totals has a column share; goal is an aggregate over the columns share and weight (normalised, at t).
    """
    for _ in range(ROUNDS):
        steps = 1 << HALVINGS
        tried = [low + (high - low) * i / steps for i in range(1, steps)] + [high]
        at = totals.select("share", F.explode(F.array(*[F.lit(x) for x in tried])).alias("t"))
        raw = at.withColumn("raw", F.pow("share", "t"))
        sums = raw.groupBy("t").agg(F.sum("raw").alias("whole"))
        held = raw.join(sums, "t").withColumn("weight", F.col("raw") / F.col("whole")).groupBy("t").agg(goal.alias("ok"))
        good = [r["t"] for r in held.where("ok").collect()]
        if high in good:
            return high
        low = max([low, *good])
        high = min(x for x in tried if x > low)
    return low


def exponent(totals: DataFrame, sources: int, entropy: float = ENTROPY, repeats: float = REPEATS) -> float:
    """The temperature exponent for the source shares in totals."""
    if sources < 2:
        return 1.0
    enough = -F.sum(F.col("weight") * F.log("weight")) >= entropy * math.log(sources) - 1e-12
    calm = bisect(totals, enough)
    return max(calm, least_exponent(totals, repeats))


def least_exponent(totals: DataFrame, repeats: float) -> float:
    """The least t at which no source is passed over more than ``repeats`` times.

    A source's passes are share^(t - 1), the largest source having one pass if shares are relative to it. The smallest
    share s thus needs s^(t - 1) <= repeats, or t >= 1 + log(repeats) / log(s).
    """
    s = totals.select((F.min("share") / F.max("share")).alias("s")).first()["s"]
    return 0.0 if s is None or s >= 1 else min(1.0, max(0.0, 1 + math.log(repeats) / math.log(s)))


def plan(rows: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, budget: int | None = None, stage=None) -> DataFrame:
    """source, tokens, docs, weight, passes for each source that has tokens; passes is how often its tokens are used.

    Without a budget of tokens, the source that would be used least is used once.
    """
    totals = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")).where("tokens > 0")
    totals = (stage or Staging(rows.sparkSession))(totals)
    whole = totals.agg(F.sum("tokens").alias("tokens"), F.count("*").alias("sources")).first()
    shares = totals.withColumn("share", F.col("tokens") / F.lit(float(whole["tokens"] or 1)))
    t = exponent(shares, whole["sources"], entropy, repeats)
    raw = shares.withColumn("raw", F.pow("share", F.lit(t)))
    scale = raw.agg(F.sum("raw").alias("raw"), F.min(F.col("raw") / F.col("tokens")).alias("least")).first()
    spend = budget if budget is not None else (scale["raw"] / scale["least"] if scale["raw"] else 0)
    weight = F.col("raw") / F.lit(float(scale["raw"] or 1))
    return raw.select("source", "tokens", "docs", weight.alias("weight"), (weight * float(spend) / F.col("tokens")).alias("passes"), F.lit(t).alias("exponent"))


def mix(docs: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, budget: int | None = None, seed: int = 1, text: bool = True) -> DataFrame:
    """Every use of a document: the columns of docs, n_tokens, weight and passes of its source, pass (from 0), block, position.

    position in [0, 1) is where the block begins in the source's budget: ordering by it interleaves the sources at their
    weights, and within a block by in_block. Null sources are one source. Documents without words, null texts among them,
    are used once, at position 0, and count for nothing; so does a source without words. Repeated rows are used each. Rows
    of one id are told apart by their content; an id of more than BLOCK_DOCS rows is dealt to blocks by its rows, not by id.
    Columns of docs named like an added one are replaced; with text=False docs has n_tokens already and needs no text.
    """
    added = {"n_tokens", "weight", "passes", "pass", "block", "position", "in_block"}
    stage = Staging(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() not in added]
    # the row travels in one column, so that its names meet no others; the words are counted in one pass over the texts
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col("source").alias("of"), F.col("doc_id").alias("id"),
        (tokens(F.col("text")) if text else F.col("n_tokens")).alias("n_tokens"), F.monotonically_increasing_id().alias("number"),
    )
    rows = stage(packed)
    sources = stage(plan(rows.select(F.col("of").alias("source"), "n_tokens"), entropy, repeats, budget, stage).select(F.col("source").alias("of"), "tokens", "docs", "weight", "passes"))
    # the numbers are written, so they stay; at most one id for BLOCK_DOCS rows is hot. Hot ids and turns are written for
    # their size to be known: while they are small, no text is shuffled to meet them
    hot = stage(rows.groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK_DOCS).select("id", F.lit(True).alias("hot")))
    dealt = F.xxhash64(F.lit(seed), "id", F.when(F.col("hot"), F.col("number")))
    placed = _same(_same(rows, hot, "id"), sources, "of").withColumn("block", F.pmod(dealt, F.greatest(F.lit(1), F.ceil(F.col("docs") / BLOCK_DOCS))))
    # the blocks of every pass, in the pass's order, with the tokens before them
    blocks = placed.where("n_tokens > 0").groupBy("of", "block").agg(
        F.sum("n_tokens").alias("own"), F.first("tokens").alias("all"), F.first("passes").alias("passes")
    )
    turns = blocks.withColumn("pass", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.round("passes", 9)) - 1, F.lit(0)).cast("int"))))
    before = Window.partitionBy("of", "pass").orderBy(F.xxhash64(F.lit(seed), "pass", "block"), "block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("own").over(before), F.lit(0))
    left = F.round(F.col("all") * (F.col("passes") - F.col("pass")))
    turns = turns.select("of", "block", "pass", start.alias("start"), left.alias("left"), "own", "all", "passes").where("start < left")
    turns = stage(turns.select(
        "of", "block", "pass", "start", "left", (F.col("start") + F.col("own") > F.col("left")).alias("cut"),
        ((F.col("pass") * F.col("all") + F.col("start")) / (F.col("all") * F.col("passes"))).alias("position"),
    ))
    used = _same(placed.where("n_tokens > 0"), turns, "of", "block").where("pass IS NOT NULL").withColumn("in_block", F.xxhash64(F.lit(seed), "pass", "id"))
    columns = ["row", "n_tokens", "weight", "passes", "pass", "block", "position", "in_block"]
    whole = used.where(~F.col("cut")).select(*columns)
    # the one block of each source in which its budget ends; rows alike in all of these are alike
    order = ["in_block", "id", "n_tokens", F.xxhash64(F.to_json("row")), "number"]
    running = Window.partitionBy("of", "pass", "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    cut = used.where("cut").withColumn("upto", F.col("start") + F.sum("n_tokens").over(running)).where("upto <= left").select(*columns)
    empty = placed.where("n_tokens = 0").select(
        "row", "n_tokens", "weight", "passes", F.lit(0).alias("pass"), "block", F.lit(0.0).alias("position"), F.xxhash64(F.lit(seed), F.lit(0), "id").alias("in_block")
    )
    every = whole.unionByName(cut).unionByName(empty)
    return every.select("row.*", *columns[1:])


def _same(rows: DataFrame, other: DataFrame, of: str, *also: str) -> DataFrame:
    """Left join on a column that may be null, and further ones."""
    named = other.withColumnsRenamed({c: f"other_{c}" for c in (of, *also)})
    on = F.col(of).eqNullSafe(F.col(f"other_{of}"))
    for c in also:
        on = on & (F.col(c) == F.col(f"other_{c}"))
    return rows.join(named, on, "left").drop(f"other_{of}", *[f"other_{c}" for c in also])
