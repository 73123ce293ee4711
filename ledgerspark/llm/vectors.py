"""Exact top-k search: a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance r from it, and vectors of like distance form an
annulus. Inner products become distances by one more component, sqrt(M^2 - |x|^2) for a stored vector and 0
for a query, M being the largest norm: then |x' - q'|^2 = M^2 + |q|^2 - 2 x.q, and the triangle inequality
says |x' - q'| >= |d(q', pivot) - r|. A query first searches the annulus around its own distance from its
nearest pivot, which gives it a k-th score, then every other annulus whose bound does not rule it out. The
others are skipped unseen. Results are exact.

Pivots come from a bounded sample, sqrt(n) of n vectors between LEAST_PIVOTS and MOST_PIVOTS; every vector is indexed.
Annuli are dealt out in blocks of vectors against blocks of queries, so no task holds more than BLOCK of each, whatever is
common; a block of vectors goes only where some query must look into it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import Staging
from .words import pack, record

LEAST_PIVOTS, MOST_PIVOTS = 16, 256
RINGS = 8
BLOCK = 4096
#: Rounding slack of distances, relative to the largest norm.
SLACK = 1e-9


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id and the floored components of the vectors that take part: neither null nor with null or non-finite components.

    Sums are exact below 2^53; a null vec_id takes no part.
    """
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    scaled = F.transform(x, lambda v: F.floor(v.cast("double") * 256).cast("double"))
    return vectors.where(x.isNotNull() & ~bad & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("x"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), dim)


class Pivots:
    """The pivots of each vector length, with the added component, and the largest norm."""

    def __init__(self, rows: list[list[float]], norm2: float):
        self.norm2 = norm2
        self.by_dim: dict[int, np.ndarray] = {}
        for dim in {len(r) for r in rows}:
            self.by_dim[dim] = self.lift(np.array([r for r in rows if len(r) == dim], np.float64).reshape(-1, dim))

    def lift(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, self.norm2 - (x**2).sum(1)))
        return np.concatenate([x, extra[:, None]], 1)

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        """A row per vector, a column per pivot of its length; one column of zeros where there is no pivot."""
        own = self.by_dim.get(lifted.shape[1] - 1)
        if own is None:
            return np.zeros((len(lifted), 1))
        return np.sqrt(np.maximum(0.0, (lifted**2).sum(1)[:, None] - 2 * lifted @ own.T + (own**2).sum(1)))


def by_length(batch: pa.RecordBatch):
    """The rows of each vector length: (length, positions, matrix)."""
    lengths = np.asarray(pa.compute.list_value_length(batch.column("x")))
    for dim in np.unique(lengths):
        at = np.flatnonzero(lengths == dim)
        yield int(dim), at, matrix(batch.column("x").take(pa.array(at)), int(dim))


def keyed(rows: DataFrame, pivots: Pivots) -> DataFrame:
    """vec_id, x, dim, pivot and distance of every vector."""
    schema = pa.schema([("vec_id", pa.int64()), ("x", pa.binary()), ("dim", pa.int32()), ("pivot", pa.int32()), ("distance", pa.float64())])

    def run(batches):
        for batch in batches:
            for dim, at, x in by_length(batch):
                d = pivots.distances(pivots.lift(x))
                near = d.argmin(1)
                ids = np.asarray(batch.column("vec_id"))[at]
                yield record(schema, ids, [pack(v) for v in x], np.full(len(at), dim), near, d[np.arange(len(at)), near])

    return rows.mapInArrow(run, "vec_id long, x binary, dim int, pivot int, distance double")


class Annuli:
    """All annuli with their bounds: at most MOST_PIVOTS * RINGS rows per vector length, so small whatever the number of vectors."""

    def __init__(self, rows: list):
        self.by_dim: dict[int, dict] = {}
        for dim in {r["dim"] for r in rows}:
            own = sorted((r["pivot"], r["ring"], r["low"], r["high"], -(-r["n"] // BLOCK)) for r in rows if r["dim"] == dim)
            pivot, ring, low, high, blocks = (np.array(c) for c in zip(*own))
            self.by_dim[dim] = {"pivot": pivot, "ring": ring, "low": low, "high": high, "blocks": blocks}

    def bounds(self, dim: int, d: np.ndarray) -> np.ndarray:
        """Least possible distance of each query (row) from each annulus (column)."""
        a = self.by_dim[dim]
        mine = d[:, a["pivot"]]
        return np.maximum(0.0, np.maximum(a["low"] - mine, mine - a["high"]))


def routed(queries: DataFrame, pivots: Pivots, annuli: Annuli, first: bool) -> DataFrame:
    """Each query once per block of the annuli it must look into: the nearest one, or after that all that its k-th score leaves open."""
    schema = pa.schema(
        [("dim", pa.int32()), ("pivot", pa.int32()), ("ring", pa.int32()), ("block", pa.int32()), ("query_id", pa.int64()), ("q", pa.binary()), ("least", pa.float64())]
    )
    slack = SLACK * (1 + math.sqrt(pivots.norm2))

    def run(batches):
        for batch in batches:
            for dim, at, q in by_length(batch):
                if dim not in annuli.by_dim:
                    continue
                ids = np.asarray(batch.column("vec_id"))[at]
                least = np.asarray(batch.column("least").fill_null(-np.inf))[at]
                a, lifted = annuli.by_dim[dim], pivots.lift(q, True)
                bound = annuli.bounds(dim, pivots.distances(lifted))
                nearest = bound.argmin(1)
                if first:
                    look = np.arange(bound.shape[1]) == nearest[:, None]
                else:
                    reach = np.sqrt(np.maximum(0.0, pivots.norm2 + (q**2).sum(1) - 2 * np.maximum(least, -1e300)))
                    look = (bound <= reach[:, None] + slack) & (np.arange(bound.shape[1]) != nearest[:, None])
                row, col = np.nonzero(look)
                times = a["blocks"][col]
                row, col = np.repeat(row, times), np.repeat(col, times)
                block = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                packed = [pack(v) for v in q]
                yield record(schema, np.full(len(row), dim), a["pivot"][col], a["ring"][col], block, ids[row], [packed[i] for i in row], least[row])

    return queries.mapInArrow(run, "dim int, pivot int, ring int, block int, query_id long, q binary, least double")


def best(k: int):
    """For one block of vectors and one of queries: each query's k best of at least its k-th score so far."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        out = []
        if queries.num_rows and vectors.num_rows:
            order = np.argsort(np.asarray(vectors.column("vec_id")), kind="stable")
            ids = np.asarray(vectors.column("vec_id"))[order]
            x = np.stack([np.frombuffer(v, np.float64) for v in vectors.column("x").to_pylist()])[order]
            q = np.stack([np.frombuffer(v, np.float64) for v in queries.column("q").to_pylist()])
            q_ids, least = np.asarray(queries.column("query_id")), np.asarray(queries.column("least"))
            for a in range(0, len(q), 256):
                scores = q[a : a + 256] @ x.T
                for i, row in enumerate(scores):
                    at = np.flatnonzero((row >= least[a + i]) & (ids != q_ids[a + i]))
                    # ids ascend, so a stable sort leaves ties to the smaller vec_id
                    at = at[np.argsort(-row[at], kind="stable")[:k]]
                    out.append((np.full(len(at), q_ids[a + i]), ids[at], row[at].astype(np.int64)))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [[], [], []]
        return pa.Table.from_batches([record(schema, *columns)])

    return run


def search(vectors: DataFrame, every: int = 50, k: int = 5, pivots: int | None = None, effort: dict[str, int] | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best others by inner product of floored components, ties to the smaller vec_id.

    Queries are the vectors whose vec_id is divisible by ``every``. Vectors of different length never meet; one with no
    other of its length gets no row. A vec_id that repeats is a candidate each time, but not to itself; as a query it is
    asked once (the first of its vectors by content). ``effort`` takes how many pairs were scored, and how many there are.
    """
    spark = vectors.sparkSession
    stage = Staging(spark)
    rows = valid(vectors)
    norm = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    whole = rows.agg(F.max(norm).alias("norm2"), F.count("*").alias("n")).first()
    norm2 = whole["norm2"] or 0.0
    if pivots is None:
        pivots = min(MOST_PIVOTS, max(LEAST_PIVOTS, math.isqrt(whole["n"])))
    sample = [r["x"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()]
    chosen = Pivots(sample, norm2)
    index = stage(keyed(rows, chosen))
    widest = index.select(F.max("distance").alias("d")).first()["d"] or 0.0
    ring = F.least(F.lit(RINGS - 1), F.floor(F.col("distance") / (widest / RINGS or 1.0))).cast("int")
    index = index.withColumn("ring", ring)
    annuli_rows = index.groupBy("dim", "pivot", "ring").agg(F.min("distance").alias("low"), F.max("distance").alias("high"), F.count("*").alias("n"))
    found = annuli_rows.collect()
    annuli = Annuli(found)
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("x").alias("x"))
    parts = max(1, -(-asked.count() // BLOCK))
    sizes = spark.createDataFrame([(r["dim"], r["pivot"], r["ring"], -(-r["n"] // BLOCK)) for r in found], "dim int, pivot int, ring int, blocks int")
    annulus = ["dim", "pivot", "ring"]
    blocked = index.join(F.broadcast(sizes), annulus).withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "vec_id", "x"), F.col("blocks")).cast("int"))
    key = [*annulus, "block", "part"]
    part = F.pmod(F.xxhash64(F.lit("part"), "query_id"), F.lit(parts)).cast("int")

    def look(queries: DataFrame, first: bool) -> DataFrame:
        sent = stage(routed(queries, chosen, annuli, first).withColumn("part", part))
        wanted = stage(sent.select(key).distinct())
        dealt = blocked.join(wanted, [*annulus, "block"]).select(*key, "vec_id", "x")
        if effort is not None:
            pairs = sent.groupBy(key).count().join(dealt.groupBy(key).agg(F.count("*").alias("n")), key)
            effort["scored"] = effort.get("scored", 0) + (pairs.agg(F.sum(F.col("count") * F.col("n"))).first()[0] or 0)
            effort["pairs"] = asked.count() * whole["n"]
        return sent.groupBy(key).cogroup(dealt.groupBy(key)).applyInArrow(best(k), "query_id long, vec_id long, score long")

    near = stage(look(asked.withColumn("least", F.lit(None).cast("double")), True))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("least"))
    rest = look(asked.join(kth, "vec_id", "left"), False)
    ranked = near.unionByName(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
