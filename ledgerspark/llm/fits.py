"""What the trained operators share: folds, bounded samples of labelled rows, fitting in one task."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import Staging


#: Parts of a value's rows that are ranked by themselves.
PARTS = 64


def fold(folds: int, column: str = "doc_id") -> Column:
    """crc32 of the id's text modulo the number of folds; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


def first_rows(rows: DataFrame, of: str, most: int) -> DataFrame:
    """doc_id, text and the column ``of`` of at most ``most`` rows for each of its values, the first by hash of the id.

    Rows alike in these columns are one. The choice is made on hashes of the texts, in one pass, and only the chosen texts are
    shuffled; an id that repeats, or a value that most rows have, fills no task.
    """
    kinds = rows.select(of, "doc_id", F.xxhash64("text").alias("h")).distinct()
    order = [F.xxhash64("doc_id"), "doc_id", "h"]
    # first within parts of a value, so that the last choice is among PARTS * most rows, however many tasks there are
    chosen = kinds.withColumn("part", F.pmod("h", F.lit(PARTS)))
    for among in ([of, "part"], [of]):
        place = F.row_number().over(Window.partitionBy(*among).orderBy(*order))
        chosen = chosen.withColumn("place", place).where(F.col("place") <= most)
    # written, so that its size is known: a small choice is broadcast, and no text is shuffled to meet it
    chosen = Staging(rows.sparkSession)(chosen.select(F.col(of).alias("of"), F.col("doc_id").alias("id"), "h"))
    wanted = (F.col(of) == F.col("of")) & (F.col("doc_id") == F.col("id")) & (F.xxhash64("text") == F.col("h"))
    return rows.join(chosen, wanted, "left_semi").groupBy(of, "doc_id", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text")).drop("h")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, train: Column) -> DataFrame:
    """(text, label) of at most per_class training rows of each of the classes 0 and 1, the first by hash of the id.

    Labels are looked up for at most per_class ids a class, which join the documents; the sample is bounded again in rows,
    as an id may have several texts. Rows and labels that repeat count once. Labels that are null or neither 0 nor 1, and
    null ids, teach nothing.
    """
    marks = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & train).distinct()
    ids = reduce(
        DataFrame.unionByName,
        [marks.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (0, 1)],
    )
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    return first_rows(rows, "label", per_class).select("text", "label")


def fit(sample: DataFrame, learn: Callable[[pa.Table], bytes]) -> bytes:
    """Run learn over a bounded sample in one executor task and bring back its model."""

    def one(table: pa.Table) -> pa.Table:
        return pa.table({"model": pa.array([learn(table)], pa.binary())})

    rows = sample.groupBy(F.lit(0).alias("all")).applyInArrow(one, "model binary").collect()
    return bytes(rows[0]["model"]) if rows else b""


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of P(y = 1 | margin), by Newton steps with smoothed targets."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margin, np.ones_like(margin)], 1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(x @ w)
        gradient = x.T @ (p - target) + 1e-3 * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w = w - step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
    return float(w[0]), float(w[1])
