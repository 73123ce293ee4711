"""Quality classifier: Naive Bayes support vectors.

A text's features are indicators of its byte trigrams and of its pairs of word shapes (how many capitals, other letters and
signs a word has, and whether it repeats the word before), hashed into 2^BITS places. Each place is scaled by the log ratio
of its smoothed class counts (Naive Bayes), rows longer than the median row are cut to its length, and a linear model with
hinge loss is fitted on them by dual coordinate descent. Margins become probabilities by a logistic curve, corrected for
the classes' shares in all training labels. Counts and model come from a bounded sample of labelled rows (``per_class``);
every text is scored whole.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fits import fit, fold, labelled_sample, platt, sigmoid
from .words import Texts, record, slices, sums

BITS = 18
THRESHOLD = 0.7
#: Rows of each class that the model is fitted on, at most.
PER_CLASS = 3000


def shapes(texts: Texts) -> np.ndarray:
    """A number below 48 for every word: capitals (0, 1, more), other letters (or none), signs (0, 1, 2, more), repeats the word before."""
    kinds = np.zeros(256, np.int64)
    kinds[65:91] = 1
    kinds[[*range(97, 123), *range(128, 256)]] = 1 << 21
    kinds[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 1 << 42
    running = np.concatenate([[0], np.cumsum(kinds[texts.data])])
    found = running[texts.ends] - running[texts.starts]
    few = (1 << 21) - 1
    word = texts.hashes()
    same = np.zeros(len(word), bool)
    same[1:] = word[1:] == word[:-1]
    same[texts.word_bounds[:-1][texts.counts > 0]] = False
    return np.minimum(found & few, 2) * 16 + (found >> 21 & few > 0) * 8 + np.minimum(found >> 42, 3) * 2 + same


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature places of each text, one after the other, and the texts' bounds in them."""
    texts = Texts(column, lower=False)
    data = texts.data.astype(np.uint32)
    text = np.repeat(np.arange(texts.n, dtype=np.uint32), np.diff(texts.bounds))
    gram = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    inside = text[:-2] == text[2:]
    shape = shapes(texts).astype(np.uint32)
    of = texts.text_of_word().astype(np.uint32)
    pair = (shape[:-1] * 48 + shape[1:]) | np.uint32(1 << 30)
    beside = of[:-1] == of[1:]
    grams = np.concatenate([gram[inside], pair[beside]])
    place = (grams * np.uint32(2654435769)) >> np.uint32(32 - BITS)
    # slices() gives at most 4096 texts: 12 bits beside the 18 of a place
    key = np.sort(np.concatenate([text[:-2][inside], of[:-1][beside]]) << np.uint32(BITS) | place)
    key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    return key & np.uint32((1 << BITS) - 1), np.searchsorted(key, np.arange(texts.n + 1, dtype=np.uint64) << BITS)


def log_count_ratio(places: np.ndarray, rows: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Log of the smoothed share of class 1 over that of class 0, for each place."""
    high = 1 + np.bincount(places[y[rows] == 1], minlength=1 << BITS)
    low = 1 + np.bincount(places[y[rows] == 0], minlength=1 << BITS)
    return np.log(high / high.sum()) - np.log(low / low.sum())


def dual_descent(values, places, bounds, y, cost: float = 4.0, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear hinge-loss model, by coordinate descent on the dual."""
    weight, bias, alpha = np.zeros(1 << BITS), 0.0, np.zeros(len(y))
    square = sums(values**2, bounds) + 1
    sign = np.where(y == 1, 1.0, -1.0)
    rng = np.random.default_rng(7)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(y)):
            at, x = places[bounds[i] : bounds[i + 1]], values[bounds[i] : bounds[i + 1]]
            gradient = sign[i] * (weight[at] @ x + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost)
            step = (new - alpha[i]) * sign[i]
            if step:
                weight[at] += step * x
                bias += step
                moved += abs(step)
                alpha[i] = new
        if moved < 1e-3 * len(y):
            break
    return weight, bias


def learn(table: pa.Table) -> bytes:
    y = np.array(table["label"])
    found, lengths = [], []
    for piece in slices(table.select(["text"]).to_batches()):
        places, bounds = features(piece.column(0))
        found.append(places)
        lengths.append(np.diff(bounds))
    places, bounds = np.concatenate(found), np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
    rows = np.repeat(np.arange(len(y)), np.diff(bounds))
    ratio = log_count_ratio(places, rows, y)
    norm = np.sqrt(sums(ratio[places] ** 2, bounds))
    usual = float(np.median(norm)) or 1.0
    values = ratio[places] / np.maximum(norm, usual)[rows]
    weight, bias = dual_descent(values, places, bounds, y)
    slope, shift = platt(sums(weight[places] * values, bounds) + bias, y)
    return pickle.dumps(
        {"ratio": ratio.astype(np.float32), "weight": (weight * ratio).astype(np.float32), "bias": bias, "slope": slope, "shift": shift, "usual": usual}
    )


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, folds: int = 4, held: int = 2) -> bytes:
    """The model, from labels of rows outside fold ``held`` alone. Without rows of both classes it is empty."""
    model = fit(labelled_sample(docs, labels, "quality", per_class, fold(folds) != held), lambda t: learn(t) if len(set(t["label"].to_pylist())) == 2 else b"")
    if not model:
        return model
    # the sample has as many rows of either class, as far as there are; all training labels tell their real odds
    counts = labels.where(fold(folds) != held).agg(*[F.sum((F.col("quality") == k).cast("long")).alias(f"n{k}") for k in (0, 1)]).first()
    taken = [min(per_class, counts[f"n{k}"]) for k in (0, 1)]
    state = pickle.loads(model)
    state["shift"] += float(np.log(counts["n1"] / counts["n0"]) - np.log(taken[1] / taken[0]))
    return pickle.dumps(state)


def probabilities(model: dict, column: pa.Array) -> np.ndarray:
    places, bounds = features(column)
    norm = np.sqrt(sums(model["ratio"][places].astype(np.float64) ** 2, bounds))
    margin = sums(model["weight"][places].astype(np.float64), bounds) / np.maximum(norm, model["usual"]) + model["bias"]
    return sigmoid(model["slope"] * margin + model["shift"])


def score(docs: DataFrame, model: bytes, folds: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs.

    A null text is an empty one; texts of under three bytes and two words have no features and get the score of the bias.
    Without a model every score is 0.5. Rows that repeat are scored each; other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches):
        fitted = pickle.loads(model) if model else None
        for piece in slices(batches):
            p = probabilities(fitted, piece.column("text")) if fitted else np.full(piece.num_rows, 0.5)
            yield record(schema, piece.column("doc_id"), piece.column("held_out"), p, (p >= THRESHOLD).astype(np.int32))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (fold(folds) == held).alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
