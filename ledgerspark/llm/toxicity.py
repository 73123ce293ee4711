"""Toxicity: a linear-chain conditional random field tags toxic words.

Each word is clean or toxic. A word's emission is the sum of the weights of its features (the word, its
first four and five bytes, its last three), hashed; two-by-two transition weights tie neighbours together.
Documents carry labels, words do not, so training words get theirs from the sample: in a toxic document a
word is toxic if one of its features stands in far more toxic documents than clean ones. The field is then
fitted on those tags by gradient ascent. Forward-backward gives every word of every whole text its marginal;
the document's doubt is -log of the chance that no suspicious word is toxic, and a logistic curve makes it a score.

With two states, forward and backward vectors are one ratio each, and all texts of a slice take a step at
once: texts lie ordered by length, so those still running are a prefix.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fits import fit, fold, labelled_sample, platt, sigmoid
from .words import Texts, mix, record, slices, token_hashes

BITS = 18
THRESHOLD = 0.5
#: Rows of each class that the model is fitted on, at most.
PER_CLASS = 2000
#: A feature is telling if its log odds, toxic texts to clean ones, are so many standard errors above 0, and clean texts have
#: it at most 1/RATIO as often.
ERRORS, RATIO = 2.5, 25
#: Marginals below this are noise and add nothing to a document's score.
FLOOR = 0.05
SEGMENT = 64
CLIP = 30.0
#: Doubt beyond this says no more.
MOST_DOUBT = 12.0


def features(texts: Texts) -> np.ndarray:
    """A column of hashed places for each of: the word, its first 4 and 5 bytes, its last 3."""
    s, e = texts.starts, texts.ends
    kinds = [texts.hashes(), token_hashes(texts.data, s, np.minimum(e, s + 4)), token_hashes(texts.data, s, np.minimum(e, s + 5))]
    tail = np.maximum(s, e - 3)
    kinds.append(token_hashes(texts.data, tail, e))
    return np.stack([(mix(h + np.uint64(k + 1)) >> np.uint64(64 - BITS)).astype(np.int32) for k, h in enumerate(kinds)], 1)


class Steps:
    """Where each word of texts of the given lengths lies when all texts step at once."""

    def __init__(self, lengths: np.ndarray):
        order = np.argsort(-lengths, kind="stable")
        rank = np.empty(len(lengths), np.int64)
        rank[order] = np.arange(len(lengths))
        longest = int(lengths.max()) if len(lengths) else 0
        #: Texts that have a word at step t.
        self.active = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(longest), side="right")
        self.base = np.concatenate([[0], np.cumsum(self.active)])
        step = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.place = self.base[step] + np.repeat(rank, lengths)


def forward_backward(emission: np.ndarray, steps: Steps, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ratios toxic to clean of the forward and backward vectors, and of the emissions, in stepped order.

    trans[i, j] weighs going from i to j, 0 clean and 1 toxic.
    """
    a = np.exp(trans)
    e = np.empty(len(emission))
    e[steps.place] = np.exp(np.clip(emission, -CLIP, CLIP))
    ahead, back = e.copy(), np.ones(len(e))
    base, active = steps.base, steps.active
    for t in range(1, len(active)):
        r = ahead[base[t - 1] : base[t - 1] + active[t]]
        ahead[base[t] : base[t + 1]] *= (r * a[1, 1] + a[0, 1]) / (r * a[1, 0] + a[0, 0])
    for t in range(len(active) - 1, 0, -1):
        b = e[base[t] : base[t + 1]] * back[base[t] : base[t + 1]]
        back[base[t - 1] : base[t - 1] + active[t]] = (a[1, 1] * b + a[1, 0]) / (a[0, 1] * b + a[0, 0])
    return ahead, back, e


def marginals(emission: np.ndarray, steps: Steps, trans: np.ndarray) -> np.ndarray:
    ahead, back, _ = forward_backward(emission, steps, trans)
    odds = ahead * back
    return (odds / (1 + odds))[steps.place]


def pairs(ahead, back, e, steps: Steps, trans: np.ndarray) -> np.ndarray:
    """Expected number of each transition."""
    total = np.zeros((2, 2))
    a = np.exp(trans)
    for t in range(1, len(steps.active)):
        n, at, now = steps.active[t], steps.base[t - 1], slice(steps.base[t], steps.base[t + 1])
        r, b = ahead[at : at + n], e[now] * back[now]
        weights = (np.full(n, a[0, 0]), a[0, 1] * b, r * a[1, 0], r * a[1, 1] * b)
        whole = sum(weights)
        total += np.array([(w / whole).sum() for w in weights]).reshape(2, 2)
    return total


def doubts(p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """-log of the chance that no word of each text is toxic; words with a marginal below FLOOR don't count."""
    running = np.concatenate([[0.0], np.cumsum(np.where(p >= FLOOR, -np.log1p(-np.minimum(p, 1 - 1e-9)), 0.0))])
    return np.minimum(running[bounds[1:]] - running[bounds[:-1]], MOST_DOUBT)


def log_odds(bad: np.ndarray, n_bad: int, good: np.ndarray, n_good: int) -> np.ndarray:
    """Log odds ratio of being in a toxic text against being in a clean one, in standard errors; half a text is added to each count."""
    counts = [bad + 0.5, n_bad - bad + 0.5, good + 0.5, n_good - good + 0.5]
    return (np.log(counts[0] / counts[1]) - np.log(counts[2] / counts[3])) / np.sqrt(sum(1 / c for c in counts))


def tags(places: np.ndarray, lengths: np.ndarray, shingle: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """1 for each word that its features show to be toxic; which texts may teach.

    A text that shares its least shingle with an earlier one of its class is a copy and isn't counted.
    """
    text = np.repeat(np.arange(len(lengths)), lengths)
    first = np.zeros(len(lengths), bool)
    first[np.unique(np.stack([shingle, y.astype(np.uint64)], 1), axis=0, return_index=True)[1]] = True
    toxic = np.zeros(len(places), bool)
    n_bad, n_good = (y[first] == 1).sum(), (y[first] == 0).sum()
    for k in range(places.shape[1]):
        seen = np.unique(text[first[text]] * np.int64(1 << BITS) + places[first[text], k])
        of, place = seen >> BITS, seen & ((1 << BITS) - 1)
        bad = np.bincount(place[y[of] == 1], minlength=1 << BITS)
        good = np.bincount(place[y[of] == 0], minlength=1 << BITS)
        telling = (log_odds(bad, n_bad, good, n_good) >= ERRORS) & (bad * max(1, n_good) >= RATIO * n_bad * good)
        toxic |= telling[places[:, k]]
    toxic &= y[text] == 1
    shown = np.bincount(text[toxic], minlength=len(lengths)) > 0
    return toxic, first & ((y == 0) | shown)


def least_shingle(texts: Texts, word: np.ndarray) -> np.ndarray:
    """The smallest hash of three consecutive words of each text; of the words where there are fewer than three."""
    out = np.zeros(texts.n, np.uint64)
    three = mix(word[:-2] * np.uint64(3) + mix(word[1:-1] * np.uint64(5) + word[2:])) if len(word) > 2 else word[:0]
    for i in range(texts.n):
        a, b = texts.word_bounds[i], texts.word_bounds[i + 1]
        out[i] = three[a : b - 2].min() if b - a > 2 else word[a:b].min() if b > a else 0
    return out


def learn(table: pa.Table, rounds: int = 30, rate: float = 0.6, decay: float = 1e-3) -> bytes:
    y = np.array(table["label"])
    found, lengths, shingles = [], [], []
    for piece in slices(table.select(["text"]).to_batches()):
        texts = Texts(piece.column(0))
        found.append(features(texts))
        lengths.append(texts.counts)
        shingles.append(least_shingle(texts, texts.hashes()))
    places, n = np.concatenate(found), np.concatenate(lengths)
    toxic, teaches = tags(places, n, np.concatenate(shingles), y)
    keep = np.repeat(teaches, n)
    every = places, n, y
    places, toxic, n, y = places[keep], toxic[keep], n[teaches], y[teaches]
    # segments of bounded length step together
    whole, rest = n // SEGMENT, n % SEGMENT
    cut = np.where(np.arange(2 * len(n)) % 2 == 0, np.repeat(whole, 2), 1)
    size = np.where(np.arange(2 * len(n)) % 2 == 0, SEGMENT, np.repeat(rest, 2))
    size = np.repeat(size, cut)
    steps = Steps(size[size > 0])
    stepped = np.empty(len(places), np.int8)
    stepped[steps.place] = toxic
    seen = np.zeros((2, 2))
    for t in range(1, len(steps.active)):
        before, now = stepped[steps.base[t - 1] : steps.base[t - 1] + steps.active[t]], stepped[steps.base[t] : steps.base[t + 1]]
        seen += np.bincount(before * 2 + now, minlength=4).reshape(2, 2)
    weight, bias, trans = np.zeros((places.shape[1], 1 << BITS)), -3.0, np.zeros((2, 2))
    square, bias_square, trans_square = np.full(weight.shape, 1e-6), 1e-6, np.full((2, 2), 1e-6)
    for _ in range(rounds if len(places) else 0):
        emission = bias + sum(weight[k][places[:, k]] for k in range(len(weight)))
        ahead, back, e = forward_backward(emission, steps, trans)
        odds = (ahead * back)[steps.place]
        miss = toxic - odds / (1 + odds)
        for k in range(len(weight)):
            g = np.bincount(places[:, k], weights=miss, minlength=1 << BITS) - decay * weight[k]
            square[k] += g * g
            weight[k] += rate * g / np.sqrt(square[k])
        g = miss.sum()
        bias_square += g * g
        bias += rate * g / np.sqrt(bias_square)
        g = seen - pairs(ahead, back, e, steps, trans) - decay * trans
        trans_square += g * g
        trans += 0.3 * rate * g / np.sqrt(trans_square)
    places, n, y = every
    emission = bias + sum(weight[k][places[:, k]] for k in range(len(weight)))
    seen_doubt = doubts(marginals(emission, Steps(n), trans), np.concatenate([[0], np.cumsum(n)]))
    slope, shift = platt(seen_doubt, y)
    return pickle.dumps({"weight": weight.astype(np.float32), "bias": bias, "trans": trans, "slope": slope, "shift": shift})


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, folds: int = 5, held: int = 0) -> bytes:
    """The model, from labels of rows outside fold ``held`` alone. Without rows of both classes it is empty."""
    return fit(labelled_sample(docs, labels, "toxic", per_class, fold(folds) != held), lambda t: learn(t) if len(set(t["label"].to_pylist())) == 2 else b"")


def spans(p: np.ndarray, texts: Texts) -> list[list[dict]]:
    """Runs of words whose marginal reaches THRESHOLD: byte offsets in the UTF-8 text, and the largest marginal."""
    out: list[list[dict]] = [[] for _ in range(texts.n)]
    text = np.searchsorted(texts.word_bounds, np.flatnonzero(p >= THRESHOLD), side="right") - 1
    last = (-1, -2)
    for i, w in zip(text, np.flatnonzero(p >= THRESHOLD)):
        start, end = int(texts.starts[w] - texts.bounds[i]), int(texts.ends[w] - texts.bounds[i])
        if last == (i, w - 1):
            out[i][-1] |= {"end": end, "p": max(out[i][-1]["p"], float(p[w]))}
        else:
            out[i].append({"start": start, "end": end, "p": float(p[w])})
        last = (i, w)
    return out


def score(docs: DataFrame, model: bytes, folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted, spans for every row of docs.

    Null and empty texts have no doubt and no span, and the curve's least score. Without a model every score is 0. Rows that repeat are scored
    each; labels, lang, source and other columns are not read.
    """
    item = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32()), ("spans", pa.list_(item))])

    def run(batches):
        field = pickle.loads(model) if model else None
        for piece in slices(batches):
            texts = Texts(piece.column("text"))
            if field and len(texts.starts):
                places = features(texts)
                emission = field["bias"] + sum(field["weight"][k][places[:, k]] for k in range(places.shape[1])).astype(np.float64)
                p = marginals(emission, Steps(texts.counts), field["trans"])
            else:
                p = np.zeros(len(texts.starts))
            if field:
                score = sigmoid(field["slope"] * doubts(p, texts.word_bounds) + field["shift"])
            else:
                score = np.zeros(texts.n)
            yield record(schema, piece.column("doc_id"), piece.column("held_out"), score, (score >= THRESHOLD).astype(np.int32), spans(p, texts))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (fold(folds) == held).alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, spans array<struct<start: long, end: long, p: double>>")
