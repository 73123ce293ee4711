"""Language ID: prediction by partial matching over bytes.

Each language has a context tree of the bytes that follow every context of up to three bytes. A byte's
code length in a context is -log2 of its share of the context's counts; a byte the context has not seen
costs the context's escape (method C: d distinct bytes in n occurrences give the escape d of n + d) and is
coded in the next shorter context. Contexts that a language has not seen cost nothing to leave. The
statistics are frozen after training, so a byte's code length depends on the byte and the three before it,
and the trees become one table of code lengths per four-byte string, with the shorter strings behind it for
what no tree holds. A text's language is that of the least total code length.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fits import first_rows, fit, fold
from .words import Texts, record, slices, sums

DEPTH = 4
PAD = "   "
#: Training texts of each language, at most.
PER_LANGUAGE = 400
UNKNOWN = "und"


class Table:
    """Places of unsigned 32-bit keys: open addressing, looked up for whole arrays at once."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(8, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.keys = np.zeros(1 << self.bits, np.uint32)
        self.places = np.full(1 << self.bits, -1, np.int32)
        left = np.arange(len(keys), dtype=np.int32)
        slot = self.slot(keys)
        while len(left):
            free = self.places[slot] < 0
            self.places[slot[free]] = left[free]
            self.keys[slot[free]] = keys[left[free]]
            lost = self.places[slot] != left
            left, slot = left[lost], (slot[lost] + np.uint32(1)) & np.uint32((1 << self.bits) - 1)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint32(2654435769)) >> np.uint32(32 - self.bits)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for those that are not there."""
        slot = self.slot(keys)
        out = self.places[slot]
        odd = np.flatnonzero((self.keys[slot] != keys) & (out >= 0))
        while len(odd):
            slot_odd = slot[odd] = (slot[odd] + np.uint32(1)) & np.uint32((1 << self.bits) - 1)
            out[odd] = self.places[slot_odd]
            odd = odd[(self.keys[slot_odd] != keys[odd]) & (out[odd] >= 0)]
        return out


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The four-byte string that ends at each byte of each lower-cased text, and the texts' bounds."""
    column = column.cast(pa.large_string()).fill_null("")
    padded = Texts(pc.binary_join_element_wise(pa.scalar(PAD, pa.large_string()), pc.utf8_lower(column), pa.scalar("", pa.large_string())), lower=False)
    data = padded.data.astype(np.uint32)
    gram = data.copy()
    for back in (1, 2, 3):
        gram[back:] |= data[:-back] << np.uint32(8 * back)
    keep = np.ones(len(data), bool)
    for k in range(len(PAD)):
        keep[padded.bounds[:-1] + k] = False
    return gram[keep], padded.bounds - len(PAD) * np.arange(padded.n + 1)


def learn(table: pa.Table) -> bytes:
    names = sorted(set(table["lang"].to_pylist()))
    code = np.array([names.index(x) for x in table["lang"].to_pylist()])
    seen: list[list[np.ndarray]] = [[] for _ in names]
    at = 0
    for piece in slices(table.select(["text"]).to_batches()):
        gram, bounds = grams(piece.column(0))
        text = np.repeat(code[at : at + piece.num_rows], np.diff(bounds))
        at += piece.num_rows
        for k in range(len(names)):
            seen[k].append(np.stack(np.unique(gram[text == k], return_counts=True)).astype(np.int64))
    #: By depth 1..4: (strings of that many bytes, their counts) for each language.
    counts: list[list[tuple[np.ndarray, np.ndarray]]] = []
    for depth in range(1, DEPTH + 1):
        row = []
        for found in seen:
            all_ = np.concatenate(found, axis=1)
            keys, place = np.unique(all_[0] & ((1 << 8 * depth) - 1), return_inverse=True)
            row.append((keys, np.bincount(place, weights=all_[1], minlength=len(keys))))
        counts.append(row)
    model: dict = {"names": names, "levels": []}
    shorter = np.full((256, len(names)), 8.0)  # below the empty context all bytes are alike
    short_keys = np.arange(256)
    for depth in range(1, DEPTH + 1):
        low = (1 << 8 * (depth - 1)) - 1
        keys = np.unique(np.concatenate([k for k, _ in counts[depth - 1]])).astype(np.uint32)
        contexts = np.unique(keys >> 8)
        bits, escape = np.zeros((len(keys), len(names))), np.zeros((len(contexts), len(names)))
        below = shorter[np.searchsorted(short_keys, keys & (low if depth > 1 else 255))]
        for k, (own, n) in enumerate(counts[depth - 1]):
            context = np.searchsorted(contexts, own >> 8)
            total, kinds = np.bincount(context, weights=n, minlength=len(contexts)), np.bincount(context, minlength=len(contexts))
            known = kinds > 0
            escape[known, k] = np.log2((total[known] + kinds[known]) / kinds[known])
            bits[:, k] = escape[np.searchsorted(contexts, keys >> 8), k] + below[:, k]
            bits[np.searchsorted(keys, own), k] = np.log2((total + kinds)[context] / n)
        model["levels"].append((keys, bits.astype(np.float32), contexts.astype(np.uint32), escape.astype(np.float32)))
        shorter, short_keys = bits, keys
    return pickle.dumps(model)


class Trees:
    """The frozen trees, ready for whole arrays of four-byte strings."""

    def __init__(self, model: bytes):
        state = pickle.loads(model)
        self.names = state["names"]
        self.levels = [(Table(keys), bits, Table(contexts), escape) for keys, bits, contexts, escape in state["levels"]]

    def lengths(self, gram: np.ndarray, depth: int = DEPTH) -> np.ndarray:
        """Code length in bits of each string's last byte after the bytes before it: a row per string, a column per language."""
        if depth == 0:
            return np.full((len(gram), len(self.names)), 8.0, np.float32)
        table, bits, contexts, escape = self.levels[depth - 1]
        place = table.find(gram)
        out = bits[place]
        lost = np.flatnonzero(place < 0)
        if len(lost):
            rest = gram[lost]
            context = contexts.find(rest >> np.uint32(8))
            cost = np.where((context >= 0)[:, None], escape[context], np.float32(0))
            out[lost] = cost + self.lengths(rest & np.uint32((1 << 8 * (depth - 1)) - 1), depth - 1)
        return out


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, folds: int = 3, held: int = 1) -> bytes:
    """The model, from texts and languages of documents outside fold ``held`` alone.

    A language learns from at most per_language whole texts, the first by hash of the id; the sample of all languages is found
    in one pass. Null languages and ids and null or empty texts teach nothing; rows that repeat teach once.
    """
    rows = docs.where(F.col("lang").isNotNull() & (fold(folds) != held) & (F.octet_length("text") > 0)).select("doc_id", "lang", "text")
    return fit(first_rows(rows, "lang", per_language).select("text", "lang"), learn)


def score(docs: DataFrame, model: bytes, folds: int = 3, held: int = 1, keep_text_hash: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits_per_byte for every row of docs, with keep_text_hash also the text's xxhash64.

    A null text, and one without a letter, is `und` with score 0. Where code lengths tie, the first language by name
    wins. The score is the share of the winner in the languages' probabilities of the text. Without a model all is
    `und`. Repeated rows are scored each; lang, source and other columns are not read.
    """
    fields = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("bits_per_byte", pa.float64())]
    schema = pa.schema(fields + [("text_hash", pa.int64())] * keep_text_hash)

    def run(batches):
        trees = Trees(model) if model else None
        for piece in slices(batches):
            text = piece.column("text")
            kept = [piece.column("text_hash")] if keep_text_hash else []
            lettered = np.array(pc.match_substring_regex(text, r"\p{L}").fill_null(False), dtype=bool) if trees else np.zeros(len(text), bool)
            if trees:
                gram, bounds = grams(text)
                bits = trees.lengths(gram)
                total = np.stack([sums(bits[:, k].astype(np.float64), bounds) for k in range(len(trees.names))], 1)
                best = total.argmin(1)
                share = 1 / np.exp2(np.maximum(total.min(1)[:, None] - total, -60)).sum(1)
                rate = total.min(1) / np.maximum(np.diff(bounds), 1)
                names = [trees.names[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
            else:
                share = rate = np.zeros(len(text))
                names = [UNKNOWN] * len(text)
            yield record(schema, piece.column("doc_id"), piece.column("held_out"), names, np.where(lettered, share, 0.0), rate, *kept)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (fold(folds) == held).alias("held_out"))
    if keep_text_hash:
        rows = rows.withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, bits_per_byte double" + ", text_hash long" * keep_text_hash)
