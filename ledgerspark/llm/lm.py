"""LM scoring: an Elias-Fano n-gram trie.

The model has two levels. Level one has every word's count. Level two is a trie: contexts (the word before), and
under each its successors. Contexts and the pointers to their successors are stored as monotone sequences in Elias-Fano
form, and the probabilities (absolute discounting) are quantised to one byte; level one keeps plain counts, which the base
score needs. Both levels are cut into shards by hash, a block of arrays each, which is searched as it is stored: a
context among those of its upper bits, a pair among the successors between its context's two pointers.

    P(w | v) = (c(v, w) - D) / c(v)        where (v, w) was seen
             = D t(v) / c(v) * P(w)        where not; t(v): kinds of successors. v unseen: P(w)
    P(w)     = (c(w) + 1) / (N + V + 1)

A text's probability is the even mixture of the texts' probabilities under P(w) and under P(w | v), so one that the
corpus' word pairs say nothing of loses at most log10(2) against the base.

Scoring never moves texts. Tasks send their distinct word pairs, packed, with the texts they stand in, to the shards,
which return sums per text; what level two has not seen goes on to level one. Words and pairs so frequent that their
shards would stand out (at most HOT of each, and HOT_PER_SHARD for every shard) are sent to the tasks instead.
Words are told apart by 64 bits at level one, by 40 bits at level two.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import Staging
from .elias_fano import Sequence, between, decode, dump, encode, named, views, within
from .words import Texts, mix, pack, record, slices

DISCOUNT = 0.75
#: Text bytes for a shard.
SHARD_BYTES = 40 << 20
#: Tokens that a task gathers before it sends them, and texts.
BATCH_TOKENS = 500_000
BATCH_TEXTS = 60_000
HOT = 1 << 16
HOT_PER_SHARD = 8
#: The word that ends a text, and stands before its first.
END = mix(np.array([0x454E44], np.uint64))[0]
DROP = np.uint64(24)
LOW40 = np.uint64((1 << 40) - 1)


def pack40(x: np.ndarray) -> bytes:
    return pack(x.astype(np.uint32)) + pack((x >> np.uint64(32)).astype(np.uint8))


def unpack40(data) -> np.ndarray:
    n = len(data) // 5
    return np.frombuffer(data, np.uint32, n).astype(np.uint64) | np.frombuffer(data, np.uint8, n, 4 * n).astype(np.uint64) << np.uint64(32)


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted in ascending keys, and which are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def gathered(batches):
    """(keys of the texts, context, word, text of every token) of many texts at once; the end is a token."""
    held, tokens, texts = [], 0, 0

    def together():
        keys = np.concatenate([k for k, _, _ in held])
        counts = np.concatenate([n for _, n, _ in held])
        bounds = np.concatenate([[0], np.cumsum(counts + 1)])
        word = np.full(bounds[-1], END, np.uint64)
        last = np.zeros(len(word), bool)
        last[bounds[1:] - 1] = True
        word[~last] = np.concatenate([h for _, _, h in held])
        context = np.concatenate([np.array([END], np.uint64), word[:-1]])
        return keys, context, word, np.repeat(np.arange(len(keys), dtype=np.int32), counts + 1)

    for piece in slices(batches):
        found = Texts(piece.column("text"))
        held.append((np.asarray(piece.column("key")), found.counts, found.hashes()))
        tokens, texts = tokens + len(found.starts) + found.n, texts + found.n
        if tokens >= BATCH_TOKENS or texts >= BATCH_TEXTS - 4096:
            yield together()
            held, tokens, texts = [], 0, 0
    if held:
        yield together()


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts


def split(column, kind) -> np.ndarray:
    pieces = [np.frombuffer(x, kind) for x in column.to_pylist()]
    return np.concatenate(pieces) if pieces else np.zeros(0, kind)


# --- level one ------------------------------------------------------------------------------


def word_level(rows: DataFrame, shards: int) -> DataFrame:
    """shard, block, kinds, tokens, top: level one in shards; top is the most frequent words (hash, count) of the shard."""
    sent = pa.schema([("shard", pa.int32()), ("words", pa.binary()), ("counts", pa.binary())])
    most = HOT_PER_SHARD * 4 + 4 * HOT // shards

    def send(batches):
        for _, _, word, _ in gathered(batches):
            kinds, counts = np.unique(word, return_counts=True)
            cuts = np.searchsorted(shard_of(kinds, shards), np.arange(shards + 1))
            full = np.flatnonzero(np.diff(cuts))
            yield record(sent, full, [pack(kinds[cuts[s] : cuts[s + 1]]) for s in full], [pack(counts[cuts[s] : cuts[s + 1]].astype(np.uint32)) for s in full])

    made = pa.schema([("shard", pa.int32()), ("block", pa.binary()), ("kinds", pa.int64()), ("tokens", pa.int64()), ("top", pa.list_(pa.struct([("h", pa.int64()), ("c", pa.int64())])))])

    def build(table: pa.Table) -> pa.Table:
        kinds, counts = summed(split(table.column("words"), np.uint64), split(table.column("counts"), np.uint32).astype(np.int64))
        block = dump(named(encode(kinds), "words") | {"counts": counts})
        top = np.argsort(-counts, kind="stable")[:most]
        best = [{"h": int(h), "c": int(c)} for h, c in zip(kinds[top].view(np.int64), counts[top])]
        return pa.Table.from_batches([record(made, [table.column("shard")[0].as_py()], [block], [len(kinds)], [int(counts.sum())], [best])])

    packed = rows.mapInArrow(send, "shard int, words binary, counts binary")
    return packed.groupBy("shard").applyInArrow(build, "shard int, block binary, kinds long, tokens long, top array<struct<h: long, c: long>>")


class Hot:
    """Frequent words and pairs with what the model knows of them; their number is bounded."""

    def __init__(self, words: list[tuple[int, int]], contexts: int):
        h, c = np.array([w for w, _ in words], np.int64).view(np.uint64), np.array([n for _, n in words], np.float64)
        #: Contexts whose successors are spread over many shards, with their counts: the most frequent words.
        first = np.argsort(-c, kind="stable")[:contexts]
        order = np.argsort(h[first])
        self.contexts, self.context_counts = h[first][order], c[first][order]
        self.context_kinds = np.zeros(len(self.contexts))
        order = np.argsort(h)
        self.words, self.word_counts = h[order], c[order]
        #: Frequent pairs by hash, with their log probability.
        self.pairs, self.pair_logs = np.zeros(0, np.uint64), np.zeros(0)

    def route(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Hash by which a pair finds its shard: its context's, for hot contexts one of 64."""
        _, hot = find(self.contexts, context)
        return np.where(hot, mix(context + (word & np.uint64(63)) * np.uint64(0x9E3779B97F4A7C15)), context)


def pair_hash(context40: np.ndarray, word40: np.ndarray) -> np.ndarray:
    return mix(mix(context40) + word40)


# --- level two ------------------------------------------------------------------------------


def dealt(context, word, shards: int, hot: Hot):
    """Order by shard, context and word; the shards' cuts; where a pair and where a context begins."""
    shard = shard_of(hot.route(context, word), shards)
    context, word = context >> DROP, word >> DROP
    order = np.lexsort((word, context, shard))
    context, word, shard = context[order], word[order], shard[order]
    new_context = np.concatenate([[True], (context[1:] != context[:-1]) | (shard[1:] != shard[:-1])]) if len(word) else np.zeros(0, bool)
    new_pair = new_context.copy()
    new_pair[1:] |= word[1:] != word[:-1]
    return order, context, word, shard, np.flatnonzero(new_context), np.flatnonzero(new_pair)


def packed_pairs(context, word, shard, contexts, pairs, shards: int):
    """(shard, contexts, successors of each, words, occurrences of each, low, high) for every shard that has pairs; low and high bound its tokens."""
    times = np.diff(np.append(pairs, len(word)))
    kinds = np.diff(np.append(np.searchsorted(pairs, contexts), len(pairs)))
    cut_c, cut_p = np.searchsorted(shard[contexts], np.arange(shards + 1)), np.searchsorted(shard[pairs], np.arange(shards + 1))
    ends = np.append(pairs, len(word))
    for s in np.flatnonzero(np.diff(cut_p)):
        c, p = slice(cut_c[s], cut_c[s + 1]), slice(cut_p[s], cut_p[s + 1])
        yield int(s), pack40(context[contexts[c]]), pack(kinds[c].astype(np.uint32)), pack40(word[pairs[p]]), pack(times[p].astype(np.uint32)), ends[cut_p[s]], ends[cut_p[s + 1]]


def quantised(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One-byte codes of the values and what each stands for: the values themselves if at most 256, else means of equal shares."""
    kinds, place, times = np.unique(values, return_inverse=True, return_counts=True)
    if len(kinds) <= 256:
        return place.astype(np.uint8), kinds
    bin_of = np.minimum(255, (np.cumsum(times) - times) * 256 // len(values))
    weight = np.bincount(bin_of, weights=times, minlength=256)
    mean = np.bincount(bin_of, weights=times * kinds, minlength=256) / np.maximum(weight, 1)
    return bin_of[place].astype(np.uint8), mean


class Trie:
    """Level two of one shard."""

    @staticmethod
    def build(context: np.ndarray, word: np.ndarray, counts: np.ndarray, hot: Hot) -> bytes:
        """The block of arrays of ascending pairs (40-bit context, 40-bit word) and their counts."""
        starts = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(context) else np.zeros(0, np.int64)
        own = context[starts]
        kinds = np.diff(np.append(starts, len(context)))
        total = np.add.reduceat(counts, starts).astype(np.float64) if len(starts) else np.zeros(0)
        at, is_hot = find(hot.contexts >> DROP, own)
        total[is_hot] = hot.context_counts[at[is_hot]]
        logs, log_of = quantised(np.log10((counts - DISCOUNT) / np.repeat(total, kinds)))
        rest, rest_of = quantised(np.log10(DISCOUNT * kinds / np.maximum(total, 1)))
        parts = named(encode(own), "contexts") | named(encode(np.append(starts, len(context))), "pointers")
        return dump(
            parts | {"low": word.astype(np.uint32), "high": (word >> np.uint64(32)).astype(np.uint8), "logs": logs, "log_of": log_of, "rest": rest, "rest_of": rest_of}
        )

    def __init__(self, block):
        a = views(block)
        self.contexts, self.pointers = Sequence(within(a, "contexts")), Sequence(within(a, "pointers"))
        self.low, self.high = a["low"], a["high"]
        self.logs, self.log_of, self.rest, self.rest_of = a["logs"], a["log_of"], a["rest"], a["rest_of"]

    def _word(self, i: np.ndarray) -> np.ndarray:
        return self.low[i].astype(np.uint64) | self.high[i].astype(np.uint64) << np.uint64(32)

    def look(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log10 probability of each pair that was seen, the log10 weight of going on to level one for those that weren't; which were seen.

        Pairs come by context: a context is looked for once, and its successors between its pointers.
        """
        if not len(context):
            return np.zeros(0), np.zeros(0, bool)
        first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
        times = np.diff(np.append(first, len(context)))
        at, known = self.contexts.find(context[first])
        low, high = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        low[known], high[known] = self.pointers.get(at[known]).astype(np.int64), self.pointers.get(at[known] + 1).astype(np.int64)
        rest = np.zeros(len(at))
        rest[known] = self.rest_of[self.rest[at[known]]]
        to, seen = between(self._word, word, np.repeat(low, times), np.repeat(high, times))
        out = np.repeat(rest, times)
        out[seen] = self.log_of[self.logs[to[seen]]]
        return out, seen


def pair_level(rows: DataFrame, shards: int, hot: Hot) -> DataFrame:
    """shard, block, kinds, top: level two in shards; kinds of successors of hot contexts; the most frequent pairs of the shard."""
    most = HOT_PER_SHARD * 4 + 4 * HOT // shards
    sent = pa.schema([("shard", pa.int32()), *[(c, pa.binary()) for c in ("contexts", "kinds", "words", "counts")]])

    def send(batches):
        for _, context, word, _ in gathered(batches):
            _, context, word, shard, c, p = dealt(context, word, shards, hot)
            yield record(sent, *[list(x) for x in zip(*[r[:5] for r in packed_pairs(context, word, shard, c, p, shards)])])

    made = pa.schema(
        [("shard", pa.int32()), ("block", pa.binary()), ("kinds", pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int64())])))]
        + [("top", pa.list_(pa.struct([("h", pa.int64()), ("c", pa.int64()), ("p", pa.float64())])))]
    )

    def build(table: pa.Table) -> pa.Table:
        context = np.concatenate([np.repeat(unpack40(c), np.frombuffer(k, np.uint32)) for c, k in zip(table.column("contexts").to_pylist(), table.column("kinds").to_pylist())])
        word = np.concatenate([unpack40(w) for w in table.column("words").to_pylist()])
        counts = split(table.column("counts"), np.uint32)
        order = np.lexsort((word, context))
        context, word, counts = context[order], word[order], counts[order].astype(np.int64)
        at = np.flatnonzero(np.concatenate([[True], (context[1:] != context[:-1]) | (word[1:] != word[:-1])]))
        context, word, counts = context[at], word[at], np.add.reduceat(counts, at)
        block = Trie.build(context, word, counts, hot)
        own, n = np.unique(context, return_counts=True)
        _, is_hot = find(hot.contexts >> DROP, own)
        kinds = [{"h": int(h), "n": int(k)} for h, k in zip(own[is_hot], n[is_hot])]
        top = np.sort(np.argsort(-counts, kind="stable")[:most])
        logs, _ = Trie(block).look(context[top], word[top])
        names = pair_hash(context[top], word[top]).view(np.int64)
        best = [{"h": int(h), "c": int(c), "p": float(x)} for h, c, x in zip(names, counts[top], logs)]
        return pa.Table.from_batches([record(made, [table.column("shard")[0].as_py()], [block], [kinds], [best])])

    packed = rows.mapInArrow(send, "shard int, contexts binary, kinds binary, words binary, counts binary")
    return packed.groupBy("shard").applyInArrow(build, "shard int, block binary, kinds array<struct<h: long, n: long>>, top array<struct<h: long, c: long, p: double>>")


# --- model and scores -----------------------------------------------------------------------


class Model:
    """Two written tables of shards, the hot words and pairs, and the counts of the training tokens."""

    def __init__(self, words: DataFrame, pairs: DataFrame, hot: Hot, tokens: int, kinds: int, shards: int):
        self.words, self.pairs, self.hot, self.tokens, self.kinds, self.shards = words, pairs, hot, tokens, kinds, shards


def train(docs: DataFrame, shards: int) -> Model:
    """The model of every text of docs (columns key, text)."""
    stage = Staging(docs.sparkSession)
    words = stage(word_level(docs, shards))
    whole = words.agg(F.sum("tokens").alias("tokens"), F.sum("kinds").alias("kinds")).first()
    bound = max(HOT, HOT_PER_SHARD * shards)
    top = words.select(F.explode("top").alias("t")).select("t.h", "t.c").orderBy(F.desc("c"), "h").limit(bound).toPandas()
    hot = Hot(list(zip(top["h"].tolist(), top["c"].tolist())), HOT_PER_SHARD * shards)
    pairs = stage(pair_level(docs, shards, hot))
    kinds = pairs.select(F.explode("kinds").alias("k")).groupBy("k.h").agg(F.sum("k.n").alias("n")).toPandas()
    order = np.argsort(hot.contexts >> DROP, kind="stable")
    at, there = find((hot.contexts >> DROP)[order], kinds["h"].to_numpy(np.int64).astype(np.uint64))
    hot.context_kinds[order[at[there]]] = kinds["n"].to_numpy(np.float64)[there]
    best = pairs.select(F.explode("top").alias("t")).select("t.h", "t.c", "t.p").orderBy(F.desc("c"), "h").limit(bound).toPandas()
    names = best["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(names)
    hot.pairs, hot.pair_logs = names[order], best["p"].to_numpy(np.float64)[order]
    return Model(words, pairs, hot, int(whole["tokens"] or 0), int(whole["kinds"] or 0), shards)


#: What travels to level one: kind 0 asks for words, kind 1 asks for words that level two sent on, kind 2 are sums already.
TO_WORDS = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("texts", pa.binary()), ("words", pa.binary()), ("times", pa.binary()), ("at", pa.binary()), ("values", pa.binary())])
TO_WORDS_SQL = "shard int, kind int, texts binary, words binary, times binary, at binary, values binary"
SUMS = pa.schema([("key", pa.int64()), ("rows", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("chain", pa.float64())])
SUMS_SQL = "key long, rows long, n_tokens long, n_known long, base double, chain double"
#: Sums of texts on their way together: a row for a bucket of texts, not for each text.
PACKED = pa.schema([("bucket", pa.int32()), ("texts", pa.binary()), ("values", pa.binary())])
PACKED_SQL = "bucket int, texts binary, values binary"
BUCKETS_PER_SHARD = 4


def per_text(text: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(text, weights=values, minlength=n)


def ask_pairs(model: Model):
    """Tasks' word pairs for level two: packed pairs, and for each occurrence the text's place in texts."""
    hot, shards = model.hot, model.shards
    schema = pa.schema([("shard", pa.int32()), *[(c, pa.binary()) for c in ("texts", "contexts", "kinds", "words", "times", "at", "local")]])

    def send(batches):
        for keys, context, word, text in gathered(batches):
            at, frequent = find(hot.pairs, pair_hash(context >> DROP, word >> DROP))
            local = per_text(text[frequent], hot.pair_logs[at[frequent]], len(keys))
            rest = ~frequent
            order, context, word, shard, c, p = dealt(context[rest], word[rest], shards, hot)
            text = text[rest][order].astype(np.uint16)
            rows = [(0, pack(keys), b"", b"", b"", b"", b"", pack(local))]
            for s, contexts, kinds, words, times, low, high in packed_pairs(context, word, shard, c, p, shards):
                here, place = np.unique(text[low:high], return_inverse=True)
                rows.append((s, pack(keys[here]), contexts, kinds, words, times, pack(place.astype(np.uint16)), b""))
            yield record(schema, *[list(x) for x in zip(*rows)])

    return send, "shard int, texts binary, contexts binary, kinds binary, words binary, times binary, at binary, local binary"


def answer_pairs(model: Model):
    hot, shards = model.hot, model.shards
    hot40 = np.sort(hot.contexts >> DROP)
    order = np.argsort(hot.contexts >> DROP, kind="stable")
    with np.errstate(divide="ignore"):
        hot_rest = np.log10(DISCOUNT * hot.context_kinds[order] / np.maximum(hot.context_counts[order], 1))

    def answer(asked: pa.Table, blocks: pa.Table) -> pa.Table:
        trie = Trie(blocks.column("block")[0].as_buffer()) if blocks.num_rows else None
        out = []
        for row in asked.to_pylist():
            keys = np.frombuffer(row["texts"], np.int64)
            if row["local"]:
                out.append((0, 2, row["texts"], b"", b"", b"", row["local"]))
                continue
            context, word = np.repeat(unpack40(row["contexts"]), np.frombuffer(row["kinds"], np.uint32)), unpack40(row["words"])
            times, at = np.frombuffer(row["times"], np.uint32), np.frombuffer(row["at"], np.uint16)
            logs, seen = trie.look(context, word) if trie else (np.zeros(len(word)), np.zeros(len(word), bool))
            place, is_hot = find(hot40, context)
            logs = np.where(is_hot & ~seen, hot_rest[place] if len(hot_rest) else 0.0, logs)
            out.append((0, 2, row["texts"], b"", b"", b"", pack(per_text(at, np.repeat(logs, times), len(keys)))))
            # unseen: the words alone, by shard of level one
            miss = np.repeat(~seen, times)
            missed, text = np.repeat(word, times)[miss], at[miss]
            by = np.lexsort((text, missed))
            missed, text = missed[by], text[by]
            shard = shard_of(missed << DROP, shards)
            cuts = np.searchsorted(shard, np.arange(shards + 1))
            for s in np.flatnonzero(np.diff(cuts)):
                own, t = missed[cuts[s] : cuts[s + 1]], text[cuts[s] : cuts[s + 1]]
                first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                here, p = np.unique(t, return_inverse=True)
                out.append((int(s), 1, pack(keys[here]), pack40(own[first]), pack(np.diff(np.append(first, len(own))).astype(np.uint32)), pack(p.astype(np.uint16)), b""))
        return pa.Table.from_batches([record(TO_WORDS, *([list(x) for x in zip(*out)] or [[]] * len(TO_WORDS)))])

    return answer


def ask_words(model: Model):
    """Tasks' words for level one, but for hot ones, which are summed on the spot."""
    hot, shards, all_ = model.hot, model.shards, model.tokens + model.kinds + 1

    def send(batches):
        for keys, _, word, text in gathered(batches):
            at, frequent = find(hot.words, word)
            base = per_text(text[frequent], np.log10((hot.word_counts[at[frequent]] + 1) / all_), len(keys))
            known, tokens = np.bincount(text[frequent], minlength=len(keys)), np.bincount(text, minlength=len(keys))
            rows = [(0, 2, pack(keys), b"", b"", b"", pack(np.stack([base, known, tokens]).astype(np.float64)))]
            word, text = word[~frequent], text[~frequent]
            order = np.lexsort((text, word))
            word, text = word[order], text[order].astype(np.uint16)
            cuts = np.searchsorted(shard_of(word, shards), np.arange(shards + 1))
            for s in np.flatnonzero(np.diff(cuts)):
                own, t = word[cuts[s] : cuts[s + 1]], text[cuts[s] : cuts[s + 1]]
                first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                here, place = np.unique(t, return_inverse=True)
                rows.append((int(s), 0, pack(keys[here]), pack(own[first]), pack(np.diff(np.append(first, len(own))).astype(np.uint32)), pack(place.astype(np.uint16)), b""))
            yield record(TO_WORDS, *[list(x) for x in zip(*rows)])

    return send


def answer_words(model: Model):
    all_, buckets = model.tokens + model.kinds + 1, model.shards * BUCKETS_PER_SHARD

    def answer(asked: pa.Table, blocks: pa.Table) -> pa.Table:
        words, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if blocks.num_rows:
            a = views(blocks.column("block")[0].as_buffer())
            words, counts = decode(within(a, "words")), a["counts"]
        short = words >> DROP
        parts = []
        for row in asked.to_pylist():
            keys = np.frombuffer(row["texts"], np.int64)
            n = len(keys)
            zero = np.zeros(n)
            if row["kind"] == 2:
                values = np.frombuffer(row["values"], np.float64).reshape(-1, n)
                # sums of level two are one row of numbers, those of the tasks' hot words three
                parts.append((keys, zero, zero, zero, zero, values[0]) if len(values) == 1 else (keys, zero + 1, values[2], values[1], values[0], zero))
                continue
            at, times = np.frombuffer(row["at"], np.uint16), np.frombuffer(row["times"], np.uint32)
            to, there = find(words, np.frombuffer(row["words"], np.uint64)) if row["kind"] == 0 else find(short, unpack40(row["words"]))
            c = np.where(there, counts[to] if len(counts) else 0, 0)
            logs = per_text(at, np.repeat(np.log10((c + 1) / all_), times), n)
            if row["kind"] == 0:
                parts.append((keys, zero, zero, per_text(at, np.repeat(there, times), n), logs, zero))
            else:
                parts.append((keys, zero, zero, zero, zero, logs))
        if not parts:
            return pa.Table.from_batches([], PACKED)
        keys, added = added_up(parts)
        bucket = shard_of(mix(keys.view(np.uint64)), buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        full = np.flatnonzero(np.diff(cuts))
        own = [order[cuts[b] : cuts[b + 1]] for b in full]
        return pa.Table.from_batches([record(PACKED, full, [pack(keys[o]) for o in own], [pack(added[:, o]) for o in own])])

    return answer


def added_up(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of (keys, five rows of values) and the sums of their values."""
    keys, *values = (np.concatenate(x) for x in zip(*parts))
    texts, place = np.unique(keys, return_inverse=True)
    return texts, np.stack([np.bincount(place, weights=v, minlength=len(texts)) for v in values])


def unpacked(table: pa.Table) -> pa.Table:
    """One row for every text of a bucket."""
    parts = []
    for texts, values in zip(table.column("texts").to_pylist(), table.column("values").to_pylist()):
        keys = np.frombuffer(texts, np.int64)
        parts.append((keys, *np.frombuffer(values, np.float64).reshape(5, len(keys))))
    keys, added = added_up(parts)
    return pa.Table.from_batches([record(SUMS, keys, *[v.astype(np.int64) for v in added[:3]], *added[3:])])


def score_by(docs: DataFrame, model: Model) -> DataFrame:
    """key, rows, n_tokens, n_known, base, chain of the texts of docs (columns key, text), rows alike in key summed."""
    send, sql = ask_pairs(model)
    asked = docs.mapInArrow(send, sql).withColumn("shard", spread("texts", model.shards, "length(local) > 0"))
    passed = asked.groupBy("shard").cogroup(model.pairs.select("shard", "block").groupBy("shard")).applyInArrow(answer_pairs(model), TO_WORDS_SQL)
    words = docs.mapInArrow(ask_words(model), TO_WORDS_SQL)
    every = passed.unionByName(words).withColumn("shard", spread("texts", model.shards, "kind = 2"))
    found = every.groupBy("shard").cogroup(model.words.select("shard", "block").groupBy("shard")).applyInArrow(answer_words(model), PACKED_SQL)
    return found.groupBy("bucket").applyInArrow(unpacked, SUMS_SQL)


def spread(column: str, shards: int, when: str) -> Column:
    """Rows that any shard can take go to one by their content."""
    return F.when(F.expr(when), F.pmod(F.xxhash64(column), F.lit(shards)).cast("int")).otherwise(F.col("shard"))


def score(docs: DataFrame, training: Column, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs.

    The model learns from the rows where training holds, all of them. A null text is an empty one: its end is its one
    token. Repeated rows are learned and scored each. Without training rows nothing is known, and every token has
    probability 1. Other columns are not read.
    """
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    shards = max(8, -(-size // shard_bytes))
    named_docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~training).alias("held_out"), "text", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("key"))
    model = train(named_docs.where(~F.col("held_out")).select("key", "text"), shards)
    sums = score_by(named_docs.select("key", "text"), model)
    one = lambda c: F.col(c) / F.col("rows")
    high = F.greatest(one("base"), one("chain"))
    mixed = high + F.log10(0.5 * F.pow(F.lit(10.0), one("base") - high) + 0.5 * F.pow(F.lit(10.0), one("chain") - high))
    return named_docs.select("doc_id", "held_out", "key").join(sums, "key").select(
        "doc_id", "held_out", one("n_tokens").cast("long").alias("n_tokens"), one("n_known").cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), one("base").alias("base_score"), mixed.alias("score"), one("chain").alias("chain_score"),
    )
