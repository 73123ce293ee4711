"""Words of whole Arrow batches of texts, as numpy arrays.

A batch's texts lie end to end in one byte buffer, so words, their hashes and sums per text are a few
vectorised passes, whatever the lengths of the texts. Slices bound the memory: a slice holds at most
SLICE_BYTES of text or one text. A word's hash depends on its bytes alone, in any task and session.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

SLICE_BYTES = 2 << 20
SLICE_TEXTS = 4096
BLOCK = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: 0x20 and 0x09-0x0D part words.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: 0x00-0x2F, 0x3A-0x60 and 0x7B-0x7F part words of letters and digits; bytes over 0x7F belong to non-ASCII letters.
NOT_WORD = np.zeros(256, bool)
NOT_WORD[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit integers (multiply and shift)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64))
ODD = 0xF1357AEA2E62A9C5
POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of ODD and of its inverse, modulo 2^64."""
    if len(POWERS["up"]) < n:
        for name, base in (("up", ODD), ("down", pow(ODD, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return POWERS["up"][:n], POWERS["down"][:n]


def token_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] for each pair: a difference of running polynomial sums, block by block."""
    out = np.zeros(len(starts), np.uint64)
    cuts = np.searchsorted(starts, np.arange(0, len(data) + BLOCK, BLOCK))
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            low, high = int(starts[a]), int(ends[b - 1])
            up, down = powers(max(high - low, BLOCK))
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(BYTE_CODE[data[low:high]] * up[: high - low], out=sums[1:])
            out[a:b] = (sums[ends[a:b] - low] - sums[starts[a:b] - low]) * down[starts[a:b] - low]
    return mix(out)


class Texts:
    """A slice of texts: the byte buffer (A-Z lower-cased if asked), text bounds and words."""

    def __init__(self, column: pa.Array, blank: np.ndarray = BLANK, lower: bool = True):
        column = column.cast(pa.large_string()).fill_null("")
        self.n = len(column)
        bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + self.n + 1] if self.n else np.zeros(1, np.int64)
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if raw is not None and raw.size else np.zeros(0, np.uint8)
        self.bounds = bounds - bounds[0]
        self.data = LOWER[data] if lower else data
        inside = ~blank[self.data]
        first = np.zeros(len(data) + 1, bool)
        first[self.bounds] = True
        before = np.ones(len(data), bool)
        before[1:] = ~inside[:-1]
        after = np.ones(len(data), bool)
        after[:-1] = ~inside[1:]
        self.starts = np.flatnonzero(inside & (before | first[:-1]))
        self.ends = np.flatnonzero(inside & (after | first[1:])) + 1
        #: Words of text i are [word_bounds[i], word_bounds[i + 1]).
        self.word_bounds = np.searchsorted(self.starts, self.bounds)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.word_bounds)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.counts)

    def hashes(self) -> np.ndarray:
        return token_hashes(self.data, self.starts, self.ends)


def slices(batches, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut so that each piece has at most SLICE_BYTES of text, or one text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.array(pa.compute.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
        at, ends = 0, np.cumsum(sizes)
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + SLICE_BYTES, side="right")))
            to = min(to, at + SLICE_TEXTS, batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i + 1]], 0 where the range is empty."""
    total = np.zeros(len(bounds) - 1, np.result_type(values.dtype, np.int64) if values.dtype.kind in "bui" else np.float64)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if len(full):
        total[full] = np.add.reduceat(values.astype(total.dtype, copy=False), bounds[full])
    return total


def pack(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    made = [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(made, schema=schema)
