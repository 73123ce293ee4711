"""Monotone sequences in Elias-Fano form, and named arrays in one memory-mappable block."""

from __future__ import annotations

import json

import numpy as np


def encode(values: np.ndarray) -> dict[str, np.ndarray]:
    """A non-decreasing sequence of unsigned integers: the lower bits as they are, the upper ones as a bit vector in which the i-th 1 is at upper part + i."""
    values = values.astype(np.uint64)
    n, top = len(values), int(values[-1]) if len(values) else 0
    width = max(0, (top // n).bit_length() - 1) if n else 0
    high = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
    bits = np.zeros(int(high[-1]) + 1 if n else 0, np.uint8)
    bits[high] = 1
    low = [np.zeros(0, np.uint8)]
    for a in range(0, n, 1 << 16):  # a multiple of 8 rows fills whole bytes
        part = values[a : a + (1 << 16), None] >> np.arange(width, dtype=np.uint64) & np.uint64(1)
        low.append(np.packbits(part.astype(np.uint8)))
    return {"shape": np.array([n, width], np.int64), "low": np.concatenate(low), "high": np.packbits(bits)}


def decode(parts: dict[str, np.ndarray]) -> np.ndarray:
    n, width = (int(x) for x in parts["shape"])
    high = np.flatnonzero(np.unpackbits(parts["high"]))[:n] - np.arange(n)
    out = high.astype(np.uint64) << np.uint64(width)
    for a in range(0, n if width else 0, 1 << 16):
        rows = min(n - a, 1 << 16)
        bits = np.unpackbits(parts["low"][a * width // 8 :][: -(-rows * width // 8)])[: rows * width].reshape(rows, width)
        for k in range(width):
            out[a : a + rows] |= bits[:, k].astype(np.uint64) << np.uint64(k)
    return out


#: Set bits of a byte, and the places of its k-th set and k-th clear bit (8 where there is none), from the high end as packed.
ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1, dtype=np.int64)
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(bool)
KTH_ONE = np.array([np.append(np.flatnonzero(row), [8] * 8)[:8] for row in _BITS])
KTH_ZERO = np.array([np.append(np.flatnonzero(~row), [8] * 8)[:8] for row in _BITS])


class Sequence:
    """An encoded sequence, searched as it is stored; beside it a count of the set bits before every byte of the upper parts."""

    def __init__(self, parts: dict[str, np.ndarray]):
        self.n, self.width = (int(x) for x in parts["shape"])
        self.low_bits, self.high_bits = parts["low"], parts["high"]
        self.before = np.zeros(len(self.high_bits) + 1, np.int32)
        np.cumsum(ONES[self.high_bits], out=self.before[1:])

    def _low(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.uint64)
        place = i.astype(np.int64) * self.width
        for k in range(self.width):
            bit = place + k
            out |= ((self.low_bits[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1).astype(np.uint64) << np.uint64(k)
        return out

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at places, which must be there."""
        byte = np.searchsorted(self.before, i, side="right") - 1
        high = (byte << 3) + KTH_ONE[self.high_bits[byte], i - self.before[byte]] - i
        return high.astype(np.uint64) << np.uint64(self.width) | self._low(i)

    def _up_to(self, high: np.ndarray) -> np.ndarray:
        """How many values have at most the given upper part."""
        last = 8 * len(self.high_bits) - int(self.before[-1])
        there = np.flatnonzero((high >= 0) & (high < last))
        zeros = 8 * np.arange(len(self.before)) - self.before
        byte = np.searchsorted(zeros, high[there], side="right") - 1
        out = np.where(high < 0, 0, self.n)
        out[there] = (byte << 3) + KTH_ZERO[self.high_bits[byte], high[there] - zeros[byte]] - high[there]
        return np.minimum(out, self.n)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first place at which each value is, and whether it is there; found among the values of its upper part."""
        if not self.n:
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        high = (wanted >> np.uint64(self.width)).astype(np.int64)
        mask = np.uint64((1 << self.width) - 1)
        return between(self._low, wanted & mask, self._up_to(high - 1), self._up_to(high))


def between(value, wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of each wanted value among the ascending values of the places [low, high): the first place, and whether it is there."""
    at, end = low.copy(), high.copy()
    open_ = np.flatnonzero(at < end)
    while len(open_):
        middle = (at[open_] + end[open_]) >> 1
        less = value(middle) < wanted[open_]
        at[open_] = np.where(less, middle + 1, at[open_])
        end[open_] = np.where(less, end[open_], middle)
        open_ = open_[at[open_] < end[open_]]
    there = at < high
    here = np.flatnonzero(there)
    there[here] = value(at[here]) == wanted[here]
    return np.where(there, at, 0), there


def dump(arrays: dict[str, np.ndarray]) -> bytes:
    """The arrays end to end behind a header; every array begins at a multiple of 8 bytes."""
    head, body, at = {}, [], 0
    for name, a in arrays.items():
        data = np.ascontiguousarray(a).tobytes()
        head[name] = [str(a.dtype), at, len(a)]
        body.append(data + b"\0" * (-len(data) % 8))
        at += len(body[-1])
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    return len(text).to_bytes(8, "little") + text + b"".join(body)


def views(block) -> dict[str, np.ndarray]:
    """The arrays of a block (bytes, an Arrow buffer or a numpy.memmap) without copying it."""
    block = np.frombuffer(block, np.uint8)
    size = int.from_bytes(block[:8].tobytes(), "little")
    start = 8 + size
    return {k: np.frombuffer(block[start + at :], kind, n) for k, (kind, at, n) in json.loads(block[8:start].tobytes()).items()}


def within(arrays: dict[str, np.ndarray], name: str) -> dict[str, np.ndarray]:
    return {k.removeprefix(name + "."): v for k, v in arrays.items() if k.startswith(name + ".")}


def named(parts: dict[str, np.ndarray], name: str) -> dict[str, np.ndarray]:
    return {f"{name}.{k}": v for k, v in parts.items()}
