"""A K2-treap: a compressed quadtree over a sparse grid whose cells store the maximum of the values below them.

The grid is 2^depth rows and columns. Level by level, a cell that holds something has four bits, one for each quarter
(two bits of place: row half, column half); the set bits, in order, are the cells of the next level, so a cell's quarter
is found by counting the bits before it. Every cell but those of the last level has the maximum below it; a cell of the
last level is a point, with its value. Maxima are stored as what they fall short of the cell above, which is 0 at least
once below every cell.
"""

from __future__ import annotations

import numpy as np

from .elias_fano import dump, views


def spread(x: np.ndarray) -> np.ndarray:
    """The bits of 32-bit numbers at the even places of 64-bit ones."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << np.uint64(shift)) & np.uint64(mask)
    return x


def build(row: np.ndarray, column: np.ndarray, value: np.ndarray, depth: int) -> dict[str, np.ndarray]:
    """The arrays of the treap over distinct points (row, column) with values of 0 or more."""
    place = spread(row) << np.uint64(1) | spread(column)
    order = np.argsort(place)
    cells, best = place[order], value[order].astype(np.int64)
    bits, short = [], []
    for _ in range(depth):
        above = cells >> np.uint64(2)
        first = np.flatnonzero(np.concatenate([[True], above[1:] != above[:-1]])) if len(cells) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(first, len(cells)))
        most = np.maximum.reduceat(best, first) if len(first) else best
        quarters = np.zeros(4 * len(first), np.uint8)
        quarters[4 * np.repeat(np.arange(len(first)), sizes) + (cells & np.uint64(3)).astype(np.int64)] = 1
        bits.append(quarters)
        short.append(np.repeat(most, sizes) - best)
        cells, best = above[first], most
    parts = {"root": best[:1]}
    for level in range(depth):
        parts[f"bits{level}"] = np.packbits(bits[depth - 1 - level], bitorder="little")
        gap = short[depth - 1 - level]
        parts[f"short{level}"] = gap.astype(np.min_scalar_type(int(gap.max()) if len(gap) else 0))
    return parts


#: Set bits of a byte; set bits of a cell's four below each quarter.
ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1, dtype=np.int32)
BELOW = np.array([[bin(four & (1 << quarter) - 1).count("1") for quarter in range(4)] for four in range(16)], np.int32)


class Treap:
    """Walks from the root: cells are numbered within their level, -1 is an empty one.

    The bits stay packed; beside them a level has the number of set bits before every byte, that is before every second cell.
    """

    def __init__(self, parts: dict[str, np.ndarray], depth: int):
        self.depth, self.root = depth, int(parts["root"][0]) if len(parts["root"]) else 0
        self.levels = []
        for level in range(depth):
            bits = parts[f"bits{level}"]
            ones = ONES[bits]
            self.levels.append((bits, np.cumsum(ones, dtype=np.int32) - ones, parts[f"short{level}"]))

    def below(self, level: int, cell: np.ndarray, best: np.ndarray, row_half: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """The quarters of cells of a level (0: the root) in a row half, and their maxima, for the left and the right columns.

        Empty cells have empty quarters; the maximum of an empty one is 0.
        """
        bits, before, short = self.levels[level]
        if not len(short):
            return [(np.full(cell.shape, -1, np.int32), np.zeros(cell.shape, np.int64))] * 2
        known = np.maximum(cell, 0)
        byte, odd = bits[known >> 1], known & 1
        four = np.where(cell < 0, 0, byte >> (odd << 2).astype(np.uint8) & 15)
        first = before[known >> 1] + odd * ONES[byte & 15]
        out = []
        for quarter in (2 * row_half, 2 * row_half + 1):
            there = four >> quarter & 1 > 0
            found = np.where(there, first + BELOW[four, quarter], -1).astype(np.int32)
            out.append((found, np.where(there, best - short[found], 0)))
        return out


def pack(row: np.ndarray, column: np.ndarray, value: np.ndarray, depth: int, **more: np.ndarray) -> bytes:
    """A treap and further arrays as one block, which tasks view without copying."""
    return dump({**build(row, column, value, depth), "depth": np.array([depth], np.int64), **more})


def unpack(block) -> tuple[Treap, dict[str, np.ndarray]]:
    parts = views(block)
    return Treap(parts, int(parts["depth"][0])), parts
