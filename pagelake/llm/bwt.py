"""Column-wise construction of the Burrows-Wheeler transform and the common prefixes of many strings.

All strings are worked on together, from their ends: round j inserts, for every string with more than j
bytes, its suffix of length j+1. Where it goes follows from the transform of the shorter suffixes alone: the
new suffix is a byte c before a suffix already placed, so it comes after all suffixes that start with a
smaller byte and after as many with c as there are c's above that place (LF mapping). Its common prefix with
a neighbour is one more than the smallest common prefix between the two places below them.

Transform and prefixes live in files that each round reads and writes once, in order. A round reads them whole, so
they do not bound the memory of a collection; its size does.
"""

from __future__ import annotations

import os

import numpy as np

#: Stands in the transform where a string has no byte before the suffix; the byte 255 occurs in no UTF-8 text.
END = 255
BLOCK = 16
#: For the columns low to high of a block (row low * BLOCK + high): 255 in all other columns.
_COLUMN = np.arange(BLOCK)
OUTSIDE = np.where((_COLUMN >= np.repeat(_COLUMN, BLOCK)[:, None]) & (_COLUMN <= np.tile(_COLUMN, BLOCK)[:, None]), 0, 255).astype(np.uint8)


class RangeMinimum:
    """Smallest value of ranges of an array of small numbers: a sparse table over blocks, and scans inside them."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.rows = np.full(-(-n // BLOCK) * BLOCK, 255, dtype=np.uint8)
        self.rows[:n] = values
        least = self.rows
        for _ in range(BLOCK.bit_length() - 1):
            least = np.minimum(least[0::2], least[1::2])
        self.rows = self.rows.reshape(-1, BLOCK)
        self.levels = [least]
        while len(self.levels[-1]) > 1 << (len(self.levels) - 1):
            half = 1 << (len(self.levels) - 1)
            last = self.levels[-1]
            if len(last) <= half:
                break
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def _within(self, block: np.ndarray, low: np.ndarray | int, high: np.ndarray) -> np.ndarray:
        """Minimum over the columns low to high of blocks: the others are raised, then columns are compared whole."""
        raised = self.rows[block] | OUTSIDE[low * BLOCK + high]
        return np.ascontiguousarray(raised.T).min(axis=0)

    def between(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum over [first, last] of each pair, both inclusive."""
        a, b = first // BLOCK, last // BLOCK
        out = self._within(a, first % BLOCK, np.where(a == b, last % BLOCK, BLOCK - 1))
        apart = np.flatnonzero(a != b)
        if len(apart):
            out[apart] = np.minimum(out[apart], self._within(b[apart], 0, last[apart] % BLOCK))
            lo, size = a[apart] + 1, b[apart] - a[apart] - 1
            for level in range(len(self.levels)):
                some = np.flatnonzero((size >> level > 0) & (size >> level + 1 == 0))
                if len(some):
                    t, i = self.levels[level], lo[some]
                    j = i + size[some] - (1 << level)
                    out[apart[some]] = np.minimum(out[apart[some]], np.minimum(t[i], t[j]))
        return out


class Columns:
    """The transform and the common prefixes in files; a round reads the old ones and leaves new ones."""

    KINDS = {"bwt": np.uint8, "lcp": np.uint8}

    def __init__(self, folder: str):
        self.folder, self.turn = folder, 0

    def read(self) -> list[np.ndarray]:
        return [np.fromfile(os.path.join(self.folder, f"{name}.{self.turn}"), dtype=kind) for name, kind in self.KINDS.items()]

    def write(self, *columns: np.ndarray) -> None:
        # a new file and the old one removed: overwriting would make file systems flush every round to disk
        self.turn += 1
        for (name, kind), column in zip(self.KINDS.items(), columns, strict=True):
            column.astype(kind, copy=False).tofile(os.path.join(self.folder, f"{name}.{self.turn}"))
            if self.turn > 1:
                os.remove(os.path.join(self.folder, f"{name}.{self.turn - 1}"))


def _entered(order: np.ndarray, begin: np.ndarray, place: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``order`` with the places of new bytes entered, the new beginnings of the bytes, and where each place went.
    Places whose byte is END are left out (-1)."""
    at = np.full(len(place), -1, dtype=np.int64)
    sort = np.argsort(byte.astype(np.int64) << 32 | place)
    cut = np.searchsorted(byte[sort], np.arange(257))
    for c in np.flatnonzero(np.diff(cut[:END + 1])).tolist():
        some = sort[cut[c] : cut[c + 1]]
        at[some] = begin[c] + np.searchsorted(order[begin[c] : begin[c + 1]], place[some])
    sort = sort[: cut[END]]
    at[sort] += np.arange(len(sort))
    new, keep = np.empty(len(order) + len(sort), dtype=np.int32), np.ones(len(order) + len(sort), dtype=bool)
    keep[at[sort]] = False
    new[keep], new[at[sort]] = order, place[sort]
    return new, begin + np.minimum(cut, cut[END]), at


def construct(data: np.ndarray, lens: np.ndarray, cap: int, folder: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transform, common prefixes (``cap`` at most, below 255) and places by byte of all suffixes of the strings,
    the empty ones first.

    ``data`` holds the strings one after the other, below 2^31 bytes in all. Equal suffixes of different
    strings stand in the order of the strings.
    """
    m, ends = len(lens), np.cumsum(lens)
    files = Columns(folder)
    bwt = np.full(m, END, dtype=np.uint8)
    bwt[lens > 0] = data[ends[lens > 0] - 1]
    order, begin, k = _entered(np.zeros(0, dtype=np.int32), np.zeros(257, dtype=np.int64), np.arange(m), bwt)
    # (order lists the places of the transform's bytes, byte by byte: the LF mapping, kept up to date instead of sorted anew)
    files.write(bwt, np.zeros(m, dtype=np.uint8))
    active = np.flatnonzero(lens > 0)
    k = k[active]
    for j in range(int(lens.max(initial=0))):
        bwt, lcp = files.read()
        p = order[k].astype(np.int64)
        c = bwt[p].astype(np.int64)
        minimum = RangeMinimum(lcp)
        above, below = np.zeros(len(p), dtype=np.uint8), np.zeros(len(p), dtype=np.uint8)
        has = np.flatnonzero(k > begin[c])
        above[has] = np.minimum(minimum.between(order[k[has] - 1].astype(np.int64) + 1, p[has]).astype(np.int64) + 1, cap)
        has = np.flatnonzero(k + 1 < begin[c + 1])
        below[has] = np.minimum(minimum.between(p[has] + 1, order[k[has] + 1].astype(np.int64)).astype(np.int64) + 1, cap)
        at = m + k
        old = np.ones(len(bwt) + len(at), dtype=bool)
        old[at] = False
        new_bwt, new_lcp = np.empty(len(old), dtype=np.uint8), np.empty(len(old), dtype=np.uint8)
        new_bwt[old], new_lcp[old] = bwt, lcp
        more = lens[active] > j + 1
        byte = np.full(len(at), END, dtype=np.uint8)
        byte[more] = data[ends[active[more]] - j - 2]
        new_bwt[at] = byte
        inner = at + 1 < len(old)
        new_lcp[at[inner] + 1] = below[inner]
        new_lcp[at] = above
        moved = np.arange(len(old), dtype=np.int32)[old]  # where the old places are now
        order, begin, k = _entered(np.take(moved, order), begin, at, byte)
        files.write(new_bwt, new_lcp)
        active, k = active[more], k[more]
    return (*files.read(), order)


def suffix_places(order: np.ndarray, total: int, lens: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, start, place) of every suffix of at least ``least`` bytes, found by walking
    the transform back from the empty suffixes."""
    m = len(lens)
    step = np.zeros(total, dtype=np.int64)
    step[order] = np.arange(len(order)) + m
    who, place, out = np.arange(m), np.arange(m), []
    for j in range(int(lens.max(initial=0)) + 1):
        if j >= least:
            out.append((who, lens[who] - j, place))
        on = lens[who] > j
        who, place = who[on], step[place[on]]
    if not out:
        return (np.zeros(0, dtype=np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))
