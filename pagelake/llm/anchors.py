"""Content-defined anchors: where equal strings of a fixed length can be looked for, wherever they lie.

Of the ``gram``-byte strings inside a window of ``length`` bytes, the one with the smallest hash is the
window's anchor (the leftmost of equals). Windows with equal bytes have equal anchors at equal offsets, so
equal windows can only be found among windows of one anchor hash. Neighbouring windows mostly share their
anchor: the maximal stretch of windows with one anchor is a run.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(20240607).integers(1, 1 << 63, size=256, dtype=np.uint64)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    up, down = np.full(n, BASE), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Hasher:
    """Hashes of any substrings of ``data`` from prefix sums of a polynomial."""

    def __init__(self, data: np.ndarray):
        size = 1 << max(16, int(len(data) + 1).bit_length())
        self.up, self.down = _powers(size)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_byte_values()[data] * self.up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


class Runs:
    """Runs of all texts in ``data`` (one after the other, text i ending at ``ends[i]``): text, first window start in
    data, windows, place and hash of the anchor.

    The windows of a run have two sides: those in which ``half`` bytes or more stand before the anchor, and those
    in which the bytes after it are the more. Equal windows are on the same side, so two runs can only share
    windows of a side if the bytes around the anchor that all of its windows hold agree: ``sides`` has their hashes.
    """

    def __init__(self, data: np.ndarray, ends: np.ndarray, length: int, gram: int):
        self.length, self.gram, self.half = length, gram, (length - gram) // 2 + 1
        self.text = self.first = self.windows = self.place = np.zeros(0, dtype=np.int64)
        self.hash = np.zeros(0, dtype=np.uint64)
        self.hasher = None
        starts = np.concatenate([[0], ends[:-1]])
        if len(data) >= gram and np.any(ends - starts >= length):
            self.hasher = Hasher(data)
            self._find(data, ends)

    def content_hash(self, first: np.ndarray, windows: np.ndarray) -> np.ndarray:
        if self.hasher is None:
            return np.zeros(0, dtype=np.uint64)
        return self.hasher.of(first, first + windows + self.length - 1)

    def sides(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Whether a run has windows of the first side and its hash (0 without), and the same for the second side."""
        left = self.first <= self.place - self.half
        right = self.first + self.windows > self.place - self.half + 1
        hashes = [np.zeros(len(self.first), dtype=np.uint64) for _ in range(2)]
        if self.hasher is not None:
            at = self.place[left]
            hashes[0][left] = self.hasher.of(at - self.half, at + self.gram)
            at = self.place[right]
            hashes[1][right] = self.hasher.of(at, at + self.length - self.half + 1)
        return left, hashes[0], right, hashes[1]

    def _find(self, data: np.ndarray, ends: np.ndarray) -> None:
        length, gram, hasher = self.length, self.gram, self.hasher
        n = len(data) - gram + 1
        at = np.arange(n)
        h = mix((hasher.sums[gram:] - hasher.sums[:n]) * hasher.down[:n])
        # sliding minimum over the grams of a window: the hash's low bits hold the gram's offset in the window, so the
        # leftmost of equals is the smallest
        width = length - gram + 1
        bits = np.uint64(max(1, (width - 1).bit_length()))
        low, k = h >> bits << bits, 1
        while k < width:
            step = min(k, width - k)
            n, k = n - step, k + step
            low = np.minimum(low[:n], low[step:] + np.uint64(step))
        place = (low & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
        text = np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends])))[:n]
        ok = at[:n] + length <= ends[text]  # windows that lie in one text
        where = at[:n] + place
        new = np.ones(n, dtype=bool)
        new[1:] = (where[1:] != where[:-1]) | ~ok[:-1]
        first = np.flatnonzero(new & ok)
        if not len(first):
            return
        stop = np.flatnonzero(new | ~ok)
        after = np.searchsorted(stop, first, side="right")
        last = np.append(stop, n)[after]
        self.text, self.first, self.windows = text[first], first, last - first
        self.place, self.hash = where[first], h[where[first]]


def runs(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, first window start in data, windows, anchor hash, content hash) of each of the ``Runs``.

    The content of a run are the bytes of its windows, ``windows`` + ``length`` - 1 of them. Texts shorter than
    ``length`` have none.
    """
    r = Runs(data, ends, length, gram)
    return r.text, r.first, r.windows, r.hash, r.content_hash(r.first, r.windows)
