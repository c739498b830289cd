"""Words of many texts at once: maximal runs of bytes of one class, by numpy over the column's own buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Every byte, A-Z as a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column one after the other, and where each text begins (with the end); null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()) if pa.types.is_large_string(column.type) else column.cast(pa.binary()).cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if len(at) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    all_bytes = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return all_bytes[at[0] : at[-1]], at - at[0]


def runs(data: np.ndarray, begins: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes for which ``word`` (a table of 256) holds, within texts."""
    inside = word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = begins[(begins > 0) & (begins < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def coded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Each run's number among the distinct ones, and those (lower-cased, binary); all bytes of ``word`` are in runs."""
    ends_at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    kept = LOWER[data[word[data]]]
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends_at), pa.py_buffer(kept)])
    found = found.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary
