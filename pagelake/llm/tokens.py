"""Token counts: rank-synchronous merging of byte pairs on ragged numpy arrays.

Pre-tokens are split as the byte-level vocabulary's pattern splits them, distinct ones are held together
as one ragged array, and in every round each sequence applies all occurrences of its own lowest-ranked
adjacent pair. A sequence without a mergeable pair is finished and leaves the array; what is left of it is
its token count.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text, id_type, keep_cache, slices, tokenizer_path

NONE = np.iinfo(np.int64).max
#: Distinct pre-tokens remembered by a worker before it starts afresh (a bound on memory, not on results).
REMEMBERED = 400_000

# The letters of the blocks Latin-1 to Latin Extended-B, without the two signs among them
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Texts of these characters only have the same letters, digits and spaces in every regular-expression library.
PLAIN = re.compile(rf"[\t\n\r -~{LETTERS}]*\Z")
# Fixed value: the split pattern of the vocabulary, for plain texts
SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+", re.ASCII)


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: visible Latin-1 characters stand for themselves, the others follow from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(256))
    return [chr(b) if b in shown else chr(256 + next(hidden)) for b in range(256)]


class MergeTable:
    """Merge ranks of a byte-level vocabulary as sorted pair keys."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.specials = [t["content"] for t in spec["added_tokens"]]
        symbols = byte_symbols()
        self.byte_of = {c: b for b, c in enumerate(symbols)}
        self.byte_id = np.array([vocab[c] for c in symbols], dtype=np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)[order]

    def counts(self, pieces: list[bytes], max_symbols: int = 1 << 20) -> np.ndarray:
        """Tokens of each piece. Empty pieces have none. Works on blocks of about ``max_symbols`` bytes."""
        lens = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        out, block = np.zeros(len(pieces), dtype=np.int64), np.cumsum(lens) // max_symbols
        cuts = np.flatnonzero(np.diff(block)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(pieces)], strict=True):
            if b > a:
                out[a:b] = self._merge(b"".join(pieces[a:b]), lens[a:b])
        return out

    def _merge(self, data: bytes, lens: np.ndarray) -> np.ndarray:
        out = np.zeros(len(lens), dtype=np.int64)
        sym = self.byte_id[np.frombuffer(data, dtype=np.uint8)]
        who = np.flatnonzero(lens > 0)
        lens = lens[who]
        while len(who):
            start = np.cumsum(lens) - lens
            seq = np.repeat(np.arange(len(who)), lens)
            rank = np.full(len(sym), NONE)
            at = np.flatnonzero(seq[1:] == seq[:-1])
            key = sym[at] << 32 | sym[at + 1]
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[found] == key
            where = np.zeros(len(sym), dtype=np.int64)
            rank[at[hit]], where[at[hit]] = self.rank[found[hit]], found[hit]
            low = np.minimum.reduceat(rank, start)
            live = low != NONE
            out[who[~live]] = lens[~live]
            merge = (rank == low[seq]) & live[seq]
            # in a run of equal symbols pairs overlap: every second one counts, from the left
            idx = np.flatnonzero(merge)
            if len(idx):
                first = np.ones(len(idx), dtype=bool)
                first[1:] = np.diff(idx) != 1
                run = np.maximum.accumulate(np.where(first, idx, 0))
                idx = idx[(idx - run) % 2 == 0]
            sym[idx] = self.made[where[idx]]
            keep = live[seq]
            keep[idx + 1] = False
            lens = np.bincount(seq[keep], minlength=len(who))[live]
            sym, who = sym[keep], who[live]
        return out


class Splitter:
    """Texts to pre-tokens (bytes), exactly as the library splits them."""

    def __init__(self, path: str, table: MergeTable):
        self.path, self.byte_of, self._library = path, table.byte_of, None
        self.special = re.compile("|".join(map(re.escape, table.specials))) if table.specials else None

    def __call__(self, text: str) -> tuple[list, int]:
        """Pre-tokens (str for plain parts, bytes otherwise) and the number of special strings."""
        parts, n = [text], 0
        if self.special is not None and (found := self.special.findall(text)):
            parts, n = self.special.split(text), len(found)
        out: list = []
        for p in parts:
            if PLAIN.match(p):
                out += SPLIT.findall(p)
            elif p:
                out += [bytes(map(self.byte_of.__getitem__, s)) for s, _ in self.library.pre_tokenizer.pre_tokenize_str(p)]
        return out, n

    @property
    def library(self):
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        return self._library


@lru_cache(maxsize=4)
def _worker(path: str) -> tuple[MergeTable, Splitter, dict]:
    table = MergeTable(path)
    keep_cache("tokens", _worker.cache_clear)
    return table, Splitter(path, table), {}


def token_counts(texts: list[str | None], path: str) -> list[int]:
    """Tokens of each text (null: none)."""
    table, split, known = _worker(path)
    pieces = [split(t) if t else ([], 0) for t in texts]
    if len(known) > REMEMBERED:
        known.clear()
    new = list({p for ps, _ in pieces for p in ps if p not in known})
    known.update(zip(new, table.counts([p.encode() if isinstance(p, str) else p for p in new]).tolist(), strict=True))
    return [n + sum(map(known.__getitem__, ps)) for ps, n in pieces]


def count_tokens(
    docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    A null or empty text has no bytes and no tokens. Ids are carried as they are (null and repeated ones
    too); other columns take no part. No shuffle: every row is counted where it is read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_path(tokenizer)
        for whole in batches:
            for b in slices(whole, "text", 4 << 20, "tokens"):
                texts = b.column("text").to_pylist()
                n = token_counts(texts, path)
                size = [len(t.encode()) if t else 0 for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return id_text(docs, id_col, text_col).mapInArrow(
        run, f"doc_id {id_type(docs, id_col)}, n_bytes long, n_tokens long, over_limit boolean"
    )
