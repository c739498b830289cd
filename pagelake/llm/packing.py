"""Packing by minimum bin slack.

Documents become token ids; full windows are cut off, and what remains of each document (1 to capacity-1
ids) goes to a pool, a multiset of lengths. A window starts with the largest remaining length; a bitset
subset-sum over the multiset then finds the sum closest to the free space, and the counts of the lengths
that make it are read off by backtracking. Where even the best sum leaves slack, one more remainder is cut
to fill it. So every window is full except the last one of a partition.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict, deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, id_text, id_type, keep_cache, slices, tokenizer_path
from .wordruns import LOWER, flat, runs

#: Remainders pooled at once (bounds a task's memory: at most capacity ids each).
POOL = 6000
#: Words and parts a worker remembers before it starts afresh (a bound on memory, not on results).
REMEMBERED = 700_000
#: Bytes of a part: all but ASCII white space.
PART = np.ones(256, dtype=bool)
PART[list(b" \t\n\r\x0b\x0c")] = False
#: Kinds of bytes: white space (0), letters (those of two bytes too), digits, other ASCII, and what makes a part whole.
LETTER, DIGIT, OTHER, ODD = 1, 2, 3, 4
KIND = np.full(256, ODD, dtype=np.uint8)
KIND[ord("!") : ord("~") + 1] = OTHER
KIND[ord("'")] = ODD
KIND[ord("0") : ord("9") + 1] = DIGIT
for _a, _b in ((ord("A"), ord("Z")), (ord("a"), ord("z")), (0xC3, 0xC9), (0x80, 0xBF)):
    KIND[_a : _b + 1] = LETTER
KIND[~PART] = 0
# Lower-case letters and the vocabulary's split pattern, for texts of plain characters
LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"  # without U+0130, whose lower case is two characters
PLAIN = re.compile(rf"[!-~{LETTERS}]*\Z")
WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\s{LETTERS}0-9]+", re.ASCII)


def best_fill(lengths: dict[int, int], free: int) -> dict[int, int]:
    """Counts of lengths (none over its count) whose sum is as close below or at ``free`` as the multiset allows.

    Bitset dynamic programming: bit s of ``reach`` says that sum s can be made. Counts are taken in powers
    of two, so each length adds log(count) steps; the steps kept are those needed to read the counts back.
    """
    reach, goal, mask = 1, 1 << free, (2 << free) - 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted((n for n in lengths if n <= free), reverse=True):
        left, take = min(lengths[length], free // length), 1
        while left > 0:
            take = min(take, left)
            more = (reach | reach << length * take) & mask
            if more != reach:
                steps.append((reach, length, take))
                reach = more
            left, take = left - take, take * 2
        if reach & goal:
            break
    total, used = reach.bit_length() - 1, Counter()
    for before, length, take in reversed(steps):
        if not before >> total & 1:
            used[length] += take
            total -= length * take
    return dict(used)


class Packer:
    """Windows of a partition, from a pool of remainders ``(ids as bytes, doc, start, tokens of the doc)``."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.pool: dict[int, deque] = defaultdict(deque)
        self.size, self.out = 0, []

    def add(self, ids: bytes, doc, n: int) -> None:
        step = 4 * self.capacity
        full = len(ids) - len(ids) % step
        for a in range(0, full, step):
            self._window([(ids[a : a + step], doc, a // 4, n)])
        if full < len(ids):
            self._pool((ids[full:], doc, full // 4, n))

    def _pool(self, piece) -> None:
        self.pool[len(piece[0]) // 4].append(piece)
        self.size += 1

    def _take(self, length: int):
        piece = self.pool[length].popleft()
        self.size -= 1
        if not self.pool[length]:
            del self.pool[length]
        return piece

    def _window(self, pieces: list) -> None:
        at = 0
        for ids, doc, start, n in pieces:
            length = len(ids) // 4
            self.out.append((doc, start, length, zlib.crc32(ids), n, self.next_id, at))
            at += length
        self.next_id += 1

    def pack(self, keep: int = 0) -> None:
        """Fill windows until ``keep`` remainders or fewer are left."""
        while self.size > keep:
            pieces = [self._take(max(self.pool))]
            free = self.capacity - len(pieces[0][0]) // 4
            for length, k in best_fill({n: len(q) for n, q in self.pool.items()}, free).items():
                pieces += [self._take(length) for _ in range(k)]
                free -= length * k
            if free and self.size:  # no sum fits exactly: the largest one left is cut
                ids, doc, start, n = self._take(max(self.pool))
                cut = 4 * min(free, len(ids) // 4)
                pieces.append((ids[:cut], doc, start, n))
                if cut < len(ids):
                    self._pool((ids[cut:], doc, start + cut // 4, n))
            self._window(pieces)

    def rows(self) -> list:
        rows, self.out = self.out, []
        return rows


@lru_cache(maxsize=4)
def _worker(path: str):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    keep_cache("packing", _worker.cache_clear)
    return tok, {}


def _words(words: list[bytes], tok, known: dict) -> None:
    """Ids of words that are one pre-token each: many in one call, told apart by their word numbers."""
    for a in range(0, len(words), 5000):
        some = words[a : a + 5000]
        e = tok.encode(b" ".join(some).decode(), add_special_tokens=False)
        ids, of = np.array(e.ids, dtype="<u4"), np.array(e.word_ids, dtype=np.int64)
        if len(of) and of[-1] + 1 == len(some):
            cuts = (4 * np.searchsorted(of, np.arange(len(some) + 1))).tolist()
            data = ids.tobytes()
            known.update((w, data[i:j]) for w, i, j in zip(some, cuts, cuts[1:], strict=False))
        else:
            for w, one in zip(some, tok.encode_batch([w.decode() for w in some], add_special_tokens=False), strict=True):
                known[w] = np.array(one.ids, dtype="<u4").tobytes()


def _parts(parts: list[bytes], tok, known: dict) -> None:
    """Ids of parts without white space: plain ones are split on to words, others (with other characters, or with
    the mark of a special string) go to the library as they are."""
    plain, other = [], []
    for p in parts:
        t = p.decode()
        if PLAIN.match(t) and "<|" not in t:
            plain.append((p, [w.encode() for w in WORDS.findall(t.lower())]))
        else:
            other.append(p)
    _words(list({w for _, ws in plain for w in ws if w not in known}), tok, known)
    known.update([(p, b"".join(map(known.__getitem__, ws))) for p, ws in plain])
    for a in range(0, len(other), 20_000):
        some = other[a : a + 20_000]
        for p, e in zip(some, tok.encode_batch([p.decode() for p in some], add_special_tokens=False), strict=True):
            known[p] = np.array(e.ids, dtype="<u4").tobytes()


def units(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """What the texts consist of besides ASCII white space: for each unit in order the number of the distinct one; those
    (binary); which of those are whole parts; and how many units lie before the end of each text.

    A unit is a run of letters, a digit or a run of other ASCII characters, in lower case (A-Z), if the part
    between white space has nothing but those and no apostrophe; else it is the whole part.
    """
    data, begins = flat(texts)
    kind = KIND[data]
    before, after = data[:-1], data[1:]
    pair = (before >= 0xC3) & (before <= 0xC9)  # first bytes of letters of two bytes
    kind[1:][(after & 0xC0 == 0x80) & ~pair] = ODD
    none = pair & (((before == 0xC3) & ((after == 0x97) | (after == 0xB7))) | ((before == 0xC4) & (after == 0xB0)) | ((before == 0xC9) & (after > 0x8F)))
    kind[1:][none | ((before == ord("<")) & (after == ord("|")))] = ODD
    starts, ends = runs(data, begins, PART)
    odd = np.concatenate([[0], np.cumsum(kind == ODD)])
    whole = odd[ends] > odd[starts]
    # from here on without white space
    inside = PART[data]
    kind, data, size = kind[inside], data[inside], ends - starts
    in_whole = np.repeat(whole, size)
    first = np.ones(len(data), dtype=bool)
    first[1:] = ~in_whole[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT))
    first[np.cumsum(size) - size] = True
    at = np.flatnonzero(first)
    found = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(data)).astype(np.int64)), pa.py_buffer(np.where(in_whole, data, LOWER[data]))]
    ).dictionary_encode()
    code = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    distinct_whole = np.zeros(len(found.dictionary), dtype=bool)
    distinct_whole[code] = in_whole[at]
    ended = np.concatenate([[0], np.cumsum(inside)])[begins[1:]]
    return code, found.dictionary, distinct_whole, np.searchsorted(at, ended)


def encode(texts: list[bytes | None], path: str, end_id: int) -> list[bytes]:
    """Little-endian 32-bit ids of each text, ``end_id`` last; a null text has only that id."""
    ids, at = encode_column(pa.array(texts, pa.binary()).cast(pa.string()), path, end_id)
    return [ids[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)]


def encode_column(texts: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts one after the other, and where each text's ids begin (with the end). The last id of a
    text is ``end_id``, a null text's only one.

    The vocabulary drops white space and splits at it, so the ids of a text are those of its units. Distinct units
    are looked up once, those not remembered are worked out, and the ids are then gathered for all places.
    """
    tok, known = _worker(path)
    code, distinct, whole, last = units(texts)
    if len(known) > REMEMBERED:
        known.clear()
    found = distinct.to_pylist()
    new = [(u, w) for u, w in zip(found, whole.tolist(), strict=True) if u not in known]
    _words([u for u, w in new if not w], tok, known)
    _parts([u for u, w in new if w], tok, known)
    found = [*map(known.__getitem__, found), end_id.to_bytes(4, "little")]
    ids = np.frombuffer(b"".join(found), dtype="<u4")
    size = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
    at = np.cumsum(size) - size
    # after its last unit each text has one more, the end
    code = np.insert(code, last, len(distinct))
    size, before = size[code], np.concatenate([[0], np.cumsum(size[code])])
    gathered = ids[np.repeat(at[code] - before[:-1], size) + np.arange(before[-1])]
    return gathered, before[np.concatenate([[0], last + np.arange(1, len(last) + 1)])]


def pack_documents(
    docs: DataFrame,
    capacity: int = 2048,
    tokenizer: str = "word_bpe_49k.json",
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is a document of the end id alone. Repeated rows are packed as often as they
    occur; ids are carried as they are. No shuffle: a partition packs its own rows, and only its last
    sequence can be short. The rows of a partition are sorted by id and text first, so a task that is run again
    gives the same pieces, in whatever order its rows arrive. Sequence ids are unique (partition number and a
    running number).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_path(tokenizer)
        packer = Packer(capacity, TaskContext.get().partitionId() << 40)
        def rows():
            got = packer.rows()
            cols = list(zip(*got, strict=True)) if got else [[]] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

        for whole in batches:
            for b in slices(whole, "text", 4 << 20, "packing"):
                ids, at = encode_column(b.column("text"), path, end_id)
                for doc, x, y in zip(b.column("doc_id").to_pylist(), at.tolist(), at[1:].tolist(), strict=False):
                    packer.add(ids[x:y].tobytes(), doc, y - x)
                if packer.size > POOL:
                    packer.pack(keep=POOL // 2)
                yield rows()
        packer.pack()
        yield rows()

    ddl = f"doc_id {id_type(docs, id_col)}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    schema = arrow_schema(ddl)
    rows = id_text(docs, id_col, text_col).sortWithinPartitions("doc_id", F.xxhash64("text"))
    return rows.mapInArrow(run, ddl)
