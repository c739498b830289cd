"""Suffix-array deduplication: bytes of repeated strings, over all documents at once.

Every string of ``length`` bytes that starts earlier somewhere is repeated; its bytes go. A collection's
transform and common prefixes (see ``bwt``) put equal strings next to each other: where the common prefix of
neighbours reaches ``length``, they begin with the same string.

To build such collections in parallel, the strings of the documents are dealt by content: equal strings have
equal anchors (see ``anchors``), so the runs of one anchor hash meet in one collection. Two runs of one anchor can
only share a window if half of the window's other bytes agree on one side of the anchor. A first pass counts the
runs by the hashes of these wider strings; only the windows of sides whose hash several runs have take part in the
second pass, which sends their bytes. What is counted does not depend on the order of the rows, so the passes may
see them in different ones.
Equal runs are reduced to their first occurrence, in each task before they are sent and where they meet: the
later ones are repeated as a whole. So a passage copied into a third of all documents enters a collection once.

A common gram with other bytes around it everywhere gives one hash very many different runs. Where they have more
bytes than a collection, their windows are dealt again by anchors of longer grams, at last by the whole window:
equal windows have equal anchors of every gram length, so they still meet.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.operators.indexing import broadcast_if_small
from pagelake.session import ship_code

from .anchors import Runs, runs
from .bwt import construct, suffix_places
from .common import arrow_schema, byte_rows, integer_ids, side, slices, written

GRAM = 32
#: Bytes hashed at once; a longer text goes in parts that overlap by a window.
PART = 1 << 18
#: Bytes of text of a task within which equal runs are reduced before anything is sent (about 30 runs a KB).
SCOPE = 16 << 20
#: Bytes of a collection; a collection ends at the first anchor hash after that. A hash with more is dealt again.
COLLECTION = 1 << 19
#: Bytes of runs dealt again at once: by whole windows they become some sixty times as many.
AGAIN = 1 << 20
#: Bits of a hash that are counted; whole bytes.
COUNTED_BITS = 48
#: Bits of a hash that say its slot in the broadcast bitmap of repeated hashes, at most (2^28 slots are 32 MB).
BITMAP_BITS = 28
NULL_ID = -(1 << 63)
RUNS = "hash long, doc long, mark long, start long, windows long, content binary"


def _parts(texts: list[bytes | None], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of about PART bytes: (bytes, ends of the parts, row of each part, its start in the row)."""
    held, size = [], 0

    def block():
        data = np.frombuffer(b"".join(h[0] for h in held), dtype=np.uint8)
        lens = np.array([len(h[0]) for h in held], dtype=np.int64)
        return data, np.cumsum(lens), np.array([h[1] for h in held]), np.array([h[2] for h in held], dtype=np.int64)

    for i, t in enumerate(texts):
        for a in range(0, max(1, len(t or b"") - length + 1), PART):
            part = t[a : a + PART + length - 1] if t else b""
            if len(part) >= length:
                held.append((part, i, a))
                size += len(part)
            if size >= PART:
                yield block()
                held, size = [], 0
    if held:
        yield block()


def _scopes(batches: Iterator[pa.RecordBatch], scope: int, column: str = "text") -> Iterator[list[pa.RecordBatch]]:
    """A task's rows in slices, gathered into scopes of about ``scope`` bytes of text."""
    held, size = [], 0
    for whole in batches:
        for b in slices(whole, column, min(4 << 20, scope)):
            held.append(b)
            size += pa.compute.sum(pa.compute.binary_length(b.column(column))).as_py() or 0
            if size >= scope:
                yield held
                held, size = [], 0
    if held:
        yield held


def _kept_bits(hash_: np.ndarray) -> np.ndarray:
    """What is counted of a hash: its leading bits (a chance agreement only sends bytes in vain)."""
    return hash_ >> np.uint64(64 - COUNTED_BITS)


def _packed(sorted_: np.ndarray) -> bytes:
    """Sorted numbers of COUNTED_BITS bits, byte plane by byte plane: the leading planes hardly change and compress."""
    return sorted_.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - COUNTED_BITS // 8 :].T.tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, dtype=np.uint8).reshape(COUNTED_BITS // 8, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, 8 - COUNTED_BITS // 8 :] = planes.T
    return out.view(">u8").ravel().astype(np.uint64)


def _shared_hashes(source: DataFrame, length: int, gram: int, scope_bytes: int) -> DataFrame:
    """(hash): the counted bits of the hashes of sides (see ``anchors.Runs``) that more than one run has. A scope sends each hash
    once, or twice if several of its runs have it, so the result is the same however the rows lie in scopes.

    Hashes travel in sorted blocks, a block for each range of hashes, and are counted by sorting where they meet.
    """
    ranges = 1
    while ranges < min(1 << 16, 2 * int(source.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))):
        ranges *= 2
    shift = np.uint64(COUNTED_BITS - (ranges.bit_length() - 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for scope in _scopes(batches, scope_bytes):
            found = []
            for b in scope:
                for data, ends, _, _ in _parts(byte_rows(b.column("text")), length):
                    left, left_hash, right, right_hash = Runs(data, ends, length, gram).sides()
                    found += [left_hash[left], right_hash[right]]
            if found:
                all_ = np.sort(_kept_bits(np.concatenate(found)))
                third = np.zeros(len(all_), dtype=bool)
                third[2:] = all_[2:] == all_[:-2]
                all_ = all_[~third]
                cuts = np.searchsorted(all_, np.arange(ranges + 1, dtype=np.uint64) << shift)
                some = np.flatnonzero(np.diff(cuts))
                blocks = [_packed(all_[cuts[r] : cuts[r + 1]]) for r in some.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(blocks, pa.binary())], names=["part", "hashes"])

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [_unpacked(x) for b in batches for x in b.column("hashes").to_pylist()]
        if found:
            all_ = np.sort(np.concatenate(found))
            again = np.flatnonzero(all_[1:] == all_[:-1])
            shared = np.unique(all_[again]).view(np.int64)
            for a in range(0, len(shared), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(shared[a : a + (1 << 16)])], names=["hash"])

    return source.mapInArrow(count, "part long, hashes binary").repartition("part").mapInArrow(several, "hash long")


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes at a and at b are equal; not if the size is negative."""
    same = size >= 0
    todo = np.flatnonzero(same & (a != b))
    block = np.cumsum(size[todo]) >> 22  # (so many bytes are compared at once)
    for some in np.split(todo, np.flatnonzero(np.diff(block)) + 1):
        n = size[some]
        before = np.cumsum(n) - n
        step = np.arange(n.sum()) - np.repeat(before, n)
        differ = data[np.repeat(a[some], n) + step] != data[np.repeat(b[some], n) + step]
        same[some] = np.add.reduceat(differ, before) == 0 if len(some) else True
    return same


def _reduced(hash_, content_hash, doc, mark, start, windows, block, at, texts: list[np.ndarray], length: int) -> pa.RecordBatch:
    """Of equal runs the first one with its bytes (``at`` in ``texts[block]``), the later ones without. Runs are taken for
    equal by their hashes, and then compared byte by byte: one that is different after all has its bytes, too."""
    order = np.lexsort((start, doc, content_hash))  # (equal bytes have equal anchors)
    lead = np.ones(len(order), dtype=bool)
    lead[1:] = (np.diff(content_hash[order]) != 0) | (np.diff(hash_[order]) != 0)
    first = order[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))]
    data = np.concatenate(texts)
    place = (np.cumsum([0, *map(len, texts)])[:-1])[block] + at
    lead |= ~_same_bytes(data, place[order], place[first], np.where(windows[order] == windows[first], windows[order] + length - 1, -1))
    first = np.where(lead, order, first)
    again = (doc[order] == doc[first]) & (start[order] == start[first])  # the same place in a row that repeats its id
    wide = again & (lead | (mark[order] != mark[first]))  # with another text it has other strings, too
    some = wide | ~again
    order, bytes_ = order[some], wide[some]
    content = [
        data[a : a + n + length - 1].tobytes() if w else None
        for a, n, w in zip(place[order].tolist(), windows[order].tolist(), bytes_.tolist(), strict=True)
    ]
    out = [pa.array(c) for c in (hash_.view(np.int64)[order], doc[order], mark[order], start[order], windows[order])]
    return pa.RecordBatch.from_arrays([*out, pa.array(content, pa.binary())], names=["hash", "doc", "mark", "start", "windows", "content"])


def _candidate_runs(source: DataFrame, bitmap, bits: int, share: tuple[int, int], length: int, gram: int, scope_bytes: int) -> DataFrame:
    """The first of equal runs in a scope, with its bytes, the later ones without bytes; of every run only the windows of
    sides whose hash is in the bitmap."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.frombuffer(bitmap.value, dtype=np.uint8)

        def shared(has: np.ndarray, hash_: np.ndarray) -> np.ndarray:
            hash_ = _kept_bits(hash_)
            slot = hash_ & np.uint64((1 << bits) - 1)
            ok = has & ((wanted[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0)
            if share[1] > 1:
                ok &= (hash_ >> np.uint64(32) & np.uint64(0xFFFF)) % np.uint64(share[1]) == np.uint64(share[0])
            return ok

        for scope in _scopes(batches, scope_bytes):
            held: list[tuple] = []
            texts: list[np.ndarray] = []
            for b in scope:
                docs = np.asarray(pa.compute.fill_null(b.column("doc"), NULL_ID), dtype=np.int64)
                marks = np.asarray(b.column("mark"), dtype=np.int64)
                for data, ends, row, offset in _parts(byte_rows(b.column("text")), length):
                    r = Runs(data, ends, length, gram)
                    left, left_hash, right, right_hash = r.sides()
                    left, right = shared(left, left_hash), shared(right, right_hash)
                    some = np.flatnonzero(left | right)
                    border = r.place[some] - r.half + 1  # the first window of the second side
                    at = np.where(left[some], r.first[some], np.maximum(r.first[some], border))
                    after = np.where(right[some], r.first[some] + r.windows[some], np.minimum(r.first[some] + r.windows[some], border))
                    of, begins = r.text[some], np.concatenate([[0], ends[:-1]])
                    start = at - begins[of] + offset[of]
                    held.append((r.hash[some], r.content_hash(at, after - at), docs[row[of]], marks[row[of]], start, after - at, np.full(len(at), len(texts)), at))
                    texts.append(data)
            if held:
                yield _reduced(*(np.concatenate(x) for x in zip(*held, strict=True)), texts, length)

    return source.mapInArrow(find, RUNS)


def _dealt_again(found: DataFrame, length: int, gram: int) -> DataFrame:
    """Runs by the anchors of another gram length, of the windows of runs that have their bytes; reduced like those."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for scope in _scopes(batches, AGAIN, "content"):
            held, texts = [], []
            for b in scope:
                doc, mark, start = (np.asarray(b.column(c), dtype=np.int64) for c in ("doc", "mark", "start"))
                for data, ends, row, offset in _parts(byte_rows(b.column("content")), length):
                    part, at, windows, hash_, content_hash = runs(data, ends, length, gram)
                    begins, of = np.concatenate([[0], ends[:-1]]), row[part]
                    at_start = start[of] + at - begins[part] + offset[part]
                    held.append((hash_, content_hash, doc[of], mark[of], at_start, windows, np.full(len(at), len(texts)), at))
                    texts.append(data)
            if held:
                yield _reduced(*(np.concatenate(x) for x in zip(*held, strict=True)), texts, length)

    return found.mapInArrow(find, RUNS)


def repeated_windows(strings: list[bytes], doc: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """For the strings of a collection, each standing at (doc, start): the windows (string, offset) that start
    earlier elsewhere, in order of string and offset. Found in the common prefixes of the collection."""
    lens = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
    with tempfile.TemporaryDirectory(prefix="collection-") as folder:
        _, lcp, order = construct(np.frombuffer(b"".join(strings), dtype=np.uint8), lens, length, folder)
    who, offset, place = suffix_places(order, len(lcp), lens, length)
    class_ = np.cumsum(lcp < length)[place]
    at = start[who] + offset
    order = np.lexsort((at, doc[who], class_))
    lead = np.ones(len(order), dtype=bool)
    lead[1:] = np.diff(class_[order]) != 0
    first = order[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))]
    earlier = (doc[who[first]] != doc[who[order]]) | (at[first] != at[order])
    got = order[earlier]
    got = got[np.lexsort((offset[got], who[got]))]
    return np.stack([who[got], offset[got]], axis=1)


def _collections(runs_: DataFrame, length: int, collection: int) -> DataFrame:
    """Spans (doc, mark, start, windows) of repeated windows, from the runs that have their bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings, doc, mark, start, copies = [], [], [], [], []
        size, group, last_hash, last, place, marks = 0, 0, None, None, None, set()

        def table(rows):
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc", "mark", "start", "windows"])

        def solve():
            nonlocal size
            d, s = np.array(doc, dtype=np.int64), np.array(start, dtype=np.int64)
            hit = repeated_windows(strings, d, s, length) if strings else np.zeros((0, 2), dtype=np.int64)
            out = list(copies)
            if len(hit):
                new = np.ones(len(hit), dtype=bool)
                new[1:] = (np.diff(hit[:, 0]) != 0) | (np.diff(hit[:, 1]) != 1)
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(hit)))
                out += [(doc[i], mark[i], start[i] + offset, k) for (i, offset), k in zip(hit[first].tolist(), n.tolist(), strict=True)]
            for x in (strings, doc, mark, start, copies):
                x.clear()
            size = 0
            return table(out)

        def alone():
            """A string that shares its hash with no other has nothing to be compared with."""
            nonlocal size
            if len(strings) - group == 1:
                size -= len(strings.pop())
                for x in (doc, mark, start):
                    x.pop()

        for b in batches:
            for h, d, m, s, n, content in zip(*(b.column(c).to_pylist() for c in ("hash", "doc", "mark", "start", "windows", "content")), strict=True):
                if h != last_hash:
                    alone()
                    if size >= collection:
                        yield solve()
                    group, last = len(strings), None
                if h != last_hash or content != last:
                    last_hash, last, place, marks = h, content, (d, s), set()
                if (d, s) != place:  # the same run starts earlier: all its strings are repeated
                    copies.append((d, m, s, n))
                    if len(copies) > 100_000:
                        yield table(copies)
                        copies.clear()
                elif m not in marks:  # the first place (marks: rows that repeat its id with another text)
                    marks.add(m)
                    strings.append(content)
                    doc.append(d)
                    mark.append(m)
                    start.append(s)
                    size += len(content)
        alone()
        yield solve()

    return runs_.mapInArrow(work, "doc long, mark long, start long, windows long")


def repeated_spans(
    source: DataFrame, length: int, gram: int = GRAM, collection: int = COLLECTION, bitmap_bits: int = BITMAP_BITS, scope: int = SCOPE
) -> DataFrame:
    """(doc, mark, start, windows): stretches of window starts that are repeated, of a table (doc, mark, text)."""
    hashes = written(_shared_hashes(source, length, gram, scope), "anchors")
    n = hashes.count()
    bits = max(10, min(bitmap_bits, int(32 * max(n, 1)).bit_length()))
    shares = max(1, -(-8 * n // (1 << bitmap_bits)))  # more passes where the bitmap would be too full
    sc, out = source.sparkSession.sparkContext, []
    for i in range(shares):
        some = hashes if shares == 1 else hashes.where(F.expr(f"(shiftrightunsigned(hash, 32) & 65535) % {shares} = {i}"))
        slot = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))
        words = some.groupBy(F.shiftrightunsigned(slot, 6).alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(hash & 63 as int))")).alias("bits")
        )
        table, bitmap = words.toArrow(), np.zeros(max(1, (1 << bits) >> 6), dtype=np.int64)
        bitmap[table.column("word").to_numpy()] = table.column("bits").to_numpy()
        found = written(_candidate_runs(source, sc.broadcast(bitmap.tobytes()), bits, (i, shares), length, gram, scope), "runs")
        counts, at = written(found.where("content is not null").groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") > 1), "anchors"), gram
        for longer in ((gram + length) // 2, length, None):
            # the later ones of equal runs in a scope have no bytes: they are repeated as a whole
            out.append(found.where("content is null").select("doc", "mark", "start", "windows"))
            dealt = found.where("content is not null")
            # a run has at most 2 * length - gram bytes; anchors of whole windows need no others, as equal windows stand once
            large = counts.where(F.col("n") > collection // (2 * length - at)).select("hash")
            again = longer is not None and len(large.head(1)) > 0
            if again:
                large = broadcast_if_small(large, 4_000_000)
                found = written(_dealt_again(dealt.join(large, "hash", "left_semi"), length, longer), "runs")
                dealt = dealt.join(large, "hash", "left_anti")
            out.append(_collections(dealt.repartition("hash").sortWithinPartitions("hash", "content", "doc", "start"), length, collection))
            if not again:
                break
            if longer < length:
                counts, at = written(found.where("content is not null").groupBy("hash").agg(F.count("*").alias("n")), "anchors"), longer
    return reduce(DataFrame.unionByName, out)


def remove_repeats(
    docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, **sizes
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, spans (start, end of each maximal removed run, in bytes), kept (binary),
    and, with ``carry``, a struct ``rest`` of the columns named there and kept_text (the kept bytes as a string, without
    the bytes of characters of which only a part is left; null where the text is).

    A byte goes when a string of ``length`` bytes that covers it also starts earlier: in a smaller id, or
    further up in the same document. Null and empty texts have no bytes. Ids are integers (others are an error);
    null is smaller than any. Rows that repeat an id are judged by their text: the same place of the same id is not earlier
    than itself, so identical rows keep the same bytes. An empty table gives no rows.
    """
    if not 32 <= length < 255:
        raise ValueError("length must be 32 to 254 bytes")
    integer_ids(docs, id_col)
    ship_code(docs.sparkSession)
    pad = "_" * (1 + max([0, *map(len, carry or [])]))  # (a struct needs a field; longer than any name carried)
    rows = docs.select(
        docs[id_col].alias("doc_id"),
        docs[id_col].cast("long").alias("doc"),
        docs[text_col].cast("string").alias("text"),
        F.struct(*[docs[c].alias(c) for c in carry or []], F.lit(None).cast("int").alias(pad)).alias("rest"),
    ).withColumn("mark", F.xxhash64("text"))
    spans = written(repeated_spans(rows.select("doc", "mark", "text"), length, min(GRAM, length // 2), **sizes), "spans")
    # a document's spans meet as stretches of starts; neighbours are joined where they are applied
    by_doc = spans.groupBy("doc", "mark").agg(F.collect_list(F.struct("start", "windows")).alias("found"))
    key = F.coalesce("doc", F.lit(NULL_ID))
    joined = rows.withColumn("doc", key).join(side(by_doc, spans.count()), ["doc", "mark"], "left").select("doc_id", "text", "found", "rest")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", 8 << 20):
                found = b.column("found")
                size, cut, kept, whole_text = [], [], [], b.column("text")
                for t, i in zip(byte_rows(b.column("text")), range(b.num_rows), strict=True):
                    t, out = t or b"", []
                    if found[i].is_valid:
                        flat = found[i].values
                        first, n = flat.field("start").to_numpy(), flat.field("windows").to_numpy()
                        order = np.argsort(first, kind="stable")
                        first, end = first[order], np.maximum.accumulate((first + n + length - 1)[order])
                        new = np.ones(len(first), dtype=bool)
                        new[1:] = first[1:] > end[:-1]
                        lead = np.flatnonzero(new)
                        out = list(zip(first[lead].tolist(), end[np.append(lead[1:], len(first)) - 1].tolist(), strict=True))
                    at = [0, *(x for s in out for x in s), len(t)]
                    size.append(len(t))
                    cut.append([{"start": a, "end": e} for a, e in out])
                    kept.append(b"".join(t[a:e] for a, e in zip(at[::2], at[1::2], strict=True)) if out else t)
                cols = [b.column("doc_id"), pa.array(size, pa.int64()), pa.array(cut, fields.field("spans").type), pa.array(kept, pa.binary())]
                if carry is not None:
                    clean = [k.decode("utf-8", "ignore") if whole_text[i].is_valid else None for i, k in enumerate(kept)]
                    cols += [b.column("rest"), pa.array(clean, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=fields.names)

    kind, rest = rows.schema["doc_id"].dataType.simpleString(), rows.schema["rest"].dataType.simpleString()
    ddl = f"doc_id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    ddl += f", rest {rest}, kept_text string" if carry is not None else ""
    fields = arrow_schema(ddl)
    return joined.mapInArrow(apply, ddl)


def digest(out: DataFrame) -> DataFrame:
    """The digest columns of ``remove_repeats``."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
