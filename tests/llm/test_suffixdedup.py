import hashlib
import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelake.llm import anchors, bwt, suffixdedup
from pagelake.llm import common as helpers


@pytest.mark.parametrize("seed", range(25))
def test_transform_and_common_prefixes(seed):
    rnd = random.Random(seed)
    strings = [bytes(rnd.choice(b"ab" if seed % 2 else b"abcd\0") for _ in range(rnd.randint(0, 40))) for _ in range(rnd.randint(1, 25))]
    strings += strings[:3]
    suffixes = sorted((s[i:], k, i) for k, s in enumerate(strings) for i in range(len(s) + 1))
    common = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    want = [0] + [min(12, common(a[0], b[0])) for a, b in zip(suffixes, suffixes[1:], strict=False)]
    lens = np.array([len(s) for s in strings])
    with tempfile.TemporaryDirectory() as folder:
        got, lcp, order = bwt.construct(np.frombuffer(b"".join(strings), dtype=np.uint8), lens, 12, folder)
    assert got.tolist() == [strings[k][i - 1] if i else bwt.END for _, k, i in suffixes]
    assert lcp.tolist() == want
    for k, i, place in zip(*(x.tolist() for x in bwt.suffix_places(order, len(lcp), lens, 5)), strict=True):
        assert suffixes[place][1:] == (k, i)


def test_equal_windows_have_equal_anchors():
    rnd = random.Random(1)
    common = bytes(rnd.choice(b"abcdef") for _ in range(300))
    texts = [bytes(rnd.choice(b"abcdef") for _ in range(rnd.randint(0, 90))) + common[rnd.randint(0, 90) :] for _ in range(8)] + [b"a" * 500]
    data, ends = np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([len(t) for t in texts])
    of, seen = {}, set()
    for t, at, n, h, _ in zip(*anchors.runs(data, ends, 100, 32), strict=True):
        begin = 0 if t == 0 else ends[t - 1]
        for w in range(at, at + n):
            window = data[w : w + 100].tobytes()
            assert of.setdefault(window, h) == h and w + 100 <= ends[t] and w >= begin
            seen.add(w)
    assert len(seen) == sum(max(0, len(t) - 99) for t in texts)


def brute(rows, length):
    """rows (id, bytes): the digest by comparing all windows."""
    first = {}
    for i, t in rows:
        for p in range(len(t) - length + 1):
            w = t[p : p + length]
            first[w] = min(first.get(w, (i, p)), (i, p))
    out = []
    for i, t in rows:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] != (i, p):
                gone[p : p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for p in range(len(t)) if gone[p] and not (p and gone[p - 1]))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def texts_of(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("aàbcdé") for _ in range(rnd.randint(2, 6)))
    say = lambda n: " ".join(word() for _ in range(n))
    passage, line, base = say(40), "a very common line of about sixty bytes, in every text: end\n", say(120)
    texts = [say(rnd.randint(0, 60)) for _ in range(30)]
    texts += [say(5) + passage[rnd.randint(0, 20) :] + say(5) for _ in range(20)]
    texts += [line + say(4) + line + say(9) for _ in range(30)] + [base] * 25
    texts += [base[: 200 + i] + "X" + base[200 + i :] for i in range(15)]
    texts += ["ab" * 400, "a" * 1000, "a" * 99, "a" * 100, "", None, passage * 3]
    return texts


@pytest.mark.parametrize(
    "seed, sizes", [(1, {}), (2, {"collection": 500}), (3, {"bitmap_bits": 12, "scope": 3000}), (4, {"bitmap_bits": 6, "scope": 1})]
)
def test_removal_against_brute_force(spark, docs_of, seed, sizes):
    texts = texts_of(seed)
    got = suffixdedup.digest(suffixdedup.remove_repeats(docs_of(texts, parts=4), length=100, **sizes)).collect()
    assert sorted(map(tuple, got)) == brute([(i, (t or "").encode()) for i, t in enumerate(texts)], 100)


def test_parts_of_long_texts_cover_every_window(monkeypatch):
    monkeypatch.setattr(suffixdedup, "PART", 150)
    texts = [b"x" * 99, b"y" * 100, bytes(range(200)) * 4, None, b""]
    seen = set()
    for data, ends, row, start in suffixdedup._parts(texts, 100):
        for e, b, r, s in zip(ends, [0, *ends[:-1]], row, start, strict=True):
            assert data[b:e].tobytes() == texts[r][s : s + e - b]
            seen |= {(r, s + w) for w in range(e - b - 99)}
    assert seen == {(i, p) for i, t in enumerate(texts) if t for p in range(len(t) - 99)}


def test_odd_rows(odd):
    got = suffixdedup.remove_repeats(odd, carry=["spans", "fp"])
    rows = {(r.doc_id, r.n_bytes): r for r in got.collect()}
    assert got.count() == odd.count()
    assert rows[1, 0].kept_text is None and rows[2, 0].kept_text == "" and rows[5, 6].kept_text == "ééé"
    assert rows[4, 8].rest.spans == "clash" and rows[4, 8].spans == []
    assert bytes(rows[6, 70_000].kept) == b"x"  # the string at the second byte also starts at the first
    assert suffixdedup.remove_repeats(odd.where("false")).collect() == []


def test_rows_that_repeat_an_id(spark):
    rnd = random.Random(9)
    t = "".join(rnd.choice("abcdefgh") for _ in range(250))
    df = spark.createDataFrame([(1, t), (1, t), (2, t), (None, t)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, len(r.kept)) for r in suffixdedup.remove_repeats(df).collect())
    assert got == [(0, 250), (1, 0), (1, 0), (2, 0)]
    got = sorted((r.doc_id, len(r.kept)) for r in suffixdedup.remove_repeats(df.where("doc_id is not null")).collect())
    assert got == [(1, 250), (1, 250), (2, 0)]


def test_passes_may_see_rows_in_different_orders(spark, monkeypatch):
    rnd = random.Random(4)
    say = lambda: "".join(rnd.choice("abcdefgh") for _ in range(300))
    twice = say()
    rows = [(0, 0, twice), (1, 0, say()), (2, 0, twice), (3, 0, say())]
    source = spark.createDataFrame(rows, "doc long, mark long, text string").coalesce(1)
    real = suffixdedup._candidate_runs
    # the copies share a scope of two rows in the first pass, and lie in different ones in the second
    monkeypatch.setattr(suffixdedup, "_candidate_runs", lambda s, *rest: real(s.sortWithinPartitions("doc"), *rest))
    first = source.sortWithinPartitions(F.col("doc") % 2, "doc")
    got = suffixdedup.repeated_spans(first, 100, scope=301).collect()
    assert {r.doc for r in got} == {2} and sum(r.windows for r in got) == 201


def test_a_common_gram_among_other_bytes_is_dealt_again(spark, docs_of, monkeypatch):
    rnd = random.Random(5)
    say = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    short, long_ = say(40), say(90)
    texts = [say(80) + short + say(80) for _ in range(60)] + [say(80) + long_ + say(80) for _ in range(60)]
    texts += [texts[3][20:180] + say(9), say(7) + texts[70][40:190], texts[80][:170]]
    dealt, real = [], suffixdedup._collections
    monkeypatch.setattr(suffixdedup, "_collections", lambda runs_, *rest: dealt.append(runs_) or real(runs_, *rest))
    got = suffixdedup.digest(suffixdedup.remove_repeats(docs_of(texts, parts=4), length=100, collection=2000)).collect()
    assert sorted(map(tuple, got)) == brute([(i, t.encode()) for i, t in enumerate(texts)], 100)
    for runs_ in dealt:
        sizes = runs_.select("hash", "content").distinct().groupBy("hash").agg(F.sum(F.octet_length("content")).alias("n"))
        assert all(r.n <= 2000 for r in sizes.collect())


def test_spans_meet_their_rows_by_a_merge_where_they_are_many(docs_of, monkeypatch):
    """A row's spans are a list, which Spark does not measure: their counted number decides whether they are broadcast."""
    rnd = random.Random(5)
    part = "".join(rnd.choice("abcdefgh ") for _ in range(150))
    docs = docs_of([f"{i} {part} {i}{part[:120]}" for i in range(9)] + [None, ""])
    few = {r.doc_id: r for r in suffixdedup.remove_repeats(docs, 100).collect()}
    monkeypatch.setattr(helpers, "FEW", 0, raising=False)
    out = suffixdedup.remove_repeats(docs, 100)
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().sparkPlan().toString()
    assert {r.doc_id: r for r in out.collect()} == few and any(r.spans for r in few.values())
