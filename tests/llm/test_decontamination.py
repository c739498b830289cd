import hashlib
import random
import re

import numpy as np
import pytest

from pagelake.llm import decontam

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
ITEMS = "item_id long, text string, window string"


def brute(docs, items, window):
    wins = {}
    for i, t in items:
        w = WORD.findall((t or "").encode().lower())
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[s : s + n]), set()).add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w = WORD.findall((t or "").encode().lower())
        hit, found = set(), set()
        for n in {len(x) for x in wins}:
            for s in range(len(w) - n + 1):
                if got := wins.get(tuple(w[s : s + n])):
                    hit |= set(range(s, s + n))
                    found |= got
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), sha, bool(hit)))
    return out


def tables(spark, seed):
    rnd = random.Random(seed)
    vocab = ["Alpha", "b", "c2", "é", "ñu", "x", "y"]
    sentence = lambda n: rnd.choice([" ", ", ", "\n"]).join(rnd.choice(vocab) for _ in range(n))
    items = [(i, sentence(rnd.randint(0, 14))) for i in range(12)] + [(12, None), (None, sentence(6)), (3, sentence(5)), (13, "b b b b b b b b")]
    docs = [(i, sentence(rnd.randint(0, 60))) for i in range(60)]
    docs += [(100 + k, sentence(5) + " " + (items[k][1] or "") + " " + sentence(5)) for k in range(12)]
    docs += [(200, None), (201, ""), (202, "b " * 300), (203, "no such words")]
    return docs, items


@pytest.mark.parametrize("seed, block_bytes", [(1, 1 << 20), (2, 1 << 20), (3, 60)])
def test_against_brute_force(spark, seed, block_bytes):
    docs, items = tables(spark, seed)
    d = spark.createDataFrame([(*r, "z") for r in docs], "doc_id long, text string, spans string").repartition(3)
    b = spark.createDataFrame([(*r, "z") for r in items], ITEMS)
    got = decontam.digest(decontam.find_contamination(d, b, window=4, block_bytes=block_bytes))
    assert sorted(map(tuple, got.collect())) == sorted(brute(docs, items, 4))


def test_a_long_document_in_parts_gives_the_same():
    docs, items = tables(None, 5)
    test = decontam.TestSet([(i, t.encode()) for i, t in items if t], 4)
    whole = " ".join(t for _, t in docs if t).encode()
    one = list(decontam._document_matches([whole], test))
    parts = list(decontam._document_matches([whole], test, shard_words=50))
    assert one[0][:2] == parts[0][:2]
    assert {i[0] for i in one[0][2]} == {i[0] for i in parts[0][2]}


def test_longest_match_and_its_place():
    test = decontam.TestSet([("q", b"a b c d e f"), ("r", b"c d e")], 3)
    (spans, found), = decontam.shard_matches([b"x b c d e y c d e z".split()], test)
    assert spans == [(1, 4), (6, 3)]
    assert sorted(found) == [("q", 4, 1, 1), ("r", 3, 2, 0)]


def test_suffix_array_orders_by_words():
    words = np.array([2, 1, 2, 1, 0, 2, 1, 3, 0])
    sa = decontam.suffix_array(words, np.flatnonzero(words > 0), 4)
    rows = [words[s : s + 4].tolist() for s in sa]
    assert rows == sorted(rows)


def test_decontaminate_keeps_clean_and_null_rows(spark, odd):
    items = spark.createDataFrame([(1, "no id at all here", "w"), (2, "same row", "w")], ITEMS)
    kept = decontam.decontaminate(odd, items, window=3)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 2, 3, 5, 6]
    assert kept.where("doc_id is null").count() == 1
    assert decontam.find_contamination(odd, items.where("false")).where("size(spans) > 0").count() == 0
    assert decontam.find_contamination(odd.where("false"), items).count() == 0


def all_matches(doc, items, window):
    """Every maximal match by comparing all pairs of places."""
    out = []
    for name, t in items:
        n, m = min(window, len(t)), len(t)
        for a in range(len(doc)):
            for b in range(m):
                if doc[a] == t[b] and not (a and b and doc[a - 1] == t[b - 1]):
                    k = 0
                    while a + k < len(doc) and b + k < m and doc[a + k] == t[b + k]:
                        k += 1
                    if k >= n:
                        out.append((name, k, a, b))
    return sorted(out)


@pytest.mark.parametrize("seed, shard_words", [(1, 1 << 18), (2, 25), (3, 9)])
def test_every_maximal_match(seed, shard_words, monkeypatch):
    monkeypatch.setattr(decontam, "PAIRS", 50)
    rnd = random.Random(seed)
    say = lambda n: [rnd.choice([b"a", b"b", b"c"]) for _ in range(n)]
    items = [(f"i{k}", say(rnd.choice([2, 6, 15]))) for k in range(5)] + [("same", [b"a"] * 7)]
    test = decontam.TestSet([(k, b" ".join(t)) for k, t in items], 4)
    docs = [say(60) + items[0][1] + say(10), [b"a"] * 40, say(3), [b"x"] * 9, items[2][1] * 3]
    got = list(decontam._document_matches([b" ".join(d) for d in docs], test, shard_words))
    assert [sorted(m) for _, _, m in got] == [all_matches(d, items, 4) for d in docs]
