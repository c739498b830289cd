import random

import numpy as np
import pytest
import xxhash

from pagelake.llm import common, graph, simhash
from pagelake.llm.common import written


def bits_of(text, shingle):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > n)


def roots(fps, bits):
    """Root of each fingerprint by plain union over all pairs."""
    fps = sorted(set(fps))
    up = {f: f for f in fps}

    def find(f):
        while up[f] != f:
            f = up[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {f: find(f) for f in fps}


def test_fingerprints_and_components(docs_of):
    rnd = random.Random(4)
    base = " ".join(rnd.choice("one two three four five six seven".split()) for _ in range(120))
    texts = [base] * 3 + [base.replace("one", f"One{i}", 1) for i in range(6)] + ["", None, "  ", "one", "ONE", "a b", "é É"]
    texts += [" ".join(rnd.choice("abcdefgh") for _ in range(30)) for _ in range(20)]
    got = {r.doc_id: r for r in simhash.near_duplicates(docs_of(texts)).collect()}
    fps = {i: bits_of(t, 3) for i, t in enumerate(texts)}
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == fps
    root = roots(fps.values(), 3)
    least = {}
    for i, f in fps.items():
        least[root[f]] = min(least.get(root[f], i), i)
    assert {i: r.component_id for i, r in got.items()} == {i: least[root[f]] for i, f in fps.items()}


def near(rnd, centre, most):
    for b in rnd.sample(range(64), rnd.randint(0, most)):
        centre ^= 1 << b
    return centre


@pytest.mark.parametrize("bits, paired", [(3, 1 << 30), (3, 4), (3, 1), (2, 2), (1, 2), (0, 1)])
def test_links_join_what_is_linked(spark, bits, paired):
    rnd = random.Random(bits * 100 + paired)
    fps = set()
    for _ in range(4):
        centre = rnd.getrandbits(64)
        fps |= {near(rnd, centre, 4) for _ in range(150)}
        fps |= {centre ^ rnd.getrandbits(6) for _ in range(60)}  # a bucket of 48 equal bits
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    got = simhash.links(spark.createDataFrame(signed, "fp long").repartition(3), bits, paired).collect()
    up = {f[0]: f[0] for f in signed}

    def find(f):
        while up[f] != f:
            f = up[f]
        return f

    for r in got:
        assert ((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= bits and r.a != r.b
        x, y = find(r.a), find(r.b)
        up[y] = x
    classes = lambda m: sorted(sorted(f for f in m if m[f] == r) for r in set(m.values()))
    want = roots(fps, bits)
    mine = {f[0] % (1 << 64): find(f[0]) % (1 << 64) for f in signed}
    assert classes(mine) == classes(want)


def test_a_full_bucket_gives_a_forest():
    fps = np.arange(1 << 9, dtype=np.uint64)
    out = simhash.spanning_links(fps, np.ones(len(fps), dtype=bool), 1)
    assert len(out) == len(fps) - 1


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(0, 300)] + [(1000, 1001), (1001, 1000), (5000, 5000)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(chain, "a long, b long").repartition(4)).collect()))
    assert {got[i] for i in range(1, 301)} == {0} and got[1001] == 1000 and 5000 not in got
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_odd_rows(odd):
    got = [tuple(r) for r in simhash.near_duplicates(odd).collect()]
    assert len(got) == odd.count()
    empty = {c for i, f, c in got if f == "0" * 16}
    assert empty == {1} and [c for i, f, c in got if i == 4] == [4, 4]
    assert simhash.near_duplicates(odd.where("false")).collect() == []


def _broadcast(df):
    """What stands right under the broadcasts of a plan."""
    lines = df._jdf.queryExecution().sparkPlan().toString().splitlines()
    return [line for line in lines if "BroadcastHashJoin" in line]


def test_what_an_explode_makes_is_never_broadcast(spark):
    """A look-up table has up to 33 rows for each fingerprint, and Spark takes it for as large as the fingerprints."""
    rnd = random.Random(7)
    fps = [(rnd.getrandbits(64) - (1 << 63),) for _ in range(200)]
    fps += [((5 << 32) + i,) for i in range(100)]  # a large bucket
    fps = written(spark.createDataFrame(fps, "fp long"), "fps")
    for df in (simhash.links(fps.limit(200)), simhash.links(fps)):
        inner = [line for line in _broadcast(df) if "Inner" in line]
        assert inner == [] and "SortMergeJoin" in df._jdf.queryExecution().sparkPlan().toString()


def test_joins_are_merged_where_rows_are_many(spark, docs_of, monkeypatch):
    """The counted rows decide what is broadcast, not Spark's estimate; either way the results are the same."""
    words = "one two three four five six seven eight".split()
    rnd = random.Random(9)
    base = [" ".join(rnd.choice(words) for _ in range(60)) for _ in range(12)]
    docs = docs_of(base * 3 + [t.replace("one", "two", 1) for t in base] + [(1, base[1]), (None, base[2]), (None, base[2])])
    few = sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str), sorted(map(tuple, simhash.deduplicate(docs).collect()), key=str)
    monkeypatch.setattr(common, "FEW", 0)
    near, kept = simhash.near_duplicates(docs), simhash.deduplicate(docs)
    assert (sorted(map(tuple, near.collect()), key=str), sorted(map(tuple, kept.collect()), key=str)) == few
    assert _broadcast(near) == _broadcast(kept) == []
