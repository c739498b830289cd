import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pagelake.llm import ranking

TERM = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
ITEMS = "item_id long, text string"


def terms(text):
    return ["".join(c.lower() if c.isascii() else c for c in t) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n = sum(1 for _, b in bags if b)
    total = sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for i, b in bags:
            if b:
                m = 100 - 75 + 75 * b.total() * n // total
                s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in terms(text))
                if s > 0:
                    found.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def rows(df):
    return sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def texts(seed, n):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["the"] * 30 + ["É", "é", "Straße", "東京"]
    return [" ".join(rnd.choice(words) for _ in range(rnd.choice([1, 3, 20, 200]))) for _ in range(n)]


@pytest.mark.parametrize("buckets, block_bytes", [(1024, 1 << 20), (3, 1 << 20), (64, 300)])
def test_equals_brute_force(docs_of, spark, buckets, block_bytes):
    docs = texts(buckets, 700)
    docs += ["", None, "...", docs[0], docs[0].upper(), "The THE the w1-w2_w3 tabs\tand\nlines"]
    items = [(i, t) for i, t in enumerate(texts(5, 15))] + [(50, "the the THE w1"), (51, ""), (52, None), (53, "unseen")]
    got = ranking.rank_documents(docs_of(docs, 4), spark.createDataFrame(items, ITEMS), buckets=buckets, block_bytes=block_bytes)
    assert rows(got) == brute(list(enumerate(docs)), items)


def test_few_documents_are_scored():
    """The threshold ends the rescoring: most documents are passed by their bound alone."""
    docs = texts(9, 6000)
    q = ranking.Queries([(0, b"w1 w2 w3 w4"), (1, b"w50 w51")])
    bags = [set(terms(t)) for t in docs]
    df = np.array([sum(t.decode() in b for b in bags) for t in q.terms.to_pylist()])
    s = ranking.Searcher(q, ranking.weights(df, len(docs)), len(docs), sum(len(terms(t)) for t in docs), 10, 1024)
    for a in range(0, len(docs), 1000):
        s.search(pa.array(docs[a : a + 1000]), list(range(a, a + 1000)))
    assert s.scored < 0.1 * 2 * len(docs)


def test_ties_repeated_and_null_ids(spark):
    docs = [(i, "same words here") for i in (7, 3, None, 5, 3)] + [(9, "other")]
    items = [(1, "words"), (1, "words"), (None, "other")]
    got = ranking.rank_documents(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS), k=5)
    found = [(r.item_id, r["rank"], r.doc_id) for r in got.collect()]
    expected = [(1, r, i) for r, i in enumerate((3, 3, 5, 7, None), 1)] * 2 + [(None, 1, 9)]
    assert sorted(map(str, found)) == sorted(map(str, expected))


def test_odd_rows(odd, spark):
    items = spark.createDataFrame([(1, "same ROW at", "x")], ITEMS + ", score string")
    got = ranking.rank_documents(odd, items)
    assert [r.doc_id for r in got.orderBy("rank").collect()] == [4, 4, None]
    assert ranking.rank_documents(odd.limit(0), items).collect() == []
    assert ranking.rank_documents(odd, items.limit(0)).collect() == []
