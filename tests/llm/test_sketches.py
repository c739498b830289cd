import base64
import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from pagelake.llm import sketches

#: characters without spaces that the tests use
WORD = re.compile(r"[぀-ヿ一-鿿]|[^\s぀-ヿ一-鿿]+")


def plain_sketch(text, scale):
    words, hashes = WORD.findall((text or "").lower()), set()
    for i in range(max(1, len(words) - 4) if words else 0):
        h = 42
        for w in words[i : i + 5]:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        hashes.add(h >> 33)
    return sorted({h for h in hashes if h < 2**31 // scale} or sorted(hashes)[:1])


def as_text(hashes):
    return base64.b64encode(b"".join(h.to_bytes(4, "big") for h in hashes)).decode()


def like(a, b):
    return len(set(a) & set(b)) / min(len(a), len(b)) if a and b else float(len(a) == len(b))


def plain(rows, scale):
    rows = sorted(rows)
    out = []
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        cut = len(t) // 4
        edited = t[: len(t) - cut] + after[:cut]
        own, new, then = (plain_sketch(x, scale) for x in (t, edited, after))
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), as_text(own), as_text(new), like(own, new), like(own, then)))
    return out


@pytest.mark.parametrize("scale", [1, 4])
def test_equals_brute_force(docs_of, scale):
    rnd = random.Random(scale)
    words = "red Green blÜe 😀😀 été über x ein zwei 東京都 mañana".split()
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 4, 5, 6, 40, 300]))) for _ in range(60)]
    texts += ["", None, "   ", "one", texts[3], "東京都東京都東京都東京", " ".join(["same line of five words"] * 50)]
    got = sketches.fingerprint_documents(docs_of(texts, parts=5), scale).collect()
    got = sorted((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in got)
    assert got == plain([(i, t or "") for i, t in enumerate(texts)], scale)


def test_sketches_merge(spark):
    rnd = random.Random(2)
    a, b = ([rnd.choice("abcdefghijk") for _ in range(n)] for n in (3000, 12))
    df = spark.createDataFrame([(" ".join(a), " ".join(b))], "a string, b string").select(F.col("a"), F.col("b"))
    left, right = sketches.sketch(F.col("a"), 8), sketches.sketch(F.col("b"), 8)
    r = df.select(left.alias("l"), right.alias("r"), sketches.merged(left, right, 8).alias("m"), sketches.containment(right, left).alias("c")).first()
    both = sorted(set(r.l) | set(r.r))
    assert r.m == ([h for h in both if h < 2**31 // 8] or both[:1])
    assert r.c == len(set(r.l) & set(r.r)) / len(r.r)


def test_containment_of_a_short_in_a_long_document(spark):
    rnd = random.Random(3)
    long = [f"w{rnd.randrange(5000)}" for _ in range(40_000)]
    df = spark.createDataFrame([(" ".join(long), " ".join(long[1000:1400]))], "a string, b string")
    a, b = sketches.sketch(F.col("a"), 4), sketches.sketch(F.col("b"), 4)
    r = df.select(sketches.containment(b, a).alias("in_long"), sketches.containment(a, b).alias("in_short")).first()
    assert r.in_long == 1.0 and r.in_short == pytest.approx(0.01, abs=0.004)


def test_odd_rows(odd, spark):
    got = sketches.fingerprint_documents(odd).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(["None", "1", "2", "3", "4", "4", "5", "6"])
    by = {r.doc_id: r for r in got}
    assert by[1].fingerprint == by[2].fingerprint == by[3].fingerprint == "" and by[1].n_chars == 0
    assert by[2].near_edited == 1.0 and by[1].near_next == 1.0 and by[3].near_next == 0.0
    same = [r for r in got if r.doc_id == 4]
    assert sorted(r.near_next for r in same) == [0.0, 1.0]  # the first one is followed by its copy
    nothing = sketches.fingerprint_documents(odd.limit(0))
    assert nothing.collect() == [] and nothing.columns[0] == "doc_id"
    alone = sketches.fingerprint_documents(odd.where("doc_id = 6")).collect()[0]
    assert alone.near_next == 1.0 and alone.near_edited == 1.0
