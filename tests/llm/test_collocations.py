import random
import re
from collections import Counter, defaultdict

import pytest

from pagelake.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, top, least):
    f, n, found = defaultdict(Counter), Counter(), []
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = [x for x in re.split(r"[ \t]", piece) if x]
            n[lang or "und"] += len(w)
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    for lang, c in f.items():
        kept = []
        for p, a in c.items():
            if len(p) > 1 and a >= least:
                score, k = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]], p))
        longer = Counter()
        for *_, p in kept:
            for q in (p[:2], p[1:]) if len(p) == 3 else ():
                longer[q] = max(longer[q], c[p])
        kept = sorted(x for x in kept if len(x[5]) == 3 or 100 * longer[x[5]] < 50 * c[x[5]])[:top]
        found += [(lang, i, p.decode(), -a, le, r, n[lang], -s) for i, (s, a, p, le, r, _) in enumerate(kept, 1)]
    return sorted(found)


def rows_of(seed, n):
    rnd = random.Random(seed)
    words = ["the"] * 12 + ["of"] * 6 + [f"w{i}" for i in range(30)] + ["É", "Éa", "New York", "point of view", "a.b", "x;y"]
    out = []
    for _ in range(n):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", "\t", ". ", "\n"]) for _ in range(rnd.choice([0, 2, 30, 120])))
        out.append((text.upper() if rnd.random() < 0.1 else text, rnd.choice(["en", "en", "en", "de", None, "und"])))
    return out


def result(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.mark.parametrize("top, least", [(5, 10), (60, 10), (100_000, 3)])
def test_equals_brute_force(spark, top, least):
    rows = rows_of(top, 150) + [("red herring here. " * 40, "fr"), (None, "en"), ("", "en")]
    got = collocations.mine(spark.createDataFrame(rows, "text string, lang string").repartition(4), top, least)
    assert result(got) == brute(rows, top, least)


def test_frontier_is_expanded_until_enough_survive(spark):
    """The best pairs all go, as longer phrases hold them: the survivors are found further down."""
    rows = [(f"a{i} b{i} c{i} d{i}", "en") for i in range(12) for _ in range(20)]
    rows += [(f"p{i} q{j}", "en") for i in range(8) for j in range(8) for _ in range(10 + i)]
    got = collocations.mine(spark.createDataFrame(rows, "text string, lang string").repartition(3), 40, 10)
    assert result(got) == brute(rows, 40, 10)


def test_small_tables_of_flags_only_send_more(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SLOTS", 1)
    rows = rows_of(77, 80)
    got = collocations.mine(spark.createDataFrame(rows, "text string, lang string").repartition(3), 20, 5)
    assert result(got) == brute(rows, 20, 5)


def test_odd_rows(odd, spark):
    assert collocations.mine(odd).collect() == []
    assert collocations.mine(odd.limit(0)).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = result(collocations.mine(odd, 10, 1))
    assert ("und", "same row") in {(x[0], x[2]) for x in got} and all(x[0] == "und" for x in got)
    long = spark.createDataFrame([("word " * 300_000, "en"), ("y" * 2_000_000, "en")], "text string, lang string")
    assert [(x[2], x[3]) for x in result(collocations.mine(long))] == [("word word word", 299_998)]
