import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelake.llm import langmodel as lm


def stream(text):
    """Letters in lower case with single spaces, after a text's own start."""
    out, space = [], True
    for c in text.lower() + " ":
        if c.isalpha():
            out.append(c)
            space = False
        elif not space:
            out.append(" ")
            space = True
    return "".join(out)


class Plain:
    """Interpolated Kneser-Ney from its definition, with dictionaries."""

    def __init__(self, texts, order, alphabet):
        self.order, self.unseen = order, 1 / alphabet
        top = Counter()
        for t in texts:
            s = " " * (order - 1) + stream(t)
            top.update(s[i : i + order] for i in range(len(s) - order + 1))
        self.c = {order: top}
        for k in range(order - 1, 0, -1):
            self.c[k] = Counter(g[1:] for g in self.c[k + 1])
        self.d = {}
        self.total, self.types = defaultdict(int), defaultdict(int)
        for k, c in self.c.items():
            n1, n2 = (sum(v == n for v in c.values()) for n in (1, 2))
            self.d[k] = n1 / (n1 + 2 * n2) if n1 else 0.5
            for g, v in c.items():
                self.total[k, g[:-1]] += v
                self.types[k, g[:-1]] += 1

    def p(self, gram):
        k = len(gram)
        if not k:
            return self.unseen
        lower = self.p(gram[1:])
        total = self.total.get((k, gram[:-1]))
        if not total:
            return lower
        return max(self.c[k].get(gram, 0) - self.d[k], 0) / total + self.d[k] * self.types[k, gram[:-1]] / total * lower

    def entropy(self, text):
        s = " " * (self.order - 1) + stream(text)
        grams = [s[i : i + self.order] for i in range(len(s) - self.order + 1)]
        return -sum(math.log2(self.p(g)) for g in grams) / len(grams)


TEXTS = ["The cat, the HAT!", "a cat is a cat is a cat", "thé Été 日本 \U00010330x", "that hat that cat", "  ", "ab"]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_entropies_are_kneser_neys(order):
    parts = [lm.grams(*lm.streams([t.encode()]), order) for t in TEXTS]
    keys, n = np.unique(np.concatenate(parts), return_counts=True)
    alphabet = len({c for t in TEXTS for c in stream(t)}) + 1
    model = lm.LanguageModels({"x": lm.KneserNey(keys, n, order, alphabet)}, order)
    plain = Plain(TEXTS, order, alphabet)
    tests = [*TEXTS, "that cat is new", "zzz qqq", "été"]
    size, h = model.entropies([t.encode() for t in tests])
    for t, k, x in zip(tests, size, h[:, 0], strict=True):
        assert k == len(stream(t))
        if k:
            assert abs(x - plain.entropy(t)) < 1e-9


def test_probabilities_of_a_context_sum_to_one():
    keys, n = np.unique(lm.grams(*lm.streams([b"abracadabra abba cab"]), 3), return_counts=True)
    model = lm.KneserNey(keys, n, 3, 27)
    letters = [ord(c) for c in "abcdefghijklmnopqrstuvwxyz "]
    for a in "abr ":
        for b in "abz ":
            grams = np.array([ord(a) << 32 | ord(b) << 16 | c for c in letters])
            assert abs(np.exp2(-model.bits(grams)).sum() - 1) < 1e-9


def test_long_texts_go_in_parts():
    t = ("some words here " * 50).encode()
    whole, parts = (list(lm._blocks([b"x", t, None], size)) for size in (1 << 20, 100))
    assert len(parts) > 3
    assert np.concatenate([c for c, _ in whole]).tolist() == np.concatenate([c for c, _ in parts]).tolist()
    assert "é" * 500 == "".join(chr(c) for c, in zip(np.concatenate([c for c, _ in lm._blocks([("é" * 500).encode()], 101)]), strict=True)).replace(" ", "")


def corpus(rnd, lang, n):
    parts = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["ersch", "ung", "eit", "gö"]}[lang]
    return [" ".join("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(5, 60))) for _ in range(n)]


def test_identify_and_reject(spark):
    rnd = random.Random(2)
    rows = [(i, t, lang) for lang in ("aa", "bb") for i, t in enumerate(corpus(rnd, lang, 120), 0 if lang == "aa" else 500)]
    noise = ["".join(rnd.choice("qxzwvjkyp ") for _ in range(120)) for _ in range(10)]
    odd = [(1000, None, "aa"), (1001, "", None), (1002, "12 34 !", "bb"), (None, "kalomi tuka lomi kalo", None), (7, "kalo mitu kalomi", "aa")]
    rows += odd + [(2000 + i, t, None) for i, t in enumerate(noise)]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, score string").repartition(3)
    out = lm.held_out(F.col("doc_id"), 4, 2)
    got = [r.asDict() for r in lm.identify(docs, ~out).collect()]
    assert len(got) == len(rows)
    want = {i: lang for i, t, lang in rows if i is not None and i < 1000}
    assert all(g["lang_pred"] == want[g["doc_id"]] for g in got if g["doc_id"] in want and g["doc_id"] != 7)
    assert not any(g["rejected"] for g in got if g["doc_id"] in want)
    assert all(g["rejected"] for g in got if (g["doc_id"] or 0) >= 2000)
    for g in got:
        if g["doc_id"] in (1000, 1001, 1002):
            assert (g["lang_pred"], g["score"], g["rejected"]) == ("und", 0.0, True)
        assert 0 <= g["score"] <= 1
    kept = lm.identify(docs, ~out, keep=True)
    assert kept.columns[:4] == docs.columns and kept.where("score = 'clash'").count() == len(rows)
    none = lm.identify(docs, F.lit(False)).select("lang_pred").distinct().collect()
    assert [r.lang_pred for r in none] == ["und"]
    assert lm.identify(docs.where("false"), ~out).collect() == []


@pytest.mark.parametrize("order, max_entries", [(4, 60), (4, 12), (3, 40)])
def test_a_model_in_parts_gives_the_same_numbers(spark, order, max_entries):
    rnd = random.Random(3)
    rows = [(i, t, lang) for lang in ("aa", "bb") for i, t in enumerate(corpus(rnd, lang, 30), 0 if lang == "aa" else 500)]
    docs = spark.createDataFrame([*rows, (None, None, None), (7, "zzz qqq 日本", None)], "doc_id long, text string, lang string").repartition(3)
    teach = F.col("lang").isNotNull()
    whole, parts = (sorted(map(str, lm.identify(docs, teach, order, max_entries=n).collect())) for n in (10**9, max_entries))
    assert parts == whole
    fitted = lm.fit(docs.select("lang", "text"), order, max_entries)
    assert fitted.order == order and len(fitted.parts) > 2


def test_ties_go_to_the_first_language_by_name(spark):
    text = "lomika tuso relani"
    docs = spark.createDataFrame([(i, text, lang) for i, lang in enumerate(["bb", "aa"] * 5)], "doc_id long, text string, lang string")
    got = lm.identify(docs.unionByName(spark.createDataFrame([(99, "lomika " * 100_000, None)], docs.schema)), F.col("lang").isNotNull()).collect()
    assert len(got) == 11 and {r.lang_pred for r in got} == {"aa"}


@pytest.mark.parametrize("ranges", [2, 4096])
def test_limits_come_from_every_row(spark, monkeypatch, ranges):
    monkeypatch.setattr(lm, "RANGES", ranges)
    rnd = np.random.default_rng(5)
    rows = [(lang, int(n), float(h)) for lang, k in (("aa", 3000), ("bb", 1), ("cc", 40)) for n, h in zip(rnd.integers(1, 500, k), rnd.normal(3, 1, k), strict=True)]
    rows += [("dd", 9, 2.5)] * 60 + [("dd", 9, 4.0)]
    got = lm.rejection_limits(spark.createDataFrame(rows, "lang string, n long, h double").repartition(3), 0.01, 2.0)
    assert set(got) == {"aa", "bb", "cc", "dd"}
    for lang, (base, spread) in got.items():
        n, h = np.array([r[1:] for r in rows if r[0] == lang]).T
        mean = np.average(h, weights=n)
        assert abs(base - mean - 2) < 1e-8
        assert abs(spread - max(0.0, np.quantile((h - mean) * np.sqrt(n), 0.99))) < 1e-6
    assert lm.rejection_limits(spark.createDataFrame([], "lang string, n long, h double"), 0.01, 2.0) == {}


def test_all_training_rows_set_the_limits(spark):
    """More rows than a sample once held, most of them copies of one text: of all rows the given share lies above the limit."""
    rnd = random.Random(8)
    rows = [(i, t, "aa") for i, t in enumerate(["kalo mitu " * 3] * 8000 + corpus(rnd, "aa", 1000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = lm.identify(docs, F.lit(True), rejected_share=0.05, margin_bits=0.0)
    assert 430 <= got.where("rejected").count() <= 451
