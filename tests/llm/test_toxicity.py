import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelake.llm import langmodel, toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_matches_are_those_of_the_edit_distance():
    rnd = random.Random(1)
    words = {"".join(rnd.choice("abc") for _ in range(rnd.randint(2, 11))): rnd.random() + 1 for _ in range(40)}
    stems = {"cccc": 9.0}
    lexicon = toxicity.Lexicon(words, stems)
    allowed = lambda w: 0 if len(w) < 5 else 1 if len(w) < 9 else 2
    for _ in range(3000):
        w = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 12)))
        near = [(distance(w, t), -x) for t, x in words.items() if distance(w, t) <= allowed(t)]
        want = (-min(near)[1], min(near)[0]) if near else None
        if w.startswith("cccc") and (want is None or want[1]):
            want = (9.0, 0)
        assert lexicon.match(w) == want, w


def test_states_are_bounded(monkeypatch):
    monkeypatch.setattr(toxicity, "STATES", 20)
    lexicon = toxicity.Lexicon({"abcdefgh": 2.0}, {})
    assert [lexicon.match(w) for w in ("abcdefgh", "abxdefgh", "zzzz", "abcdefg")] == [(2.0, 0), (2.0, 1), None, (2.0, 1)]


def test_quotation_weighs_less_than_abuse():
    lexicon = toxicity.Lexicon({"stupid": 5.0}, {})
    abuse = toxicity.features("you are so stupid today", lexicon)
    plain = toxicity.features("a rather stupid day", lexicon)
    quoted = toxicity.features('they wrote "so stupid indeed" here', lexicon)
    mention = toxicity.features("the word stupid has six letters", lexicon)
    typo = toxicity.features("a rather stupidd day", lexicon)
    assert abuse[0] > plain[0] > typo[0] > 0 and quoted[0] == mention[0] == 0 and quoted[2] > 0 and mention[2] > 0


@pytest.fixture
def tables(spark):
    rnd = random.Random(3)
    vocab = ["".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randint(3, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(600):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(5, 80))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rnd.randint(1, 4)):
                words[rnd.randrange(len(words))] = rnd.choice(["scumbag", "moronic", "idiotic", "zorg" + rnd.choice(vocab)])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    hot = "a copied text full of unusual wording like xylophonic and quizzical"
    rows += [(1000 + i, hot) for i in range(200)]  # copies labelled toxic must not make their words terms
    labels += [(1000 + i, 1, 1) for i in range(6)] + [(1, 1, None), (None, 1, 1), (5000, 0, 1)]
    rows += [(2000, None), (2001, ""), (2002, "you are an idiotiic person"), (2003, "a quiet evening"), (None, "moronic")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string").repartition(3)
    return docs, spark.createDataFrame([(*r, "y") for r in labels], "doc_id long, quality int, toxic int, text string")


def test_held_out_rows(tables):
    docs, labels = tables
    got = toxicity.score_toxicity(docs, labels, lambda i: ~langmodel.held_out(i, 3, 1))
    got = got.withColumn("held_out", langmodel.held_out(F.col("doc_id"), 3, 1)).collect()
    assert len(got) == docs.count()
    by = {r.doc_id: r for r in got}
    held = [by[i] for i in range(600) if by[i].held_out]
    assert np.mean([r.predicted == (r.doc_id % 6 == 0) for r in held]) > 0.97
    assert by[2002].predicted == 1 and by[2003].predicted == 0 and by[None].predicted == 1
    assert by[2000].score == by[2001].score < 0.3
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)


def test_without_labels(tables):
    docs, labels = tables
    none = toxicity.score_toxicity(docs, labels.where("false"), lambda i: F.lit(True))
    assert {(r.score, r.predicted) for r in none.collect()} == {(0.0, 0)}
    assert toxicity.score_toxicity(docs.where("false"), labels, lambda i: F.lit(True)).collect() == []


def test_the_model_does_not_depend_on_the_order_of_rows(spark, tables):
    docs, labels = tables
    teaches = lambda i: ~langmodel.held_out(i, 3, 1)
    twice = docs.unionByName(docs.where("doc_id % 50 = 0").withColumn("text", F.lit("another text of the same id")))
    a = toxicity.score_toxicity(twice.repartition(5, "text"), labels.repartition(2), teaches).collect()
    b = toxicity.score_toxicity(twice.orderBy(F.desc("text")), labels.orderBy("doc_id"), teaches).collect()
    key = lambda r: (str(r.doc_id), r.score)
    assert sorted(map(key, a)) == sorted(map(key, b))


def test_a_very_long_text(spark, tables):
    docs, labels = tables
    long = spark.createDataFrame([(10_001, "calm words here " * 200_000 + "you moronic scumbag"), (10_002, "x" * 2_000_000)], "doc_id long, text string")
    got = toxicity.score_toxicity(docs.select("doc_id", "text").unionByName(long), labels, lambda i: ~langmodel.held_out(i, 3, 1))
    rows = {r.doc_id: r for r in got.where("doc_id > 10000").collect()}
    assert rows[10_001].score > rows[10_002].score and all(0 <= r.score <= 1 for r in rows.values())
