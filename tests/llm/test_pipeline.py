import random

import corpus_pipeline
import pytest
from pagelake.llm import simhash, suffixdedup

from .conftest import DOCS


def test_stages_do_their_work(spark, tmp_path):
    rnd = random.Random(8)
    vocab = ["".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randint(3, 8))) for _ in range(400)]
    say = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    texts = [say(rnd.randint(40, 90)) for _ in range(60)]
    items = [say(30) for _ in range(3)]
    passage = say(70)
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100, texts[0]), (101, texts[1].upper()), (102, None), (103, "123 456"), (105, "".join(rnd.choice("qxzwvjkyp ") for _ in range(300)))]
    rows += [(110, say(30) + " " + items[1] + " " + say(30))]
    rows += [(120, say(50) + " " + passage + " " + say(50)), (121, say(50) + " " + passage + " é " + say(50))]
    docs = spark.createDataFrame([(i, t, "xx" if i % 3 else None, "s", len(t or "")) for i, t in rows], DOCS).repartition(2)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    seen, now = {}, spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        if name != "packing":
            assert now.columns == docs.columns
            seen[name] = {r.doc_id: r for r in now.collect()}
    ids = {i for i, _ in rows}
    assert set(seen["language_id"]) == ids - {102, 103, 105}
    assert {r.lang for r in seen["language_id"].values()} == {"xx"}
    assert set(seen["near_dedup"]) == set(seen["language_id"]) - {100, 101}
    cut = seen["suffix_dedup"][121].text
    assert set(seen["suffix_dedup"]) == set(seen["near_dedup"]) and passage not in cut and len(cut) < len(dict(rows)[121]) - len(passage) + 3
    assert seen["suffix_dedup"][120].text == dict(rows)[120]
    assert set(seen["decontamination"]) == set(seen["suffix_dedup"]) - {110}
    assert {r.doc_id for r in now.collect()} == set(seen["decontamination"])
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.doc_tokens) for r in whole} == {(r.doc_id, r.doc_tokens) for r in now.collect()}


def test_one_row_of_each_group_stays(spark):
    rnd = random.Random(3)
    say = lambda n: " ".join(rnd.choice("red green blue black white grey".split()) + str(rnd.randrange(40)) for _ in range(n))
    a, b = say(150), say(150)
    rows = [(5, a, "x"), (5, a, "x"), (9, a, "x"), (None, a, "x"), (None, b, "x"), (None, b, "x"), (3, None, "n"), (4, "", "n"), (None, None, "n")]
    rows += [(7, say(150), "x"), (7, say(150), "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(3)
    got = sorted((str(r.doc_id), str(r.text)) for r in simhash.deduplicate(docs).collect())
    assert got == sorted([("5", a), ("None", b), ("3", "None"), ("7", rows[-1][1]), ("7", rows[-2][1])])
    assert simhash.deduplicate(docs).columns == docs.columns


ODD = DOCS + ", key string, _ int, __row long, spans string, row string"


def test_stages_on_odd_tables(spark, tmp_path):
    words = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(None, words), (None, words), (1, None), (2, ""), (3, " \n"), (4, words + " thirteen"), (4, words + " thirteen"), (5, "é" * 300), (6, "long " * 30_000)]
    docs = spark.createDataFrame([(i, t, "xx", None, None, "k", 1, 2, "s", "r") for i, t in rows], ODD).repartition(2)
    spark.createDataFrame([(1, "no such words"), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for table in (docs, docs.where("false")):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, table, str(tmp_path))
            n = out.count()
            if name != "packing":
                assert out.columns == docs.columns
            if table is not docs:
                assert n == 0
            elif name in ("suffix_dedup", "decontamination"):
                assert n == len(rows)
            elif name == "near_dedup":
                assert n == 5  # the words, the empty ones, thirteen, é and the long one


def test_ids_that_are_no_integers(spark):
    docs = spark.createDataFrame([("a", "text")], "doc_id string, text string")
    with pytest.raises(ValueError, match="integer"):
        suffixdedup.remove_repeats(docs)


def test_language_limits_know_every_row(spark):
    """An odd text in 50 of 9,050 rows is more than the thousandth that may lie above the limit: none of its copies goes."""
    rows = ["ab" * (10 + i % 50) + " " + "ab" * (10 + i // 50 % 50) for i in range(9000)] + ["aba" * 30] * 50
    docs = spark.createDataFrame([(i, t, "aa", "s", len(t)) for i, t in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.language_id(spark, docs.repartition(4), "").count() == 9050
