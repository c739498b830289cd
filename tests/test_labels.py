"""Label map, multi-hot, codec, split, metrics, prediction, uncertainty."""

import math

import pytest
from pyspark.sql import functions as F

from pagelake.operators import active as A
from pagelake.operators import labels as L
from pagelake.operators.metrics import flattened_f1


@pytest.fixture
def rows(spark):
    data = [
        ("1", "a", "spam, ham"),
        ("2", "b", "ham"),
        ("3", "c", ""),
        ("4", "d", None),
        ("5", "e", " eggs ,,"),
        ("6", "f", "Ham"),
    ]
    return spark.createDataFrame(data, "id string, text string, labels string")


def test_label_map_sorted_trimmed_distinct(rows):
    got = [(r.label, r.idx) for r in L.label_map(rows).orderBy("idx").collect()]
    # code-point order: upper case before lower case
    assert got == [("Ham", 0), ("eggs", 1), ("ham", 2), ("spam", 3)]


def test_multihot_unknown_ignored_unlabelled_zero(rows, spark):
    names = ["ham", "spam"]
    got = {r.id: r.v for r in rows.select("id", L.multihot(rows, names).alias("v")).collect()}
    assert got == {"1": [1, 1], "2": [1, 0], "3": [0, 0], "4": [0, 0], "5": [0, 0], "6": [0, 0]}


def test_bin_codec_roundtrip(spark):
    df = spark.createDataFrame([([0, 1, 0],), ([1],)], "v array<int>")
    enc = df.select(L.encode_bin("v").alias("s"))
    assert [r.s for r in enc.collect()] == ["0,1,0", "1"]
    assert [r.v for r in enc.select(L.decode_bin("s").alias("v")).collect()] == [[0, 1, 0], [1]]
    bad = spark.createDataFrame([("",)], "s string")
    with pytest.raises(Exception):
        bad.select(L.decode_bin("s")).collect()


@pytest.mark.parametrize("n", [1, 9, 10, 11, 257])
def test_split_counts(spark, n):
    df = spark.range(n).select(F.col("id").cast("string").alias("id"))
    s = L.train_val_split(df, "id", 0.1, 42)
    assert s.where("split = 'val'").count() == math.ceil(n * 0.1)
    assert s.count() == n
    # membership: the rows with the smallest hashes
    order = sorted(((r.h, r.id) for r in df.select("id", L.split_hash("id", 42).alias("h")).collect()))
    want = {i for _, i in order[: math.ceil(n * 0.1)]}
    assert {r.id for r in s.where("split = 'val'").collect()} == want


def test_flattened_f1(spark):
    df = spark.createDataFrame(
        [(1, 0, 0.9, 0.1), (0, 0, 0.5, 0.2), (1, 1, 0.2, 0.7)], "y1 int, y2 int, p1 double, p2 double"
    )
    r = flattened_f1(df, ["y1", "y2"], ["p1", "p2"]).first()
    # cells: (1,1) (0,0) (0,1) (0,0) (1,0) (1,1) -> tp 2, fp 1, fn 1, tn 2
    assert (r.tp, r.fp, r.fn, r.tn) == (2, 1, 1, 2)
    assert r.f1_micro == pytest.approx(4 / 6)
    assert r.f1_macro == pytest.approx((2 * 2 / (4 + 2) + 2 * 2 / (4 + 2)) / 2)
    one = spark.createDataFrame([(0, 0.1)], "y int, p double")
    r1 = flattened_f1(one, ["y"], ["p"]).first()
    assert (r1.f1_micro, r1.f1_macro) == (1.0, 1.0)


def test_predict_threshold_inclusive_and_unknown_index(spark):
    df = spark.createDataFrame([([0.0, 2.0, -3.0],)], "lg array<double>")
    p = df.select(A.probs_from_logits("lg").alias("p"))
    r = p.select(A.predict_from_probs("p", ["a", "b"], 0.5).alias("x")).first().x
    assert r.labels == ["a", "b"]  # sigmoid(0) = 0.5 is selected
    assert set(r.scores) == {"a", "b", "2"}
    r0 = p.select(A.predict_from_probs("p", ["a", "b"], 0.0).alias("x")).first().x
    assert r0.labels == ["a", "b", "2"]


def test_entropy_and_sampling(spark):
    df = spark.createDataFrame(
        [(1, [0.5, 0.5]), (2, [0.0, 1.0]), (3, []), (4, [0.5, 0.5]), (5, [0.9, 0.2])], "id long, p array<double>"
    )
    e = {r.id: r.u for r in df.select("id", A.mean_binary_entropy("p").alias("u")).collect()}
    assert e[1] == pytest.approx(math.log(2), rel=1e-9)
    assert e[2] == pytest.approx(0.0, abs=1e-9)
    assert e[3] is None
    top = A.sample_uncertain(df, "id", "p", top_k=2).collect()
    assert [r.id for r in top] == [1, 4]


def test_white_space_of_every_kind_is_stripped(spark):
    df = spark.createDataFrame([("a,\tb\n",), (" c , a",)], "labels string")
    assert [r["label"] for r in L.label_map(df).orderBy("idx").collect()] == ["a", "b", "c"]
    assert spark.range(1).select(L.decode_bin(F.lit("1,\t0 ")).alias("v")).first()["v"] == [1, 0]


def test_csv_columns_are_found_by_the_header(spark, tmp_path):
    from pagelake.sources import csvio

    (tmp_path / "x.csv").write_text('text,extra,id\nhello,z,7\n"a, b",,8\n')
    got = [tuple(r) for r in csvio.read_csv(spark, str(tmp_path / "x.csv"), ["id", "text", "labels"]).collect()]
    assert got == [("7", "hello", ""), ("8", "a, b", "")]


def test_a_label_map_as_one_object(spark, tmp_path):
    from pagelake.sources import csvio

    (tmp_path / "m.json").write_text('{\n  "b": 1,\n  "a": 0\n}')
    assert {r["label"]: r["idx"] for r in csvio.read_label_map_object(spark, str(tmp_path / "m.json")).collect()} == {"a": 0, "b": 1}
