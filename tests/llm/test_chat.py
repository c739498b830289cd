import json
import random

from pagelake.llm import chat

CALLS = "conv_id long, call_id string, turn long, name string, arguments string, stage string"
RESULTS = "conv_id long, call_id string, turn long, content string, name string"
SCHEMAS = "name string, param string, type string, required boolean, turn int"


def test_linking_order_validation_and_json(spark):
    calls = [
        (1, "a", 1, "get", '{"n": 1.50, "z": "x\\ny", "ref": "$c"}'),
        (1, "b", 3, "get", '{"n": 2, "z": "$a", "more": [1, {"y": 1, "x": null}]}'),
        (1, "c", 5, "get", '{"n": "two"}'),
        (1, "c", 6, "get", '{"n": 3}'),
        (1, "d", 7, "nothing", "not json"),
        (1, "e", 9, "get", None),
        (1, "p", 11, "get", '{"n": 1, "ref": "$q"}'),
        (1, "q", 12, "get", '{"n": 1, "ref": "$p"}'),
        (1, "r", 13, "get", '{"n": 1, "ref": "$p $q", "z": "$gone"}'),
        (2, "a", 1, "get", '{"n": 9}'),
        (2, None, 2, "get", '{"n": 9}'),
        (None, "a", 2, "get", '{"n": 9}'),
    ]
    results = [(1, "a", 2, "ok \"A\""), (1, "b", 2, "before"), (1, "c", 7, "late"), (1, "c", 8, "later"), (1, "x", 4, "alone"), (2, "a", 3, None), (3, None, 1, "n")]
    schemas = [("get", "n", "number", True), ("get", "z", "string", False), ("get", "ref", "string", False)]
    got = chat.link_calls(
        spark.createDataFrame([(*c, "clash") for c in calls], CALLS).repartition(3),
        spark.createDataFrame([(*r, "clash") for r in results], RESULTS),
        spark.createDataFrame([(*s, 1) for s in schemas], SCHEMAS),
    ).collect()
    by = {(r.conv_id, r.call_id): r for r in got}
    assert len(got) == len(by) == 13
    line = lambda *k: (by[k].status, by[k].stage, by[k].errors)
    assert line(1, "a") == ("linked", 1, "")
    assert line(1, "b") == ("early", 2, "unknown:more")
    assert line(1, "c") == ("linked", 0, "type:n")
    assert line(1, "d") == ("no_result", 0, "arguments,tool")
    assert line(1, "e") == ("no_result", 0, "arguments")
    assert line(1, "p") == line(1, "q") == ("no_result", None, "")
    assert line(1, "r") == ("no_result", 0, "need:gone,need:p $q")
    assert line(1, "x") == ("no_call", None, "") and by[1, "x"].turn == 4
    assert line(2, None)[0] == line(3, None)[0] == "no_id"
    assert line(None, "a")[0] == "no_result"
    for r in got:
        m = json.loads(r.message)
        assert r.message == json.dumps(m, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert (m["id"], m["status"], ",".join(m["errors"])) == (r.call_id, r.status, r.errors)
    assert json.loads(by[1, "a"].message)["arguments"] == {"n": 1.5, "z": "x\ny", "ref": "$c"}
    assert json.loads(by[1, "c"].message)["duplicates"] == 2 and json.loads(by[1, "c"].message)["result"] == "late"
    assert json.loads(by[1, "d"].message)["arguments"] == {"arguments": "not json"}


def test_long_chain_and_empty_tables(spark):
    calls = [(1, f"k{i}", 100 - i, "get", json.dumps({"ref": f"$k{i - 1}"} if i else {})) for i in range(9)]
    c = spark.createDataFrame([(*x, "") for x in calls], CALLS)
    r, s = spark.createDataFrame([], RESULTS), spark.createDataFrame([], SCHEMAS)
    assert {x.call_id: x.stage for x in chat.link_calls(c, r, s).collect()} == {f"k{i}": i for i in range(9)}
    assert chat.link_calls(c.where("false"), r, s).collect() == []


def test_a_chain_of_a_thousand(spark):
    calls = spark.range(1000).selectExpr("1L as conv_id", "concat('k', id) as call_id")
    needs = spark.range(1, 1000).selectExpr("1L as conv_id", "concat('k', id) as call_id", "concat('k', id - 1) as need")
    got = {r.call_id: r.stage for r in chat.stages(calls, needs).collect()}
    assert got == {f"k{i}": i for i in range(1000)}


def test_stages_of_any_graph(spark):
    rnd = random.Random(7)
    edges = {(f"n{a}", f"n{b}") for a in range(60) for b in rnd.sample(range(a), min(a, rnd.choice([0, 1, 1, 1, 2, 3])))}
    edges |= {("x", "y"), ("y", "z"), ("z", "x"), ("behind", "x"), ("behind", "n5"), ("self", "self"), ("far", "behind")}
    nodes = {f"n{a}" for a in range(60)} | {"x", "y", "z", "behind", "self", "far"}
    stage = {}
    for a in range(60):
        stage[f"n{a}"] = max((stage[d] + 1 for c, d in edges if c == f"n{a}"), default=0)
    calls = spark.createDataFrame([(1, n) for n in nodes], "conv_id long, call_id string")
    needs = spark.createDataFrame([(1, *e) for e in edges], "conv_id long, call_id string, need string")
    assert {r.call_id: r.stage for r in chat.stages(calls, needs).collect()} == stage
