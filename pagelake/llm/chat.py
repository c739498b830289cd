"""Chat formatting: tool calls linked to their results, ordered, validated and written as canonical JSON.

DataFrame operations only. Calls and results meet in a hash join on their identifier. A call whose arguments
hold ``"$<id>"`` needs the result of that call: stages follow from removing, round by round, the calls
whose needs are met (topological order). Arguments are exploded and joined with the schemas of the tools.
Canonical JSON has sorted keys, no spaces and normalised numbers (the JSON text of a variant).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.session import scratch_path

from .common import written

KEY = ["conv_id", "call_id"]
#: How the JSON type of a value is written in a schema.
TYPE_NAMES = (
    "case when t = 'STRING' then 'string' when t = 'BIGINT' then 'integer' when t = 'BOOLEAN' then 'boolean' "
    "when t = 'VOID' then 'null' when t like 'ARRAY%' then 'array' when t like 'OBJECT%' then 'object' else 'number' end"
)


def _needs(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, need): the identifiers that a call's arguments refer to."""
    found = F.expr(r"""regexp_extract_all(arguments, '"\\$([^"\\\\]+)"', 1)""")
    return calls.select(*KEY, F.explode(F.array_distinct(found)).alias("need"))


def stages(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """(conv_id, call_id, stage): 0 without needs, else one more than the latest need. Calls on a cycle, or behind
    one, are left out. ``needs`` only names calls that exist.

    Each round settles the calls whose needs are all settled. Where a call waits for one that itself waits for a
    single call, its need is passed on to that one, with the length of the way: so a chain takes as many rounds as
    its length has binary digits. Every round's calls are written to one table, which is read at the end.
    """
    out, i = scratch_path(calls.sparkSession, "stages"), 0
    ready = calls.select(*KEY).join(needs.select(*KEY).distinct(), KEY, "left_anti").withColumn("stage", F.lit(0).cast("long"))
    ready.write.parquet(f"{out}/round=0")
    ready = calls.sparkSession.read.parquet(f"{out}/round=0")
    # way: steps to the need; settled: way + stage of a need that is settled (such needs become one row without a need)
    open_ = written(needs.select(*KEY, "need", F.lit(1).cast("long").alias("way"), F.lit(None).cast("long").alias("settled")), "needs")
    while True:
        met = ready.select("conv_id", F.col("call_id").alias("need"), "stage")
        open_ = open_.join(met, ["conv_id", "need"], "left")
        open_ = written(open_.select(*KEY, "need", "way", F.coalesce("settled", F.col("way") + F.col("stage")).alias("settled")), "needs")
        calls_ = open_.groupBy(*KEY).agg(F.count("*").alias("n"), F.count("settled").alias("k"), F.max("settled").alias("stage"))
        i += 1
        calls_.where("n = k").select(*KEY, "stage").write.parquet(f"{out}/round={i}")
        ready = calls.sparkSession.read.schema(ready.schema).parquet(f"{out}/round={i}")
        if ready.isEmpty():
            break
        open_ = open_.join(ready.select(*KEY), KEY, "left_anti")
        single = open_.groupBy(*KEY).agg(F.count("*").alias("n"), F.first("need").alias("further"), F.first("way").alias("more")).where("n = 1")
        single = single.select("conv_id", F.col("call_id").alias("need"), "further", "more")
        waiting = open_.where("settled is null").drop("settled").join(single, ["conv_id", "need"], "left")
        waiting = waiting.select(*KEY, F.coalesce("further", "need").alias("need"), (F.col("way") + F.coalesce("more", F.lit(0))).alias("way"))
        waiting = waiting.groupBy(*KEY, "need").agg(F.max("way").alias("way")).withColumn("settled", F.lit(None).cast("long"))
        done = open_.where("settled is not null").groupBy(*KEY).agg(F.max("settled").alias("settled"))
        open_ = waiting.unionByName(done.select(*KEY, F.lit(None).cast("string").alias("need"), F.lit(0).cast("long").alias("way"), "settled"))
    found = calls.sparkSession.read.schema(ready.schema).option("basePath", out).parquet(*[f"{out}/round={r}" for r in range(i)])
    return found.select(*KEY, F.col("stage").cast("int").alias("stage"))


def problems(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """(conv_id, call_id, errors): sorted complaints about arguments, for the calls that have any.

    ``schemas`` (name, param, type, required) gives the types string, integer, number, boolean, null, array and
    object; an integer is a number. Complaints: ``arguments`` (no JSON object), ``tool`` (no schema of that
    name), ``missing:p``, ``unknown:p`` and ``type:p``.
    """
    schemas = schemas.groupBy("name", "param").agg(F.min("type").alias("type"), F.max("required").alias("required"))
    tools = schemas.select("name").distinct().withColumn("has", F.lit(True))
    typed = calls.join(tools, "name", "left").select(
        *KEY, "name", F.coalesce("has", F.lit(False)).alias("has"), F.from_json("arguments", "map<string,variant>").alias("given"),
        (F.expr("coalesce(schema_of_variant(try_parse_json(arguments)), '')").startswith("OBJECT")).alias("ok"),
    )
    plain = typed.select(*KEY, F.explode(F.array_compact(F.array(F.when(~F.col("ok"), F.lit("arguments")), F.when(~F.col("has"), F.lit("tool"))))).alias("error"))
    both = typed.where("ok and has")
    given = both.select(*KEY, "name", F.explode("given").alias("param", "value"))
    given = given.select(*KEY, "name", "param", F.expr("coalesce(schema_of_variant(value), 'VOID')").alias("t"))
    given = given.select(*KEY, "name", "param", F.expr(TYPE_NAMES).alias("is_type"))
    checked = given.join(schemas, ["name", "param"], "left").select(
        *KEY,
        F.when(F.col("type").isNull(), F.concat(F.lit("unknown:"), "param")).when(
            (F.col("type") != F.col("is_type")) & ~((F.col("type") == "number") & (F.col("is_type") == "integer")), F.concat(F.lit("type:"), "param")
        ).alias("error"),
    )
    wanted = both.join(schemas.where("required"), "name").select(*KEY, "param").join(given.select(*KEY, "param"), [*KEY, "param"], "left_anti")
    missing = wanted.select(*KEY, F.concat(F.lit("missing:"), "param").alias("error"))
    every = plain.unionByName(checked.where("error is not null")).unionByName(missing)
    return every.groupBy(*KEY).agg(F.array_sort(F.collect_set("error")).alias("errors"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call or unanswered result: conv_id, call_id, turn, status, stage, errors (comma-joined), message.

    ``calls``: conv_id, call_id, turn, name, arguments (JSON text). ``results``: conv_id, call_id, turn, content.
    Of several calls (or results) with one identifier in a conversation the earliest counts (ties: the
    smallest values), and ``duplicates`` in the message says how many others there were. status is ``linked``,
    ``no_result``, ``no_call`` (a result alone), ``early`` (the result comes before its call) or ``no_id`` (a
    null identifier links to nothing; such rows are kept one by one). stage orders a conversation's calls with
    ``turn``; it is null for calls on or behind a cycle and for results alone. A need that names no call of the
    conversation is the complaint ``need:<id>``. Empty tables give no rows; other columns take no part.
    """
    calls = calls.select(*KEY, "turn", F.col("name").cast("string").alias("name"), F.col("arguments").cast("string").alias("arguments"))
    results = results.select(*KEY, "turn", F.col("content").cast("string").alias("content"))
    first = lambda *c: F.min(F.struct("turn", *c)).alias("x")  # noqa: E731  combined before the shuffle
    named = calls.where("call_id is not null").groupBy(*KEY).agg(first("name", "arguments"), (F.count("*") - 1).alias("more"))
    named = written(named.select(*KEY, "x.*", "more"), "calls")
    answers = results.where("call_id is not null").groupBy(*KEY).agg(first("content"), (F.count("*") - 1).alias("more"))
    answers = answers.select(*KEY, F.col("x.turn").alias("answered"), "x.content", F.col("more").alias("again"))

    every = written(_needs(named), "all-needs")
    exists = named.select("conv_id", F.col("call_id").alias("need"))
    needs = every.join(exists, ["conv_id", "need"], "left_semi")
    lost = every.join(exists, ["conv_id", "need"], "left_anti").groupBy(*KEY)
    lost = lost.agg(F.array_sort(F.collect_set(F.concat(F.lit("need:"), "need"))).alias("lost"))

    linked = (
        named.join(answers.hint("shuffle_hash"), KEY, "full_outer")
        .join(stages(named, needs), KEY, "left")
        .join(problems(named, schemas), KEY, "left")
        .join(lost, KEY, "left")
    )
    alone_calls = calls.where("call_id is null").withColumn("more", F.lit(0).cast("long"))
    alone_results = results.where("call_id is null").select(*KEY, F.col("turn").alias("answered"), "content", F.lit(0).cast("long").alias("again"))
    linked = linked.unionByName(alone_calls, True).unionByName(alone_results, True)
    no_call = F.col("more").isNull()
    status = (
        F.when(F.col("call_id").isNull(), "no_id")
        .when(no_call, "no_call")
        .when(F.col("again").isNull(), "no_result")
        .when(F.col("answered") < F.col("turn"), "early")
        .otherwise("linked")
    )
    empty = F.array().cast("array<string>")
    errors = F.concat(F.coalesce("errors", empty), F.coalesce("lost", empty))
    arguments = F.coalesce(F.to_json(F.try_parse_json("arguments")), F.to_json(F.try_parse_json(F.to_json(F.struct("arguments")))), F.lit("null"))
    # the fields are written in the order of their names; arguments is JSON already
    text = lambda c: F.coalesce(F.regexp_extract(F.to_json(F.struct(F.col(c).alias("x"))), r"(?s)^\{\"x\":(.*)\}$", 1), F.lit("null"))
    value = lambda c: F.when(F.col(c).isNull(), F.lit("null")).otherwise(text(c))
    message = F.concat(
        F.lit('{"arguments":'), F.when(no_call, F.lit("null")).otherwise(arguments),
        F.lit(',"duplicates":'), (F.coalesce("more", F.lit(0)) + F.coalesce("again", F.lit(0))).cast("string"),
        F.lit(',"errors":'), F.to_json(F.col("errors")),
        F.lit(',"id":'), value("call_id"), F.lit(',"name":'), value("name"),
        F.lit(',"result":'), value("content"), F.lit(',"status":"'), F.col("status"), F.lit('"}'),
    )
    return (
        linked.withColumn("status", status)
        .withColumn("errors", errors)
        .select(*KEY, F.coalesce("turn", "answered").alias("turn"), "status", "stage", F.array_join("errors", ",").alias("errors"), message.alias("message"))
    )
