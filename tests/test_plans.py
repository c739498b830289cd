"""Plan shape of the registered queries: what would hurt at scale must not appear."""

import pytest

from pagelake.plans import registry

registry.load_all()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, sf_small):
    out = {}
    for name, fn in registry.QUERIES.items():
        out[name] = _plan(fn(spark, sf_small))
    return out


def test_every_query_has_an_oracle_or_is_a_model_fit():
    rows_only = set(registry.QUERIES) - set(registry.SQL)
    assert rows_only <= {"featurize", "train_predict", "model_selection", "active_sample"}


def test_no_pair_joins_and_no_row_at_a_time_python(plans):
    for name, p in plans.items():
        assert "CartesianProduct" not in p, name
        assert "BroadcastNestedLoopJoin" not in p, name
        assert "BatchEvalPython" not in p, name  # row-at-a-time Python UDFs


def test_python_only_in_searches_and_summaries(plans):
    with_python = {n for n, p in plans.items() if "MapInPandas" in p or "FlatMapCoGroupsInPandas" in p or "ArrowEvalPython" in p}
    searches = {"vector_search", "vector_search_batch", "search_text", "search_json", "search_pages"}
    summaries = {"chunk_summaries", "final_summary", "summarize", "enrich_pages"}  # Arrow batches of whole texts
    assert with_python <= searches | summaries


def test_aggregations_combine_before_the_shuffle(plans):
    for name in ("raw_store", "lang_detect", "multilabel_metrics", "robots_admission", "upsert_pages", "fetch_outcomes"):
        assert "partial_" in plans[name], name


def test_per_document_text_jobs_do_not_shuffle(plans):
    # the only exchange allowed is spread()'s repartition of a scan with too few splits
    for name in ("chunks", "keyword_tokens", "top_keywords", "chunk_summaries", "final_summary", "summarize", "extract_main"):
        assert "ENSURE_REQUIREMENTS" not in plans[name], name


def test_small_sides_are_broadcast(plans):
    assert "BroadcastHashJoin" in plans["robots_admission"]
    assert "BroadcastHashJoin" in plans["lang_detect"]


def test_scans_read_only_needed_columns(spark, sf_small):
    df = registry.QUERIES["valid_vectors"](spark, sf_small)
    p = _plan(df)
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in p
    lookup = _plan(registry.QUERIES["page_lookup"](spark, sf_small))
    assert "html" not in lookup.split("ReadSchema")[1].split("\n")[0]


def test_spread_never_runs_a_plan_with_a_shuffle(spark, sf_small):
    from pagelake.session import read_table, spread

    docs = read_table(spark, sf_small, "documents")
    joined = docs.join(read_table(spark, sf_small, "labels"), "doc_id")
    spark.sparkContext.setJobGroup("spread", "spread")
    try:
        for df in (joined, docs.groupBy("lang").count(), docs.distinct()):
            assert spread(df) is df
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("spread")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "RoundRobin" in spread(docs)._jdf.queryExecution().toString() or docs.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
