"""Text jobs over a documents table.

Everything here is per document, so everything is a per-row expression:
chunks, lead summaries, their merge, and the top-k keyword count (sort the
tokens, count runs, sort the runs). No job in this module shuffles, whatever
the number of documents; a hot key cannot exist.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_code, spread
from ..functions.text import (
    chunk_array,
    chunk_extracts,
    extract_summary,
    joined_summaries,
    keyword_tokens,
    lead_summary,
    text_extract,
)


def chunks(df: DataFrame, id_col: str, text_col: str, max_chars: int = 4000, overlap: int = 200) -> DataFrame:
    """One row per chunk: ``id, chunk_idx, start_idx, end_idx, chunk``."""
    return spread(df.select(id_col, text_col), id_col).select(F.col(id_col), F.inline(chunk_array(text_col, max_chars, overlap)))


def with_top_keywords(df: DataFrame, text_col: str, top_k: int, out: str = "_kw") -> DataFrame:
    """Adds ``out``: ``array<struct<cnt bigint, keyword string>>``, the ``top_k``
    keyword tokens of the row by count, ties by first occurrence.

    Per row, no shuffle: the (token, position) pairs are sorted, runs of equal
    tokens give each token's count and first position, and the runs are
    sorted by (-count, first position). Staged projections whose lambdas use
    only their own arguments, so nothing is recomputed per element when
    Catalyst inlines a column.
    """
    t = df.withColumn("_kt", F.coalesce(keyword_tokens(text_col), F.array().cast("array<string>")))
    n = F.size("_kt")
    idx = F.slice(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), 1, n)
    t = t.withColumn("_ks", F.sort_array(F.zip_with("_kt", idx, lambda w, i: F.struct(w.alias("w"), i.alias("p")))))
    n = F.size("_ks")
    words = F.transform("_ks", lambda x: x["w"])
    nxt = F.slice(F.concat(F.slice(words, 2, F.greatest(n - 1, F.lit(0))), F.array(F.lit(None).cast("string"))), 1, n)
    pos = F.slice(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), 1, n)
    t = t.withColumn("_kw_w", words).withColumn("_kn", nxt)
    # 1-based positions where a run of one token ends
    t = t.withColumn("_ke", F.array_compact(F.zip_with(F.zip_with("_kw_w", "_kn", lambda a, b: ~a.eqNullSafe(b)), pos, lambda f, k: F.when(f, k))))
    starts = F.slice(F.concat(F.array(F.lit(1)), F.transform("_ke", lambda e: e + 1)), 1, F.size("_ke"))
    t = t.withColumn("_kb", starts)
    # the first element of a run holds the token's first position (pairs sorted by token, then position)
    is_start = F.zip_with("_kw_w", F.slice(F.concat(F.array(F.lit(None).cast("string")), F.col("_kw_w")), 1, n), lambda a, b: ~a.eqNullSafe(b))
    t = t.withColumn("_kf", F.array_compact(F.zip_with(is_start, "_ks", lambda f, x: F.when(f, x))))
    t = t.withColumn("_kc", F.zip_with("_ke", "_kb", lambda e, b: (e - b + 1).cast("bigint")))
    runs = F.sort_array(F.zip_with("_kf", "_kc", lambda x, c: F.struct((-c).alias("nc"), x["p"].alias("p"), x["w"].alias("w"))))
    top = F.transform(F.slice(runs, 1, top_k), lambda r: F.struct((-r["nc"]).alias("cnt"), r["w"].alias("keyword")))
    return t.withColumn(out, top).drop("_kt", "_ks", "_kw_w", "_kn", "_ke", "_kb", "_kf", "_kc")


def top_keywords(df: DataFrame, id_col: str, text_col: str, top_k: int = 10, repartition: bool = True) -> DataFrame:
    """The ``top_k`` most frequent keyword tokens per row, ties by first occurrence.

    Output: ``id, rank, keyword, cnt`` (rank from 1). Computed inside each row
    (no shuffle); ``repartition`` only spreads a scan with too few splits.
    """
    base = df.select(id_col, text_col)
    if repartition:
        base = spread(base, id_col)
    kw = with_top_keywords(base, text_col, top_k)
    # posexplode_outer: a plain posexplode makes Catalyst infer a filter on the
    # array and push it (inlined) below the staged projections
    return (
        kw.select(id_col, F.posexplode_outer("_kw").alias("rank", "k"))
        .where(F.col("k").isNotNull())
        .select(id_col, (F.col("rank") + 1).cast("bigint").alias("rank"), F.col("k.keyword").alias("keyword"), F.col("k.cnt").alias("cnt"))
    )


def keywords_array(df: DataFrame, id_col: str, text_col: str, top_k: int, repartition: bool = True) -> DataFrame:
    """T3 as a list column per row (``id, keywords array<string>``); rows without tokens get ``[]``."""
    base = df.select(id_col, text_col)
    if repartition:
        base = spread(base, id_col)
    kw = with_top_keywords(base, text_col, top_k)
    return kw.select(id_col, F.transform("_kw", lambda k: k["keyword"]).alias("keywords"))


def chunk_summaries(df: DataFrame, id_col: str, text_col: str, max_chars: int = 4000, overlap: int = 200) -> DataFrame:
    """T4: extractive summary per chunk (``id, chunk_idx, summary``)."""
    arr = F.transform(chunk_array(text_col, max_chars, overlap), lambda c: c["chunk"])
    s = spread(df.select(id_col, text_col), id_col).select(id_col, F.explode_outer(F.array(chunk_extracts(arr))).alias("_s"))
    return s.select(id_col, F.posexplode("_s").alias("chunk_idx", "summary"))


def summarize(
    df: DataFrame,
    id_col: str,
    text_col: str,
    max_chars: int = 4000,
    overlap: int = 200,
    top_k: int = 15,
    summarizer=None,
    passthrough: list[str] | None = None,
) -> DataFrame:
    """``id, final_summary, chunk_summaries, keywords, num_chunks``.

    Default backend: extractive summaries of each whole chunk, and of all chunk
    summaries together, as column expressions without a shuffle. ``summarizer`` (optional) is a model slot: a function
    ``pandas.Series[str] -> pandas.Series[str]`` applied with ``mapInPandas``
    to the chunk rows and to the joined summaries (one model load per worker).
    Keywords come from the chunk summaries joined by a blank line. Empty or
    NULL text gives ``'' / [] / [] / 0``. ``passthrough`` columns of ``df``
    are carried to the output.
    """
    keep = [c for c in (passthrough or []) if c not in (id_col,)]
    arr = chunk_array(text_col, max_chars, overlap)
    df = spread(df.select(id_col, text_col, *[c for c in keep if c != text_col]), id_col)
    if summarizer is None:
        # (through a one-element generator: what uses the summaries cannot be merged with, and repeat, what makes them)
        extracts = F.array(chunk_extracts(F.transform(arr, lambda s: s["chunk"])))
        base = df.select(id_col, *keep, F.explode_outer(extracts).alias("chunk_summaries"))
        base = base.select(id_col, *keep, "chunk_summaries", joined_summaries("chunk_summaries").alias("_joined"))
        base = base.select("*", text_extract("_joined").alias("final_summary"), F.size("chunk_summaries").alias("num_chunks"))
    else:
        base = _model_summaries(df, id_col, arr, summarizer)
        if keep:
            base = base.join(df.select(id_col, *keep), id_col, "left")
    # keywords of the joined summaries, inside each row: no shuffle
    kw = with_top_keywords(base, "_joined", top_k)
    return kw.select(
        id_col,
        *keep,
        F.when(F.col("num_chunks") == 0, F.lit("")).otherwise(F.col("final_summary")).alias("final_summary"),
        "chunk_summaries",
        F.transform("_kw", lambda k: k["keyword"]).alias("keywords"),
        "num_chunks",
    )


def _call_per_batch_then_row(model, texts: pd.Series) -> list:
    """The model on a whole Arrow batch; if that raises, on each text alone, so
    one failing text falls back (``None``) without taking its batch with it."""
    try:
        return list(model(texts))
    except Exception:  # noqa: BLE001 - the original falls back per text
        out = []
        for t in texts:
            try:
                out.append(list(model(pd.Series([t])))[0])
            except Exception:  # noqa: BLE001
                out.append(None)
        return out


def _model_summaries(df: DataFrame, id_col: str, arr, summarizer) -> DataFrame:
    """Model slot for T4/T5: the summariser runs in Arrow batches over chunk rows.

    A document's chunk summaries then meet in one row, as its record asks for.
    A failing call falls back to the lead summary for that chunk, as the original does.
    """
    ship_code(df.sparkSession)
    rows = df.select(id_col, F.inline(arr)).select(id_col, "chunk_idx", "chunk", lead_summary("chunk").alias("lead"))

    def run(it):
        for pdf in it:
            outs = _call_per_batch_then_row(summarizer, pdf["chunk"])
            pdf["summary"] = [o.strip() if isinstance(o, str) else l for o, l in zip(outs, pdf["lead"])]
            yield pdf[[id_col, "chunk_idx", "summary"]]

    sch = rows.select(id_col, "chunk_idx", F.lit("").alias("summary")).schema
    summ = rows.mapInPandas(run, sch)
    per_doc = summ.groupBy(id_col).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("chunk_idx", "summary"))), lambda s: s["summary"]).alias(
            "chunk_summaries"
        )
    )
    per_doc = per_doc.select(
        id_col, "chunk_summaries", joined_summaries("chunk_summaries").alias("_joined"), F.size("chunk_summaries").alias("num_chunks")
    )

    def merge(it):
        for pdf in it:
            fallback = [extract_summary(t) for t in pdf["_joined"]]
            outs = _call_per_batch_then_row(summarizer, pdf["_joined"])
            pdf["final_summary"] = [o.strip() if isinstance(o, str) else f for o, f in zip(outs, fallback)]
            yield pdf

    sch2 = per_doc.select("*", F.lit("").alias("final_summary")).schema
    merged = per_doc.mapInPandas(merge, sch2)
    empty = df.select(id_col).join(merged, id_col, "left_anti").select(
        id_col,
        F.array().cast("array<string>").alias("chunk_summaries"),
        F.lit("").alias("_joined"),
        F.lit(0).alias("num_chunks"),
        F.lit("").alias("final_summary"),
    )
    return merged.unionByName(empty)
