"""Language detection (X6, X7) as table work: character 3-gram naive Bayes.

Profile: 3-gram counts per language learned from a labelled text table
(``groupBy(gram)`` with one count column per language, partial aggregation
map-side). Scoring: every gram of a text looks up its per-language log
probabilities (broadcast hash join when the profile is proven small,
otherwise a shuffle join that AQE splits on frequent grams), and one
aggregation per text sums them - one column per language, so the rows are
never multiplied by the number of languages. Grams are taken over the whole
text. Only texts longer than 50 characters are scored (X7); others get NULL.

Smoothing is add-one over the gram vocabulary ``V``:
``log p(g | l) = ln((c_lg + 1) / (N_l + V))`` and grams never seen in
training contribute ``ln(1 / (N_l + V))``. Ties go to the smaller language code.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import spread, written
from .indexing import broadcast_if_small

N = 3
MIN_CHARS = 50  # X7: detection only for longer texts


def normalized(text) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.lower(t), r"[^\p{L}]+", " ")


def grams(norm_text) -> Column:
    """All overlapping character 3-grams of an already normalised text (whole text).

    One linear regex pass with a look-ahead group: positional ``substring`` on a
    UTF-8 string walks from the start on every call and would make this
    quadratic in the text length.
    """
    t = F.col(norm_text) if isinstance(norm_text, str) else norm_text
    return F.regexp_extract_all(t, F.lit("(?=(.{%d}))" % N), 1)


class LangProfile:
    def __init__(self, table: DataFrame, langs: list[str], priors: list[float], unseen: list[float]):
        self.table = table  # (gram, lp_0 .. lp_k)
        self.langs = langs
        self.priors = priors
        self.unseen = unseen


def fit_profile(train: DataFrame, text_col: str = "text", lang_col: str = "lang", max_langs: int = 500) -> LangProfile:
    """Learn the 3-gram profile from a labelled table."""
    lab = train.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    docs = lab.groupBy(lang_col).agg(F.count("*").alias("d")).limit(max_langs + 1).collect()  # one row per language
    if len(docs) > max_langs:
        raise ValueError(f"more than max_langs={max_langs} languages")
    langs = sorted(r[lang_col] for r in docs)
    dcount = {r[lang_col]: r["d"] for r in docs}
    total_docs = sum(dcount.values())
    # round-robin: hashing on the text would send every copy of a text (copies
    # may be a third of a corpus) to one task
    g = spread(lab.select(lang_col, text_col)).select(lang_col, normalized(text_col).alias("_nt")).select(lang_col, F.explode(grams("_nt")).alias("gram"))
    # counted by gram and language, combined map-side; then one row per gram, written once for the reads below
    pairs = g.groupBy("gram", F.col(lang_col).alias("_l")).agg(F.count("*").alias("_c"))
    wide = pairs.groupBy("gram").agg(*[F.sum(F.when(F.col("_l") == l, F.col("_c")).otherwise(0)).alias(f"c_{i}") for i, l in enumerate(langs)])
    counts = written(wide, "grams")
    stats = counts.agg(F.count("*").alias("V"), *[F.sum(f"c_{i}").alias(f"n_{i}") for i in range(len(langs))]).collect()[0]
    V = stats["V"]
    ns = [stats[f"n_{i}"] or 0 for i in range(len(langs))]
    table = counts.select(
        "gram",
        *[F.log((F.col(f"c_{i}") + F.lit(1.0)) / F.lit(float(ns[i] + V))).alias(f"lp_{i}") for i in range(len(langs))],
    )
    priors = [math.log(dcount[l] / total_docs) for l in langs]
    unseen = [math.log(1.0 / (ns[i] + V)) for i in range(len(langs))]
    return LangProfile(table, langs, priors, unseen)


def detect(df: DataFrame, profile: LangProfile, id_col: str, text_col: str = "text", max_broadcast_grams: int = 5_000_000) -> DataFrame:
    """``id, lang`` for every row (NULL when the text is not longer than 50 characters)."""
    k = len(profile.langs)
    scored_src = (
        spread(df.select(id_col, text_col), id_col)
        .where(F.length(text_col) > MIN_CHARS)
        .select(id_col, normalized(text_col).alias("_nt"))
        .select(id_col, F.explode(grams("_nt")).alias("gram"))
    )
    prof = broadcast_if_small(profile.table, max_broadcast_grams)
    j = scored_src.join(prof, "gram", "left")
    sums = j.groupBy(id_col).agg(
        *[
            F.sum(F.coalesce(F.col(f"lp_{i}"), F.lit(profile.unseen[i]))).alias(f"s_{i}")
            for i in range(k)
        ]
    )
    # argmax; ties to the smaller language code (langs are sorted)
    best = F.struct(F.lit(float("-inf")).alias("s"), F.lit(None).cast("string").alias("l"))
    for i, lang in enumerate(profile.langs):
        s = F.col(f"s_{i}") + F.lit(profile.priors[i])
        best = F.when(s > best["s"], F.struct(s.alias("s"), F.lit(lang).alias("l"))).otherwise(best)
    pred = sums.select(id_col, best["l"].alias("lang"))
    return df.select(id_col).join(pred, id_col, "left")
