"""Language detection query on ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import langid
from ..session import read_table
from .registry import register

NORM_SQL = "regexp_replace(lower({x}), '[^\\p{L}]+', ' ', 'g')"


def grams_sql(t: str) -> str:
    """3-grams of an already normalised text column."""
    return (
        f"list_filter(list_transform(generate_series(1, greatest(length({t}) - 2, 1)), "
        f"lambda i: substring({t}, i, 3)), lambda g: length(g) = 3)"
    )


def profile_sql() -> str:
    """CTEs ``lg_*``: the 3-gram profile learned from ``documents`` (add-one smoothing)."""
    return f"""
lg_tr AS (SELECT lang, {NORM_SQL.replace('{x}', 'text')} AS nt FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL),
lg_dl AS (SELECT lang, count(*) AS d FROM lg_tr GROUP BY lang),
lg_g AS (SELECT lang, unnest({grams_sql('nt')}) AS gram FROM lg_tr),
lg_c AS (SELECT lang, gram, count(*) AS c FROM lg_g GROUP BY lang, gram),
lg_v AS (SELECT count(DISTINCT gram) AS V FROM lg_c),
lg_nl AS (SELECT lang, sum(c) AS n FROM lg_c GROUP BY lang),
lg_lp AS (SELECT lg_dl.lang, gv.gram, ln((coalesce(lg_c.c, 0) + 1.0) / (lg_nl.n + lg_v.V)) AS lp
          FROM lg_dl CROSS JOIN (SELECT DISTINCT gram FROM lg_c) gv CROSS JOIN lg_v
          JOIN lg_nl ON lg_nl.lang = lg_dl.lang LEFT JOIN lg_c ON lg_c.lang = lg_dl.lang AND lg_c.gram = gv.gram)"""


def score_sql(table: str, id_col: str, text_col: str) -> str:
    """CTEs ``lg_s*``; ``lg_best(id, lang)`` for the rows of ``table`` longer than 50 characters."""
    return f"""
lg_sn AS (SELECT {id_col} AS id, {NORM_SQL.replace('{x}', text_col)} AS nt FROM {table} WHERE length({text_col}) > {langid.MIN_CHARS}),
lg_sg AS (SELECT id, unnest({grams_sql('nt')}) AS gram FROM lg_sn),
lg_sc AS (SELECT lg_sg.id, lg_dl.lang,
                 sum(coalesce(lg_lp.lp, ln(1.0 / (lg_nl.n + lg_v.V)))) + ln(lg_dl.d / (SELECT sum(d) FROM lg_dl)) AS s
          FROM lg_sg CROSS JOIN lg_dl CROSS JOIN lg_v JOIN lg_nl ON lg_nl.lang = lg_dl.lang
          LEFT JOIN lg_lp ON lg_lp.gram = lg_sg.gram AND lg_lp.lang = lg_dl.lang
          GROUP BY lg_sg.id, lg_dl.lang, lg_dl.d, lg_nl.n, lg_v.V),
lg_best AS (SELECT id, lang FROM lg_sc QUALIFY row_number() OVER (PARTITION BY id ORDER BY s DESC, lang) = 1)"""


def _fold_sql(name: str, fold: int) -> str:
    """CTEs ``<name>_*``: the profile of the other fold, and ``<name>_best`` for the rows of this one."""
    profile = profile_sql().strip().replace("FROM documents WHERE", f"FROM documents WHERE doc_id % 2 <> {fold} AND")
    scores = score_sql(f"(SELECT * FROM documents WHERE doc_id % 2 = {fold})", "doc_id", "text").strip()
    return f"{profile},\n{scores}".replace("lg_", f"{name}_")


LANG_SQL = f"""
WITH {_fold_sql('la', 0)},
{_fold_sql('lb', 1)},
best AS (SELECT * FROM la_best UNION ALL SELECT * FROM lb_best)
SELECT d.doc_id, b.lang FROM documents d LEFT JOIN best b ON d.doc_id = b.id
"""


@register("lang_detect", LANG_SQL)
def lang_detect(spark, sf_dir):
    """X6 + X7: language of every document longer than 50 characters, from the
    3-gram profile learned on the other half of the labelled documents."""
    docs = read_table(spark, sf_dir, "documents")
    fold = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(2))
    profiles = [langid.fit_profile(docs.where(fold != k), "text", "lang") for k in (0, 1)]
    found = [langid.detect(docs.where(fold == k), profiles[k], "doc_id", "text") for k in (0, 1)]
    return found[0].unionByName(found[1])
