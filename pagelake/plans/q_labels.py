"""Label-loop queries: S4-S7, L1-L4, L7, L9-L11."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import active as A
from ..operators import labels as L
from ..operators.metrics import flattened_f1
from ..session import scratch_path
from ..sources import csvio
from . import fixtures as X
from .registry import register

TEST_SIZE, SEED = 0.1, 42


# white space of every kind at both ends, written out for the oracle
STRIP = r"regexp_replace({x}, '^[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{2000}-\x{200A}\x{3000}]+|[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{2000}-\x{200A}\x{3000}]+$', '', 'g')"


def _strip(x: str) -> str:
    return STRIP.replace("{x}", x)


def _label_map_sql() -> str:
    return f"""
lr AS ({X.LABEL_ROWS_SQL}),
lm AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS idx
       FROM (SELECT DISTINCT {_strip('p')} AS label FROM (SELECT unnest(string_split(coalesce(labels, ''), ',')) AS p FROM lr)
             WHERE {_strip('p')} <> ''))"""


@register("label_map", f"WITH {_label_map_sql()} SELECT label, idx FROM lm")
def label_map(spark, sf_dir):
    """L1: label -> index over all label rows."""
    return L.label_map(X.label_rows(spark, sf_dir))


def _multihot_sql() -> str:
    return f"""
{_label_map_sql()},
ll AS (SELECT list(label ORDER BY idx) AS names FROM lm),
mh AS (SELECT lr.id, lr.text, list_transform(ll.names, lambda n: CAST(list_contains(
              list_filter(list_transform(string_split(coalesce(lr.labels, ''), ','), lambda x: {_strip('x')}), lambda x: x <> ''), n) AS INTEGER)) AS vec
       FROM lr CROSS JOIN ll)"""


def _multihot(spark, sf_dir):
    rows = X.label_rows(spark, sf_dir)
    names = L.collect_label_list(L.label_map(rows))
    return rows.select("id", "text", L.multihot(rows, names).alias("vec"))


@register(
    "multihot",
    f"WITH {_multihot_sql()} SELECT id, array_to_string(vec, ',') AS labels_bin, CAST(list_sum(vec) AS INTEGER) AS n_labels FROM mh",
)
def multihot(spark, sf_dir):
    """L2 + L4 (encode): multi-hot target per row, unlabelled rows all zeros."""
    m = _multihot(spark, sf_dir)
    return m.select(
        "id",
        L.encode_bin("vec").alias("labels_bin"),
        F.aggregate("vec", F.lit(0), lambda s, x: s + x).alias("n_labels"),
    )


def _split_sql(which: str) -> str:
    return f"""
WITH {_multihot_sql()},
r AS (SELECT id, text, vec, row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR) || '-{SEED}'), id) AS rn,
             count(*) OVER () AS n FROM mh)
SELECT id, text, array_to_string(vec, ',') AS labels_bin FROM r
WHERE {'rn <= ceil(n * ' + str(TEST_SIZE) + ')' if which == 'val' else 'rn > ceil(n * ' + str(TEST_SIZE) + ')'}
"""


def _split_roundtrip(spark, sf_dir, which: str):
    """L3 + S6 + S7: split, write the split as CSV, read it back (the label map: ``label_map_json``)."""
    m = _multihot(spark, sf_dir)
    s = L.train_val_split(m, "id", TEST_SIZE, SEED).select("id", "text", L.encode_bin("vec").alias("labels_bin"), "split")
    path = scratch_path(spark, f"split-{which}")
    csvio.write_csv(s.where(F.col("split") == which).drop("split"), path)
    back = csvio.read_csv(spark, path, ["id", "text", "labels_bin"])
    return back.select(F.col("id").cast("bigint").alias("id"), "text", "labels_bin")


@register("split_val", _split_sql("val"))
def split_val(spark, sf_dir):
    """L3: validation rows (ceil(n * 0.1) smallest hashes), through the CSV sink and source."""
    return _split_roundtrip(spark, sf_dir, "val")


@register("split_train", _split_sql("train"))
def split_train(spark, sf_dir):
    """L3: training rows, through the CSV sink and source."""
    return _split_roundtrip(spark, sf_dir, "train")


@register(
    "labels_bin_decode",
    f"""
WITH {_multihot_sql()}
SELECT id, CAST(generate_subscripts(vec, 1) - 1 AS INTEGER) AS idx, unnest(vec) AS bit FROM mh
""",
)
def labels_bin_decode(spark, sf_dir):
    """S7 + L4 (decode): labels_bin written to CSV, read back and decoded to (id, idx, bit)."""
    m = _multihot(spark, sf_dir).select(F.col("id").cast("string").alias("id"), L.encode_bin("vec").alias("labels_bin"))
    path = scratch_path(spark, "labels-bin")
    csvio.write_csv(m, path)
    back = csvio.read_csv(spark, path, ["id", "labels_bin"])
    return back.select(F.col("id").cast("bigint").alias("id"), F.posexplode(L.decode_bin("labels_bin")).alias("idx", "bit"))


@register(
    "labelled_csv",
    f"SELECT CAST(id AS VARCHAR) AS id, text, labels FROM ({X.LABEL_ROWS_SQL})",
)
def labelled_csv(spark, sf_dir):
    """Label rows written as CSV (quotes, newlines) and read back as strings."""
    rows = X.label_rows(spark, sf_dir)
    path = scratch_path(spark, "labelled")
    csvio.write_csv(rows, path)
    return csvio.read_csv(spark, path, ["id", "text", "labels"])


@register(
    "label_export",
    """
SELECT CAST(d.doc_id AS VARCHAR) AS id, CASE WHEN l.quality = 0 THEN '' ELSE d.text END AS text, '' AS labels
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
""",
)
def label_export(spark, sf_dir):
    """Export of summarised pages for labelling, through CSV."""
    from .q_ingest import summary_pages

    pages = summary_pages(spark, sf_dir)
    path = scratch_path(spark, "export")
    csvio.write_csv(csvio.label_export(pages), path)
    return csvio.read_csv(spark, path, ["id", "text", "labels"])


@register(
    "multilabel_metrics",
    f"""
WITH s AS ({X.SCORED_LABELS_SQL}),
c AS (SELECT y_quality AS y, CAST(p_quality >= 0.5 AS INTEGER) AS p FROM s
      UNION ALL SELECT y_toxic, CAST(p_toxic >= 0.5 AS INTEGER) FROM s),
a AS (SELECT count(*) AS n_cells,
             CAST(sum(CASE WHEN y = 1 AND p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
             CAST(sum(CASE WHEN y = 0 AND p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
             CAST(sum(CASE WHEN y = 1 AND p = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
             CAST(sum(CASE WHEN y = 0 AND p = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn FROM c)
SELECT n_cells, tp, fp, fn, tn,
       round((tp + tn) / n_cells, 9) AS f1_micro,
       round(((CASE WHEN tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END)
            + (CASE WHEN tn + fp + fn > 0 THEN 2.0 * tn / (2 * tn + fp + fn) ELSE 0 END))
            / ((tp + fp + fn > 0)::INT + (tn + fp + fn > 0)::INT), 9) AS f1_macro
FROM a
""",
)
def multilabel_metrics(spark, sf_dir):
    """f1_micro / f1_macro over the flattened (row x label) cells at threshold 0.5."""
    s = X.scored_labels(spark, sf_dir)
    m = flattened_f1(s, ["y_quality", "y_toxic"], ["p_quality", "p_toxic"], 0.5)
    return m.select("n_cells", "tp", "fp", "fn", "tn", F.round("f1_micro", 9).alias("f1_micro"), F.round("f1_macro", 9).alias("f1_macro"))


_PROBS_SQL = f"WITH g AS ({X.LOGITS_SQL}), p AS (SELECT vec_id, list_transform(logits, lambda x: 1.0 / (1.0 + exp(-x))) AS probs FROM g)"


@register(
    "predict_labels",
    f"""
{_PROBS_SQL}
SELECT vec_id,
       array_to_string(list_filter(list_transform(range(1, 65), lambda i: 'v' || i), lambda n, i: probs[i] >= 0.5), ',') AS labels,
       {', '.join(f'round(probs[{i}], 9) AS score_v{i}' for i in range(1, 65))}
FROM p
""",
)
def predict_labels(spark, sf_dir):
    """Sigmoid of logits, labels with score >= 0.5 in index order, score per label."""
    g = X.logits(spark, sf_dir)
    pr = g.select("vec_id", A.predict_from_probs(A.probs_from_logits("logits"), list(X.LOGIT_LABELS), 0.5).alias("p"))
    return pr.select(
        "vec_id",
        F.array_join("p.labels", ",").alias("labels"),
        *[F.round(F.col("p.scores")[n], 9).alias(f"score_{n}") for n in X.LOGIT_LABELS],
    )


_ENTROPY_SQL = (
    "-list_sum(list_transform(probs, lambda x: x * ln(x + 1e-12) + (1 - x) * ln(1 - x + 1e-12))) / len(probs)"
)


@register(
    "uncertainty",
    f"{_PROBS_SQL} SELECT vec_id, round({_ENTROPY_SQL}, 9) AS uncertainty FROM p WHERE len(probs) > 0",
)
def uncertainty(spark, sf_dir):
    """Mean binary entropy of the label probabilities."""
    g = X.logits(spark, sf_dir).select("vec_id", A.probs_from_logits("logits").alias("probs"))
    return g.select("vec_id", F.round(A.mean_binary_entropy("probs"), 9).alias("uncertainty")).where(
        F.col("uncertainty").isNotNull()
    )


@register(
    "sample_uncertain",
    f"""
{_PROBS_SQL}, u AS (SELECT vec_id, {_ENTROPY_SQL} AS unc FROM p WHERE len(probs) > 0)
SELECT vec_id, round(unc, 9) AS uncertainty FROM u ORDER BY unc DESC, vec_id LIMIT 50
""",
)
def sample_uncertain(spark, sf_dir):
    """The 50 most uncertain rows (top-k is the feature)."""
    g = X.logits(spark, sf_dir).select("vec_id", A.probs_from_logits("logits").alias("probs"))
    top = A.sample_uncertain(g, "vec_id", "probs", 50)
    return top.select("vec_id", F.round("uncertainty", 9).alias("uncertainty"))


@register("label_map_json", f"WITH {_label_map_sql()} SELECT label, idx FROM lm")
def label_map_json(spark, sf_dir):
    """S6 + S7: the label map written as JSON next to the split files and read back."""
    lm = L.label_map(X.label_rows(spark, sf_dir))
    path = scratch_path(spark, "label-map")
    csvio.write_label_map(lm, path)
    return csvio.read_label_map(spark, path)
