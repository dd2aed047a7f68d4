"""Contact thresholds on stored numbers and on the text model's score."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import thresholds
from ..session import staged
from .data import DOCS_PARAMS, LINES_PARAMS, LINES_SQL, labelled_documents, lines_with_orders
from .registry import query
from .texts import scored_documents

RATES = (0.01, 0.05, 0.1, 0.25, 0.5, 1.0)
_DOCS_SQL = """base AS (SELECT n_chars::DOUBLE AS score, toxic = 1 AS pos
  FROM documents JOIN labels USING (doc_id) WHERE toxic IN (0, 1))"""
_LINES_BASE = f"""{LINES_SQL}, base AS (SELECT {{score}}::DOUBLE AS score, l_linestatus = 'F' AS pos
  FROM lines WHERE l_linestatus IN ('F', 'O'))"""
_SWEEP_SQL = """levels AS (SELECT score, count(*) AS n, count(*) FILTER (pos) AS p FROM base
  WHERE score IS NOT NULL AND NOT isnan(score) GROUP BY score),
sweep AS (SELECT score AS threshold, CAST(sum(n) OVER (ORDER BY score DESC) AS BIGINT) AS contacted,
  CAST(sum(p) OVER (ORDER BY score DESC) AS BIGINT) AS positives FROM levels),
sizes AS (SELECT count(*) AS n_rows, count(*) FILTER (pos) AS n_pos FROM base)"""
_FIGURES_SQL = """contacted, positives, round(contacted / n_rows, 6) AS contact_rate,
  round(positives / nullif(contacted, 0), 6) AS precision, round(positives / nullif(n_pos, 0), 6) AS recall"""
_RATES_SQL = "rates AS (SELECT unnest([" + ", ".join(map(str, RATES)) + "])::DOUBLE AS rate)"
_TABLE_SQL = f"""{_SWEEP_SQL}, {_RATES_SQL},
best AS (SELECT rate, n_rows, n_pos, min(threshold) AS threshold, coalesce(max(contacted), 0) AS contacted,
  coalesce(max(positives), 0) AS positives
  FROM rates CROSS JOIN sizes LEFT JOIN sweep ON contacted <= floor(rate * n_rows) GROUP BY ALL)
SELECT rate, threshold, {_FIGURES_SQL} FROM best"""


@query("threshold_table", f"WITH {_DOCS_SQL}, {_TABLE_SQL}")
def threshold_table(spark, sf_dir):
    """The threshold of each contact budget, with the length of a document as its score."""
    return thresholds.threshold_table(labelled_documents(spark, sf_dir), "n_chars", DOCS_PARAMS.label, RATES)


@query("threshold_table_prices", f"WITH {_LINES_BASE.format(score='l_extendedprice')}, {_TABLE_SQL}")
def threshold_table_prices(spark, sf_dir):
    """The same on the prices of order lines, nearly all of them distinct."""
    lines = lines_with_orders(spark, sf_dir)
    return thresholds.threshold_table(lines, "l_extendedprice", LINES_PARAMS.label, RATES)


@query(
    "threshold_curve",
    f"WITH {_LINES_BASE.format(score='l_quantity')}, {_SWEEP_SQL} "
    f"SELECT threshold, {_FIGURES_SQL} FROM sweep CROSS JOIN sizes",
)
def threshold_curve(spark, sf_dir):
    """Every threshold of a number with few levels and many ties."""
    return thresholds.threshold_curve(lines_with_orders(spark, sf_dir), "l_quantity", LINES_PARAMS.label)


@query(
    "threshold_metrics",
    f"""WITH {_DOCS_SQL}, sizes AS (SELECT count(*) AS n_rows, count(*) FILTER (pos) AS n_pos FROM base),
given AS (SELECT unnest([0.0, 500.0, 2000.0, 1e9])::DOUBLE AS threshold),
hits AS (SELECT threshold, count(score) AS contacted, count(score) FILTER (pos) AS positives
  FROM given LEFT JOIN base ON score >= threshold GROUP BY threshold)
SELECT threshold, {_FIGURES_SQL} FROM hits CROSS JOIN sizes""",
)
def threshold_metrics(spark, sf_dir):
    """Rate, precision and recall at agreed thresholds."""
    docs = labelled_documents(spark, sf_dir)
    return thresholds.threshold_metrics(docs, "n_chars", DOCS_PARAMS.label, (0.0, 500.0, 2000.0, 1e9))


@query(
    "retain_flags",
    f"""WITH {_DOCS_SQL}, {_SWEEP_SQL}
SELECT doc_id, coalesce(n_chars >= (SELECT min(threshold) FROM sweep, sizes
  WHERE contacted <= floor(0.1::DOUBLE * n_rows)), FALSE) AS retain
FROM documents""",
)
def retain_flags(spark, sf_dir):
    """Retain or not, for all documents, at the threshold that a tenth of the labelled ones reach."""
    docs = labelled_documents(spark, sf_dir, "left")
    agreed = thresholds.threshold_table(docs, "n_chars", DOCS_PARAMS.label, [0.1]).first()["threshold"]
    return thresholds.retain(docs, "n_chars", agreed).select("doc_id", "retain")


@query("text_model_thresholds")
def text_model_thresholds(spark, sf_dir):
    """Contact budgets on the score of the text model."""
    scored = staged(scored_documents(spark, sf_dir).select("toxic", "score"), "scores")
    table = thresholds.threshold_table(scored, "score", DOCS_PARAMS.label, RATES)
    return table.withColumn("threshold", F.round("threshold", 4))
