"""Feature roles and the leakage scan."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import leakage as leak
from ..operators import roles
from ..operators.missingness import missingness
from ..spec import TableSpec
from .data import (
    DOCS_PARAMS,
    DOCS_SPEC,
    LINES_AS_OF,
    LINES_PARAMS,
    LINES_SPEC,
    LINES_SQL,
    labelled_documents,
    lines_with_orders,
    table,
)
from .registry import query
from .scans import missing_sql

# column: role, non-feature, planned
_ROLES = {
    "orderkey": ("id", True, False), "l_partkey": ("tech", True, False),
    "l_suppkey": ("tech", True, False), "l_linenumber": ("num", False, True),
    "l_quantity": ("num", False, True), "l_extendedprice": ("num", False, True),
    "l_discount": ("num", False, True), "l_tax": ("num", False, True),
    "l_returnflag": ("cat", False, True), "l_linestatus": ("label", True, False),
    "l_shipdate": ("date", False, True), "o_custkey": (None, True, False),
    "o_orderstatus": ("cat", False, True), "o_totalprice": ("num", False, True),
    "o_orderdate": ("date", False, True), "o_orderpriority": ("cat", False, True),
}
_FEATURES = [c for c, (_, _, planned) in _ROLES.items() if planned]
_LINES_KEYED = LINES_SQL.replace("SELECT l.*", "SELECT l_orderkey AS orderkey, l.*")


def _text(value):
    return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"


@query(
    "role_report",
    f"WITH {_LINES_KEYED} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {_text(role)} AS role, {nf} AS non_feature, "
        f"{planned} AS planned, FALSE AS leaked, FALSE AS missing_required, "
        f"FALSE AS text_type_warning, {_text('(?i)custkey$' if c == 'o_custkey' else None)} "
        f"AS pattern_hits, count({c}) AS filled_rows FROM lines"
        for c, (role, nf, planned) in _ROLES.items()
    ),
)
def role_report(spark, sf_dir):
    """Role, exclusion, pattern hits and fill of every column of the joined table."""
    return roles.role_report(lines_with_orders(spark, sf_dir), LINES_SPEC)


@query(
    "guard_report",
    f"WITH {_LINES_KEYED} SELECT 'ok' AS status, CAST(NULL AS VARCHAR) AS reason, "
    f"'{','.join(sorted(c for c, r in _ROLES.items() if r[1]))}' AS non_features, "
    f"'{','.join(sorted(_FEATURES))}' AS planned_features, '' AS leaked, count(*) AS n_rows "
    "FROM lines",
)
def guard_report(spark, sf_dir):
    """The guard's verdict beside the rows it applies to."""
    df = lines_with_orders(spark, sf_dir)
    status, reason = roles.guard_status(df, LINES_SPEC, LINES_PARAMS)
    joined = lambda names: F.lit(",".join(names))
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(status).alias("status"),
        F.lit(reason).cast("string").alias("reason"),
        joined(roles.non_features(df.columns, LINES_SPEC)).alias("non_features"),
        joined(LINES_SPEC.planned_features).alias("planned_features"),
        joined(roles.leaked_features(df.columns, LINES_SPEC)).alias("leaked"),
        "n_rows",
    )


def _verdict(df, spec, watched):
    """The guard's verdict on a configuration it should object to, beside the cells concerned."""
    status, reason = roles.guard_status(df, spec)
    joined = lambda names: F.lit(",".join(names))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(watched).alias("cells")).select(
        F.lit(status).alias("status"),
        F.lit(reason.split(":")[0]).alias("reason"),
        joined(roles.leaked_features(df.columns, spec)).alias("leaked"),
        joined(roles.missing_required(df.columns, spec)).alias("absent"),
        joined(roles.mistyped_text(df, spec)).alias("mistyped"),
        "n_rows",
        "cells",
    )


@query(
    "guard_with_leak",
    "SELECT CASE WHEN count(o_custkey) > 0 THEN 'fail' ELSE 'ok' END AS status, "
    "'non-feature columns among planned features' AS reason, 'o_custkey,o_shippriority' AS leaked, "
    "'' AS absent, '' AS mistyped, count(*) AS n_rows, count(o_custkey) AS cells FROM orders",
)
def guard_with_leak(spark, sf_dir):
    """An id and a technical column are among the planned features; roles come from lists alone."""
    df = table(spark, sf_dir, "orders").withColumn("o_shippriority", F.lit(0))
    spec = TableSpec.from_mapping(
        {"columns": [{"name": "o_orderkey", "type": "int"}]},
        {
            "id_cols": ["o_orderkey", "o_custkey"],
            "label_col": "o_orderstatus",
            "cat_cols": ["o_orderpriority", "o_custkey"],
            "num_cols": ["o_totalprice", "o_shippriority"],
            "tech_cols": ["o_shippriority"],
        },
    )
    return _verdict(df, spec, "o_custkey")


@query(
    "guard_missing_required",
    "SELECT 'fail' AS status, 'required columns missing' AS reason, '' AS leaked, "
    "'branch,returned' AS absent, '' AS mistyped, count(*) AS n_rows, count(o_orderkey) AS cells "
    "FROM orders",
)
def guard_missing_required(spark, sf_dir):
    """An id and the label are listed, undeclared and absent."""
    spec = TableSpec.from_mapping(
        {"columns": [{"name": "o_totalprice", "type": "float"}]},
        {"id_cols": ["o_orderkey", "branch"], "label_col": "returned", "num_cols": ["o_totalprice"]},
    )
    return _verdict(table(spark, sf_dir, "orders"), spec, "o_orderkey")


@query(
    "guard_text_type",
    "SELECT 'warn' AS status, 'text columns that are not strings' AS reason, '' AS leaked, "
    "'' AS absent, 'n_chars' AS mistyped, count(*) AS n_rows, count(n_chars) AS cells "
    "FROM documents",
)
def guard_text_type(spark, sf_dir):
    """A listed text column holds numbers."""
    spec = TableSpec.from_mapping(
        {"columns": [{"name": "doc_id", "type": "int"}]},
        {"id_cols": ["doc_id"], "text_cols": ["text", "n_chars"]},
    )
    return _verdict(table(spark, sf_dir, "documents"), spec, "n_chars")


@query(
    "select_features",
    f"WITH {_LINES_KEYED} SELECT \"column\", n_rows, missing_count "
    f"FROM ({missing_sql('lines', _FEATURES)})",
)
def select_features(spark, sf_dir):
    """Only planned features are left; the scan reads no others but the join key."""
    features = roles.select_features(lines_with_orders(spark, sf_dir), LINES_SPEC, LINES_PARAMS)
    return missingness(features).select("column", "n_rows", "missing_count")


# ---------------------------------------------------------------- leakage


@query(
    "leakage_keywords",
    f"WITH {_LINES_KEYED} "
    "SELECT 'l_linestatus' AS \"column\", '(?i)status' AS keyword, count(l_linestatus) "
    "AS filled_rows FROM lines UNION ALL SELECT 'o_orderstatus', '(?i)status', "
    "count(o_orderstatus) FROM lines",
)
def leakage_keywords(spark, sf_dir):
    """Suspicious names, the label's own name included, and how much data they carry."""
    df = lines_with_orders(spark, sf_dir)
    return leak.keyword_report(df, df.columns, LINES_PARAMS.leakage_keywords)


@query(
    "leakage_candidates",
    f"WITH {_LINES_KEYED} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS filled_rows FROM lines" for c in _FEATURES
    ),
)
def leakage_candidates(spark, sf_dir):
    """Columns that are neither excluded nor free text."""
    df = lines_with_orders(spark, sf_dir)
    names = leak.candidates(df, LINES_SPEC)
    cells = [x for c in names for x in (F.lit(c), F.col(f"n_{c}"))]
    counted = df.agg(*[F.count(c).alias(f"n_{c}") for c in names])
    return counted.select(F.stack(F.lit(len(names)), *cells).alias("column", "filled_rows"))


def _pure_sql(source, columns, pos, neg, pos_name, neg_name, support):
    parts = [
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS level, "
        f"count(*) FILTER ({pos}) AS p, count(*) FILTER ({neg}) AS q FROM {source} GROUP BY {c}"
        for c in columns
    ]
    return (
        "SELECT \"column\", level, p + q AS support, "
        f"CASE WHEN p > 0 THEN '{pos_name}' ELSE '{neg_name}' END AS class_only FROM ("
        + " UNION ALL ".join(parts)
        + f") WHERE p + q >= {support} AND (p = 0) <> (q = 0)"
    )


_DOCS = "docs AS (SELECT * FROM documents JOIN labels USING (doc_id))"


@query(
    "pure_levels",
    f"WITH {_DOCS} "
    + _pure_sql("docs", ("lang", "source", "text"), "toxic = 1", "toxic = 0", "1", "0", 1),
)
def pure_levels(spark, sf_dir):
    """Levels, whole texts among them, that go with one class only."""
    return leak.pure_levels(
        labelled_documents(spark, sf_dir), DOCS_PARAMS.label, ["lang", "source", "text"], 1
    )


_INSTANT_SQL = r"regexp_replace(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '\.?0+$', '')"


@query(
    "pure_levels_of_dates",
    f"WITH timed AS (SELECT {_INSTANT_SQL} AS ts, event_type FROM events) "
    + _pure_sql(
        "timed", ("ts",), "event_type = 'click'", "event_type = 'error'", "click", "error", 1
    ),
)
def pure_levels_of_dates(spark, sf_dir):
    """Every instant is a level of its own; events of other types add no support."""
    rule = leak.LabelRule("event_type", ("click", "error"), "click")
    return leak.pure_levels(table(spark, sf_dir, "events"), rule, ["ts"], 1)


def auc_sql(source, columns, pos):
    """Exact AUC on average ranks, one column after the other."""
    parts = []
    for c in columns:
        parts.append(
            f"SELECT '{c}' AS \"column\", (sum(r) FILTER (y) - n_pos * (n_pos + 1) / 2.0) "
            "/ (CAST(n_pos AS DOUBLE) * n_neg) AS auc, n_pos, n_neg FROM ("
            f"SELECT y, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS r, "
            "count(*) FILTER (y) OVER () AS n_pos, count(*) FILTER (NOT y) OVER () AS n_neg "
            f"FROM (SELECT {c} AS v, {pos} AS y FROM {source} WHERE {c} IS NOT NULL)) "
            "GROUP BY n_pos, n_neg"
        )
    return (
        "SELECT \"column\", round(auc, 6) AS auc, round(greatest(auc, 1 - auc), 6) AS auroc, "
        "n_pos, n_neg FROM (" + " UNION ALL ".join(parts) + ")"
    )


_LINE_NUMBERS = (
    "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice",
)


@query("univariate_auc", f"WITH {LINES_SQL} " + auc_sql("lines", _LINE_NUMBERS, "l_linestatus = 'F'"))
def univariate_auc(spark, sf_dir):
    """AUC of every numeric candidate, in both directions."""
    df = lines_with_orders(spark, sf_dir)
    return leak.univariate_auc(df, LINES_PARAMS.label, _LINE_NUMBERS)


@query(
    "univariate_auc_documents",
    f"WITH {_DOCS} " + auc_sql("docs", ("n_chars", "quality"), "toxic = 1"),
)
def univariate_auc_documents(spark, sf_dir):
    docs = labelled_documents(spark, sf_dir)
    return leak.univariate_auc(docs, DOCS_PARAMS.label, ["n_chars", "quality"])


@query(
    "near_perfect_auc",
    f"WITH {LINES_SQL}, scored AS ("
    + auc_sql("lines", ("l_quantity", "price_again"), "l_extendedprice >= 50000").replace(
        "FROM lines", "FROM (SELECT *, l_extendedprice * 2 AS price_again FROM lines)"
    )
    + ") SELECT * FROM scored WHERE auroc >= 0.98",
)
def near_perfect_auc(spark, sf_dir):
    """A label derived from a price, and that price among the features."""
    df = lines_with_orders(spark, sf_dir).select(
        "l_quantity",
        (F.col("l_extendedprice") * 2).alias("price_again"),
        F.when(F.col("l_extendedprice") >= 50000, "Yes").otherwise("No").alias("dear"),
    )
    rule = leak.LabelRule("dear")
    return leak.near_perfect(df, rule, ["l_quantity", "price_again"])


@query(
    "auc_needs_clean_labels",
    "SELECT c AS \"column\", CAST(NULL AS DOUBLE) AS auc, CAST(NULL AS DOUBLE) AS auroc, "
    "CAST(NULL AS BIGINT) AS n_pos, CAST(NULL AS BIGINT) AS n_neg FROM "
    "(SELECT unnest(['n_chars', 'quality']) AS c) WHERE EXISTS (SELECT 1 FROM documents d "
    "LEFT JOIN labels l USING (doc_id) WHERE l.toxic IS NULL)",
)
def auc_needs_clean_labels(spark, sf_dir):
    """Unlabelled documents among the rows: the scan does not apply."""
    docs = labelled_documents(spark, sf_dir, "left")
    return leak.univariate_auc(docs, DOCS_PARAMS.label, ["n_chars", "quality"])


@query(
    "future_dates",
    f"WITH {LINES_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (year({c}) > 2000) AS future_year_gt, "
        f"count(*) FILTER ({c} > TIMESTAMP '{LINES_AS_OF}') AS after_now FROM lines"
        for c in ("l_shipdate", "o_orderdate")
    ),
)
def future_dates(spark, sf_dir):
    df = lines_with_orders(spark, sf_dir)
    return leak.future_dates(df, LINES_SPEC.with_role("date"), LINES_AS_OF, 2000)


@query(
    "date_order",
    f"WITH {LINES_SQL} SELECT 'o_orderdate' AS first, 'l_shipdate' AS second, "
    "count(*) FILTER (l_shipdate < o_orderdate) AS violations FROM lines",
)
def date_order(spark, sf_dir):
    """Lines shipped before they were ordered."""
    return leak.date_order(lines_with_orders(spark, sf_dir), LINES_PARAMS.date_order_pairs)


_LINE_LEVELS = ("l_returnflag", "o_orderstatus", "o_orderpriority")
_DATE_LEVELS = {
    "l_shipdate": "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')",
    "o_orderdate": "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')",
}
_ALL_PURE = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {expr} AS level, "
    "count(*) FILTER (l_linestatus = 'F') AS p, count(*) FILTER (l_linestatus = 'O') AS q "
    f"FROM lines GROUP BY {c}"
    for c, expr in {**{c: c for c in _LINE_LEVELS}, **_DATE_LEVELS}.items()
)
FINDINGS_SQL = f"""WITH {LINES_SQL}, auc AS ({auc_sql('lines', _LINE_NUMBERS, "l_linestatus = 'F'")}),
pure AS (SELECT * FROM ({_ALL_PURE}) WHERE p + q >= 20 AND (p = 0) <> (q = 0)),
findings AS (
SELECT 'keyword' AS "check", 'o_orderstatus' AS "column", '(?i)status' AS detail,
       CAST(NULL AS DOUBLE) AS amount
UNION ALL SELECT 'pure_level', "column",
       coalesce(level, '<null>') || ' -> ' || CASE WHEN p > 0 THEN 'F' ELSE 'O' END,
       CAST(p + q AS DOUBLE) FROM pure
UNION ALL SELECT CASE WHEN auroc >= 0.98 THEN 'near_perfect_auc' ELSE 'auc' END, "column", NULL,
       auroc FROM auc
UNION ALL SELECT 'future_year', c, NULL, n FROM (
  SELECT 'l_shipdate' AS c, count(*) FILTER (year(l_shipdate) > 2000) AS n FROM lines
  UNION ALL SELECT 'o_orderdate', count(*) FILTER (year(o_orderdate) > 2000) FROM lines) WHERE n > 0
UNION ALL SELECT 'after_now', c, NULL, n FROM (
  SELECT 'l_shipdate' AS c, count(*) FILTER (l_shipdate > TIMESTAMP '{LINES_AS_OF}') AS n FROM lines
  UNION ALL SELECT 'o_orderdate', count(*) FILTER (o_orderdate > TIMESTAMP '{LINES_AS_OF}')
  FROM lines) WHERE n > 0
UNION ALL SELECT 'date_order', 'o_orderdate', 'l_shipdate', n FROM (
  SELECT count(*) FILTER (l_shipdate < o_orderdate) AS n FROM lines) WHERE n > 0)"""


def findings_of_lines(spark, sf_dir, all_auc=True):
    df = lines_with_orders(spark, sf_dir)
    return leak.leakage_findings(df, LINES_SPEC, LINES_PARAMS, LINES_AS_OF, all_auc=all_auc)


def findings_of_documents(spark, sf_dir):
    """The flagship: every check over the labelled documents, AUC rows always listed."""
    docs = labelled_documents(spark, sf_dir)
    return leak.leakage_findings(
        docs, DOCS_SPEC, DOCS_PARAMS, "2026-01-01 00:00:00", all_auc=True
    )


@query(
    "leakage_findings",
    f'{FINDINGS_SQL} SELECT "check", "column", detail, round(amount, 6) AS amount FROM findings',
)
def leakage_findings(spark, sf_dir):
    """All checks over the joined order lines in one findings table."""
    return findings_of_lines(spark, sf_dir).withColumn("amount", F.round("amount", 6))


_DOC_FINDINGS_SQL = (
    f"WITH {_DOCS}, auc AS ({auc_sql('docs', ('n_chars', 'quality'), 'toxic = 1')}), findings AS ("
    "SELECT CASE WHEN auroc >= 0.98 THEN 'near_perfect_auc' ELSE 'auc' END AS \"check\", "
    '"column", CAST(NULL AS VARCHAR) AS detail, auroc AS amount FROM auc '
    "UNION ALL SELECT 'pure_level', \"column\", coalesce(level, '<null>') || ' -> ' || class_only, "
    "CAST(support AS DOUBLE) FROM ("
    + _pure_sql("docs", ("lang", "source"), "toxic = 1", "toxic = 0", "1", "0", 5)
    + "))"
)


@query("leakage_findings_documents", f"{_DOC_FINDINGS_SQL} SELECT * FROM findings")
def leakage_findings_documents(spark, sf_dir):
    return findings_of_documents(spark, sf_dir)


@query(
    "suspect_features",
    f"""{_DOC_FINDINGS_SQL} SELECT DISTINCT "column" FROM findings
WHERE "check" IN ('pure_level', 'near_perfect_auc')""",
)
def suspect_features(spark, sf_dir):
    return leak.suspect_features(findings_of_documents(spark, sf_dir))


@query(
    "leakage_status",
    f"""{FINDINGS_SQL} SELECT count(*) AS n_findings, CASE WHEN count(*) > 0
THEN 'needs_manual_review' ELSE 'no_leakage_detected' END AS status FROM findings
WHERE "check" <> 'auc'""",
)
def leakage_status(spark, sf_dir):
    return leak.leakage_status(findings_of_lines(spark, sf_dir, all_auc=False))


@query(
    "train_test_id_overlap",
    "WITH a AS (SELECT l_orderkey AS id, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' "
    "GROUP BY 1), b AS (SELECT l_orderkey AS id, count(*) AS n FROM lineitem "
    "WHERE l_linestatus = 'O' GROUP BY 1) SELECT count(*) AS shared_ids, "
    "coalesce(sum(a.n), 0) AS train_rows, coalesce(sum(b.n), 0) AS test_rows FROM a JOIN b USING (id)",
)
def train_test_id_overlap(spark, sf_dir):
    """Orders that occur on both sides of a split by line status."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linestatus")
    return leak.id_overlap(
        lines.where("l_linestatus = 'F'"), lines.where("l_linestatus = 'O'"), "l_orderkey"
    )
