"""Column profiles, label and missingness."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import label as lab
from ..operators import missingness as miss
from ..operators import profile as prof
from ..operators import sketches
from ..operators.cast import cast_table
from ..session import shared_folder, small_frame
from ..sources.manifest import list_files
from ..spec import LabelRule
from .data import (
    CAST_SQL,
    LABEL,
    ORDERS_PARAMS,
    ORDERS_SPEC,
    RAW_COLUMNS,
    SCANNED_SQL,
    labelled_documents,
    scanned_orders,
    table,
)
from .registry import query
from .scans import missing_sql

QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
_NAMES = [prof.quantile_name(q) for q in QUANTILES]
FIGURES = ("min", "max", "mean", "std", *_NAMES)


def _rounded(df, *names):
    return df.select(*[F.round(c, 7).alias(c) if c in names else c for c in df.columns])


def numeric_sql(source: str, columns: dict[str, str]) -> str:
    parts = []
    for c, kind in columns.items():
        quantiles = ", ".join(
            f"round(quantile_cont(CAST({c} AS DOUBLE), {q}), 7) AS {n}"
            for q, n in zip(QUANTILES, _NAMES)
        )
        parts.append(
            f"SELECT '{c}' AS \"column\", '{kind}' AS type, count(*) AS count, "
            f"round(1 - count({c}) / count(*), 6) AS missing_share, "
            f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
            f"round(avg({c}), 7) AS mean, round(stddev_samp({c}), 7) AS std, "
            f"count(DISTINCT {c}) AS n_unique, {quantiles} FROM {source}"
        )
    return " UNION ALL ".join(parts)


def levels_sql(source: str, columns) -> str:
    """(column, level, n) over the present levels."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS level, count(*) AS n "
        f"FROM {source} WHERE coalesce(CAST({c} AS VARCHAR), '') <> '' GROUP BY {c}"
        for c in columns
    )


def top_sql(k: int) -> str:
    return (
        'SELECT "column", position, level, n, round(n / total, 6) AS share FROM ('
        'SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, level) AS position, '
        'sum(n) OVER (PARTITION BY "column") AS total FROM levels) '
        f"WHERE position <= {k}"
    )


def categorical_sql(source: str, columns: dict[str, str], rare: float) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{kind}' AS type, count(*) AS count, "
        f"count(*) FILTER (coalesce(CAST({c} AS VARCHAR), '') = '') AS missing FROM {source}"
        for c, kind in columns.items()
    )
    return (
        f"SELECT r.\"column\", r.type, r.count, count(l.level) AS n_unique, "
        f"round(coalesce(sum(l.n) FILTER (l.n / t.total < {rare}), 0) / max(t.total), 6) "
        f"AS rare_share, round(r.missing / r.count, 6) AS missing_share "
        f"FROM ({rows}) r LEFT JOIN levels l ON l.\"column\" = r.\"column\" "
        f"LEFT JOIN (SELECT \"column\", sum(n) AS total FROM levels GROUP BY 1) t "
        f"ON t.\"column\" = r.\"column\" GROUP BY r.\"column\", r.type, r.count, r.missing"
    )


LINE_FAMILIES = {"int": 4, "float": 4, "bool": 0, "category": 0, "string": 2, "datetime": 1}
LINE_NUMBERS = {
    "l_orderkey": "int", "l_partkey": "int", "l_suppkey": "int", "l_linenumber": "int",
    "l_quantity": "float", "l_extendedprice": "float", "l_discount": "float", "l_tax": "float",
}


@query(
    "profile_overview",
    " UNION ALL ".join(
        f"SELECT '{f}' AS family, {n} AS n_columns, count(*) AS n_rows, 11 AS n_cols FROM lineitem"
        for f, n in LINE_FAMILIES.items()
    ),
)
def profile_overview(spark, sf_dir):
    """Rows, columns and columns per type family."""
    return prof.overview(table(spark, sf_dir, "lineitem"))


@query(
    "profile_overview_after_cast",
    f"WITH {CAST_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{f}' AS family, {n} AS n_columns, count(*) AS n_rows, 10 AS n_cols FROM typed"
        for f, n in {
            "int": 1, "float": 1, "bool": 1, "category": 2, "string": 4, "datetime": 1,
        }.items()
    ),
)
def profile_overview_after_cast(spark, sf_dir):
    typed = cast_table(scanned_orders(spark, sf_dir), ORDERS_SPEC, ORDERS_PARAMS)
    return prof.overview(typed)


@query("numeric_profile", numeric_sql("lineitem", LINE_NUMBERS))
def numeric_profile(spark, sf_dir):
    """Moments, exact distinct counts and exact quantiles of all numeric columns."""
    return _rounded(prof.numeric_profile(table(spark, sf_dir, "lineitem")), *FIGURES)


@query(
    "numeric_profile_with_nulls",
    f"WITH {CAST_SQL} {numeric_sql('typed', {'total': 'float', 'quantity': 'int'})}",
)
def numeric_profile_with_nulls(spark, sf_dir):
    typed = cast_table(scanned_orders(spark, sf_dir), ORDERS_SPEC, ORDERS_PARAMS)
    return _rounded(prof.numeric_profile(typed, ["total", "quantity"]), *FIGURES)


@query(
    "numeric_profile_sketch",
    "SELECT \"column\", type, count, missing_share, min, max, mean, std, TRUE AS n_unique_close, "
    f"TRUE AS quantiles_close FROM ({numeric_sql('lineitem', LINE_NUMBERS)})",
)
def numeric_profile_sketch(spark, sf_dir):
    """The single-pass mode: exact figures, and whether its estimates keep what they promise.

    A quantile's rank may be off by a thousandth of the rows, and a distinct count
    by four times the sketch's deviation of five per cent.
    """
    lines = table(spark, sf_dir, "lineitem")
    return _checked(prof.numeric_profile(lines, approx=True), lines, 0.001, 0.2)


def _checked(found, lines, rank_error, distinct_error):
    """The exact figures of a profile, and whether its estimates are within their errors.

    Ranks and distinct values come from one count of the values of each column.
    """
    estimates = found.collect()  # one row per column
    cells = []
    for i, r in enumerate(estimates):
        value = F.col(r["column"])
        integral = isinstance(lines.schema[r["column"]].dataType, T.IntegralType)
        whole = value.cast("bigint") if integral else F.lit(None).cast("bigint")
        cells += [F.lit(i), whole, F.lit(None).cast("double") if integral else value.cast("double")]
    long = lines.select(F.stack(F.lit(len(estimates)), *cells).alias("slot", "whole", "fraction"))
    counts = long.where("whole IS NOT NULL OR fraction IS NOT NULL").groupBy("slot", "whole", "fraction").agg(
        F.count(F.lit(1)).alias("n")
    )
    number = F.coalesce(F.col("whole").cast("double"), F.col("fraction"))
    slots = [(i, r["column"], r["count"], r["n_unique"], [r[name] for name in _NAMES]) for i, r in enumerate(estimates)]
    # One row per column.
    grid = small_frame(lines.sparkSession, slots, "slot int, column string, rows bigint, guess bigint, at array<double>")
    ranks = []
    for k in range(len(_NAMES)):
        below, upto = number < F.col("at")[k], number <= F.col("at")[k]
        ranks += [F.sum(F.when(below, F.col("n"))).alias(f"b{k}"), F.sum(F.when(upto, F.col("n"))).alias(f"u{k}")]
    sums = counts.join(F.broadcast(grid.select("slot", "at")), "slot").groupBy("slot").agg(
        F.count(F.lit(1)).alias("distinct"), F.sum("n").alias("total"), *ranks
    )
    near = F.lit(True)
    for k, q in enumerate(QUANTILES):
        below, upto = (F.coalesce(F.col(f"{x}{k}"), F.lit(0)) / F.nullif(F.col("total"), F.lit(0)) for x in "bu")
        slack = F.lit(rank_error) + F.lit(1.0) / F.greatest("rows", F.lit(1))
        near = near & (below <= F.lit(q) + slack) & (upto >= F.lit(q) - slack)
    distinct = F.coalesce("distinct", F.lit(0))
    unique = F.abs(distinct - F.col("guess")) <= distinct_error * distinct + 1
    close = grid.join(F.broadcast(sums), "slot", "left").select(
        "column", unique.alias("n_unique_close"), near.alias("quantiles_close")
    )
    figures = small_frame(lines.sparkSession, [tuple(r) for r in estimates], found.schema)
    return _rounded(figures, "mean", "std").join(close, "column").select(
        "column", "type", "count", "missing_share", "min", "max", "mean", "std", "n_unique_close", "quantiles_close"
    )


@query(
    "numeric_profile_merged",
    "SELECT \"column\", type, count, missing_share, min, max, mean, std, TRUE AS n_unique_close, "
    f"TRUE AS quantiles_close FROM ({numeric_sql('lineitem', LINE_NUMBERS)})",
)
def numeric_profile_merged(spark, sf_dir):
    """A profile merged from sketches of files that came in two deliveries.

    A quantile's rank may be off by a hundredth of the rows, and a distinct count
    by four times the sketch's deviation of 1.6 per cent.
    """
    lines = table(spark, sf_dir, "lineitem")
    data, store = shared_folder(spark, "deliveries"), shared_folder(spark, "sketches")
    for part in (0, 1):
        delivery = lines.where(F.pmod(F.xxhash64("l_orderkey"), F.lit(2)) == part)
        delivery.write.mode("append").parquet(data)
        sketches.update_sketches(spark, [data], store)
    merged = sketches.merged_profile(sketches.stored_sketches(spark, store), list_files(spark, [data]), QUANTILES)
    return _checked(merged, lines, 0.01, 0.065)


@query(
    "quantiles",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {q} AS q, round(quantile_cont({c}, {q}), 6) AS value "
        "FROM events"
        for c in ("value",)
        for q in (0.0, 0.01, 0.1, 0.5, 0.9, 0.99, 1.0)
    ),
)
def quantiles(spark, sf_dir):
    """Interpolated quantiles of one column, extremes included."""
    grid = (0.0, 0.01, 0.1, 0.5, 0.9, 0.99, 1.0)
    wide = prof.numeric_profile(table(spark, sf_dir, "events"), ["value"], grid)
    cells = [x for q in grid for x in (F.lit(q), F.col(prof.quantile_name(q)))]
    return wide.select("column", F.stack(F.lit(len(grid)), *cells).alias("q", "value")).select(
        "column", "q", F.round("value", 6).alias("value")
    )


TOP_COLUMNS = ("o_orderstatus", "o_orderpriority")


@query("top_levels", f"WITH levels AS ({levels_sql('orders', TOP_COLUMNS)}) {top_sql(10)}")
def top_levels(spark, sf_dir):
    return prof.top_levels(table(spark, sf_dir, "orders"), TOP_COLUMNS)


@query(
    "top_levels_many",
    f"WITH {SCANNED_SQL}, levels AS ({levels_sql('scanned', ('customer_name', 'order_date'))}) "
    + top_sql(25),
)
def top_levels_many(spark, sf_dir):
    """Columns with many levels; ties are ordered by level."""
    return prof.top_levels(scanned_orders(spark, sf_dir), ["customer_name", "order_date"], 25)


_SCANNED_LEVELS = {c: "string" for c in ("segment", "churned", "order_date", "quantity")}


@query(
    "categorical_profile",
    f"WITH {SCANNED_SQL}, levels AS ({levels_sql('scanned', _SCANNED_LEVELS)}) "
    + categorical_sql("scanned", _SCANNED_LEVELS, 0.01),
)
def categorical_profile(spark, sf_dir):
    """Distinct levels, rare share and missing share."""
    wide = prof.categorical_profile(scanned_orders(spark, sf_dir), list(_SCANNED_LEVELS))
    return wide.drop("top_levels")


@query(
    "rare_levels",
    f"WITH levels AS ({levels_sql('documents', ('lang', 'source'))}) "
    + categorical_sql("documents", {"lang": "string", "source": "string"}, 0.2),
)
def rare_levels(spark, sf_dir):
    wide = prof.categorical_profile(
        table(spark, sf_dir, "documents"), ["lang", "source"], rare_level=0.2
    )
    return wide.drop("top_levels")


_RARE_COLUMNS = ("customer_name", "segment", "order_date", "total")


@query(
    "rare_shares",
    f"""WITH {SCANNED_SQL}, levels AS ({levels_sql('scanned', _RARE_COLUMNS)}),
sized AS (SELECT *, sum(n) OVER (PARTITION BY "column") AS n_valid FROM levels)
SELECT "column", CAST(max(n_valid) AS BIGINT) AS n_valid, count(*) FILTER (n / n_valid >= 0.01) AS frequent_levels,
  round(sum(CASE WHEN n / n_valid < 0.01 THEN n ELSE 0 END) / max(n_valid), 6) AS rare_share
FROM sized GROUP BY "column\"""",
)
def rare_shares(spark, sf_dir):
    """Rare share of columns with few and with nearly unique levels; only frequent levels are shuffled."""
    return prof.rare_shares(scanned_orders(spark, sf_dir), _RARE_COLUMNS)


@query(
    "top_levels_pruned",
    f"WITH {SCANNED_SQL}, levels AS ({levels_sql('scanned', ('quantity', 'order_date', 'total'))}) " + top_sql(5),
)
def top_levels_pruned(spark, sf_dir):
    """Top levels of columns whose tail is left out before the shuffle."""
    return prof.top_levels_pruned(scanned_orders(spark, sf_dir), ["quantity", "order_date", "total"], 5)


@query(
    "datetime_profile",
    "SELECT 'ts' AS \"column\", 'datetime' AS type, count(*) AS count, "
    "round(1 - count(ts) / count(*), 6) AS missing_share, "
    "strftime(min(ts), '%Y-%m-%dT%H:%M:%S.%f') AS min, "
    "strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%f') AS max FROM events",
)
def datetime_profile(spark, sf_dir):
    return prof.datetime_profile(table(spark, sf_dir, "events"))


@query(
    "boolean_profile",
    f"WITH {CAST_SQL} SELECT 'express' AS \"column\", 'bool' AS type, count(*) AS count, "
    "round(count(*) FILTER (express) / count(*), 6) AS true_share, "
    "round(1 - count(express) / count(*), 6) AS missing_share FROM typed",
)
def boolean_profile(spark, sf_dir):
    typed = cast_table(scanned_orders(spark, sf_dir), ORDERS_SPEC, ORDERS_PARAMS)
    return prof.boolean_profile(typed)


def _melt_sql(inner: str, numbers, texts) -> str:
    parts = [
        f"SELECT \"column\", '{m}' AS metric, CAST({m} AS DOUBLE) AS number, "
        f"CAST(NULL AS VARCHAR) AS text FROM ({inner}) WHERE {m} IS NOT NULL"
        for m in numbers
    ] + [
        f"SELECT \"column\", '{m}', CAST(NULL AS DOUBLE), {m} FROM ({inner}) WHERE {m} IS NOT NULL"
        for m in texts
    ]
    return " UNION ALL ".join(parts)


_TYPED_NUMBERS = {"total": "float", "quantity": "int"}
_TYPED_LEVELS = {
    "order_id": "string", "customer_name": "string", "segment": "category",
    "churned": "category", "balance": "string", "priority": "string",
}
_TYPED_DATES = (
    "SELECT 'order_date' AS \"column\", 'datetime' AS type, count(*) AS count, "
    "round(1 - count(order_date) / count(*), 6) AS missing_share, "
    "strftime(min(order_date), '%Y-%m-%dT%H:%M:%S.%f') AS min, "
    "strftime(max(order_date), '%Y-%m-%dT%H:%M:%S.%f') AS max FROM typed"
)
_TYPED_FLAGS = (
    "SELECT 'express' AS \"column\", 'bool' AS type, count(*) AS count, "
    "round(count(*) FILTER (express) / count(*), 6) AS true_share, "
    "round(1 - count(express) / count(*), 6) AS missing_share FROM typed"
)


@query(
    "profile_table",
    f"WITH {CAST_SQL}, levels AS ({levels_sql('typed', _TYPED_LEVELS)}) "
    + " UNION ALL ".join(
        [
            _melt_sql(
                numeric_sql("typed", _TYPED_NUMBERS),
                ("count", "missing_share", "n_unique", *FIGURES),
                ("type",),
            ),
            _melt_sql(
                categorical_sql("typed", _TYPED_LEVELS, 0.01),
                ("count", "n_unique", "rare_share", "missing_share"),
                ("type",),
            ),
            f"SELECT \"column\", 'top_' || position, share, level FROM ({top_sql(10)})",
            _melt_sql(_TYPED_DATES, ("count", "missing_share"), ("type", "min", "max")),
            _melt_sql(_TYPED_FLAGS, ("count", "true_share", "missing_share"), ("type",)),
        ]
    ),
)
def profile_table(spark, sf_dir):
    """Every column of a typed table by its family, as long rows."""
    typed = cast_table(scanned_orders(spark, sf_dir), ORDERS_SPEC, ORDERS_PARAMS)
    return _rounded(prof.profile_table(typed, ORDERS_PARAMS), "number")


# ---------------------------------------------------------------- label and missingness


@query(
    "label_summary",
    f"""WITH {SCANNED_SQL}, c AS (SELECT count(*) AS n_rows,
  count(*) FILTER (coalesce(churned, '') = '') AS null_count,
  count(*) FILTER (churned IN ('Yes', 'No')) AS valid_count,
  count(*) FILTER (churned <> '' AND churned NOT IN ('Yes', 'No')) AS invalid_count,
  count(*) FILTER (churned = 'Yes') AS positive_count FROM scanned)
SELECT 'churned' AS "column", *, round(positive_count / valid_count, 6) AS positive_share,
  round(positive_count / n_rows, 6) AS positive_share_all,
  CASE WHEN invalid_count > 0 THEN 'invalid_label_values' ELSE 'ok' END AS status FROM c""",
)
def label_summary(spark, sf_dir):
    """Null, valid and invalid labels; positive share over valid and over all rows."""
    return lab.label_summary(scanned_orders(spark, sf_dir), LABEL)


@query(
    "label_summary_numeric",
    """WITH c AS (SELECT count(*) AS n_rows, 0 AS null_count, count(toxic) AS valid_count,
  0 AS invalid_count, count(*) FILTER (toxic = 1) AS positive_count FROM labels)
SELECT 'toxic' AS "column", *, round(positive_count / valid_count, 6) AS positive_share,
  round(positive_count / n_rows, 6) AS positive_share_all, 'ok' AS status FROM c""",
)
def label_summary_numeric(spark, sf_dir):
    return lab.label_summary(table(spark, sf_dir, "labels"), LabelRule("toxic", ("0", "1"), "1"))


@query(
    "class_counts",
    f"WITH {SCANNED_SQL} SELECT 'Yes' AS class, count(*) FILTER (churned = 'Yes') AS n FROM scanned "
    "UNION ALL SELECT 'No', count(*) FILTER (churned = 'No') FROM scanned "
    "UNION ALL SELECT 'Unknown', count(*) FILTER (churned = 'Unknown') FROM scanned",
)
def class_counts(spark, sf_dir):
    """An allowed class that never occurs is listed with zero."""
    rule = LabelRule("churned", ("Yes", "No", "Unknown"), "Yes")
    return lab.class_counts(scanned_orders(spark, sf_dir), rule)


@query(
    "invalid_label_samples",
    f"WITH {SCANNED_SQL} SELECT churned AS label FROM scanned WHERE churned <> '' "
    "AND churned NOT IN ('Yes', 'No') ORDER BY churned LIMIT 5",
)
def invalid_label_samples(spark, sf_dir):
    return lab.invalid_samples(scanned_orders(spark, sf_dir), LABEL)


_DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
_DOCS_LEFT = "docs AS (SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id))"
_MISSING_DOCS = (
    f"SELECT *, missing_count = n_rows AS fully_missing, missing_share >= 0.4 AS high_missing "
    f"FROM ({missing_sql('docs', _DOC_COLUMNS)})"
)


@query("missingness", f"WITH {_DOCS_LEFT} {_MISSING_DOCS}")
def missingness(spark, sf_dir):
    """Missing count and share of every column, with the notice flags."""
    return miss.missingness(labelled_documents(spark, sf_dir, "left"))


@query(
    "top_missing",
    f"WITH {_DOCS_LEFT} SELECT * FROM ({_MISSING_DOCS}) "
    "ORDER BY missing_share DESC, ordinal LIMIT 5",
)
def top_missing(spark, sf_dir):
    return miss.top_missing(miss.missingness(labelled_documents(spark, sf_dir, "left")))


@query(
    "missing_delta",
    f"WITH {CAST_SQL}, b AS ({missing_sql('scanned', RAW_COLUMNS)}), "
    f"a AS ({missing_sql('typed', RAW_COLUMNS)}) SELECT \"column\", "
    "round(b.missing_count / b.n_rows, 6) AS before, round(a.missing_count / a.n_rows, 6) AS after, "
    "round(a.missing_count / a.n_rows - b.missing_count / b.n_rows, 6) AS delta "
    "FROM a JOIN b USING (\"column\")",
)
def missing_delta(spark, sf_dir):
    """What the cast cost each column."""
    before = scanned_orders(spark, sf_dir)
    return miss.missing_delta(before, cast_table(before, ORDERS_SPEC, ORDERS_PARAMS))
