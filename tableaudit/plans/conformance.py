"""Schema conformance, duplicates and keys."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..operators import conform, dedup
from ..operators.cast import cast_table
from ..spec import ColumnSpec, TableSpec
from .data import (
    DOCS_PARAMS,
    DOCS_SPEC,
    ORDERS_PARAMS,
    ORDERS_SPEC,
    CAST_SQL,
    SCANNED_SQL,
    SQL_SPACE,
    scanned_orders,
    table,
)
from .registry import query

# `@` stands for the column.
_TRIM = f"regexp_replace(@, '^{SQL_SPACE}+|{SQL_SPACE}+$', '', 'g')"
_FLOAT = r"[+-]?((\p{Nd}+(\.\p{Nd}*)?)|(\.\p{Nd}+))([eE][+-]?\p{Nd}+)?"
_BAD = {
    "int": rf"NOT regexp_full_match({_TRIM}, '[+-]?\p{{Nd}}+')",
    "float": f"NOT regexp_full_match({_TRIM}, '{_FLOAT}')",
    "datetime": "coalesce(try_strptime(@, '%Y-%m-%d'), try_strptime(@, '%d/%m/%Y')) IS NULL",
}


def _probe_sql(columns: list[tuple[str, str]]) -> str:
    parts = []
    for name, kind in columns:
        bad = _BAD.get(kind, "FALSE").replace("@", name)
        parts.append(
            f"SELECT '{name}' AS \"column\", '{kind}' AS expected, count({name}) AS checked, "
            f"count(*) FILTER ({name} IS NOT NULL AND {bad}) AS fails FROM scanned"
        )
    return (
        "SELECT *, round(coalesce(fails / nullif(checked, 0), 0), 6) AS cast_fail_rate, "
        "CASE WHEN coalesce(fails / nullif(checked, 0), 0) > 0.02 "
        "AND expected IN ('int', 'float', 'datetime') THEN 'mismatch' "
        "WHEN fails > 0 THEN 'warning' ELSE 'ok' END AS severity FROM ("
        + " UNION ALL ".join(parts)
        + ")"
    )


ALL_COLUMNS = [(c.name, c.type) for c in ORDERS_SPEC.columns if c.name != "channel"]
PROBES_SQL = _probe_sql(ALL_COLUMNS)


def _only(*columns: ColumnSpec) -> TableSpec:
    return TableSpec(columns)


@query(
    "schema_column_differences",
    f"""WITH {SCANNED_SQL}
SELECT 'channel' AS "column", 'missing' AS difference, CAST(NULL AS BIGINT) AS filled_rows
UNION ALL SELECT 'balance', 'unexpected', count(*) FILTER (coalesce(balance, '') <> '') FROM scanned
UNION ALL SELECT 'priority', 'unexpected', count(*) FILTER (coalesce(priority, '') <> '')
FROM scanned""",
)
def schema_column_differences(spark, sf_dir):
    return conform.column_differences(scanned_orders(spark, sf_dir), ORDERS_SPEC)


@query(
    "critical_column_gate",
    f"""WITH {SCANNED_SQL}
SELECT 'fail' AS status, count(*) AS n_rows, 1 AS n_missing_critical FROM scanned""",
)
def critical_column_gate(spark, sf_dir):
    """The label is taken away: the verdict is ``fail``."""
    df = scanned_orders(spark, sf_dir).drop("churned")
    return conform.conformance(df, ORDERS_SPEC, ORDERS_PARAMS).select(
        "status", "n_rows", "n_missing_critical"
    )


@query(
    "integer_probe",
    f"WITH {SCANNED_SQL} "
    + _probe_sql([("quantity", "int"), ("order_id", "int"), ("total", "int")]),
)
def integer_probe(spark, sf_dir):
    spec = _only(*[ColumnSpec(c, "int") for c in ("quantity", "order_id", "total")])
    return conform.parse_report(scanned_orders(spark, sf_dir), spec)


@query(
    "float_probe",
    f"WITH {SCANNED_SQL} "
    + _probe_sql([("quantity", "float"), ("total", "float"), ("balance", "float")]),
)
def float_probe(spark, sf_dir):
    spec = _only(*[ColumnSpec(c, "float") for c in ("quantity", "total", "balance")])
    return conform.parse_report(scanned_orders(spark, sf_dir), spec)


@query("datetime_probe", f"WITH {SCANNED_SQL} " + _probe_sql([("order_date", "datetime")]))
def datetime_probe(spark, sf_dir):
    spec = _only(ColumnSpec("order_date", "datetime"))
    return conform.parse_report(scanned_orders(spark, sf_dir), spec)


@query(
    "untested_types_pass",
    f"WITH {SCANNED_SQL} "
    + _probe_sql([("segment", "category"), ("customer_name", "string"), ("express", "bool")]),
)
def untested_types_pass(spark, sf_dir):
    spec = _only(
        ColumnSpec("segment", "category"),
        ColumnSpec("customer_name", "string"),
        ColumnSpec("express", "bool"),
    )
    return conform.parse_report(scanned_orders(spark, sf_dir), spec)


@query("parse_report", f"WITH {SCANNED_SQL} {PROBES_SQL}")
def parse_report(spark, sf_dir):
    return conform.parse_report(scanned_orders(spark, sf_dir), ORDERS_SPEC, ORDERS_PARAMS)


@query(
    "text_length_limit",
    "SELECT 'text' AS \"column\", 4000 AS max_len, count(*) FILTER (length(text) > 4000) "
    "AS over_limit FROM documents",
)
def text_length_limit(spark, sf_dir):
    return conform.length_report(table(spark, sf_dir, "documents"), DOCS_SPEC, DOCS_PARAMS)


@query(
    "declared_length_limit",
    f"WITH {SCANNED_SQL} SELECT 'customer_name' AS \"column\", 18 AS max_len, "
    "count(*) FILTER (length(customer_name) > 18) AS over_limit FROM scanned",
)
def declared_length_limit(spark, sf_dir):
    return conform.length_report(scanned_orders(spark, sf_dir), ORDERS_SPEC, ORDERS_PARAMS)


@query(
    "conformance_status",
    f"""WITH {SCANNED_SQL}, probes AS ({PROBES_SQL})
SELECT 'warn' AS status, (SELECT count(*) FROM scanned) AS n_rows, 10 AS n_cols, 1 AS n_missing,
       2 AS n_unexpected, 0 AS n_missing_critical,
       count(*) FILTER (severity = 'mismatch') AS n_mismatch,
       count(*) FILTER (severity = 'warning') AS n_warning FROM probes""",
)
def conformance_status(spark, sf_dir):
    return conform.conformance(scanned_orders(spark, sf_dir), ORDERS_SPEC, ORDERS_PARAMS)


_STRICT = ("order_id", "churned", "segment", "quantity", "order_date")


@query(
    "declared_nullability",
    f"WITH {SCANNED_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (coalesce({c}, '') = '') AS nulls, "
        f"count(*) FILTER (coalesce({c}, '') = '') = 0 AS ok FROM scanned"
        for c in _STRICT
    ),
)
def declared_nullability(spark, sf_dir):
    return conform.nullability_report(scanned_orders(spark, sf_dir), ORDERS_SPEC)


_AFTER = {
    "order_id": ("string", "string"), "churned": ("category", "category"),
    "customer_name": ("string", "string"), "segment": ("category", "category"),
    "total": ("float", "float"), "quantity": ("int", "int"),
    "order_date": ("datetime", "datetime"), "express": ("bool", "bool"),
}


@query(
    "types_after_cast",
    f"WITH {CAST_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{e}' AS expected, '{f}' AS found, TRUE AS ok, "
        f"count({c}) AS non_null FROM typed"
        for c, (e, f) in _AFTER.items()
    )
    + " UNION ALL SELECT 'channel', 'category', NULL, FALSE, NULL",
)
def types_after_cast(spark, sf_dir):
    typed = cast_table(scanned_orders(spark, sf_dir), ORDERS_SPEC, ORDERS_PARAMS)
    return conform.type_report(typed, ORDERS_SPEC)


# ---------------------------------------------------------------- duplicates and keys


@query(
    "missing_keys",
    f"WITH {SCANNED_SQL} SELECT count(*) AS n_rows, "
    "count(*) FILTER (coalesce(order_id, '') = '') AS missing_keys FROM scanned",
)
def missing_keys(spark, sf_dir):
    df = scanned_orders(spark, sf_dir)
    return dedup.missing_keys(df, dedup.require_key(df, ORDERS_SPEC, ORDERS_PARAMS))


@query("drop_exact_duplicates", f"WITH {SCANNED_SQL} SELECT DISTINCT * FROM scanned")
def drop_exact_duplicates(spark, sf_dir):
    return dedup.drop_exact_duplicates(scanned_orders(spark, sf_dir))


@query(
    "duplicate_documents",
    "SELECT sum(n) AS rows_before, count(*) AS rows_after, sum(n - 1) AS duplicates_removed, "
    "count(*) FILTER (n > 1) AS duplicate_groups FROM "
    "(SELECT text, lang, count(*) AS n FROM documents GROUP BY text, lang)",
)
def duplicate_documents(spark, sf_dir):
    """Exact copies by whole text."""
    return dedup.duplicate_counts(table(spark, sf_dir, "documents").select("text", "lang"))


_LINE_COLUMNS = (
    "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)


def _diff_sql(columns, limit: int) -> str:
    """The first ``limit`` columns with more than one value, null counting as a value."""
    names = ", ".join(
        f"CASE WHEN count(DISTINCT {c}) + CAST(count(*) > count({c}) AS INT) > 1 "
        f"THEN '{c}' END"
        for c in columns
    )
    return f"array_to_string([x FOR x IN [{names}] IF x IS NOT NULL][1:{limit}], ',')"


@query(
    "key_conflicts",
    f"SELECT l_orderkey, count(*) AS row_count, {_diff_sql(_LINE_COLUMNS, 10)} AS diff_columns "
    "FROM (SELECT DISTINCT * FROM lineitem) GROUP BY l_orderkey HAVING count(*) > 1",
)
def key_conflicts(spark, sf_dir):
    """Order lines by order: each key with several rows and the columns that differ."""
    report = dedup.key_conflicts(table(spark, sf_dir, "lineitem"), "l_orderkey")
    return report.withColumn("diff_columns", F.array_join("diff_columns", ","))


_ORDER_COLUMNS = (
    "customer_name", "segment", "total", "quantity", "order_date", "churned", "express",
    "balance", "priority",
)


@query(
    "key_conflicts_with_null_key",
    f"WITH {SCANNED_SQL} SELECT order_id, count(*) AS row_count, {_diff_sql(_ORDER_COLUMNS, 3)} "
    "AS diff_columns FROM (SELECT DISTINCT * FROM scanned) GROUP BY order_id HAVING count(*) > 1",
)
def key_conflicts_with_null_key(spark, sf_dir):
    """Rows without a key share the null key."""
    report = dedup.key_conflicts(scanned_orders(spark, sf_dir), "order_id", 3)
    return report.withColumn("diff_columns", F.array_join("diff_columns", ","))


@query(
    "conflict_samples",
    f"SELECT l_partkey, count(*) AS row_count, "
    f"{_diff_sql(('l_orderkey',) + _LINE_COLUMNS[1:], 10)} AS diff_columns FROM "
    "(SELECT DISTINCT * FROM lineitem) GROUP BY l_partkey HAVING count(*) > 1 "
    "ORDER BY l_partkey LIMIT 10",
)
def conflict_samples(spark, sf_dir):
    report = dedup.conflict_samples(table(spark, sf_dir, "lineitem"), "l_partkey", 10)
    return report.withColumn("diff_columns", F.array_join("diff_columns", ","))


@query(
    "dedup_summary",
    f"""WITH {SCANNED_SQL},
rows AS (SELECT {', '.join(('order_id',) + _ORDER_COLUMNS)}, count(*) AS n FROM scanned GROUP BY ALL),
keys AS (SELECT order_id, count(*) AS kept, sum(n) AS total_rows FROM rows GROUP BY order_id)
SELECT (SELECT sum(n) FROM rows) AS n_rows_raw, (SELECT count(*) FROM rows) AS n_rows_clean,
  (SELECT sum(n - 1) FROM rows) AS duplicates_exact_removed,
  (SELECT count(*) FROM rows WHERE n > 1) AS duplicates_exact_groups,
  (SELECT count(*) FROM keys WHERE kept > 1) AS key_conflict_groups,
  (SELECT coalesce(sum(kept), 0) FROM keys WHERE kept > 1) AS key_conflict_rows,
  (SELECT coalesce(sum(total_rows), 0) FROM keys WHERE coalesce(order_id, '') = '') AS key_null_count,
  10 AS n_cols,
  CASE WHEN (SELECT count(*) FROM keys WHERE kept > 1) > 0 THEN 'fail' ELSE 'ok' END AS status""",
)
def dedup_summary(spark, sf_dir):
    strict = replace(ORDERS_PARAMS, fail_on_key_conflicts=True)
    return dedup.dedup_summary(scanned_orders(spark, sf_dir), "order_id", strict)
