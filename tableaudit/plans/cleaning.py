"""Text hygiene and casting."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..functions.text import normalize
from ..operators import dateformats
from ..operators.cast import cast_log as log_of_cast
from ..operators.cast import cast_and_write, cast_table, decide, text_hygiene
from ..session import shared_folder
from ..sources.tables import read_table
from ..spec import AuditParams, ColumnSpec, TableSpec
from .data import (
    CANONICAL_SQL,
    CAST_SQL,
    CLEAN_SQL,
    ORDERS_PARAMS,
    ORDERS_SPEC,
    RAW_COLUMNS,
    scanned_orders,
    sql_double,
    sql_long,
    table,
)
from .registry import query


def _one(name: str, kind: str) -> TableSpec:
    return TableSpec((ColumnSpec(name, kind),))


def _cast_counts(spark, sf_dir, name, kind, params=ORDERS_PARAMS, per_row=False):
    """How often each raw text became which value."""
    raw = scanned_orders(spark, sf_dir).select(name, F.col(name).alias("raw"))
    spec = _one(name, kind)
    rules = decide(raw, spec, params, per_row=per_row)
    typed = cast_table(raw, spec, params, rules)
    return typed.groupBy("raw", F.col(name).alias("value")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "text_normalize",
    f"WITH {CLEAN_SQL} SELECT customer_name, segment, express, count(*) AS n FROM clean GROUP BY ALL",
)
def text_normalize(spark, sf_dir):
    """Hard spaces, edges, NFKC."""
    names = ("customer_name", "segment", "express")
    df = scanned_orders(spark, sf_dir).select(*[normalize(F.col(c)).alias(c) for c in names])
    return df.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))


@query(
    "changed_cells",
    f"WITH {CLEAN_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (r_{c} <> {c}) AS trimmed FROM clean"
        for c in ("customer_name", "segment", "express")
    ),
)
def changed_cells(spark, sf_dir):
    """Cells that hygiene changed, per column."""
    spec = TableSpec(
        tuple(ColumnSpec(c, "string") for c in ("customer_name", "segment", "express"))
    )
    return log_of_cast(scanned_orders(spark, sf_dir), spec).select("column", "trimmed")


@query(
    "canonical_case",
    f"WITH {CLEAN_SQL} SELECT segment AS raw, {CANONICAL_SQL.format('segment')} AS value, "
    "count(*) AS n FROM clean GROUP BY ALL",
)
def canonical_case(spark, sf_dir):
    df = scanned_orders(spark, sf_dir).select("segment")
    df = df.withColumn("raw", normalize(F.col("segment")))
    typed = cast_table(df, _one("segment", "category"), ORDERS_PARAMS)
    return typed.groupBy("raw", F.col("segment").alias("value")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "thousands_separators",
    f"WITH {CLEAN_SQL} SELECT total AS raw, {sql_double(chr(34) + 'plain' + chr(34))} AS value, "
    "count(*) AS n FROM (SELECT total, replace(total, ',', '') AS plain FROM clean) GROUP BY ALL",
)
def thousands_separators(spark, sf_dir):
    """Commas between thousands; ``n/a`` is a null token, ``12d`` is no number."""
    return _cast_counts(spark, sf_dir, "total", "float")


@query(
    "decimal_comma",
    f"WITH {CLEAN_SQL} SELECT balance AS raw, {sql_double('plain')} AS value, count(*) AS n FROM "
    "(SELECT balance, replace(replace(balance, '.', ''), ',', '.') AS plain FROM clean) "
    "GROUP BY ALL",
)
def decimal_comma(spark, sf_dir):
    """``1.234,56``: some cell uses dots for thousands, so the whole column loses its dots."""
    return _cast_counts(
        spark, sf_dir, "balance", "float", replace(ORDERS_PARAMS, decimal_sep=",")
    )


@query(
    "cast_integer",
    f"WITH {CLEAN_SQL} SELECT quantity AS raw, {sql_long('quantity')} AS value, count(*) AS n "
    "FROM clean GROUP BY ALL",
)
def cast_integer(spark, sf_dir):
    """``1.0`` and ``+7`` are whole numbers, ``1.5`` and ``x`` are not."""
    return _cast_counts(spark, sf_dir, "quantity", "int")


@query(
    "cast_float",
    f"WITH {CLEAN_SQL} SELECT quantity AS raw, {sql_double('quantity')} AS value, count(*) AS n "
    "FROM clean GROUP BY ALL",
)
def cast_float(spark, sf_dir):
    return _cast_counts(spark, sf_dir, "quantity", "float")


@query(
    "cast_datetime_by_column",
    f"WITH {CLEAN_SQL} SELECT order_date AS raw, "
    "strftime(try_strptime(order_date, '%Y-%m-%d'), '%Y-%m-%d') AS value, count(*) AS n "
    "FROM clean GROUP BY ALL",
)
def cast_datetime_by_column(spark, sf_dir):
    """The first format that fits anywhere is used for the whole column."""
    df = _cast_counts(spark, sf_dir, "order_date", "datetime")
    return df.withColumn("value", F.date_format("value", "yyyy-MM-dd"))


@query(
    "cast_datetime_by_row",
    f"WITH {CLEAN_SQL} SELECT order_date AS raw, strftime(coalesce("
    "try_strptime(order_date, '%Y-%m-%d'), try_strptime(order_date, '%d/%m/%Y')), '%Y-%m-%d') "
    "AS value, count(*) AS n FROM clean GROUP BY ALL",
)
def cast_datetime_by_row(spark, sf_dir):
    """The first format that fits the cell."""
    df = _cast_counts(spark, sf_dir, "order_date", "datetime", per_row=True)
    return df.withColumn("value", F.date_format("value", "yyyy-MM-dd"))


@query(
    "cast_boolean",
    f"WITH {CLEAN_SQL} SELECT r_express AS raw, CASE express WHEN 'Yes' THEN TRUE "
    "WHEN 'No' THEN FALSE END AS value, count(*) AS n FROM clean GROUP BY ALL",
)
def cast_boolean(spark, sf_dir):
    return _cast_counts(spark, sf_dir, "express", "bool")


@query(
    "boolean_without_map",
    f"WITH {CLEAN_SQL} SELECT r_express AS raw, express AS value, count(*) AS n "
    "FROM clean GROUP BY ALL",
)
def boolean_without_map(spark, sf_dir):
    """Without a map only hygiene is applied."""
    return _cast_counts(spark, sf_dir, "express", "bool", AuditParams())


@query(
    "cast_category",
    f"WITH {CLEAN_SQL} SELECT priority AS raw, priority AS value, count(*) AS n "
    "FROM clean GROUP BY ALL",
)
def cast_category(spark, sf_dir):
    """A category is a string; Parquet encodes its levels as a dictionary."""
    return _cast_counts(spark, sf_dir, "priority", "category")


_LOG = {
    "order_id": "string",
    "churned": "category",
    "customer_name": "string",
    "segment": "category",
    "total": "float",
    "quantity": "int",
    "order_date": "datetime",
    "express": "bool",
}


def _log_sql() -> str:
    parts = []
    for c, kind in _LOG.items():
        converted = kind in ("int", "float", "datetime", "bool")
        invalid = f"count(*) FILTER (c_{c} IS NOT NULL AND {c} IS NULL)" if converted else "0"
        case = f"count(*) FILTER (c_{c} <> {c})" if c == "segment" else "0"
        parts.append(
            f"SELECT '{c}' AS \"column\", 'string' AS from_type, '{kind}' AS to_type, "
            f"count(r_{c}) AS checked, count(*) FILTER (r_{c} <> c_{c}) AS trimmed, "
            f"{case} AS case_normalized, {invalid} AS invalid_to_null FROM typed"
        )
    return (
        f"WITH {CAST_SQL} SELECT *, "
        "round(coalesce(invalid_to_null / nullif(checked, 0), 0), 6) AS cast_fail_rate, "
        "to_type IN ('int', 'float', 'datetime', 'bool') AND "
        "coalesce(invalid_to_null / nullif(checked, 0), 0) > 0.02 AS over_limit FROM ("
        + " UNION ALL ".join(parts)
        + ")"
    )


@query("cast_log", _log_sql())
def cast_log(spark, sf_dir):
    """Types, changed cells, values lost and the warning flag of every column."""
    return log_of_cast(scanned_orders(spark, sf_dir), ORDERS_SPEC, ORDERS_PARAMS)


@query("cast_log_of_write", _log_sql())
def cast_log_of_write(spark, sf_dir):
    """The same log, observed while the cast table is written."""
    raw = scanned_orders(spark, sf_dir)
    return cast_and_write(raw, ORDERS_SPEC, shared_folder(spark, "cast"), ORDERS_PARAMS)


@query(
    "cast_written",
    f"WITH {CAST_SQL} SELECT order_id, segment, total, quantity, "
    "strftime(order_date, '%Y-%m-%d') AS order_date, express, balance FROM typed",
)
def cast_written(spark, sf_dir):
    """What that write left on disk."""
    path = shared_folder(spark, "cast")
    cast_and_write(scanned_orders(spark, sf_dir), ORDERS_SPEC, path, ORDERS_PARAMS)
    typed = read_table(spark, path).withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))
    return typed.select("order_id", "segment", "total", "quantity", "order_date", "express", "balance")


@query(
    "map_tables",
    f"""WITH {CLEAN_SQL}, names AS (SELECT DISTINCT lower(c_name) AS k, replace(c_name, '#', ' no. ') AS v FROM customer),
flags AS (SELECT CAST(c_custkey AS VARCHAR) AS k, c_nationkey % 2 = 0 AS v FROM customer)
SELECT coalesce(names.v, customer_name) AS customer_name, flags.v AS quantity, count(*) AS n
FROM clean LEFT JOIN names ON lower(customer_name) = names.k LEFT JOIN flags ON quantity = flags.k GROUP BY ALL""",
)
def map_tables(spark, sf_dir):
    """Case and truth values looked up in tables, an entry for each customer."""
    customer = table(spark, sf_dir, "customer")
    names = customer.select(F.lower("c_name").alias("k"), F.replace("c_name", F.lit("#"), F.lit(" no. ")).alias("v"))
    flags = customer.select(F.col("c_custkey").cast("string").alias("k"), (F.col("c_nationkey") % 2 == 0).alias("v"))
    spec = TableSpec((ColumnSpec("customer_name", "category"), ColumnSpec("quantity", "bool")))
    params = replace(ORDERS_PARAMS, canonical_cases={"customer_name": names}, bool_maps={"quantity": flags})
    typed = cast_table(scanned_orders(spark, sf_dir).select("customer_name", "quantity"), spec, params)
    return typed.groupBy("customer_name", "quantity").agg(F.count(F.lit(1)).alias("n"))


@query(
    "text_hygiene",
    f"WITH {CLEAN_SQL} SELECT 'customer_name' AS \"column\", "
    "count(*) FILTER (r_customer_name <> customer_name) AS trimmed_count, "
    "sum(coalesce(length(r_customer_name), 0) - coalesce(length(customer_name), 0)) "
    "AS len_delta_total, "
    "round(avg(CASE WHEN coalesce(customer_name, '') = '' THEN 1.0 ELSE 0.0 END), 6) "
    "AS empty_share_after FROM clean",
)
def text_hygiene_stats(spark, sf_dir):
    return text_hygiene(scanned_orders(spark, sf_dir), ORDERS_SPEC.with_role("text"))


@query(
    "cast_table",
    f"WITH {CAST_SQL} SELECT order_id, customer_name, segment, total, quantity, "
    "strftime(order_date, '%Y-%m-%d') AS order_date, churned, express, balance, priority "
    "FROM typed",
)
def cast_whole_table(spark, sf_dir):
    """All rows in their declared types."""
    typed = cast_table(scanned_orders(spark, sf_dir), ORDERS_SPEC, ORDERS_PARAMS)
    return typed.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd")).select(
        *RAW_COLUMNS
    )


# Dates as other exports write them: one column per habit.
_WRITTEN = ("order_date", "american", "early", "stamp", "named", "priority")
_WRITTEN_SQL = """written AS (SELECT
  CASE day(o_orderdate) WHEN 14 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 15 THEN '2020-13-40'
       ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
  strftime(o_orderdate, '%m/%d/%Y') AS american,
  CASE WHEN day(o_orderdate) <= 12 THEN strftime(o_orderdate, '%d.%m.%Y') END AS early,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp,
  strftime(o_orderdate, '%d %b %Y') AS named,
  o_orderpriority AS priority FROM orders)"""
_SIGNS = {"Y": "[0-9]{4}", "n": "[0-9]{1,2}", "a": "[A-Za-z]{2,}", ".": "[.]"}
_FORMATS_SQL = "formats AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{''.join(_SIGNS.get(c, c) for c in shape)}', {len(formats)}, {k}, '{fmt}')"
    for shape, formats in dateformats.SHAPES.items()
    for k, fmt in enumerate(formats)
) + ") AS f(pattern, options, k, format))"

# The SQL engine wants each format as a constant.
_PARSED_SQL = "CASE format " + " ".join(
    f"WHEN '{f}' THEN try_strptime(cell, '{f}')" for formats in dateformats.SHAPES.values() for f in formats
) + " END"


@query(
    "date_formats",
    f"""WITH {_WRITTEN_SQL}, long AS (UNPIVOT written ON {", ".join(_WRITTEN)} INTO NAME "column" VALUE cell),
sizes AS (SELECT "column", count(*) AS present FROM long GROUP BY "column"), {_FORMATS_SQL},
each AS (SELECT "column", cell, count(*) AS n FROM long GROUP BY ALL),
tried AS (SELECT "column", cell, n, pattern, k, options, format, {_PARSED_SQL} IS NOT NULL AS fits
  FROM each JOIN formats ON regexp_full_match(cell, pattern)),
paired AS (SELECT *, fits AND count(*) FILTER (fits) OVER (PARTITION BY "column", cell, pattern) = 1 AS alone FROM tried),
totals AS (SELECT "column", pattern, k, options, format, sum(n) FILTER (fits) AS cells, bool_or(alone) AS some_alone
  FROM paired GROUP BY ALL),
judged AS (SELECT *, bool_or(some_alone AND k = 0) OVER w AS first_alone, bool_or(some_alone AND k = 1) OVER w AS second_alone
  FROM totals WINDOW w AS (PARTITION BY "column", pattern))
SELECT "column", format, CAST(cells AS BIGINT) AS cells, round(cells / present, 6) AS share,
  options = 2 AND first_alone = second_alone AS ambiguous
FROM judged JOIN sizes USING ("column")
WHERE cells > 0 AND (options = 1 OR first_alone = second_alone OR some_alone)""",
)
def date_formats(spark, sf_dir):
    """The formats found in differently written date columns."""
    day = F.dayofmonth("o_orderdate")
    as_written = lambda pattern: F.date_format("o_orderdate", pattern)
    written = table(spark, sf_dir, "orders").select(
        F.when(day == 14, as_written("dd/MM/yyyy"))
        .when(day == 15, F.lit("2020-13-40"))
        .otherwise(as_written("yyyy-MM-dd"))
        .alias("order_date"),
        as_written("MM/dd/yyyy").alias("american"),
        F.when(day <= 12, as_written("dd.MM.yyyy")).alias("early"),
        as_written("yyyy-MM-dd HH:mm:ss").alias("stamp"),
        as_written("dd MMM yyyy").alias("named"),
        F.col("o_orderpriority").alias("priority"),
    )
    return dateformats.date_formats(written, _WRITTEN)
