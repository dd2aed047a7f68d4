"""Scans, sinks, report store and manifest."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.label import class_counts
from ..operators.missingness import missingness
from ..session import shared_folder
from ..sources.manifest import manifest, row_counts
from ..sources.reports import read_report, write_report
from ..sources.tables import SURPLUS, read_delimited, read_table, write_delimited, write_table
from .data import (
    LABEL,
    ORDERS_PARAMS,
    RAW_COLUMNS,
    SCANNED_SQL,
    TOKENS,
    raw_orders,
    scanned_orders,
    table,
)
from .registry import query


def missing_sql(source: str, columns) -> str:
    """One row per column with its missing count and share."""
    return "\nUNION ALL\n".join(
        f"SELECT {i} AS ordinal, '{c}' AS \"column\", count(*) AS n_rows, "
        f"count(*) FILTER ({c} IS NULL OR CAST({c} AS VARCHAR) = '') AS missing_count, "
        f"round(count(*) FILTER ({c} IS NULL OR CAST({c} AS VARCHAR) = '') / count(*), 6) "
        f"AS missing_share FROM {source}"
        for i, c in enumerate(columns)
    )


@query(
    "csv_scan_null_tokens",
    f"WITH {SCANNED_SQL} SELECT \"column\", n_rows, missing_count, missing_share FROM "
    f"({missing_sql('scanned', RAW_COLUMNS)})",
)
def csv_scan_null_tokens(spark, sf_dir):
    """A delimited table is written and read back with every column as text, quoted line breaks included."""
    path = write_delimited(raw_orders(spark, sf_dir), shared_folder(spark, "orders-csv"))
    df = read_delimited(spark, path, ORDERS_PARAMS, multiline=True)
    return missingness(df).select("column", "n_rows", "missing_count", "missing_share")


_NOTED = ("doc_id", "lang", "text")


@query(
    "csv_scan_quoted_breaks",
    "SELECT "
    + ", ".join(f"CASE WHEN CAST({c} AS VARCHAR) IN ({TOKENS}) THEN NULL ELSE CAST({c} AS VARCHAR) END AS {c}" for c in _NOTED)
    + " FROM documents",
)
def csv_scan_quoted_breaks(spark, sf_dir):
    """Whole texts, with their line breaks and quotes, from delimited files that are split."""
    path = write_delimited(table(spark, sf_dir, "documents").select(*_NOTED), shared_folder(spark, "documents-csv"))
    return read_delimited(spark, path, ORDERS_PARAMS, multiline="split")


@query(
    "csv_scan_rows",
    f"WITH {SCANNED_SQL} SELECT segment, total, quantity, order_date, count(*) AS n "
    "FROM scanned GROUP BY ALL",
)
def csv_scan_rows(spark, sf_dir):
    """The same scan without quoted line breaks, so that large files are split."""
    path = write_delimited(raw_orders(spark, sf_dir), shared_folder(spark, "orders-csv"))
    df = read_delimited(spark, path, ORDERS_PARAMS)
    return df.groupBy("segment", "total", "quantity", "order_date").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "parquet_scan",
    "SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem "
    "WHERE l_shipdate >= TIMESTAMP '1998-01-01' GROUP BY l_returnflag",
)
def parquet_scan(spark, sf_dir):
    """Two columns and the filter column are read; the filter reaches the scan."""
    df = read_table(spark, f"{sf_dir}/lineitem.parquet")
    return (
        df.where(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
        .groupBy("l_returnflag")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
    )


@query(
    "parquet_stage",
    f"WITH {SCANNED_SQL} SELECT churned, priority, count(*) AS n FROM scanned GROUP BY ALL",
)
def parquet_stage(spark, sf_dir):
    """A stage table is written and read back."""
    path = write_table(scanned_orders(spark, sf_dir), shared_folder(spark, "orders-stage"))
    return read_table(spark, path).groupBy("churned", "priority").agg(F.count(F.lit(1)).alias("n"))


@query(
    "csv_stage",
    "SELECT l_returnflag, l_linestatus, count(*) AS n, count(DISTINCT l_orderkey) AS n_orders, "
    "round(sum(l_extendedprice), 2) AS price FROM lineitem GROUP BY ALL",
)
def csv_stage(spark, sf_dir):
    """The fallback sink: a typed table as delimited text and back."""
    lines = table(spark, sf_dir, "lineitem")
    path = write_delimited(lines, shared_folder(spark, "lines-csv"))
    df = read_delimited(spark, path)
    return df.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("l_orderkey").alias("n_orders"),
        F.round(F.sum(F.col("l_extendedprice").cast("double")), 2).alias("price"),
    )


@query(
    "report_sections",
    f"""WITH {SCANNED_SQL}
SELECT 'label' AS section, 'run-2' AS run_id, 'Yes' AS name,
       count(*) FILTER (churned = 'Yes') AS figure FROM scanned
UNION ALL SELECT 'label', 'run-2', 'No', count(*) FILTER (churned = 'No') FROM scanned
UNION ALL SELECT 'missingness', 'run-1', "column", missing_count
FROM ({missing_sql('scanned', RAW_COLUMNS)})""",
)
def report_sections(spark, sf_dir):
    """Two sections are written, one of them twice; the other must survive."""
    orders = scanned_orders(spark, sf_dir)
    store = shared_folder(spark, "reports")
    missing = missingness(orders).select("column", "missing_count")
    classes = class_counts(orders, LABEL)
    write_report(missing, store, "missingness", "run-1")
    write_report(classes, store, "label", "run-1")
    write_report(classes, store, "label", "run-2")
    label = read_report(spark, store, "label", "class string, n bigint")
    gaps = read_report(spark, store, "missingness", "`column` string, missing_count bigint")
    return label.select(
        F.lit("label").alias("section"), "run_id", F.col("class").alias("name"),
        F.col("n").alias("figure"),
    ).unionByName(
        gaps.select(
            F.lit("missingness").alias("section"), "run_id", F.col("column").alias("name"),
            F.col("missing_count").alias("figure"),
        )
    )


@query(
    "report_emptied",
    "SELECT 'run-2' AS run_id, count(*) AS rows_now, (SELECT count(DISTINCT l_linestatus) FROM lineitem) "
    "AS rows_before FROM lineitem WHERE l_quantity < 0",
)
def report_emptied(spark, sf_dir):
    """The second report of a section has no rows; those of the first must go."""
    lines = table(spark, sf_dir, "lineitem")
    store = shared_folder(spark, "reports")
    shape = "l_linestatus string, n bigint"
    report = lambda df: df.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    write_report(report(lines), store, "status", "run-1")
    before = read_report(spark, store, "status", shape).count()
    write_report(report(lines.where("l_quantity < 0")), store, "status", "run-2")
    return read_report(spark, store, "status", shape).agg(
        F.lit("run-2").alias("run_id"), F.count(F.lit(1)).alias("rows_now"), F.lit(before).alias("rows_before")
    )


@query(
    "csv_ragged_rows",
    "SELECT count(*) AS n_rows, count(*) FILTER (o_orderkey % 5 = 0) AS surplus_rows, "
    "count(*) FILTER (o_orderkey % 5 <> 1) AS with_status FROM orders",
)
def csv_ragged_rows(spark, sf_dir):
    """Rows with too many cells are marked, rows with too few are filled up with nulls."""
    orders = table(spark, sf_dir, "orders")
    key, line = F.col("o_orderkey").cast("string"), F.concat_ws(",", "o_orderkey", "o_orderstatus")
    path = shared_folder(spark, "ragged")
    orders.select(
        F.when(F.col("o_orderkey") % 5 == 0, F.concat(line, F.lit(",surplus,more")))
        .when(F.col("o_orderkey") % 5 == 1, key)
        .otherwise(line)
    ).write.text(path)
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("status", T.StringType())])
    df = read_delimited(spark, path, replace(ORDERS_PARAMS, header=False), schema=schema, surplus="keep")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(SURPLUS).alias("surplus_rows"),
        F.count("status").alias("with_status"),
    )


MANIFEST_TABLES = ("customer", "orders", "lineitem", "documents", "events")


@query(
    "ingest_manifest",
    "SELECT 'suppliers' AS dataset, octet_length(encode(content)) AS file_size_bytes, md5(content) AS md5, "
    "n_rows, 1 AS n_cols, 'a file per nation' AS reader_options, 'synthetic' AS source_version, "
    "'run-1' AS run_id FROM (SELECT string_agg(s_suppkey || ',' || s_name || chr(10), '' ORDER BY s_suppkey) "
    "AS content, count(*) AS n_rows FROM supplier GROUP BY s_nationkey)",
)
def ingest_manifest(spark, sf_dir):
    """One row per file with size, digest, rows and columns; each nation's suppliers are written as one file."""
    lines = table(spark, sf_dir, "supplier").select(
        "s_nationkey", "s_suppkey", F.concat_ws(",", "s_suppkey", "s_name").alias("value")
    )
    path = shared_folder(spark, "suppliers")
    ordered = lines.repartition("s_nationkey").sortWithinPartitions("s_nationkey", "s_suppkey")
    ordered.drop("s_suppkey").write.partitionBy("s_nationkey").text(path)
    read = spark.read.text(path).select("value")
    return manifest(spark, [path], read, "suppliers", "synthetic", "run-1", "a file per nation").drop(
        "modified_at", "path"
    )


@query(
    "manifest_row_counts",
    "\nUNION ALL\n".join(
        f"SELECT '{t}' AS dataset, 1 AS n_files, count(*) AS n_rows, "
        f"(SELECT count(*) FROM (DESCRIBE SELECT * FROM {t})) AS n_cols FROM {t}"
        for t in MANIFEST_TABLES
    ),
)
def manifest_row_counts(spark, sf_dir):
    parts = None
    for name in MANIFEST_TABLES:
        df = table(spark, sf_dir, name)
        part = row_counts(df).agg(
            F.lit(name).alias("dataset"),
            F.count(F.lit(1)).alias("n_files"),
            F.sum("n_rows").alias("n_rows"),
            F.lit(len(df.columns)).alias("n_cols"),
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts
