"""The driver's tables, and the untidy table derived from two of them.

``raw_orders`` is orders joined with their customers, written out as text the
way a careless export would do it.  What is untidy in a row follows from its
order date, priority or status, so Spark and SQL derive the same table, and it
grows with its sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import pin_settings
from ..sources.tables import apply_null_tokens, null_tokens, read_table
from ..spec import AuditParams, ColumnSpec, LabelRule, TableSpec


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(pin_settings(spark), f"{sf_dir}/{name}.parquet")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    day, month = F.dayofmonth("o_orderdate"), F.month("o_orderdate")
    text = lambda c: F.col(c).cast("string")
    money = lambda c: F.format_number(F.col(c), 2)
    name = F.col("c_name")
    rows = orders.join(customer, "o_custkey").select(
        F.when((day == 31) & (month == 12), F.lit(None))
        .when((day == 30) & (month == 12), F.lit(""))
        .otherwise(text("o_orderkey"))
        .alias("order_id"),
        F.when(day == 1, F.concat(F.lit("  "), name, F.lit(" ")))
        .when(day == 2, F.concat(F.lit("\u00a0"), name))
        .otherwise(name)
        .alias("customer_name"),
        F.when(day == 3, F.lower("c_mktsegment"))
        .when(day == 4, F.lit("None"))
        .when(day == 5, F.concat(F.lit(" "), F.col("c_mktsegment")))
        .otherwise(F.col("c_mktsegment"))
        .alias("segment"),
        F.when(day == 6, money("o_totalprice"))
        .when(day == 7, F.lit("n/a"))
        .when(day == 8, F.lit("12d"))
        .when(day == 9, F.lit(""))
        .otherwise(text("o_totalprice"))
        .alias("total"),
        F.when(day == 10, F.lit("1.0"))
        .when(day == 11, F.lit("1.5"))
        .when(day == 12, F.lit("+7"))
        .when(day == 13, F.lit("x"))
        .otherwise(text("o_custkey"))
        .alias("quantity"),
        F.when(day == 14, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(day == 15, F.lit("2020-13-40"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("order_date"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Yes"))
        .when(F.col("o_orderstatus") == "P", F.lit("No"))
        .when(month <= 4, F.lit(None))
        .when(month <= 8, F.lit(""))
        .otherwise(F.concat(F.lit("maybe "), month.cast("string")))
        .alias("churned"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Yes"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit(" No"))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit("unknown"))
        .alias("express"),
        F.translate(money("c_acctbal"), ",.", ".,").alias("balance"),
        F.col("o_orderpriority").alias("priority"),
    )
    # Low-priority orders were exported twice.
    copies = F.when(F.col("priority") == "5-LOW", F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    return rows.withColumn("__copy", F.explode(copies)).drop("__copy")


def scanned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_orders`` as a reader hands it over: null tokens are null."""
    return apply_null_tokens(raw_orders(spark, sf_dir), null_tokens(ORDERS_PARAMS))


LABEL = LabelRule("churned", ("Yes", "No"), "Yes")

ORDERS_SPEC = TableSpec(
    (
        ColumnSpec("order_id", "string", False, role="id"),
        ColumnSpec("churned", "category", False, role="label"),
        ColumnSpec("customer_name", "string", True, max_len=18, role="text"),
        ColumnSpec("segment", "category", False, role="cat"),
        ColumnSpec("total", "float", True, role="num"),
        ColumnSpec("quantity", "int", False, role="num"),
        ColumnSpec("order_date", "datetime", False, role="date"),
        ColumnSpec("express", "bool", True, role="cat"),
        ColumnSpec("channel", "category", True, role="cat"),
    )
)

ORDERS_PARAMS = AuditParams(
    label=LABEL,
    bool_maps={"express": {"Yes": True, "No": False}},
    canonical_cases={
        "segment": {
            "automobile": "Automobile",
            "building": "Building",
            "furniture": "Furniture",
            "household": "Household",
            "machinery": "Machinery",
        }
    },
)

# Fixed value: the null tokens of the reader, for the SQL side.
TOKENS = ", ".join("'" + t.replace("'", "''") + "'" for t in null_tokens(ORDERS_PARAMS))

RAW_COLUMNS = (
    "order_id", "customer_name", "segment", "total", "quantity",
    "order_date", "churned", "express", "balance", "priority",
)

_RAW_SELECT = """
  SELECT CASE WHEN day(o_orderdate) = 31 AND month(o_orderdate) = 12 THEN NULL
              WHEN day(o_orderdate) = 30 AND month(o_orderdate) = 12 THEN ''
              ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
         CASE day(o_orderdate) WHEN 1 THEN '  ' || c_name || ' '
              WHEN 2 THEN chr(160) || c_name ELSE c_name END AS customer_name,
         CASE day(o_orderdate) WHEN 3 THEN lower(c_mktsegment) WHEN 4 THEN 'None'
              WHEN 5 THEN ' ' || c_mktsegment ELSE c_mktsegment END AS segment,
         CASE day(o_orderdate) WHEN 6 THEN format('{:,.2f}', o_totalprice) WHEN 7 THEN 'n/a'
              WHEN 8 THEN '12d' WHEN 9 THEN '' ELSE CAST(o_totalprice AS VARCHAR) END AS total,
         CASE day(o_orderdate) WHEN 10 THEN '1.0' WHEN 11 THEN '1.5' WHEN 12 THEN '+7'
              WHEN 13 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END AS quantity,
         CASE day(o_orderdate) WHEN 14 THEN strftime(o_orderdate, '%d/%m/%Y')
              WHEN 15 THEN '2020-13-40' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
         CASE WHEN o_orderstatus = 'F' THEN 'Yes' WHEN o_orderstatus = 'P' THEN 'No'
              WHEN month(o_orderdate) <= 4 THEN NULL WHEN month(o_orderdate) <= 8 THEN ''
              ELSE 'maybe ' || CAST(month(o_orderdate) AS VARCHAR) END AS churned,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Yes' WHEN '2-HIGH' THEN ' No'
              WHEN '5-LOW' THEN 'unknown' END AS express,
         translate(format('{:,.2f}', c_acctbal), ',.', '.,') AS balance,
         o_orderpriority AS priority
  FROM orders JOIN customer ON o_custkey = c_custkey
"""

RAW_SQL = f"""raw0 AS ({_RAW_SELECT}),
raw AS (SELECT * FROM raw0 UNION ALL SELECT * FROM raw0 WHERE priority = '5-LOW')"""

SCANNED_SQL = (
    RAW_SQL
    + ",\nscanned AS (SELECT "
    + ", ".join(f"CASE WHEN {c} IN ({TOKENS}) THEN NULL ELSE {c} END AS {c}" for c in RAW_COLUMNS)
    + " FROM raw)"
)

# Python's white space, as a character class of the SQL engine's regexes.
SQL_SPACE = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def sql_clean(column: str) -> str:
    """The hygiene of one cell in SQL (the untidy table has no compatibility forms)."""
    return (
        f"regexp_replace(replace({column}, chr(160), ' '), '^{SQL_SPACE}+|{SQL_SPACE}+$', '', 'g')"
    )


_NUMBER = r"[+-]?(([0-9]+(\.[0-9]*)?)|(\.[0-9]+))([eE][+-]?[0-9]+)?"


def sql_double(column: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({column}, '{_NUMBER}') THEN try_cast({column} AS DOUBLE) END"
    )


def sql_long(column: str) -> str:
    whole = f"regexp_full_match({column}, '[+-]?[0-9]+')"
    return (
        f"CASE WHEN {whole} THEN try_cast({column} AS BIGINT) "
        f"WHEN floor({sql_double(column)}) = {sql_double(column)} "
        f"THEN try_cast(({sql_double(column)}) AS BIGINT) END"
    )


CANONICAL_SQL = """CASE lower({0}) WHEN 'automobile' THEN 'Automobile' WHEN 'building' THEN 'Building'
 WHEN 'furniture' THEN 'Furniture' WHEN 'household' THEN 'Household'
 WHEN 'machinery' THEN 'Machinery' ELSE {0} END"""

# `clean` keeps the cell as read beside it (r_...), `typed` the cleaned cell too (c_...).
CLEAN_SQL = (
    SCANNED_SQL
    + ",\nclean AS (SELECT "
    + ", ".join(f"{sql_clean(c)} AS {c}, {c} AS r_{c}" for c in RAW_COLUMNS)
    + " FROM scanned)"
)

CAST_SQL = (
    CLEAN_SQL
    + f""",
typed AS (SELECT order_id, customer_name, {CANONICAL_SQL.format('segment')} AS segment,
  {sql_double("replace(total, ',', '')")} AS total,
  {sql_long("replace(quantity, ',', '')")} AS quantity,
  try_strptime(order_date, '%Y-%m-%d') AS order_date,
  churned,
  CASE express WHEN 'Yes' THEN TRUE WHEN 'No' THEN FALSE END AS express,
  balance, priority,
  {", ".join(f"{c} AS c_{c}, r_{c}" for c in RAW_COLUMNS)} FROM clean)"""
)
# `balance` and `priority` are undeclared: the cast hands them on untouched.


def lines_with_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line with its order, for the label and date checks."""
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "orderkey")
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "orderkey")
    return lines.join(orders, "orderkey")


LINES_SPEC = TableSpec(
    (
        ColumnSpec("orderkey", "int", False, role="id"),
        ColumnSpec("l_linestatus", "category", False, role="label"),
        ColumnSpec("l_partkey", "int", role="tech"),
        ColumnSpec("l_suppkey", "int", role="tech"),
        ColumnSpec("l_linenumber", "int", role="num"),
        ColumnSpec("l_quantity", "float", role="num"),
        ColumnSpec("l_extendedprice", "float", role="num"),
        ColumnSpec("l_discount", "float", role="num"),
        ColumnSpec("l_tax", "float", role="num"),
        ColumnSpec("l_returnflag", "category", role="cat"),
        ColumnSpec("l_shipdate", "datetime", role="date"),
        ColumnSpec("o_orderstatus", "category", role="cat"),
        ColumnSpec("o_totalprice", "float", role="num"),
        ColumnSpec("o_orderdate", "datetime", role="date"),
        ColumnSpec("o_orderpriority", "category", role="cat"),
    ),
    non_feature_patterns=("(?i)custkey$",),
)

LINES_PARAMS = AuditParams(
    label=LabelRule("l_linestatus", ("F", "O"), "F"),
    date_order_pairs=(("o_orderdate", "l_shipdate"),),
    future_year_max=2000,
)
LINES_AS_OF = "1999-06-01 00:00:00"

LINES_SQL = "lines AS (SELECT l.*, o.* FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey)"


def labelled_documents(spark: SparkSession, sf_dir: str, how: str = "inner") -> DataFrame:
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", how)


DOCS_SPEC = TableSpec(
    (
        ColumnSpec("doc_id", "int", False, role="id"),
        ColumnSpec("toxic", "int", False, role="label"),
        ColumnSpec("text", "string", True, role="text"),
        ColumnSpec("lang", "category", role="cat"),
        ColumnSpec("source", "category", role="cat"),
        ColumnSpec("n_chars", "int", role="num"),
        ColumnSpec("quality", "int", role="num"),
    )
)

DOCS_PARAMS = AuditParams(label=LabelRule("toxic", ("0", "1"), "1"), min_support=5)
