"""Comparison of two stages of a table."""

from __future__ import annotations

import hashlib
from dataclasses import replace

from pyspark.sql import functions as F

from ..operators import differences, sanity
from ..operators.cast import cast_table, decide
from ..operators.label import label_summary
from ..operators.missingness import missingness
from ..session import shared_folder
from ..sources.tables import read_table, write_table
from .data import (
    CAST_SQL,
    LABEL,
    ORDERS_PARAMS,
    ORDERS_SPEC,
    SCANNED_SQL,
    labelled_documents,
    scanned_orders,
    table,
)
from .registry import query

_LINE_TYPES = {
    "l_orderkey": "", "l_partkey": "", "l_suppkey": "", "l_linenumber": "", "l_quantity": "",
    "l_extendedprice": "", "l_discount": "", "l_tax": "", "l_returnflag": "", "l_linestatus": "",
    "l_shipdate": "time",
}


def fingerprint_sql(source: str, columns: dict[str, str]) -> str:
    cells = []
    for c, kind in columns.items():
        text = (
            f"CAST(epoch_us({c}) AS VARCHAR)" if kind == "time" else f"CAST({c} AS VARCHAR)"
        )
        text = f"coalesce({text}, '')"
        cells.append(f"length({text}) || ':' || {text}")
    digest = "md5(" + " || ".join(cells) + ")"
    sums = " || '-' || ".join(
        f"CAST(sum((d{i} >> {shift}) & 1048575) AS VARCHAR)" for i in (0, 1) for shift in (40, 20, 0)
    )
    header = hashlib.md5("\n".join(columns).encode()).hexdigest()
    return (
        f"SELECT count(*) AS n_rows, {len(columns)} AS n_cols, '{header}' AS header_md5, "
        f"{sums} AS content_hash FROM (SELECT CAST('0x' || substr(digest, 1, 15) AS BIGINT) AS d0, "
        f"CAST('0x' || substr(digest, 16, 15) AS BIGINT) AS d1 "
        f"FROM (SELECT {digest} AS digest FROM {source}))"
    )


@query("fingerprint", fingerprint_sql("lineitem", _LINE_TYPES))
def fingerprint(spark, sf_dir):
    """Order-free content hash of all rows and columns."""
    return sanity.fingerprint(table(spark, sf_dir, "lineitem"))


@query(
    "fingerprint_texts",
    fingerprint_sql(
        "documents", {"doc_id": "", "text": "", "lang": "", "source": "", "n_chars": ""}
    ),
)
def fingerprint_texts(spark, sf_dir):
    return sanity.fingerprint(table(spark, sf_dir, "documents"))


@query(
    "fingerprint_match",
    f"WITH {CAST_SQL} SELECT (SELECT count(*) FROM scanned) = (SELECT count(*) FROM typed) "
    "AS n_rows_match, TRUE AS n_cols_match, TRUE AS header_match, FALSE AS content_hash_match",
)
def fingerprint_match(spark, sf_dir):
    """Casting keeps rows and columns but changes the content."""
    before = scanned_orders(spark, sf_dir)
    after = cast_table(before, ORDERS_SPEC, ORDERS_PARAMS)
    return sanity.compare_fingerprints(sanity.fingerprint(after), sanity.fingerprint(before))


@query(
    "fingerprint_renamed",
    "SELECT count(*) = count(*) AS n_rows_match, TRUE AS n_cols_match, count(*) = 0 AS header_match, "
    "TRUE AS content_hash_match FROM orders",
)
def fingerprint_renamed(spark, sf_dir):
    """The same rows under another column name are another table."""
    orders = table(spark, sf_dir, "orders")
    renamed = orders.withColumnRenamed("o_custkey", "o_customer")
    return sanity.compare_fingerprints(sanity.fingerprint(renamed), sanity.fingerprint(orders))


@query(
    "label_share_match",
    f"""WITH {CAST_SQL}, s AS (SELECT count(*) FILTER (churned = 'Yes') / count(*) AS p_all,
  count(*) FILTER (churned = 'Yes') / count(*) FILTER (churned IN ('Yes', 'No')) AS p_valid FROM typed)
SELECT round(p_all, 6) AS positive_share, abs(p_all - p_valid) <= 1e-6 AS label_share_match FROM s""",
)
def label_share_match(spark, sf_dir):
    """The profile's share is over valid labels, the stage's over all rows."""
    raw = scanned_orders(spark, sf_dir)
    after = cast_table(raw, ORDERS_SPEC, ORDERS_PARAMS)
    profiled = label_summary(raw, LABEL).select(
        (F.col("positive_count") / F.col("valid_count")).alias("share")
    )
    share = profiled.first()["share"]
    return sanity.label_share_match(after, LABEL, share, ORDERS_PARAMS.label_share_atol)


_DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")


@query(
    "missing_share_close",
    f"""WITH d AS (SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)),
e AS (SELECT DISTINCT * FROM d)
SELECT 7 AS columns_compared, bool_and(abs(gap) <= 1e-6) AS missing_share_close FROM ("""
    + " UNION ALL ".join(
        f"SELECT (SELECT 1 - count({c}) / count(*) FROM e) - "
        f"(SELECT round(1 - count({c}) / count(*), 6) FROM d) AS gap"
        for c in _DOC_COLUMNS
    )
    + ")",
)
def missing_share_close(spark, sf_dir):
    """Profiled before removing duplicates, compared after."""
    before = labelled_documents(spark, sf_dir, "left")
    return sanity.missing_share_close(before.dropDuplicates(), missingness(before))


@query(
    "write_read_back",
    "SELECT 'same' AS compared, TRUE AS write_ok, TRUE AS n_rows_match, TRUE AS n_cols_match, "
    "TRUE AS header_match, TRUE AS content_hash_match "
    "UNION ALL SELECT 'shorter', TRUE, count(*) = count(*) FILTER (o_orderkey % 7 <> 0), TRUE, TRUE, "
    "count(*) FILTER (o_orderkey % 7 = 0) = 0 FROM orders "
    "UNION ALL SELECT 'changed', TRUE, TRUE, TRUE, TRUE, "
    "count(*) FILTER (upper(o_orderstatus) <> lower(o_orderstatus)) = 0 FROM orders",
)
def write_read_back(spark, sf_dir):
    """A copy that is right, one that lacks rows, and one with a changed column."""
    orders = table(spark, sf_dir, "orders")
    shorter = orders.where("o_orderkey % 7 <> 0")
    changed = orders.withColumn("o_orderstatus", F.lower("o_orderstatus"))
    cases = [
        ("same", sanity.write_read_back(orders)),
        ("shorter", sanity.copy_matches(shorter, orders)),
        ("changed", sanity.copy_matches(changed, orders)),
    ]
    parts = [flags.select(F.lit(name).alias("compared"), "*") for name, flags in cases]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "sanity_flags",
    f"""WITH {SCANNED_SQL}
SELECT unnest(['n_rows_match', 'n_cols_match', 'header_match', 'content_hash_match', 'label_share_match',
  'missing_share_close', 'write_clean_ok', 'read_clean_ok', 'schema_types_match']) AS flag,
  unnest([TRUE, TRUE, TRUE, TRUE, (SELECT count(*) FILTER (churned = 'Yes') / count(*) FROM scanned) = 0.5,
  (SELECT count(quantity) = count(q.whole) AND count(order_date) = count(q.day) FROM (
     SELECT quantity, order_date, CASE WHEN quantity NOT IN ('x', '1.5') THEN 1 END AS whole,
            CASE WHEN order_date <> '2020-13-40' THEN 1 END AS day FROM scanned) q),
  TRUE, TRUE, FALSE]) AS ok""",
)
def sanity_flags(spark, sf_dir):
    """All flags of a written cast stage; its declared column ``channel`` is absent.

    Missing shares were profiled before the cast, which made some cells null.
    """
    raw = scanned_orders(spark, sf_dir)
    typed = cast_table(raw, ORDERS_SPEC, ORDERS_PARAMS)
    after = read_table(spark, write_table(typed, shared_folder(spark, "cast-stage")))
    return sanity.sanity_flags(
        after,
        ORDERS_SPEC,
        ORDERS_PARAMS,
        profiled_share=0.5,
        profiled_missing=missingness(raw).select(
            "column", (F.col("missing_count") / F.col("n_rows")).alias("missing_share")
        ),
        stored=sanity.fingerprint(typed),
        write_test=True,
    )


# A later version of the orders: prices corrected, a status lost, rows dropped and rows repeated.
_LATER_SQL = """later0 AS (SELECT * REPLACE (
    CASE WHEN o_orderkey % 97 = 3 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
    CASE WHEN o_orderkey % 101 = 9 THEN NULL ELSE o_orderstatus END AS o_orderstatus)
  FROM orders WHERE o_orderkey % 89 <> 5),
later AS (SELECT * FROM later0 UNION ALL SELECT * FROM later0 WHERE o_orderkey % 83 = 7
  UNION ALL SELECT * FROM later0 WHERE o_orderkey % 166 = 7)"""
_EXCESS_SQL = """excess AS (
  SELECT 'left' AS side, *, count(*) AS copies FROM (SELECT * FROM orders EXCEPT ALL SELECT * FROM later) GROUP BY ALL
  UNION ALL
  SELECT 'right' AS side, *, count(*) AS copies FROM (SELECT * FROM later EXCEPT ALL SELECT * FROM orders) GROUP BY ALL)"""


def _later_orders(spark, sf_dir):
    orders, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    later = orders.where(key % 89 != 5).withColumns(
        {
            "o_totalprice": F.when(key % 97 == 3, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
            "o_orderstatus": F.when(key % 101 != 9, F.col("o_orderstatus")),
        }
    )
    return later.union(later.where(key % 83 == 7)).union(later.where(key % 166 == 7))


@query(
    "stage_differences",
    f"WITH {_LATER_SQL}, {_EXCESS_SQL} SELECT side, o_orderkey, o_orderstatus, o_totalprice, copies FROM excess",
)
def stage_differences(spark, sf_dir):
    """Every row that one version of the orders holds more often than the other."""
    shown = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    return differences.stage_differences(table(spark, sf_dir, "orders"), _later_orders(spark, sf_dir), shown)


@query(
    "stage_difference_counts",
    f"""WITH {_LATER_SQL}, {_EXCESS_SQL}
SELECT side, count(*) AS rows, CAST(sum(copies) AS BIGINT) AS copies FROM excess GROUP BY side""",
)
def stage_difference_counts(spark, sf_dir):
    return differences.difference_counts(table(spark, sf_dir, "orders"), _later_orders(spark, sf_dir))


@query(
    "stage_differences_after_cast",
    f"""WITH {CAST_SQL}, a AS (SELECT c_order_id AS order_id, c_segment AS segment FROM typed),
b AS (SELECT order_id, segment FROM typed)
SELECT 'left' AS side, order_id, segment, count(*) AS copies FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) GROUP BY ALL
UNION ALL
SELECT 'right', order_id, segment, count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) GROUP BY ALL""",
)
def stage_differences_after_cast(spark, sf_dir):
    """The rows whose segment the cast wrote in its canonical form."""
    raw, columns = scanned_orders(spark, sf_dir), ["order_id", "segment"]
    # Formats and commas do not depend on the canonical cases: one look at the columns serves both casts.
    rules = decide(raw, ORDERS_SPEC, ORDERS_PARAMS)
    plain = cast_table(raw, ORDERS_SPEC, replace(ORDERS_PARAMS, canonical_cases={}), rules).select(*columns)
    return differences.stage_differences(plain, cast_table(raw, ORDERS_SPEC, ORDERS_PARAMS, rules).select(*columns))
