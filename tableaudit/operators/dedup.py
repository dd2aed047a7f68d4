"""Exact duplicates and conflicting keys.

Counts need no rows: rows are grouped by their key and a digest of 128 bits, so
a key that owns a third of the table is spread over all tasks, copies collapse
before the shuffle, and no text crosses it.  A second digest, of another kind,
travels along as a minimum and a maximum; where they differ, different rows share
a digest, and the counts are taken from the rows themselves.  To drop copies,
only rows with a repeated digest are moved, and compared in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.missing import quoted
from ..session import small_frame, staged
from ..spec import AuditParams, TableSpec

COPIES = "__copies"
DIGEST = ("__digest_0", "__digest_1")
# Up to so many repeated digests (16 bytes each) are broadcast.
MOST_REPEATED = 1_000_000


def require_key(df: DataFrame, spec: TableSpec, params: AuditParams = AuditParams()) -> str | None:
    """Name of the key column; None if it is absent and that is allowed."""
    key = spec.key
    if key is None:
        raise ValueError("the table declares no id column")
    if key not in df.columns:
        if params.fail_on_missing_key:
            raise ValueError(f"key column {key!r} is absent")
        return None
    return key


def missing_keys(df: DataFrame, key: str) -> DataFrame:
    """One row: rows whose key is null or the empty string."""
    empty = F.coalesce(quoted(key).cast("string"), F.lit("")) == ""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(empty).alias("missing_keys"))


def row_digest(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of all cells; null is a value of its own."""
    cells = [x for c in df.columns for x in (quoted(c).isNull(), quoted(c))]
    return [F.xxhash64(F.lit(seed), *cells) for seed in range(2)]


def text_digest(df: DataFrame) -> Column:
    """MD5 of the cells as text, each with its length, so that cells cannot run together; null is a value of its own."""
    cells = []
    for field in df.schema:
        value = quoted(field.name)
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            value = value + F.lit(0.0)  # a negative zero equals zero
        text = value.cast("string")
        cells += [F.coalesce(F.length(text).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text, F.lit(""))]
    return F.md5(F.concat(F.lit(""), *cells))


def digest_counts(
    df: DataFrame, key: str | None = None, digest: Callable[[DataFrame], list[Column]] = row_digest
) -> DataFrame:
    """``(key, digests, copies, mixed)``: one row per key and digest; no other column is moved.

    ``mixed`` says that different rows share the digest.
    """
    keys = [quoted(key).alias("key")] if key else []
    marked = df.select(
        *keys, *[d.alias(n) for d, n in zip(digest(df), DIGEST, strict=True)], F.unhex(text_digest(df)).alias("__check")
    )
    return marked.groupBy(*(["key"] if key else []), *DIGEST).agg(
        F.count(F.lit(1)).alias(COPIES), (F.min("__check") != F.max("__check")).alias("mixed")
    )


def drop_exact_duplicates(
    df: DataFrame,
    digest: Callable[[DataFrame], list[Column]] = row_digest,
    most_repeated: int = MOST_REPEATED,
) -> DataFrame:
    """One copy of every distinct row; null equals null.

    Rows whose digest occurs once stay where they are.  The others are shuffled and
    compared in full.  With more repeated digests than ``most_repeated`` all rows
    are.
    """
    repeated = digest_counts(df, digest=digest).where(F.col(COPIES) > 1).select(*DIGEST)
    repeated = staged(repeated, "repeated-rows")
    n = repeated.count()
    if n == 0:
        return df
    if n > most_repeated:
        return df.dropDuplicates()
    marked = df.withColumns(dict(zip(DIGEST, digest(df), strict=True)))
    repeated = F.broadcast(repeated)
    single = marked.join(repeated, list(DIGEST), "left_anti").drop(*DIGEST)
    return single.unionByName(marked.join(repeated, list(DIGEST), "left_semi").drop(*DIGEST).dropDuplicates())


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct rows with the number of their copies."""
    return df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias(COPIES))


def _count_figures() -> list[Column]:
    return [
        F.coalesce(F.sum(COPIES), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        F.coalesce(F.sum(F.col(COPIES) - 1), F.lit(0)).alias("duplicates_removed"),
        F.count_if(F.col(COPIES) > 1).alias("duplicate_groups"),
    ]


def _verified(df: DataFrame, from_digests: DataFrame, from_rows: Callable[[], DataFrame]) -> DataFrame:
    """The one row of figures taken from digests, or from the rows if a digest was shared."""
    row = from_digests.first()
    if row["mixed"]:
        return from_rows()
    fields = [f for f in from_digests.schema if f.name != "mixed"]
    return small_frame(df.sparkSession, [tuple(row[f.name] for f in fields)], T.StructType(fields))


def _any_mixed() -> Column:
    return F.coalesce(F.bool_or("mixed"), F.lit(False)).alias("mixed")


def duplicate_counts(df: DataFrame, digest: Callable[[DataFrame], list[Column]] = row_digest) -> DataFrame:
    """One row: rows before and after, copies removed, groups that had copies."""
    return _verified(
        df,
        digest_counts(df, digest=digest).agg(*_count_figures(), _any_mixed()),
        lambda: distinct_rows(df).agg(*_count_figures()),
    )


def _differs(name: str) -> Column:
    """More than one value in the group, null counting as a value."""
    value = quoted(name)
    present = F.count(value)
    some_null = (present > 0) & (present < F.count(F.lit(1)))
    return F.coalesce(F.min(value) != F.max(value), F.lit(False)) | some_null


def _difference_report(rows: DataFrame, key: str, limit: int | None) -> DataFrame:
    others = [c for c in rows.columns if c not in (key, COPIES)]
    grouped = rows.groupBy(quoted(key)).agg(
        F.count(F.lit(1)).alias("row_count"),
        *[_differs(c).alias(f"d{i}") for i, c in enumerate(others)],
    )
    names = F.array_compact(
        F.array(*[F.when(F.col(f"d{i}"), F.lit(c)) for i, c in enumerate(others)])
    )
    if limit is not None:
        names = F.slice(names, 1, limit)
    return grouped.where("row_count > 1").select(
        quoted(key), "row_count", names.alias("diff_columns")
    )


def key_conflicts(df: DataFrame, key: str, max_columns: int | None = 10) -> DataFrame:
    """``(key, row_count, diff_columns)`` for every key with more than one distinct row.

    The null key is a key.  Distinct rows that share a key differ somewhere,
    so no further test is needed to call it a conflict.
    """
    return _difference_report(distinct_rows(df), key, max_columns)


def conflict_counts(rows: DataFrame, key: str) -> DataFrame:
    """``(key, row_count)`` of conflicting keys; moves only keys and counts."""
    return rows.groupBy(quoted(key)).agg(F.count(F.lit(1)).alias("row_count")).where(
        "row_count > 1"
    )


def conflict_samples(
    df: DataFrame, key: str, n: int = 10, max_columns: int | None = 10
) -> DataFrame:
    """The first ``n`` conflicting keys in key order, with their differing columns.

    Keys are chosen on (key, count) pairs alone; the wide rows of just those
    ``n`` keys are then picked out with a broadcast of ``n`` keys.
    """
    rows = distinct_rows(df)
    chosen = (
        conflict_counts(rows, key)
        .orderBy(quoted(key).asc_nulls_last())
        .limit(n)
        .select(quoted(key).alias("__key"))
    )
    picked = rows.join(
        F.broadcast(chosen), quoted(key).eqNullSafe(F.col("__key")), "left_semi"
    )
    return _difference_report(picked, key, max_columns)


def _key_figures(rows: DataFrame) -> DataFrame:
    """The summary of ``(key, copies, mixed)``, one row per distinct row, grouped by key."""
    per_key = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("kept"),
        F.sum(COPIES).alias("raw"),
        F.count_if(F.col(COPIES) > 1).alias("groups"),
        F.bool_or("mixed").alias("mixed"),
    )
    empty = F.coalesce(F.col("key").cast("string"), F.lit("")) == ""
    clash = F.col("kept") > 1
    zero = lambda c: F.coalesce(c, F.lit(0))
    return per_key.agg(
        zero(F.sum("raw")).alias("n_rows_raw"),
        zero(F.sum("kept")).alias("n_rows_clean"),
        zero(F.sum(F.col("raw") - F.col("kept"))).alias("duplicates_exact_removed"),
        zero(F.sum("groups")).alias("duplicates_exact_groups"),
        F.count_if(clash).alias("key_conflict_groups"),
        zero(F.sum(F.when(clash, F.col("kept")))).alias("key_conflict_rows"),
        zero(F.sum(F.when(empty, F.col("raw")))).alias("key_null_count"),
        _any_mixed(),
    )


def dedup_summary(
    df: DataFrame,
    key: str | None,
    params: AuditParams = AuditParams(),
    digest: Callable[[DataFrame], list[Column]] = row_digest,
) -> DataFrame:
    """One row with every duplicate and key figure and the resulting status.

    Two steps: keys and digests are grouped, then (key, copies) by key.  Without a
    key column every row counts as a row without key.
    """
    if key is None:
        totals = duplicate_counts(df, digest).select(
            F.col("rows_before").alias("n_rows_raw"),
            F.col("rows_after").alias("n_rows_clean"),
            F.col("duplicates_removed").alias("duplicates_exact_removed"),
            F.col("duplicate_groups").alias("duplicates_exact_groups"),
            F.lit(0).cast("bigint").alias("key_conflict_groups"),
            F.lit(0).cast("bigint").alias("key_conflict_rows"),
            F.col("rows_before").alias("key_null_count"),
        )
        return _with_status(df, totals, params)
    rows = lambda: distinct_rows(df).select(quoted(key).alias("key"), COPIES, F.lit(False).alias("mixed"))
    totals = _verified(
        df, _key_figures(digest_counts(df, key, digest)), lambda: _key_figures(rows()).drop("mixed")
    )
    return _with_status(df, totals, params)


def _with_status(df: DataFrame, totals: DataFrame, params: AuditParams) -> DataFrame:
    failed = F.lit(params.fail_on_key_conflicts) & (F.col("key_conflict_groups") > 0)
    return totals.select(
        "*",
        F.lit(len(df.columns)).alias("n_cols"),
        F.when(failed, "fail").otherwise("ok").alias("status"),
    )
