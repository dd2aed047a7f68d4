"""Does a raw table follow its declared schema?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.missing import field_family, is_missing, quoted
from ..functions.parsing import float_probe, int_probe, parse_datetime_any
from ..session import small_frame
from ..spec import AuditParams, ColumnSpec, TableSpec
from .dateformats import chosen_formats

PROBED = ("int", "float", "datetime")


class CriticalColumnsMissing(ValueError):
    """The key or the label is absent: nothing further can be checked."""


def column_differences(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``(column, difference, filled_rows)``: declared but missing, present but unexpected.

    For an unexpected column the report also says how much data it carries.
    """
    missing = [c for c in spec.names if c not in df.columns]
    unexpected = [c for c in df.columns if c not in spec.names]
    if not missing and not unexpected:
        return small_frame(
            df.sparkSession, [], "column string, difference string, filled_rows bigint"
        )
    cells = [x for c in missing for x in (F.lit(c), F.lit("missing"), F.lit(None).cast("bigint"))]
    filled = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(unexpected):
        filled.append(F.count_if(~is_missing(df, c)).alias(f"n{i}"))
        cells += [F.lit(c), F.lit("unexpected"), F.col(f"n{i}")]
    return df.agg(*filled).select(
        F.stack(F.lit(len(cells) // 3), *cells).alias("column", "difference", "filled_rows")
    )


def missing_critical(df: DataFrame, spec: TableSpec) -> list[str]:
    return [c for c in spec.with_role("id", "label") if c not in df.columns]


def require_critical(df: DataFrame, spec: TableSpec) -> DataFrame:
    absent = missing_critical(df, spec)
    if absent:
        raise CriticalColumnsMissing(f"missing critical columns: {absent}")
    return df


def parses(
    df: DataFrame, col: ColumnSpec, params: AuditParams, inferred: dict[str, str] | None = None
) -> Column | None:
    """Does a non-null cell read as its declared type?  None: every cell passes.

    ``inferred`` has the date formats of columns where none is declared.
    """
    dtype = df.schema[col.name].dataType
    if not isinstance(dtype, T.StringType):
        return None
    value = quoted(col.name)
    if col.type == "int":
        return int_probe(value)
    if col.type == "float":
        return float_probe(value)
    if col.type == "datetime":
        guessed = (inferred or {}).get(col.name)
        return parse_datetime_any(value, params.date_formats or (guessed and [guessed])).isNotNull()
    return None


def _probe(df: DataFrame, spec: TableSpec, params: AuditParams) -> DataFrame:
    """One aggregate probes every declared column that is present."""
    present = [c for c in spec.columns if c.name in df.columns]
    if not present:
        raise CriticalColumnsMissing("none of the declared columns is present")
    texts = [c.name for c in present if isinstance(df.schema[c.name].dataType, T.StringType)]
    dates = [c.name for c in present if c.type == "datetime" and c.name in texts]
    inferred = {} if params.date_formats else chosen_formats(df, dates, params.day_first)
    aggs, cells = [F.count(F.lit(1)).alias("n_rows")], []
    for i, col in enumerate(present):
        ok = parses(df, col, params, inferred)
        bad = F.lit(0).cast("bigint")
        if ok is not None:
            bad = F.count_if(quoted(col.name).isNotNull() & ~F.coalesce(ok, F.lit(False)))
        aggs += [F.count(quoted(col.name)).alias(f"n{i}"), bad.alias(f"f{i}")]
        cells += [F.lit(col.name), F.lit(col.type), F.col(f"n{i}"), F.col(f"f{i}")]
    long = df.agg(*aggs).select(
        "n_rows",
        F.stack(F.lit(len(present)), *cells).alias("column", "expected", "checked", "fails"),
    )
    rate = F.coalesce(F.col("fails") / F.nullif(F.col("checked"), F.lit(0)), F.lit(0.0))
    over = (rate > params.max_cast_fail_rate) & F.col("expected").isin(*PROBED)
    return long.select(
        "n_rows",
        "column",
        "expected",
        "checked",
        "fails",
        F.round(rate, 6).alias("cast_fail_rate"),
        F.when(over, "mismatch").when(F.col("fails") > 0, "warning").otherwise("ok")
        .alias("severity"),
    )


def parse_report(df: DataFrame, spec: TableSpec, params: AuditParams = AuditParams()) -> DataFrame:
    """``(column, expected, checked, fails, cast_fail_rate, severity)``.

    A rate above the limit is a ``mismatch``; any other failure is a ``warning``.
    """
    return _probe(df, spec, params).drop("n_rows")


def length_report(df: DataFrame, spec: TableSpec, params: AuditParams = AuditParams()) -> DataFrame:
    """``(column, max_len, over_limit)`` for text columns; a declared limit wins."""
    listed = spec.with_role("text")
    undeclared = [ColumnSpec(n) for n in listed if n not in spec.names]
    texts = [
        c for c in (*spec.columns, *undeclared)
        if c.name in df.columns and (c.name in listed or c.max_len is not None)
    ]
    if not texts:
        return small_frame(
            df.sparkSession, [], "column string, max_len int, over_limit bigint"
        )
    limits = [c.max_len if c.max_len is not None else params.text_max_len for c in texts]
    aggs = [
        F.count_if(F.length(quoted(c.name)) > limit).alias(f"o{i}")
        for i, (c, limit) in enumerate(zip(texts, limits))
    ]
    cells = [
        x
        for i, (c, limit) in enumerate(zip(texts, limits))
        for x in (F.lit(c.name), F.lit(limit), F.col(f"o{i}"))
    ]
    return df.agg(*aggs).select(
        F.stack(F.lit(len(texts)), *cells).alias("column", "max_len", "over_limit")
    )


def nullability_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``(column, nulls, ok)`` for the columns declared as never null."""
    strict = [c.name for c in spec.columns if not c.nullable and c.name in df.columns]
    if not strict:
        return small_frame(df.sparkSession, [], "column string, nulls bigint, ok boolean")
    aggs = [F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(strict)]
    cells = [x for i, c in enumerate(strict) for x in (F.lit(c), F.col(f"m{i}"))]
    long = df.agg(*aggs).select(F.stack(F.lit(len(strict)), *cells).alias("column", "nulls"))
    return long.withColumn("ok", F.col("nulls") == 0)


def conformance(df: DataFrame, spec: TableSpec, params: AuditParams = AuditParams()) -> DataFrame:
    """One row: overall status with the counts behind it.

    ``fail`` if the key or label is absent, ``warn`` on a missing column or a
    type mismatch, else ``ok``.
    """
    absent = [c for c in spec.names if c not in df.columns]
    extra = [c for c in df.columns if c not in spec.names]
    critical = missing_critical(df, spec)
    # One row per column from here on.
    one = _probe(df, spec, params).agg(
        F.max("n_rows").alias("n_rows"),
        F.count_if(F.col("severity") == "mismatch").alias("n_mismatch"),
        F.count_if(F.col("severity") == "warning").alias("n_warning"),
    )
    warn = (F.col("n_mismatch") > 0) | F.lit(bool(absent))
    status = F.lit("fail") if critical else F.when(warn, "warn").otherwise("ok")
    return one.select(
        status.alias("status"),
        "n_rows",
        F.lit(len(df.columns)).alias("n_cols"),
        F.lit(len(absent)).alias("n_missing"),
        F.lit(len(extra)).alias("n_unexpected"),
        F.lit(len(critical)).alias("n_missing_critical"),
        "n_mismatch",
        "n_warning",
    )


def _type_facts(df: DataFrame, spec: TableSpec) -> list[tuple[str, str, str | None, bool]]:
    facts = []
    for col in spec.columns:
        found = field_family(df.schema[col.name]) if col.name in df.columns else None
        ok = found == col.type or (col.type == "category" and found == "string")
        facts.append((col.name, col.type, found, ok))
    return facts


def type_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``(column, expected, found, ok, non_null)`` after casting.

    String is fine where category is declared; an absent column is not ok.
    """
    facts = _type_facts(df, spec)
    aggs, cells = [F.count(F.lit(1)).alias("n_rows")], []
    for i, (name, expected, found, ok) in enumerate(facts):
        filled = F.count(quoted(name)) if found else F.lit(None).cast("bigint")
        aggs.append(filled.alias(f"n{i}"))
        cells += [F.lit(name), F.lit(expected), F.lit(found).cast("string"), F.lit(ok)]
        cells.append(F.col(f"n{i}"))
    return df.agg(*aggs).select(
        F.stack(F.lit(len(facts)), *cells).alias("column", "expected", "found", "ok", "non_null")
    )


def types_match(df: DataFrame, spec: TableSpec) -> bool:
    """The same check as a plain fact about the schema."""
    return all(ok for *_, ok in _type_facts(df, spec))
