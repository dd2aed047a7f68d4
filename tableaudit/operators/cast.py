"""Hygiene and casting of a raw, all-string table to its declared types."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.missing import quoted
from ..functions.parsing import (
    canonical_case,
    parse_datetime,
    parse_datetime_any,
    to_bool,
    to_double,
    to_long,
)
from ..functions.text import NON_ASCII, normalize, strip
from ..session import small_frame
from ..sources.tables import write_table
from ..spec import AuditParams, ColumnSpec, TableSpec
from .dateformats import chosen_formats
from .maps import is_large, look_up

CASTED = ("int", "float", "datetime", "bool")
# Columns that a joined map adds for the time of the cast.
MAPPED = "__mapped "
EUROPEAN_THOUSANDS = r"\.[0-9]{3}(,|\z)"


@dataclass(frozen=True)
class ColumnRule:
    """What one look at the whole column decided about it."""

    unicode_form: bool = True
    drop_dots: bool = False
    date_format: str | None = None


@dataclass(frozen=True)
class CastColumn:
    """One column on its way through the cast, as expressions over the raw table."""

    spec: ColumnSpec
    raw: Column
    clean: Column
    unified: Column
    result: Column


def decide(
    df: DataFrame, spec: TableSpec, params: AuditParams = AuditParams(), per_row: bool = False
) -> dict[str, ColumnRule]:
    """Column-level decisions, taken in an aggregate that returns one row.

    * does the column hold anything outside ASCII (else NFKC is skipped);
    * with a decimal comma: does any cell use dots for thousands;
    * which date format is the first that fits any cell.

    With ``per_row`` dates are tried format by format for every cell instead.
    Without declared formats the format is inferred from all cells; a column in
    which day and month may be either way round is read in ISO forms alone, unless
    ``params.day_first`` says which comes first.
    """
    present = _string_columns(df, spec)
    looked_at = [c for c in present if _questions(c, params, per_row)]

    def look(columns: list[ColumnSpec], unicode_form: bool) -> dict:
        aggs = [
            F.bool_or(question(normalize(quoted(c.name), unicode_form))).alias(f"{c.name} {tag}")
            for c in columns
            for tag, question in _questions(c, params, per_row).items()
        ]
        if not unicode_form:
            aggs += [
                F.bool_or(quoted(c.name).rlike(NON_ASCII)).alias(f"{c.name} unicode")
                for c in present
            ]
        return df.agg(*aggs).first().asDict() if aggs else {}

    # NFKC leaves the JVM, so the first look does without.  Only dates and
    # numbers in columns that do hold other characters are looked at again.
    row = look(looked_at, False)
    again = [c for c in looked_at if row[f"{c.name} unicode"]]
    row.update(look(again, True) if again else {})
    dates = [c.name for c in present if c.type == "datetime"]
    inferred = {} if params.date_formats or per_row else chosen_formats(df, dates, params.day_first)
    rules = {}
    for col in present:
        fitting = [f for f in params.date_formats if row.get(f"{col.name} {f}")]
        fallback = params.date_formats[-1] if params.date_formats else inferred.get(col.name)
        rules[col.name] = ColumnRule(
            bool(row[f"{col.name} unicode"]),
            bool(row.get(f"{col.name} dots")),
            None if per_row else (fitting[0] if fitting else fallback),
        )
    return rules


def _questions(
    col: ColumnSpec, params: AuditParams, per_row: bool
) -> dict[str, Callable[[Column], Column]]:
    """What has to be asked of any cell of a column, by the tag of the answer."""
    if col.type in ("int", "float") and params.decimal_sep == ",":
        return {"dots": lambda cell: cell.rlike(EUROPEAN_THOUSANDS)}
    if col.type == "datetime" and not per_row:
        return {
            fmt: lambda cell, fmt=fmt: parse_datetime(cell, fmt).isNotNull()
            for fmt in params.date_formats
        }
    return {}


def _string_columns(df: DataFrame, spec: TableSpec) -> list[ColumnSpec]:
    return [
        c
        for c in spec.columns
        if c.name in df.columns and isinstance(df.schema[c.name].dataType, T.StringType)
    ]


def unify_separators(clean: Column, rule: ColumnRule, params: AuditParams) -> Column:
    """Numbers written with thousands separators or a decimal comma, made plain."""
    if params.thousand_sep_policy == "homogeneous":
        if params.decimal_sep == ".":
            clean = F.replace(clean, F.lit(","), F.lit(""))
        elif rule.drop_dots:
            clean = F.replace(clean, F.lit("."), F.lit(""))
    if params.decimal_sep == ",":
        clean = F.replace(clean, F.lit(","), F.lit("."))
    return clean


def with_maps(
    df: DataFrame, spec: TableSpec, params: AuditParams, rules: dict[str, ColumnRule]
) -> DataFrame:
    """``df`` with a column of looked-up values for each column whose map is too large for a literal."""
    out = df
    for col in _string_columns(df, spec):
        clean = normalize(quoted(col.name), rules.get(col.name, ColumnRule()).unicode_form)
        if col.type == "bool" and is_large(params.bool_maps.get(col.name)):
            out = look_up(out, clean, params.bool_maps[col.name], MAPPED + col.name, "boolean")
        elif col.type == "category" and is_large(params.canonical_cases.get(col.name)):
            out = look_up(out, F.lower(strip(clean)), params.canonical_cases[col.name], MAPPED + col.name)
    return out


def cast_plan(
    df: DataFrame,
    spec: TableSpec,
    params: AuditParams = AuditParams(),
    rules: dict[str, ColumnRule] | None = None,
) -> list[CastColumn]:
    """Expressions for every declared column that is present; ``df`` comes from ``with_maps``."""
    if rules is None:
        rules = decide(df, spec, params)
    planned = []
    for col in spec.columns:
        if col.name not in df.columns:
            continue
        raw = quoted(col.name)
        if not isinstance(df.schema[col.name].dataType, T.StringType):
            planned.append(CastColumn(col, raw, raw, raw, _typed_cast(df, col)))
            continue
        rule = rules.get(col.name, ColumnRule())
        clean = normalize(raw, rule.unicode_form)
        unified, result = clean, clean
        if col.type in ("int", "float"):
            unified = unify_separators(clean, rule, params)
            result = to_long(unified) if col.type == "int" else to_double(unified)
        elif col.type == "datetime":
            result = (
                parse_datetime(clean, rule.date_format)
                if rule.date_format
                else parse_datetime_any(clean, params.date_formats)
            )
        elif MAPPED + col.name in df.columns:
            value = quoted(MAPPED + col.name)
            result = value if col.type == "bool" else F.coalesce(value, clean)
        elif col.type == "bool" and params.bool_maps.get(col.name):
            result = to_bool(clean, params.bool_maps[col.name])
        elif col.type == "category" and params.canonical_cases.get(col.name):
            result = canonical_case(clean, params.canonical_cases[col.name])
        planned.append(CastColumn(col, raw, clean, unified, result))
    return planned


def _typed_cast(df: DataFrame, col: ColumnSpec) -> Column:
    """A column that is already typed only changes width."""
    target = col.spark_field().dataType
    if col.type == "bool":
        return quoted(col.name)
    return quoted(col.name).try_cast(target)


def cast_table(
    df: DataFrame,
    spec: TableSpec,
    params: AuditParams = AuditParams(),
    rules: dict[str, ColumnRule] | None = None,
) -> DataFrame:
    """The table in its declared types; undeclared columns pass through unchanged."""
    rules = decide(df, spec, params) if rules is None else rules
    mapped = with_maps(df, spec, params, rules)
    results = {c.spec.name: c for c in cast_plan(mapped, spec, params, rules)}
    out = []
    for name in df.columns:
        if name in results:
            meta = results[name].spec.spark_field().metadata
            out.append(results[name].result.alias(name, metadata=meta))
        else:
            out.append(quoted(name))
    return mapped.select(*out)


def _changed(before: Column, after: Column) -> Column:
    return before.isNotNull() & ~before.eqNullSafe(after)


def cast_log(
    df: DataFrame,
    spec: TableSpec,
    params: AuditParams = AuditParams(),
    rules: dict[str, ColumnRule] | None = None,
) -> DataFrame:
    """What the cast did to each column, counted in one scan of the raw table.

    ``(column, from_type, to_type, checked, trimmed, case_normalized,
    invalid_to_null, cast_fail_rate, over_limit)``.  The counts are an
    ordinary aggregate rather than accumulator metrics, which a re-run stage
    would add twice.
    """
    rules = decide(df, spec, params) if rules is None else rules
    mapped = with_maps(df, spec, params, rules)
    aggs, cells = _log_figures(df, cast_plan(mapped, spec, params, rules), params)
    return _log_rows(mapped.agg(*aggs), cells, params)


def _log_figures(
    df: DataFrame, plan: list[CastColumn], params: AuditParams
) -> tuple[list[Column], list[Column]]:
    """The aggregates of a cast log, and the cells that turn their one row into a row per column."""
    aggs, cells = [], []
    for i, c in enumerate(plan):
        string = isinstance(df.schema[c.spec.name].dataType, T.StringType)
        zero = F.sum(F.lit(0).cast("bigint"))
        canonical = c.spec.type == "category" and params.canonical_cases.get(c.spec.name) is not None
        converted = c.spec.type in CASTED
        invalid = F.count_if(c.unified.isNotNull() & c.result.isNull()) if converted else zero
        aggs += [
            F.count(c.raw).alias(f"n{i}"),
            (F.count_if(_changed(c.raw, c.clean)) if string else zero).alias(f"t{i}"),
            (F.count_if(_changed(c.clean, c.result)) if canonical else zero).alias(f"c{i}"),
            invalid.alias(f"v{i}"),
        ]
        cells += [
            F.lit(c.spec.name),
            F.lit(df.schema[c.spec.name].dataType.simpleString()),
            F.lit(c.spec.type),
            F.lit(converted),
            *[F.coalesce(F.col(f"{p}{i}"), F.lit(0).cast("bigint")) for p in "ntcv"],
        ]
    return aggs, cells


def _log_rows(figures: DataFrame, cells: list[Column], params: AuditParams) -> DataFrame:
    long = figures.select(
        F.stack(F.lit(len(cells) // 8), *cells).alias(
            "column", "from_type", "to_type", "converted",
            "checked", "trimmed", "case_normalized", "invalid_to_null",
        )
    )
    rate = F.coalesce(F.col("invalid_to_null") / F.nullif(F.col("checked"), F.lit(0)), F.lit(0.0))
    return long.select(
        "column",
        "from_type",
        "to_type",
        "checked",
        "trimmed",
        "case_normalized",
        "invalid_to_null",
        F.round(rate, 6).alias("cast_fail_rate"),
        (F.col("converted") & (rate > params.max_cast_fail_rate)).alias("over_limit"),
    )


def cast_and_write(
    df: DataFrame,
    spec: TableSpec,
    path: str,
    params: AuditParams = AuditParams(),
    rules: dict[str, ColumnRule] | None = None,
) -> DataFrame:
    """Cast the table, write it to ``path`` (replacing what is there) and return its cast log, from one scan.

    The figures of the log are observed by the tasks that write.  Should Spark run
    some of them again, after a loss, and count their rows twice, the number of
    observed rows is not that of the written ones; the log is then taken by
    ``cast_log`` in a scan of its own.  Either way it is the log of the written rows.
    """
    rules = decide(df, spec, params) if rules is None else rules
    mapped = with_maps(df, spec, params, rules)
    plan = cast_plan(mapped, spec, params, rules)
    parts = ("raw", "clean", "unified", "result")
    declared = {c.spec.name for c in plan}
    wide = mapped.select(
        *[quoted(c) for c in df.columns if c not in declared],
        *[getattr(c, p).alias(f"__{p}{i}") for i, c in enumerate(plan) for p in parts],
    )
    held = [CastColumn(c.spec, *[F.col(f"__{p}{i}") for p in parts]) for i, c in enumerate(plan)]
    aggs, cells = _log_figures(df, held, params)
    seen = Observation()
    observed = wide.observe(seen, F.count(F.lit(1)).alias("n_rows"), *aggs)
    results = {c.spec.name: c for c in held}
    out = observed.select(
        *[
            results[c].result.alias(c, metadata=results[c].spec.spark_field().metadata) if c in results else quoted(c)
            for c in df.columns
        ]
    )
    write_table(out, path)
    figures = seen.get
    if figures["n_rows"] != df.sparkSession.read.schema(out.schema).parquet(path).count():
        return cast_log(df, spec, params, rules)
    names = [f"{p}{i}" for i in range(len(plan)) for p in "ntcv"]
    schema = ", ".join(f"{n} bigint" for n in names)
    return _log_rows(small_frame(df.sparkSession, [tuple(figures[n] for n in names)], schema), cells, params)


def text_hygiene(
    df: DataFrame, columns: Sequence[str], unicode_form: bool = True
) -> DataFrame:
    """``(column, trimmed_count, len_delta_total, empty_share_after)`` of text columns."""
    if not columns:
        return small_frame(
            df.sparkSession,
            [],
            "column string, trimmed_count bigint, len_delta_total bigint, "
            "empty_share_after double",
        )
    aggs, cells = [], []
    for i, name in enumerate(columns):
        before = quoted(name)
        after = normalize(before, unicode_form)
        length = lambda c: F.coalesce(F.length(c), F.lit(0)).cast("bigint")
        aggs += [
            F.count_if(_changed(before, after)).alias(f"t{i}"),
            F.coalesce(F.sum(length(before) - length(after)), F.lit(0)).alias(f"l{i}"),
            F.round(F.avg((F.coalesce(after, F.lit("")) == "").cast("double")), 6).alias(f"e{i}"),
        ]
        cells += [F.lit(name), *[F.col(f"{p}{i}") for p in "tle"]]
    return df.agg(*aggs).select(
        F.stack(F.lit(len(columns)), *cells).alias(
            "column", "trimmed_count", "len_delta_total", "empty_share_after"
        )
    )
