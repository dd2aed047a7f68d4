"""Which columns may be used as features?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.missing import field_family, is_missing, quoted
from ..session import small_frame
from ..spec import AuditParams, TableSpec, compile_patterns


class FeatureGuardError(ValueError):
    """A required column is absent, or a planned feature must not be one."""


def pattern_hits(columns: Sequence[str], patterns: Sequence[str]) -> list[tuple[str, str]]:
    """Sorted distinct (column, pattern) pairs; a broken pattern raises."""
    compiled = compile_patterns(patterns)
    return sorted({(c, p.pattern) for c in columns for p in compiled if p.search(c)})


def non_features(columns: Sequence[str], spec: TableSpec) -> list[str]:
    """Ids, label, technical columns and every column an exclusion pattern hits."""
    fixed = set(spec.with_role("id", "label", "tech"))
    return sorted(fixed | {c for c, _ in pattern_hits(columns, spec.non_feature_patterns)})


def leaked_features(columns: Sequence[str], spec: TableSpec) -> list[str]:
    """Planned features that are non-features."""
    return sorted(set(spec.planned_features) & set(non_features(columns, spec)))


def missing_required(columns: Sequence[str], spec: TableSpec) -> list[str]:
    return [c for c in spec.with_role("id", "label") if c not in columns]


def mistyped_text(df: DataFrame, spec: TableSpec) -> list[str]:
    return [
        c
        for c in spec.with_role("text")
        if c in df.columns and field_family(df.schema[c]) not in ("string", "category")
    ]


def role_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per present, declared or listed column: its roles, what the guard thinks, its fill.

    The name checks are facts about the schema; the count of non-missing
    cells is one aggregate over the table.
    """
    present = list(df.columns)
    excluded = set(non_features(present, spec))
    leaked = set(leaked_features(present, spec))
    absent = set(missing_required(present, spec))
    mistyped = set(mistyped_text(df, spec))
    hits: dict[str, list[str]] = {}
    for column, pattern in pattern_hits(present, spec.non_feature_patterns):
        hits.setdefault(column, []).append(pattern)
    planned = set(spec.planned_features)
    everything = present + [c for c in spec.mentioned if c not in present]
    filled = [
        F.count_if(~is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(present)
    ]
    cells = []
    for i, name in enumerate(everything):
        cells += [
            F.lit(name),
            F.lit(",".join(spec.roles_of(name)) or None).cast("string"),
            F.lit(name in excluded),
            F.lit(name in planned),
            F.lit(name in leaked),
            F.lit(name in absent),
            F.lit(name in mistyped),
            F.lit(",".join(hits[name]) if name in hits else None).cast("string"),
            F.col(f"n{i}") if i < len(present) else F.lit(None).cast("bigint"),
        ]
    return df.agg(*filled).select(
        F.stack(F.lit(len(everything)), *cells).alias(
            "column", "role", "non_feature", "planned", "leaked", "missing_required",
            "text_type_warning", "pattern_hits", "filled_rows",
        )
    )


def guard_status(
    df: DataFrame, spec: TableSpec, params: AuditParams = AuditParams()
) -> tuple[str, str | None]:
    """(status, reason) as a fact about the schema."""
    absent = missing_required(df.columns, spec)
    if absent:
        return "fail", f"required columns missing: {absent}"
    leaked = leaked_features(df.columns, spec)
    if leaked and params.fail_if_non_feature:
        return "fail", f"non-feature columns among planned features: {leaked}"
    mistyped = mistyped_text(df, spec)
    if mistyped and params.warn_if_text_not_string:
        return "warn", f"text columns that are not strings: {mistyped}"
    return "ok", None


def guard_report(df: DataFrame, spec: TableSpec, params: AuditParams = AuditParams()) -> DataFrame:
    """The guard's verdict as one row."""
    status, reason = guard_status(df, spec, params)
    return small_frame(
        df.sparkSession,
        [
            (
                status,
                reason,
                non_features(df.columns, spec),
                spec.planned_features,
                leaked_features(df.columns, spec),
            )
        ],
        "status string, reason string, non_features array<string>, "
        "planned_features array<string>, leaked array<string>",
    )


def select_features(
    df: DataFrame, spec: TableSpec, params: AuditParams = AuditParams()
) -> DataFrame:
    """Only the planned feature columns; raises if the guard fails.

    It is a plain projection, so the scan reads just those columns.
    """
    status, reason = guard_status(df, spec, params)
    if status == "fail":
        raise FeatureGuardError(reason)
    banned = set(leaked_features(df.columns, spec))
    return df.select(
        *[quoted(c) for c in df.columns if c in set(spec.planned_features) - banned]
    )

