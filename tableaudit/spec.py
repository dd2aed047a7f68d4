"""Declared schemas, column roles and audit thresholds.

These are plain metadata objects: they describe a table, they never hold one.
``from_mapping`` accepts the nested mappings a YAML or JSON loader returns.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

from . import defaults

TYPES = ("string", "category", "int", "float", "datetime", "bool")
ROLES = ("id", "label", "text", "date", "num", "cat", "tech")

_SPARK_TYPES = {
    "string": T.StringType(),
    "category": T.StringType(),
    "int": T.LongType(),
    "float": T.DoubleType(),
    "datetime": T.TimestampType(),
    "bool": T.BooleanType(),
}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str = "string"
    nullable: bool = True
    max_len: int | None = None
    role: str | None = None

    def spark_field(self) -> T.StructField:
        meta = {k: v for k, v in (("role", self.role), ("max_len", self.max_len)) if v is not None}
        meta["declared_type"] = self.type
        return T.StructField(
            self.name, _SPARK_TYPES.get(self.type, T.StringType()), self.nullable, meta
        )


@dataclass(frozen=True)
class TableSpec:
    """The declared columns of one table, with their roles."""

    columns: tuple[ColumnSpec, ...]
    non_feature_patterns: tuple[str, ...] = ()
    # Role lists as configured: (role, column names).  A column may have several
    # roles, and need not be declared.
    role_lists: tuple[tuple[str, tuple[str, ...]], ...] = ()

    @classmethod
    def from_mapping(cls, schema: Mapping, roles: Mapping | None = None) -> TableSpec:
        """Build from ``{"columns": [{name, type, ...}]}`` and ``{"id_cols": [...], ...}``.

        The role lists stand beside the declared columns: a name may be in
        several of them, and in none of the declared columns.
        """
        roles = roles or {}
        listed: dict[str, tuple[str, ...]] = {}
        for role in ROLES:
            names = roles.get("label_col" if role == "label" else f"{role}_cols") or ()
            listed[role] = (names,) if isinstance(names, str) else tuple(n for n in names if n)
        cols = [
            ColumnSpec(
                c["name"],
                c.get("type", "string"),
                bool(c.get("nullable", True)),
                c.get("max_len"),
                next((role for role in ROLES if c["name"] in listed[role]), None),
            )
            for c in schema["columns"]
        ]
        return cls(
            tuple(cols),
            tuple(roles.get("non_feature_cols_from_regex") or ()),
            tuple((role, names) for role, names in listed.items() if names),
        )

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def get(self, name: str) -> ColumnSpec | None:
        return next((c for c in self.columns if c.name == name), None)

    def with_role(self, *roles: str) -> list[str]:
        """Columns with any of these roles, listed ones first, each once."""
        listed = [n for role, names in self.role_lists if role in roles for n in names]
        return list(dict.fromkeys([*listed, *(c.name for c in self.columns if c.role in roles)]))

    def roles_of(self, name: str) -> list[str]:
        return [role for role in ROLES if name in self.with_role(role)]

    @property
    def mentioned(self) -> list[str]:
        """Declared columns, then those that only role lists name."""
        listed = (n for _, names in self.role_lists for n in names)
        return list(dict.fromkeys([*self.names, *listed]))

    @property
    def key(self) -> str | None:
        """The first id column."""
        ids = self.with_role("id")
        return ids[0] if ids else None

    @property
    def label(self) -> str | None:
        labels = self.with_role("label")
        return labels[0] if labels else None

    @property
    def planned_features(self) -> list[str]:
        return sorted(self.with_role("num", "cat", "date", "text"))

    def struct_type(self) -> T.StructType:
        return T.StructType([c.spark_field() for c in self.columns])

    def compiled_patterns(self) -> list[re.Pattern]:
        return compile_patterns(self.non_feature_patterns)


def compile_patterns(patterns: Iterable[str]) -> list[re.Pattern]:
    """Compile column-name patterns; a broken one is a configuration error."""
    compiled = []
    for pattern in patterns:
        try:
            compiled.append(re.compile(pattern))
        except re.error as exc:
            raise ValueError(f"bad column-name pattern {pattern!r}: {exc}") from exc
    return compiled


@dataclass(frozen=True)
class LabelRule:
    column: str
    allowed: tuple[str, ...] = ("Yes", "No")
    positive: str = "Yes"
    fail_on_invalid: bool = True
    sample_limit: int = 5

    @property
    def negatives(self) -> tuple[str, ...]:
        return tuple(v for v in self.allowed if v != self.positive)


@dataclass(frozen=True)
class AuditParams:
    """Reader options, limits and rules of an audit."""

    # reader
    encoding: str = "utf-8"
    delimiter: str = ","
    header: bool = True
    null_tokens: tuple[str, ...] = defaults.NULL_TOKENS
    # soft checks
    text_max_len: int = defaults.TEXT_MAX_LEN
    max_cast_fail_rate: float = defaults.MAX_CAST_FAIL_RATE
    max_missing_notice: float = defaults.MAX_MISSING_NOTICE
    # casting
    thousand_sep_policy: str = "homogeneous"
    decimal_sep: str = "."
    date_formats: tuple[str, ...] = defaults.DATE_FORMATS
    day_first: bool | None = None
    bool_maps: Mapping[str, Mapping[str, bool]] = field(default_factory=dict)
    canonical_cases: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    # keys
    fail_on_missing_key: bool = True
    fail_on_key_conflicts: bool = False
    # label
    label: LabelRule | None = None
    # feature guard
    fail_if_non_feature: bool = True
    warn_if_text_not_string: bool = True
    # profiling
    top_k: int = defaults.TOP_K
    rare_level: float = defaults.RARE_LEVEL
    quantiles: tuple[float, ...] = defaults.QUANTILES
    text_len_warn: int | None = defaults.TEXT_MAX_LEN
    pii_patterns: Mapping[str, str] = field(default_factory=lambda: dict(defaults.PII_PATTERNS))
    # leakage
    leakage_keywords: tuple[str, ...] = defaults.LEAKAGE_KEYWORDS
    auc_threshold: float = defaults.AUC_THRESHOLD
    min_support: int = defaults.MIN_SUPPORT
    future_year_max: int = defaults.FUTURE_YEAR_MAX
    date_order_pairs: tuple[tuple[str, str], ...] = ()
    # stage comparison
    label_share_atol: float = defaults.LABEL_SHARE_ATOL
    missing_share_atol: float = defaults.MISSING_SHARE_ATOL

    @classmethod
    def from_mapping(cls, tree: Mapping) -> AuditParams:
        """Read the nested parameter mapping an audited project keeps in its config.

        The key names are fixed values: they have to match the mapping.
        """

        def at(*path):
            node = tree
            for step in path:
                node = (node or {}).get(step) if isinstance(node, Mapping) else None
            return node

        found = {
            "encoding": at("reader_params", "encoding"),
            "delimiter": at("reader_params", "delimiter"),
            "header": at("reader_params", "header"),
            "null_tokens": at("reader_params", "na_values"),
            "text_max_len": at("soft_checks", "notes_max_len"),
            "max_cast_fail_rate": at("soft_checks", "max_cast_fail_rate"),
            "max_missing_notice": at("soft_checks", "max_missing_rate_notice"),
            "thousand_sep_policy": at("casting", "numeric_thousand_sep_policy"),
            "decimal_sep": at("casting", "decimal_sep"),
            "date_formats": at("casting", "datetime", "formats"),
            "bool_maps": at("booleans", "mappings"),
            "canonical_cases": at("categories", "canonical_cases"),
            "fail_on_missing_key": at("dedup", "fail_on_missing_key"),
            "fail_on_key_conflicts": at("dedup", "fail_on_key_conflicts"),
            "fail_if_non_feature": at("guards", "fail_if_non_feature_in_X"),
            "warn_if_text_not_string": at("guards", "warn_if_text_not_string"),
            "top_k": at("profiling", "top_k_categories"),
            "rare_level": at("profiling", "rare_level_threshold"),
            "quantiles": at("profiling", "quantiles"),
            "text_len_warn": at("notes_profiling", "max_len_chars_warn"),
            "pii_patterns": at("notes_profiling", "pii_patterns"),
            "leakage_keywords": at("leakage", "keyword_patterns"),
            "auc_threshold": at("leakage", "near_perfect", "auc_threshold"),
            "min_support": at("leakage", "near_perfect", "min_support"),
            "future_year_max": at("leakage", "temporal", "future_year_max"),
            "date_order_pairs": at("leakage", "temporal", "check_order_pairs"),
            "label_share_atol": at("sanity", "label_share_atol"),
            "missing_share_atol": at("sanity", "missing_share_atol"),
        }
        kwargs = {}
        for name, value in found.items():
            if value is None:
                continue
            if isinstance(value, (list, tuple)):
                value = tuple(tuple(v) if isinstance(v, list) else v for v in value)
            kwargs[name] = value
        for name in ("max_cast_fail_rate", "max_missing_notice", "rare_level", "auc_threshold",
                     "label_share_atol", "missing_share_atol"):
            if name in kwargs:
                kwargs[name] = float(kwargs[name])
        rule = at("label_validation")
        if rule:
            allowed = tuple(rule.get("allowed_values", ("Yes", "No")))
            kwargs["label"] = LabelRule(
                rule.get("column", "Churn"),
                allowed,
                rule.get("positive_class", allowed[0] if allowed else "Yes"),
                bool(rule.get("fail_on_invalid", True)),
                int(rule.get("sample_invalid_limit", 5)),
            )
        return cls(**kwargs)
