"""Spark toolkit for auditing, cleaning and profiling labelled tables."""

from .spec import AuditParams, ColumnSpec, TableSpec

__all__ = ["AuditParams", "ColumnSpec", "TableSpec"]
