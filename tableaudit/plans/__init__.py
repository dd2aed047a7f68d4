"""Registered queries: each operator applied to the driver's tables, with its SQL check."""

from __future__ import annotations

from . import cleaning, conformance, leaks, profiles, scans, stages, texts, thresholds
from .registry import ORACLES, QUERIES

SECTIONS = (scans, conformance, cleaning, profiles, texts, thresholds, leaks, stages)

__all__ = ["ORACLES", "QUERIES", "SECTIONS"]
