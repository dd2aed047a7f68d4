"""Parsing text cells into numbers, dates and booleans; failures become null."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# What counts as a number in a schema probe (any decimal digit)
# and in a cast (ASCII digits only, plus infinity).
INT_PROBE = r"\A[+-]?\p{Nd}+\z"
FLOAT_PROBE = r"\A[+-]?((\p{Nd}+(\.\p{Nd}*)?)|(\.\p{Nd}+))([eE][+-]?\p{Nd}+)?\z"
WHOLE_NUMBER = r"\A[+-]?[0-9]+\z"
NUMBER = r"\A[+-]?(([0-9]+(\.[0-9]*)?)|(\.[0-9]+))([eE][+-]?[0-9]+)?\z"
INFINITE = r"\A[+-]?(?i:inf|infinity)\z"

# Strptime directives and the datetime pattern letters that
# accept the same text (one or two digits for day, month, hour ...).
_STRPTIME = {
    "%Y": "yyyy", "%m": "M", "%d": "d", "%H": "H", "%M": "m", "%S": "s",
    "%y": "yy", "%b": "MMM", "%B": "MMMM", "%p": "a", "%I": "h", "%j": "D",
    "%f": "SSSSSS", "%z": "XX", "%%": "%",
}


def datetime_pattern(fmt: str) -> str:
    """Translate a strptime format; anything without ``%`` is already a pattern."""
    if "%" not in fmt:
        return fmt
    out, i = [], 0
    while i < len(fmt):
        if fmt[i] == "%":
            directive = fmt[i : i + 2]
            if directive not in _STRPTIME:
                raise ValueError(f"unsupported date directive {directive!r} in {fmt!r}")
            out.append(_STRPTIME[directive])
            i += 2
        else:
            out.append(f"'{fmt[i]}'" if fmt[i].isalpha() else fmt[i])
            i += 1
    return "".join(out)


# The ISO forms tried when no format is declared.
ISO_PATTERNS = (
    "yyyy-M-d",
    "yyyy-M-d H:m:s",
    "yyyy-M-d'T'H:m:s",
    "yyyy-M-d'T'H:m:s[.SSSSSS]",
    "yyyy-M-d'T'H:m:s[.SSSSSS]XXX",
)
_QUOTED = re.compile(r"'[^']*'")
_ZONED_TEXT = r"(?i)[0-9 ](?:Z|UTC|GMT|[+-][0-9]{1,2}:?[0-9]{2})\s*$"


def micros_of(wall: Column) -> Column:
    """Microseconds of a wall-clock time (date or timestamp without zone) read as UTC, in any session."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, wall.cast("timestamp_ntz"))


def utc_instant(wall: Column) -> Column:
    return F.timestamp_micros(micros_of(wall))


def utc_of_text(value: Column) -> Column:
    """A date or time as Spark reads it; without a zone of its own it is UTC, in any session."""
    return F.when(value.rlike(_ZONED_TEXT), F.try_to_timestamp(value)).otherwise(
        utc_instant(value.try_cast("timestamp_ntz"))
    )


def parse_datetime(value: Column, fmt: str) -> Column:
    """The instant, or null.  Where the format has no zone the text is UTC, whatever the session's zone."""
    pattern = datetime_pattern(fmt)
    if any(c in _QUOTED.sub("", pattern) for c in "XxZzVO"):
        return F.try_to_timestamp(value, F.lit(pattern))
    return F.try_to_timestamp(F.concat(value, F.lit(" Z")), F.lit(f"{pattern} X"))


def parse_datetime_any(value: Column, formats) -> Column:
    """First format that fits, cell by cell."""
    return F.coalesce(*[parse_datetime(value, f) for f in (formats or ISO_PATTERNS)])


def int_probe(value: Column) -> Column:
    return strip(value).rlike(INT_PROBE)


def float_probe(value: Column) -> Column:
    return strip(value).rlike(FLOAT_PROBE)


def to_double(value: Column) -> Column:
    """Guarded: the plain cast would also read ``12d`` as a number."""
    shaped = value.rlike(NUMBER) | value.rlike(INFINITE)
    return F.when(shaped, value.try_cast("double"))


def to_long(value: Column) -> Column:
    """Whole numbers stay exact; ``1.0`` and ``1e3`` count as whole, ``1.5`` does not."""
    number = F.when(value.rlike(NUMBER), value.try_cast("double"))
    fits = (F.abs(number) < F.lit(2.0**63)) & (F.floor(number) == number)
    return F.when(value.rlike(WHOLE_NUMBER), value.try_cast("bigint")).otherwise(
        F.when(fits, number.try_cast("bigint"))
    )


def lookup(value: Column, mapping: Mapping) -> Column:
    """Map lookup; an unmapped or null cell gives null."""
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    return F.element_at(F.create_map(*pairs), value)


def to_bool(value: Column, mapping: Mapping[str, bool]) -> Column:
    return lookup(value, mapping)


def canonical_case(value: Column, mapping: Mapping[str, str]) -> Column:
    return F.coalesce(lookup(F.lower(strip(value)), mapping), value)
