"""Text hygiene as column expressions."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters a Python string strips and splits on.
SPACES = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)
# Every other character, the common ones first: a regex engine tests the parts
# of a class in turn.
WORD_CLASS = (
    r"[\x21-\x{84}\x{a1}-\x{167f}\x{3001}-\x{10ffff}\x00-\x08\x0e-\x1b\x{86}-\x{9f}"
    r"\x{1681}-\x{1fff}\x{200b}-\x{2027}\x{202a}-\x{202e}\x{2030}-\x{205e}\x{2060}-\x{2fff}]"
)
NBSP = "\u00a0"
NON_ASCII = r"[^\x00-\x7f]"


def strip(value: Column) -> Column:
    """Remove white space at both ends, with Python's idea of white space."""
    return F.btrim(value, F.lit(SPACES))


def _nfkc(value: Column) -> Column:
    # Defined inside, so that it travels to the workers by value and they need
    # no copy of this package.
    def compose(cells: pa.Array) -> pa.Array:
        # Not Arrow's own function: in this version it leaves letters and
        # accents apart.
        return pa.array(
            [v if v is None else unicodedata.normalize("NFKC", v) for v in cells.to_pylist()],
            pa.string(),
        )

    return F.arrow_udf(compose, T.StringType())(value)


def nfkc(value: Column) -> Column:
    """Unicode NFKC.

    Spark has no such function, so the work is done on Arrow batches.  Plain
    ASCII is its own normal form; those cells travel as nulls and cost nothing.
    """
    return F.coalesce(_nfkc(F.when(value.rlike(NON_ASCII), value)), value)


def normalize(value: Column, unicode_form: bool = True) -> Column:
    """Hard spaces to spaces, strip, then NFKC.  Null stays null."""
    stripped = strip(F.replace(value, F.lit(NBSP), F.lit(" ")))
    return nfkc(stripped) if unicode_form else stripped


def word_count(value: Column) -> Column:
    """Number of pieces between runs of white space.

    Every piece shrinks to one letter, then the spaces go: what is left has
    one character per piece, and no array of pieces is ever built.
    """
    letters = F.regexp_replace(value, f"{WORD_CLASS}+", "w")
    return F.length(F.translate(letters, SPACES, ""))


def search(value: Column, pattern: str) -> Column:
    r"""Regex search in which ``\d``, ``\s`` and ``\b`` know all of Unicode."""
    return value.rlike("(?U)" + pattern)


# Fixed value: a token is a run of two or more letters, digits or underscores.
TOKEN = r"[a-z\p{L}\p{N}_]{2,}"


def tokens(value: Column) -> Column:
    return F.regexp_extract_all(F.lower(value), F.lit(TOKEN), F.lit(0))
