"""Which date formats a text column is written in.

First a histogram of the cells' shapes (digits, letters and separators) says which
formats can occur at all; there are no more shapes than the list below has.  Then
one aggregate counts, for those formats only, the cells that parse.  Where day and
month could be either way round, the cells that fit one order alone decide; if
there are none, or some of each, the column is reported as ambiguous, not guessed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import quoted
from ..functions.parsing import parse_datetime
from ..functions.text import strip
from ..session import small_frame
from .counts import cells, with_names

# Shapes of dates with the formats they can stand for (Y four digits,
# n one or two, a letters), and what may follow as a time.
DATE_SHAPES = {
    "Y-n-n": ("%Y-%m-%d",),
    "Y/n/n": ("%Y/%m/%d",),
    "Y.n.n": ("%Y.%m.%d",),
    "n-n-Y": ("%d-%m-%Y", "%m-%d-%Y"),
    "n/n/Y": ("%d/%m/%Y", "%m/%d/%Y"),
    "n.n.Y": ("%d.%m.%Y", "%m.%d.%Y"),
    "n/n/n": ("%d/%m/%y", "%m/%d/%y"),
    "n.n.n": ("%d.%m.%y", "%m.%d.%y"),
    "n a Y": ("%d %b %Y",),
    "n-a-Y": ("%d-%b-%Y",),
    "a n, Y": ("%b %d, %Y",),
}
TIME_SHAPES = {"": "", " n:n": " %H:%M", " n:n:n": " %H:%M:%S", "Tn:n:n": "T%H:%M:%S"}
SHAPES = {
    date + time: tuple(f + tail for f in formats)
    for date, formats in DATE_SHAPES.items()
    for time, tail in TIME_SHAPES.items()
}
LONGEST = 32
SCHEMA = "column string, format string, cells bigint, share double, ambiguous boolean"


@dataclass(frozen=True)
class FormatFit:
    """How many cells of a column fit a format, out of those that are there."""

    column: str
    format: str
    cells: int
    present: int
    ambiguous: bool


def shape_of(cell: Column) -> Column:
    """The cell with each run of digits or letters as one sign; null where it is too long for a date."""
    shape = F.when(F.length(cell) <= LONGEST, cell)
    for run, sign in (("[A-Za-z]{2,}", "a"), ("[0-9]{5,}", "#"), ("[0-9]{4}", "Y"), ("[0-9]{3}", "#"), ("[0-9]{1,2}", "n")):
        shape = F.regexp_replace(shape, run, sign)
    return shape


def shape_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, shape, n)`` of the cells whose shape is one of a date."""
    long = cells(df, columns).select("slot", shape_of(strip(F.col("level"))).alias("shape"))
    counted = long.where(F.col("shape").isin(*SHAPES)).groupBy("slot", "shape").agg(F.count(F.lit(1)).alias("n"))
    return with_names(counted, columns)


def infer_formats(df: DataFrame, columns: Sequence[str], day_first: bool | None = None) -> list[FormatFit]:
    """The formats that fit cells of the columns, the best of each column first.

    ``day_first`` settles the order of day and month where the cells do not.
    """
    columns = list(columns)
    if not columns:
        return []
    seen = shape_counts(df, columns).collect()
    wanted = sorted({(r["column"], r["shape"]) for r in seen})
    aggs = [F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(columns)]
    for j, (column, shape) in enumerate(wanted):
        cell = strip(quoted(column))
        fits = [(shape_of(cell) == shape) & parse_datetime(cell, f).isNotNull() for f in SHAPES[shape]]
        aggs += [F.count_if(fit).alias(f"f{j}_{k}") for k, fit in enumerate(fits)]
        if len(fits) == 2:
            aggs += [F.count_if(fits[k] & ~fits[1 - k]).alias(f"o{j}_{k}") for k in range(2)]
    row = df.agg(*aggs).first()
    found = []
    for j, (column, shape) in enumerate(wanted):
        present = row[f"n{columns.index(column)}"]
        formats = SHAPES[shape]
        alone = [row[f"o{j}_{k}"] for k in range(2)] if len(formats) == 2 else []
        undecided = len(alone) == 2 and bool(alone[0]) == bool(alone[1])
        for k, fmt in enumerate(formats):
            n = row[f"f{j}_{k}"]
            if not n:
                continue
            if alone and not undecided and not alone[k]:
                continue
            if undecided and day_first is not None and day_first != (k == 0):
                continue
            found.append(FormatFit(column, fmt, n, present, undecided and day_first is None))
    return sorted(found, key=lambda f: (columns.index(f.column), -f.cells, f.format))


def date_formats(df: DataFrame, columns: Sequence[str], day_first: bool | None = None) -> DataFrame:
    """``(column, format, cells, share, ambiguous)``: share is of the cells that are not null."""
    rows = [
        (f.column, f.format, f.cells, round(f.cells / f.present, 6), f.ambiguous)
        for f in infer_formats(df, columns, day_first)
    ]
    return small_frame(df.sparkSession, rows, SCHEMA)


def chosen_formats(df: DataFrame, columns: Sequence[str], day_first: bool | None = None) -> dict[str, str]:
    """The format that fits most cells of each column; none where the best one is ambiguous."""
    best: dict[str, FormatFit] = {}
    for fit in infer_formats(df, columns, day_first):
        best.setdefault(fit.column, fit)
    return {c: f.format for c, f in best.items() if not f.ambiguous}
