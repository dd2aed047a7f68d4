"""Inferred date formats against a cell-by-cell reading."""

import datetime as dt
import random
import re

import pytest

from tableaudit import AuditParams, ColumnSpec, TableSpec
from tableaudit.operators import cast, conform, dateformats

SPEC = TableSpec((ColumnSpec("d", "datetime"),))
FREE = AuditParams(date_formats=())


def frame(spark, cells):
    return spark.createDataFrame([(c,) for c in cells], "d string").repartition(3)


def found(spark, cells, day_first=None):
    return {
        r["format"]: (r["cells"], r["share"], r["ambiguous"])
        for r in dateformats.date_formats(frame(spark, cells), ["d"], day_first).collect()
    }


def fits(cell, fmt):
    try:
        return bool(dt.datetime.strptime(cell.strip(), fmt))
    except ValueError:
        return False


def test_formats_equal_a_cell_by_cell_count(spark):
    rng = random.Random(2)
    formats = [f for fs in dateformats.SHAPES.values() for f in fs]
    for fmt in ("%Y-%m-%d", "%d/%m/%Y", "%m.%d.%Y %H:%M", "%d %b %Y", "%b %d, %Y", "%d-%b-%Y %H:%M:%S", "%Y/%m/%dT%H:%M:%S", "%d.%m.%y"):
        days = [dt.datetime(2001, 1, 1) + dt.timedelta(minutes=rng.randrange(8_000_000)) for _ in range(60)]
        cells = [d.strftime(fmt) for d in days] + ["31/02/2020", "n-n-Y", "hello", "x" * 50, "", "2020-1-5 "]
        got = found(spark, cells)
        for name, (n, share, ambiguous) in got.items():
            shape = next(s for s, fs in dateformats.SHAPES.items() if name in fs)
            sign = {"Y": r"\d{4}", "n": r"\d{1,2}", "a": "[A-Za-z]{2,}"}
            pattern = "".join(sign.get(c, re.escape(c)) for c in shape)
            want = sum(fits(c, name) and bool(re.fullmatch(pattern, c.strip())) for c in cells)
            assert n == want and share == round(want / len(cells), 6) and not ambiguous
        assert fmt in got and set(got) <= set(formats)


def test_day_and_month_either_way_round(spark):
    both = ["01/02/2020", "11/12/2019"]
    assert found(spark, both) == {"%d/%m/%Y": (2, 1.0, True), "%m/%d/%Y": (2, 1.0, True)}
    assert found(spark, both, day_first=True) == {"%d/%m/%Y": (2, 1.0, False)}
    assert found(spark, both, day_first=False) == {"%m/%d/%Y": (2, 1.0, False)}
    # One cell that fits one order alone decides; one of each leaves it open.
    assert found(spark, [*both, "13/02/2020"]) == {"%d/%m/%Y": (3, 1.0, False)}
    assert found(spark, [*both, "02/13/2020"]) == {"%m/%d/%Y": (3, 1.0, False)}
    mixed = found(spark, [*both, "13/02/2020", "02/13/2020"])
    assert {f: (n, a) for f, (n, _, a) in mixed.items()} == {"%d/%m/%Y": (3, True), "%m/%d/%Y": (3, True)}


def test_nothing_to_find(spark):
    assert found(spark, [None, "", "a", "2020-13-40"]) == {}
    assert found(spark, []) == {}
    assert dateformats.date_formats(frame(spark, ["2020-01-01"]), []).count() == 0


def test_cast_and_probe_without_declared_formats(spark):
    us = frame(spark, ["12/31/2019", " 01/02/2020", "x", None])
    got = sorted(str(r["d"]) for r in cast.cast_table(us, SPEC, FREE).collect())
    assert got == ["2019-12-31 00:00:00", "2020-01-02 00:00:00", "None", "None"]
    report = conform.parse_report(frame(spark, ["12/31/2019", "01/02/2020", "x"]), SPEC, FREE).first()
    assert (report["checked"], report["fails"]) == (3, 1)
    # Not guessed: nothing but ISO is read, unless the order is said.
    open_ = frame(spark, ["01/02/2020", "2020-03-04"])
    assert sorted(str(r["d"]) for r in cast.cast_table(open_, SPEC, FREE).collect()) == ["2020-03-04 00:00:00", "None"]
    one = frame(spark, ["01/02/2020"])
    for first, want in ((True, "2020-02-01"), (False, "2020-01-02"), (None, "None")):
        params = AuditParams(date_formats=(), day_first=first)
        assert str(cast.cast_table(one, SPEC, params).first()["d"]).startswith(want)


@pytest.mark.parametrize("n", [0, 3])
def test_the_driver_gets_shapes_not_cells(spark, n):
    df = frame(spark, ["2020-01-01", "free text", "12 apples"] * n)
    assert dateformats.shape_counts(df, ["d"]).count() == (1 if n else 0)
