"""Hygiene, parsing and casting on small hand-made tables."""

import unicodedata

import pytest
from support import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableaudit import AuditParams, ColumnSpec, TableSpec
from tableaudit.functions import parsing, text
from tableaudit.operators import cast, maps


def one(name, kind, **more):
    return TableSpec((ColumnSpec(name, kind, **more),))


def values(spark, cells):
    return spark.createDataFrame([(c,) for c in cells], "v string")


def evaluate(spark, cells, fn):
    got = values(spark, list(enumerate(cells)) and cells).select(
        F.monotonically_increasing_id().alias("i"), fn(F.col("v")).alias("r")
    )
    return [r["r"] for r in got.orderBy("i").collect()]


def test_normalize_matches_python(spark):
    cells = [
        None, "", "  a b ", " x ", "ﬁne", "１２，５",
        " wide　", "\x1fsep\x1c", "é", "Å", "tab\t", "﻿bom", "日本 ",
    ]

    def expected(v):
        if v is None:
            return None
        return unicodedata.normalize("NFKC", v.replace(" ", " ").strip())

    assert evaluate(spark, cells, text.normalize) == [expected(c) for c in cells]


def test_word_count_matches_python(spark):
    cells = ["", "   ", "one", " two  words ", "a b c\x1fd", "　你好 w\n\tz", "é è"]
    assert evaluate(spark, cells, text.word_count) == [len(c.split()) for c in cells]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\x00"), max_size=12), min_size=1, max_size=30))
def test_strip_and_words_match_python_on_any_text(spark, cells):
    got = values(spark, cells).select("v", text.strip(F.col("v")).alias("s"), text.word_count(F.col("v")).alias("w"))
    for r in got.collect():
        assert r["s"] == r["v"].strip()
        assert r["w"] == len(r["v"].split())


def test_number_parsing(spark):
    cells = ["7", "+7", "-0", "1.0", "1e3", "1.5", ".5", "5.", "12d", "x", "", None, "1 2", "inf", "9223372036854775808"]
    assert evaluate(spark, cells, parsing.to_long) == [
        7, 7, 0, 1, 1000, None, None, 5, None, None, None, None, None, None, None,
    ]
    assert evaluate(spark, cells, parsing.to_double) == [
        7.0, 7.0, -0.0, 1.0, 1000.0, 1.5, 0.5, 5.0, None, None, None, None, None,
        float("inf"), 9223372036854775808.0,
    ]
    big = ["9007199254740993", "9223372036854775807"]
    assert evaluate(spark, big, parsing.to_long) == [9007199254740993, 9223372036854775807]


def test_probes_know_unicode_digits_and_trim(spark):
    cells = [" 12 ", "+3", "١٢", "1.0", "1e5", "1,5", "1_0", " 7", "nan"]
    assert evaluate(spark, cells, parsing.int_probe) == [
        True, True, True, False, False, False, False, True, False,
    ]
    assert evaluate(spark, cells, parsing.float_probe) == [
        True, True, True, True, True, False, False, True, False,
    ]


@pytest.mark.parametrize(
    "fmt, pattern",
    [("%Y-%m-%d", "yyyy-M-d"), ("%d/%m/%Y", "d/M/yyyy"), ("%H:%M:%S", "H:m:s"), ("d.M.yyyy", "d.M.yyyy"),
     ("%Y-%m-%dT%H", "yyyy-M-d'T'H")],
)
def test_date_formats(fmt, pattern):
    assert parsing.datetime_pattern(fmt) == pattern


def test_unknown_directive_is_an_error():
    with pytest.raises(ValueError):
        parsing.datetime_pattern("%Q")


def test_date_format_is_chosen_per_column_or_per_row(spark):
    df = spark.createDataFrame([("2020-01-05",), ("6/1/2020",), ("2020-13-40",), (None,)], "d string")
    spec, params = one("d", "datetime"), AuditParams()
    day = lambda t: t.select(F.date_format("d", "yyyy-MM-dd")).collect()
    column = cast.cast_table(df, spec, params)
    assert [r[0] for r in day(column)] == ["2020-01-05", None, None, None]
    rules = cast.decide(df, spec, params, per_row=True)
    cellwise = cast.cast_table(df, spec, params, rules)
    assert [r[0] for r in day(cellwise)] == ["2020-01-05", "2020-01-06", None, None]


def test_second_format_is_used_when_the_first_never_fits(spark):
    df = spark.createDataFrame([("06/01/2020",), ("x",)], "d string")
    rules = cast.decide(df, one("d", "datetime"), AuditParams())
    assert rules["d"].date_format == "%d/%m/%Y"


def test_full_width_dates_are_seen_by_the_decision(spark):
    df = spark.createDataFrame([("０６/０１/２０２０",)], "d string")
    typed = cast.cast_table(df, one("d", "datetime"), AuditParams())
    assert typed.select(F.date_format("d", "yyyy-MM-dd")).first()[0] == "2020-01-06"


def test_decimal_comma_is_a_rule_of_the_column(spark):
    params = AuditParams(decimal_sep=",")
    with_dots = spark.createDataFrame([("1.234,56",), ("1.5",), (None,)], "v string")
    assert rows(cast.cast_table(with_dots, one("v", "float"), params)) == [(1234.56,), (15.0,), (None,)]
    without = spark.createDataFrame([("1234,56",), ("1.5",)], "v string")
    assert rows(cast.cast_table(without, one("v", "float"), params)) == [(1.5,), (1234.56,)]


def test_thousands_commas(spark):
    df = spark.createDataFrame([("1,234.5",), ("7",), ("n/a",)], "v string")
    typed = cast.cast_table(df, one("v", "float"), AuditParams())
    assert rows(typed) == [(1234.5,), (7.0,), (None,)]
    log = cast.cast_log(df, one("v", "float"), AuditParams()).first()
    assert (log["checked"], log["invalid_to_null"], log["over_limit"]) == (3, 1, True)


def test_nulls_are_not_counted_as_lost(spark):
    df = spark.createDataFrame([("1,000",), (None,), (None,)], "v string")
    log = cast.cast_log(df, one("v", "int"), AuditParams()).first()
    assert (log["checked"], log["invalid_to_null"], log["cast_fail_rate"]) == (1, 0, 0.0)


def test_booleans_need_a_map(spark):
    df = spark.createDataFrame([("Yes",), (" No ",), ("maybe",), (None,)], "b string")
    params = AuditParams(bool_maps={"b": {"Yes": True, "No": False}})
    typed = cast.cast_table(df, one("b", "bool"), params)
    assert [r[0] for r in typed.collect()] == [True, False, None, None]
    assert cast.cast_log(df, one("b", "bool"), params).first()["invalid_to_null"] == 1
    untouched = cast.cast_table(df, one("b", "bool"), AuditParams())
    assert [r[0] for r in untouched.collect()] == ["Yes", "No", "maybe", None]


def test_canonical_case_counts_changes(spark):
    df = spark.createDataFrame([("male",), ("MALE ",), ("Male",), ("other",), (None,)], "g string")
    params = AuditParams(canonical_cases={"g": {"male": "Male"}})
    typed = cast.cast_table(df, one("g", "category"), params)
    assert [r[0] for r in typed.collect()] == ["Male", "Male", "Male", "other", None]
    log = cast.cast_log(df, one("g", "category"), params).first()
    assert (log["trimmed"], log["case_normalized"]) == (1, 2)


def test_text_hygiene(spark):
    df = spark.createDataFrame([(" a ",), ("  ",), (None,), ("ok",)], "t string")
    assert rows(cast.text_hygiene(df, ["t"])) == [("t", 2, 4, 0.5)]


def test_cast_keeps_order_of_columns_and_extra_columns(spark):
    df = spark.createDataFrame([("1", " keep ", "2")], "b string, extra string, a string")
    spec = TableSpec((ColumnSpec("a", "int"), ColumnSpec("b", "float"), ColumnSpec("gone", "int")))
    typed = cast.cast_table(df, spec, AuditParams())
    assert typed.columns == ["b", "extra", "a"]
    assert typed.first() == (1.0, " keep ", 2)


def test_casting_again_changes_nothing(spark):
    df = spark.createDataFrame([(" 1,000 ", "5/1/2020"), ("x", "2020-01-01")], "n string, d string")
    spec = TableSpec((ColumnSpec("n", "int"), ColumnSpec("d", "datetime")))
    once = cast.cast_table(df, spec, AuditParams())
    assert rows(cast.cast_table(once, spec, AuditParams())) == rows(once)


def test_empty_table(spark):
    df = spark.createDataFrame([], "n string, d string")
    spec = TableSpec((ColumnSpec("n", "int"), ColumnSpec("d", "datetime")))
    assert cast.cast_table(df, spec, AuditParams()).count() == 0
    assert [r["checked"] for r in cast.cast_log(df, spec, AuditParams()).collect()] == [0, 0]


def test_python_runs_only_where_unicode_needs_it(spark):
    df = spark.createDataFrame([("plain", "café")], "a string, b string")
    spec = TableSpec((ColumnSpec("a"), ColumnSpec("b")))
    plan = cast.cast_table(df, spec, AuditParams())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    plain = cast.cast_table(df.select("a"), spec, AuditParams())
    assert "EvalPython" not in plain._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------ one pass, large maps

WIDE = TableSpec(
    (
        ColumnSpec("id", "int"), ColumnSpec("g", "category"), ColumnSpec("b", "bool"), ColumnSpec("d", "datetime"),
        ColumnSpec("absent", "float"), ColumnSpec("f", "float"),
    )
)
WIDE_PARAMS = AuditParams(canonical_cases={"g": {"male": "Male"}}, bool_maps={"b": {"Yes": True, "No": False}})


def wide(spark, n=500):
    return spark.range(n, numPartitions=4).selectExpr(
        "CASE WHEN id % 9 = 0 THEN 'x' ELSE CAST(id AS STRING) END AS id",
        "element_at(array('male', ' MALE', 'é ', NULL), CAST(id % 4 AS INT) + 1) AS g",
        "element_at(array('Yes', 'No ', 'maybe'), CAST(id % 3 AS INT) + 1) AS b",
        "CASE WHEN id % 5 = 0 THEN 'n' ELSE '2020-01-02' END AS d",
        "CAST(id AS DOUBLE) AS f", "concat('e', id) AS extra",
    )


def test_written_cast_and_its_log(spark, tmp_path):
    df, path = wide(spark), str(tmp_path / "out")
    for _ in range(2):  # a second run replaces the first
        log = cast.cast_and_write(df, WIDE, path, WIDE_PARAMS)
        assert rows(log) == rows(cast.cast_log(df, WIDE, WIDE_PARAMS))
        back = spark.read.parquet(path)
        assert back.columns == df.columns
        assert rows(back) == rows(cast.cast_table(df, WIDE, WIDE_PARAMS))
    empty = cast.cast_and_write(df.limit(0), WIDE, path, WIDE_PARAMS)
    assert rows(empty) == rows(cast.cast_log(df.limit(0), WIDE, WIDE_PARAMS)) and not spark.read.parquet(path).count()


def test_cast_and_log_read_the_source_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    source = wide(spark)
    rules = cast.decide(source, WIDE, WIDE_PARAMS)
    df = source.mapInArrow(counted, source.schema)
    cast.cast_and_write(df, WIDE, str(tmp_path / "once"), WIDE_PARAMS, rules)
    assert read.value == 500


def test_log_of_a_write_that_was_counted_twice(spark, tmp_path, monkeypatch):
    df = wide(spark)
    want = rows(cast.cast_log(df, WIDE, WIDE_PARAMS))
    original = cast.Observation
    monkeypatch.setattr(cast, "Observation", type("Twice", (original,), {"get": property(lambda self: {k: 2 * v for k, v in original.get.fget(self).items()})}))
    assert rows(cast.cast_and_write(df, WIDE, str(tmp_path / "twice"), WIDE_PARAMS)) == want


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_large_maps_equal_literals(spark, monkeypatch, limit):
    monkeypatch.setattr(maps, "MOST_BROADCAST_BYTES", limit)
    cells = [None, "", "K5", " k7 ", "nothing", "K99999"] * 20 + ["HOT"] * 400 + [f"k{i}" for i in range(0, 100000, 997)]
    df = spark.createDataFrame([(c, c) for c in cells], "g string, b string").repartition(4)
    names = {f"k{i}": f"Value {i}" for i in range(100_000)} | {"hot": "Hot"}
    flags = {f"K{i}": i % 2 == 0 for i in range(100_000)} | {"HOT": True}
    spec = TableSpec((ColumnSpec("g", "category"), ColumnSpec("b", "bool")))
    params = AuditParams(canonical_cases={"g": names}, bool_maps={"b": flags})
    clean = [c if c is None else c.strip() for c in cells]
    want = sorted(((names.get((c or "").lower(), c), flags.get(c)) for c in clean), key=repr)
    assert sorted((tuple(r) for r in cast.cast_table(df, spec, params).collect()), key=repr) == want
    log = {r["column"]: r for r in cast.cast_log(df, spec, params).collect()}
    assert log["g"]["case_normalized"] == sum(c is not None and names.get(c.lower(), c) != c for c in clean)
    assert log["b"]["invalid_to_null"] == sum(c is not None and c not in flags for c in clean)


def test_map_with_two_values_for_a_key(spark):
    df = spark.createDataFrame([("a",)], "g string")
    twice = spark.createDataFrame([("a", "A"), ("a", "B"), (None, "x"), ("b", "B"), ("b", "B")], "key string, value string")
    params = AuditParams(canonical_cases={"g": twice})
    with pytest.raises(ValueError, match=r"\['a'\]"):
        cast.cast_table(df, one("g", "category"), params)
    fine = AuditParams(canonical_cases={"g": twice.where("key = 'b' or key is null")})
    assert cast.cast_table(df, one("g", "category"), fine).first()["g"] == "a"
