"""Conformance, duplicates, keys and feature roles."""

import pytest
from support import rows

from tableaudit import AuditParams, ColumnSpec, TableSpec
from pyspark.sql import functions as F

from tableaudit.operators import conform, dedup, leakage, roles

SPEC = TableSpec(
    (
        ColumnSpec("id", "string", False, role="id"),
        ColumnSpec("y", "category", False, role="label"),
        ColumnSpec("n", "int", role="num"),
        ColumnSpec("t", "string", max_len=3, role="text"),
    ),
    non_feature_patterns=("^raw_",),
)


def table(spark):
    return spark.createDataFrame(
        [("a", "Yes", "1", "abcd"), ("b", None, "1.5", None), (None, "No", "x", "ab"), ("", "No", None, "")],
        "id string, y string, n string, t string",
    )


def test_parse_report(spark):
    got = {r["column"]: r for r in conform.parse_report(table(spark), SPEC).collect()}
    assert (got["n"]["checked"], got["n"]["fails"], got["n"]["severity"]) == (3, 2, "mismatch")
    assert got["n"]["cast_fail_rate"] == 0.666667
    assert got["y"]["severity"] == "ok"


def test_failures_at_the_limit_are_a_warning(spark):
    df = spark.createDataFrame([("x",)] + [("1",)] * 49, "n string")
    spec = TableSpec((ColumnSpec("n", "int"),))
    assert conform.parse_report(df, spec).first()["severity"] == "warning"
    assert conform.parse_report(df, spec, AuditParams(max_cast_fail_rate=0.01)).first()["severity"] == "mismatch"


def test_all_null_column_has_rate_zero(spark):
    df = spark.createDataFrame([(None,), (None,)], "n string")
    r = conform.parse_report(df, TableSpec((ColumnSpec("n", "int"),))).first()
    assert (r["checked"], r["fails"], r["cast_fail_rate"], r["severity"]) == (0, 0, 0.0, "ok")


def test_column_differences_and_status(spark):
    df = table(spark).drop("t").withColumnRenamed("n", "m")
    got = rows(conform.column_differences(df, SPEC))
    assert got == [("m", "unexpected", 3), ("n", "missing", None), ("t", "missing", None)]
    one = conform.conformance(df, SPEC).first()
    assert (one["status"], one["n_rows"], one["n_missing"], one["n_unexpected"]) == ("warn", 4, 2, 1)
    ok = conform.conformance(table(spark).drop("n", "t"), TableSpec(SPEC.columns[:2])).first()
    assert ok["status"] == "ok"


def test_critical_gate(spark):
    df = table(spark).drop("y")
    assert conform.conformance(df, SPEC).first()["status"] == "fail"
    with pytest.raises(conform.CriticalColumnsMissing):
        conform.require_critical(df, SPEC)
    assert conform.require_critical(table(spark), SPEC) is not None


def test_lengths_and_nulls(spark):
    assert rows(conform.length_report(table(spark), SPEC)) == [("t", 3, 1)]
    assert rows(conform.nullability_report(table(spark), SPEC)) == [("id", 2, False), ("y", 1, False)]


def test_types(spark):
    df = spark.createDataFrame([("a", "Yes", 1, True)], "id string, y string, n long, t boolean")
    got = {r["column"]: (r["found"], r["ok"]) for r in conform.type_report(df, SPEC).collect()}
    assert got == {"id": ("string", True), "y": ("string", True), "n": ("int", True), "t": ("bool", False)}
    assert not conform.types_match(df, SPEC)


DUPES = [
    ("k1", "a", None), ("k1", "a", None), ("k1", "b", None), ("k2", "c", "z"),
    (None, "x", None), (None, "x", "y"), ("", "q", None), ("k3", "s", "s"), ("k3", "s", "s"),
]


def dupes(spark):
    return spark.createDataFrame(DUPES, "id string, a string, b string")


def test_duplicates(spark):
    df = dupes(spark)
    assert rows(dedup.duplicate_counts(df)) == [(9, 7, 2, 2)]
    assert dedup.drop_exact_duplicates(df).count() == 7
    assert rows(dedup.missing_keys(df, "id")) == [(9, 3)]


def test_conflicts_include_the_null_key(spark):
    got = {r["id"]: (r["row_count"], r["diff_columns"]) for r in dedup.key_conflicts(dupes(spark), "id").collect()}
    assert got == {"k1": (2, ["a"]), None: (2, ["b"])}


def test_conflict_samples_put_the_null_key_last(spark):
    one = dedup.conflict_samples(dupes(spark), "id", 1).collect()
    assert [(r["id"], r["row_count"], r["diff_columns"]) for r in one] == [("k1", 2, ["a"])]
    both = dedup.conflict_samples(dupes(spark), "id", 10).collect()
    assert {r["id"] for r in both} == {"k1", None}


def test_summary(spark):
    r = dedup.dedup_summary(dupes(spark), "id", AuditParams(fail_on_key_conflicts=True)).first()
    assert r.asDict() == {
        "n_rows_raw": 9, "n_rows_clean": 7, "duplicates_exact_removed": 2, "duplicates_exact_groups": 2,
        "key_conflict_groups": 2, "key_conflict_rows": 4, "key_null_count": 3, "n_cols": 3, "status": "fail",
    }
    assert dedup.dedup_summary(dupes(spark), "id").first()["status"] == "ok"
    keyless = dedup.dedup_summary(dupes(spark), None).first()
    assert (keyless["key_null_count"], keyless["key_conflict_groups"]) == (9, 0)


def test_empty_table_has_no_duplicates(spark):
    df = spark.createDataFrame([], "id string, a string")
    assert rows(dedup.duplicate_counts(df)) == [(0, 0, 0, 0)]
    assert dedup.dedup_summary(df, "id").first()["n_rows_raw"] == 0


def test_key_gate(spark):
    df = dupes(spark).drop("id")
    with pytest.raises(ValueError):
        dedup.require_key(df, SPEC)
    assert dedup.require_key(df, SPEC, AuditParams(fail_on_missing_key=False)) is None


def test_removed_plus_kept_is_everything(spark):
    r = dedup.duplicate_counts(dupes(spark)).first()
    assert r["duplicates_removed"] + r["rows_after"] == r["rows_before"]


def test_roles():
    columns = ["id", "y", "n", "t", "raw_n"]
    assert roles.non_features(columns, SPEC) == ["id", "raw_n", "y"]
    assert roles.leaked_features(columns, SPEC) == []
    leaky = TableSpec(SPEC.columns, ("^n$",))
    assert roles.leaked_features(columns, leaky) == ["n"]
    assert roles.pattern_hits(columns, ["(?i)^RAW", "n$"]) == [("n", "n$"), ("raw_n", "(?i)^RAW"), ("raw_n", "n$")]
    with pytest.raises(ValueError):
        roles.pattern_hits(columns, ["("])


def test_guard(spark):
    df = table(spark)
    assert roles.select_features(df, SPEC).columns == ["n", "t"]
    leaky = TableSpec(SPEC.columns, ("^n$",))
    with pytest.raises(roles.FeatureGuardError):
        roles.select_features(df, leaky)
    relaxed = AuditParams(fail_if_non_feature=False)
    assert roles.select_features(df, leaky, relaxed).columns == ["t"]
    with pytest.raises(roles.FeatureGuardError):
        roles.select_features(df.drop("id"), SPEC)
    typed = spark.createDataFrame([("a", "Yes", 1, 5)], "id string, y string, n long, t long")
    assert roles.guard_status(typed, SPEC)[0] == "warn"
    assert roles.guard_report(df, SPEC).first()["status"] == "ok"


def test_roles_follow_the_lists(spark):
    """A column may have two roles, and need not be declared."""
    spec = TableSpec.from_mapping(
        {"columns": [{"name": "a"}, {"name": "id"}]},
        {"id_cols": ["id", "id2"], "cat_cols": ["a", "id"], "tech_cols": ["t"], "label_col": "y"},
    )
    df = spark.createDataFrame([("x", "1", "k", "no")], "a string, id string, t string, y string")
    assert (spec.key, spec.label) == ("id", "y")
    assert roles.non_features(df.columns, spec) == ["id", "id2", "t", "y"]
    assert roles.leaked_features(df.columns, spec) == ["id"]
    assert roles.missing_required(df.columns, spec) == ["id2"]
    assert leakage.candidates(df, spec) == ["a"]
    assert roles.guard_status(df, spec)[0] == "fail"
    got = {r["column"]: (r["role"], r["leaked"], r["missing_required"]) for r in roles.role_report(df, spec).collect()}
    assert got == {
        "a": ("cat", False, False), "id": ("id,cat", True, False), "t": ("tech", False, False),
        "y": ("label", False, False), "id2": ("id", False, True),
    }


def test_specs_from_mappings():
    spec = TableSpec.from_mapping(
        {"columns": [{"name": "k", "type": "string", "nullable": False}, {"name": "v", "type": "float"}]},
        {"id_cols": ["k"], "num_cols": ["v"], "label_col": "y", "tech_cols": [], "non_feature_cols_from_regex": ["^_"]},
    )
    assert (spec.key, spec.planned_features, spec.non_feature_patterns) == ("k", ["v"], ("^_",))
    fields = spec.struct_type()
    assert fields["k"].metadata["role"] == "id" and not fields["k"].nullable
    params = AuditParams.from_mapping(
        {
            "soft_checks": {"max_cast_fail_rate": 0.5},
            "casting": {"decimal_sep": ",", "datetime": {"formats": ["%d.%m.%Y"]}},
            "label_validation": {"column": "y", "allowed_values": ["a", "b"], "positive_class": "b"},
            "leakage": {"temporal": {"check_order_pairs": [["x", "z"]]}},
            "sanity": {"label_share_atol": "1e-6"},
        }
    )
    assert params.max_cast_fail_rate == 0.5 and params.decimal_sep == ","
    assert params.date_formats == ("%d.%m.%Y",) and params.date_order_pairs == (("x", "z"),)
    assert params.label.positive == "b" and params.label.negatives == ("a",)
    assert params.label_share_atol == 1e-6


def wide_rows(spark):
    """Copies, keys with differing texts, nulls that change places, signed zeros and NaN."""
    data = [
        (i % 40, f"text {i % 90}", None if i % 7 else "x", "x" if i % 7 else None, [0.0, -0.0, float("nan"), 1.5][i % 4])
        for i in range(900)
    ] + [(None, None, None, None, None)] * 3
    return spark.createDataFrame(data, "id int, text string, a string, b string, z double").repartition(7)


def shared_digest(df):
    """Far too short a digest: different rows share it."""
    return [F.pmod(F.xxhash64(*df.columns), F.lit(5)), F.lit(0).cast("bigint")]


@pytest.mark.parametrize("digest", [dedup.row_digest, shared_digest])
def test_digests_give_the_counts_of_the_rows(spark, digest):
    df = wide_rows(spark)
    distinct = dedup.distinct_rows(df)
    n, groups = distinct.count(), distinct.where("__copies > 1").count()
    assert rows(dedup.duplicate_counts(df, digest)) == [(903, n, 903 - n, groups)]
    for most in (10, 10**6):
        kept = dedup.drop_exact_duplicates(df, digest, most)
        assert kept.columns == df.columns and kept.count() == n
        assert rows(kept.select("id", "text", "a", "b")) == rows(df.dropDuplicates().select("id", "text", "a", "b"))
    want = dedup._key_figures(distinct.select(F.col("id").alias("key"), "__copies", F.lit(False).alias("mixed"))).first()
    got = dedup.dedup_summary(df, "id", digest=digest).first()
    for name in ("n_rows_raw", "n_rows_clean", "key_conflict_groups", "key_conflict_rows", "key_null_count"):
        assert got[name] == want[name]
    assert got["duplicates_exact_groups"] == groups and got["n_cols"] == 5


def test_a_shared_digest_is_seen(spark):
    df = wide_rows(spark)
    assert not dedup.digest_counts(df).where("mixed").count()
    assert dedup.digest_counts(df, "id", shared_digest).where("mixed").count()
    assert not dedup.drop_exact_duplicates(df.limit(0)).count()
    assert dedup.dedup_summary(df.limit(0), "id").first()["n_rows_raw"] == 0
    plain = spark.range(5).withColumn("t", F.lit("a"))
    assert dedup.drop_exact_duplicates(plain).count() == 5


def exchanged(df):
    """What crosses the exchanges of a plan, by the formatted plan."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    parts = [p for p in text.split("\n\n") if ") Exchange" in p.split("\n")[0]]
    assert parts
    return " ".join(next(line for line in p.split("\n") if line.startswith("Input")) for p in parts)


def test_no_text_crosses_an_exchange_of_the_counts(spark):
    df = wide_rows(spark).coalesce(3)
    for plan in (dedup._key_figures(dedup.digest_counts(df, "id")), dedup.digest_counts(df)):
        moved = exchanged(plan.select("*"))
        assert "__digest_0" in moved
    import re
    source = spark.createDataFrame([(1, "a", "b")], "id int, text string, a string")
    moved = exchanged(dedup._key_figures(dedup.digest_counts(source, "id")))
    assert not re.search(r"\b(text|a)#", moved) and "key#" in moved
