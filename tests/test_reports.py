"""Profiles, label, missingness, leakage and stage comparison."""

import math
import random

import pandas as pd
import pytest
from support import rows
from pyspark.sql import functions as F

from tableaudit import AuditParams, ColumnSpec, TableSpec
from tableaudit.operators import counts, label, leakage, missingness, profile, sanity, textprofile
from tableaudit.spec import LabelRule

RULE = LabelRule("y", ("Yes", "No"), "Yes")


def numbers(spark, n=3000, seed=7):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        hot = 1.5 if i % 3 == 0 else rng.gauss(0, 10)
        data.append(
            (
                rng.randrange(5),
                hot,
                None if rng.random() < 0.2 else float("nan") if rng.random() < 0.1 else rng.random(),
                2**60 + rng.randrange(4),
                None,
                "Yes" if rng.random() < 0.3 else "No",
            )
        )
    return spark.createDataFrame(data, "few long, hot double, gaps double, big long, none double, y string")


def brute_auc(pairs):
    pos = [v for v, y in pairs if y]
    neg = [v for v, y in pairs if not y]
    wins = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


def test_numeric_profile_matches_pandas(spark):
    df = numbers(spark).select("few", "hot", "gaps", "none").repartition(5)
    pdf = pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns).astype(float)
    got = {r["column"]: r for r in profile.numeric_profile(df).collect()}
    for c in ("few", "hot", "gaps"):
        s = pdf[c].dropna()
        r = got[c]
        assert r["count"] == len(pdf) and r["n_unique"] == s.nunique()
        assert r["missing_share"] == round(1 - len(s) / len(pdf), 6)
        for name, want in (
            ("min", s.min()), ("max", s.max()), ("mean", s.mean()), ("std", s.std()),
            *((f"p{int(q * 100)}", s.quantile(q)) for q in (0.05, 0.25, 0.5, 0.75, 0.95)),
        ):
            assert r[name] == pytest.approx(want, rel=1e-9, abs=1e-12), (c, name)
    empty = got["none"]
    assert (empty["n_unique"], empty["missing_share"], empty["mean"], empty["p50"]) == (0, 1.0, None, None)


def test_long_integers_stay_distinct(spark):
    r = profile.numeric_profile(numbers(spark), ["big"]).first()
    assert r["n_unique"] == 4


def test_one_value_has_no_spread(spark):
    df = spark.createDataFrame([(4.0,), (None,)], "v double")
    r = profile.numeric_profile(df).first()
    assert (r["std"], r["p5"], r["p95"], r["mean"]) == (0.0, 4.0, 4.0, 4.0)


def test_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "v double, s string")
    assert profile.numeric_profile(df).first()["count"] == 0
    assert profile.categorical_profile(df).first()["n_unique"] == 0


def test_results_do_not_depend_on_the_ranges(spark):
    df = numbers(spark)
    items = [counts.Numeric.of(df, c) for c in ("few", "hot", "gaps")]
    results = []
    for borders in ([[], [], []], [[1.0, 3.0], [1.5], [0.1, 0.2, 0.9]], [[-5.0], [-1.0, 0.0, 1.5, 2.0], [2.0]]):
        c = counts.ranged_counts(df, items, borders, {"n_pos": F.col("y") == "Yes", "n_neg": F.col("y") == "No"})
        auc = [(r["slot"], round(r["auc"], 12)) for r in counts.area_under_curve(c).orderBy("slot").collect()]
        q = [tuple(r) for r in counts.exact_quantiles(c, (0.0, 0.1, 0.33, 1.0)).orderBy("slot", "q").collect()]
        results.append((auc, q))
    assert results[0] == results[1] == results[2]


def test_counts_add_up(spark):
    df = numbers(spark)
    total = counts.level_counts(df, ["few", "y", "none"]).agg(F.sum("n")).first()[0]
    assert total == 3 * df.count()


def test_auc_against_all_pairs(spark):
    df = numbers(spark, 400)
    got = {r["column"]: r for r in leakage.univariate_auc(df, RULE, ["few", "hot", "gaps", "none"]).collect()}
    data = df.collect()
    for c in ("few", "hot", "gaps"):
        pairs = [(r[c], r["y"] == "Yes") for r in data if r[c] is not None and not math.isnan(r[c])]
        assert got[c]["auc"] == round(brute_auc(pairs), 6)
        assert got[c]["auroc"] == round(max(brute_auc(pairs), 1 - brute_auc(pairs)), 6)
    assert got["none"]["auc"] is None


def test_auc_of_the_mirrored_column(spark):
    df = numbers(spark, 500).withColumn("mirror", -F.col("hot"))
    a, b = (r["auc"] for r in leakage.univariate_auc(df, RULE, ["hot", "mirror"]).orderBy("column").collect())
    assert a + b == pytest.approx(1.0, abs=2e-6)


def test_auc_needs_two_classes_and_clean_labels(spark):
    one = spark.createDataFrame([(1.0, "Yes"), (2.0, "Yes")], "x double, y string")
    assert leakage.univariate_auc(one, RULE, ["x"]).first()["auc"] is None
    dirty = spark.createDataFrame([(1.0, "Yes"), (2.0, None), (0.0, "No")], "x double, y string")
    assert leakage.univariate_auc(dirty, RULE, ["x"]).first()["auc"] is None
    perfect = spark.createDataFrame([(1.0, "No"), (2.0, "Yes")], "x double, y string")
    assert leakage.near_perfect(perfect, RULE, ["x"]).first()["auroc"] == 1.0


def test_pure_levels_count_null_as_a_level(spark):
    data = [(None, "Yes")] * 3 + [("a", "No")] * 3 + [("b", "Yes"), ("b", "No")] * 3 + [("c", "maybe")] * 5 + [("d", "No")]
    df = spark.createDataFrame(data, "x string, y string")
    got = rows(leakage.pure_levels(df, RULE, ["x", "y"], 3))
    assert got == sorted([("x", None, 3, "Yes"), ("x", "a", 3, "No")], key=repr)


def test_top_levels_and_rare_share(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 3 + [("c",)] * 3 + [("d",), ("",), (None,)], "x string")
    top = [(r["position"], r["level"], r["n"]) for r in profile.top_levels(df, ["x"], 3).orderBy("position").collect()]
    assert top == [(1, "a", 5), (2, "b", 3), (3, "c", 3)]
    r = profile.categorical_profile(df, ["x"], 2, 0.1).first()
    assert (r["n_unique"], r["rare_share"], r["missing_share"], r["count"]) == (4, round(1 / 12, 6), round(2 / 14, 6), 14)
    assert [t["level"] for t in r["top_levels"]] == ["a", "b"]


def long_tail(spark, n=6000):
    """Near-unique, hot with a tail, few levels, and gaps; the label follows some of them."""
    return spark.range(n, numPartitions=5).selectExpr(
        "concat('id-', id) AS near_unique",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN 'warm' ELSE concat('t', id) END AS tail",
        "concat('l', id % 4) AS few",
        "CASE WHEN id % 5 = 0 THEN NULL WHEN id % 5 = 1 THEN '' ELSE concat('g', id % 40) END AS gaps",
        "CASE WHEN id % 11 = 0 THEN 'maybe' WHEN id % 3 = 0 THEN 'Yes' ELSE 'No' END AS y",
    )


@pytest.mark.parametrize("buckets", [1, 16, 1 << 16])
def test_pruned_reports_equal_the_full_ones(spark, buckets):
    df, columns = long_tail(spark), ["near_unique", "tail", "few", "gaps"]
    for k in (1, 3, 10):
        full = rows(profile.top_levels(df, columns, k))
        assert rows(profile.top_levels_pruned(df, columns, k, buckets)) == full
    for rare in (0.0001, 0.01, 0.3):
        wide = {r["column"]: r["rare_share"] for r in profile.categorical_profile(df, columns, 3, rare).collect()}
        assert {r["column"]: r["rare_share"] for r in profile.rare_shares(df, columns, rare, buckets).collect()} == wide
    for support in (1, 2, 5, 500):
        counted = counts.level_counts(df, columns, {"p": F.col("y") == "Yes", "q": F.col("y") == "No"}).collect()
        want = sorted(
            (r["column"], r["level"], r["p"] + r["q"], "Yes" if r["p"] else "No")
            for r in counted if r["p"] + r["q"] >= support and (r["p"] == 0) != (r["q"] == 0) and r["level"] is not None
        )
        got = [r for r in rows(leakage.pure_levels(df, RULE, columns, support, buckets)) if r[1] is not None]
        assert sorted(got) == want


def test_hardly_any_level_of_a_near_unique_column_is_shuffled(spark):
    df = long_tail(spark)
    tallies = {"n_pos": F.col("y") == "Yes", "n_neg": F.col("y") == "No"}
    long = counts.cells(df, ["near_unique"], tallies)
    width = leakage.LEVEL_BUCKETS
    able = counts.bucket_sums(long, width, tallies).where(F.greatest("n_pos", "n_neg") >= 3)
    assert counts.counts_within(long, able, width, tallies).count() < 600 < counts.level_counts(df, ["near_unique"]).count() / 9
    sums = counts.bucket_sums(long, profile.BUCKETS)
    assert counts.counts_within(long, sums.where("n >= 60"), profile.BUCKETS).count() == 0
    plan = leakage.pure_levels(df, RULE, ["near_unique"], 5)._jdf.queryExecution().executedPlan().toString()
    # The light buckets go before the levels are exchanged.
    assert plan.index("hashpartitioning(slot") < plan.index("BroadcastHashJoin")


def test_pruned_reports_of_empty_and_missing_columns(spark):
    df = spark.createDataFrame([(None, ""), ("", None)], "a string, b string")
    assert profile.top_levels_pruned(df, ["a", "b"]).count() == 0
    assert [tuple(r) for r in profile.rare_shares(df, ["a", "b"]).orderBy("column").collect()] == [("a", 0, 0, 0.0), ("b", 0, 0, 0.0)]
    assert profile.rare_shares(df.limit(0), ["a"]).first()["n_valid"] == 0


def test_profile_table_covers_every_family(spark):
    df = spark.createDataFrame([("a", 1, 0.5, True), ("b", 2, None, None)], "s string, i int, f double, b boolean")
    df = df.withColumn("d", F.to_timestamp(F.lit("2020-01-02 03:04:05")))
    got = {(r["column"], r["metric"]): (r["number"], r["text"]) for r in profile.profile_table(df).collect()}
    assert got[("i", "p50")][0] == 1.5 and got[("f", "missing_share")][0] == 0.5
    assert got[("b", "true_share")][0] == 0.5 and got[("s", "top_1")] == (0.5, "a")
    assert got[("d", "min")][1] == "2020-01-02T03:04:05.000000"


def test_text_profile(spark):
    texts = ["", None, "call +7 (900) 123-45-67 now", "id 1234567", "mail a.b@c.org", "see https://x.y", "12345678"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    params = AuditParams(text_len_warn=20, pii_patterns={**AuditParams().pii_patterns, "broken": "("})
    got = {r["metric"]: (r["number"], r["warning"]) for r in textprofile.text_profile(df, "t", params).collect()}
    seventh = round(1 / 7, 6)
    assert got["empty_share"][0] == round(2 / 7, 6)
    assert got["has_email_share"][0] == seventh and got["has_url_share"][0] == seventh
    assert got["has_phone_share"][0] == seventh
    assert got["has_long_number_share"][0] == round(2 / 7, 6)
    assert "has_broken_share" not in got
    assert got["over_length_share"][0] == seventh and "20" in got["over_length_share"][1]
    assert got["chars_max"][0] == 27 and got["words_max"][0] == 5 and got["words_min"][0] == 0
    assert got["chars_p50"][0] == 10


def test_absent_text_column_is_a_warning(spark):
    df = spark.createDataFrame([("a",)], "t string")
    assert "not found" in textprofile.text_profile(df, "notes").first()["warning"]


def test_lengths_are_counted_once(spark):
    df = spark.createDataFrame([("a b",), (None,), ("c",)], "t string")
    plan = textprofile.text_lengths(df, "t")._jdf.queryExecution().optimizedPlan().toString()
    # The figures read written counts, and do not look at the texts again.
    assert "regexp_replace" not in plan and "Relation" in plan


def test_text_lengths_of_an_empty_table(spark):
    df = spark.createDataFrame([], "t string")
    got = {(r["length"], r["metric"]): r["number"] for r in textprofile.text_lengths(df, "t").collect()}
    assert got == {("chars", "min"): 0, ("chars", "max"): 0, ("words", "min"): 0, ("words", "max"): 0}


def test_label_summary(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("No",), (None,), ("",), ("b",), ("a",)], "y string")
    r = label.label_summary(df, RULE).first()
    assert (r["null_count"], r["valid_count"], r["invalid_count"]) == (2, 3, 2)
    assert (r["positive_share"], r["positive_share_all"]) == (round(1 / 3, 6), round(1 / 7, 6))
    assert r["status"] == "invalid_label_values"
    assert [x["label"] for x in label.invalid_samples(df, RULE).collect()] == ["a", "b"]
    assert rows(label.class_counts(df, RULE)) == [("No", 2), ("Yes", 1)]
    absent = label.label_summary(df.select(F.lit(1).alias("z")), RULE)
    assert absent.first()["status"] == "label column not found" and absent.first()["n_rows"] is None
    assert absent.dtypes == label.label_summary(df, RULE).dtypes
    nothing = label.label_summary(df.where("y = 'zzz'"), RULE).first()
    assert (nothing["positive_share"], nothing["status"]) == (0.0, "ok")


def test_missingness(spark):
    df = spark.createDataFrame([("", None, 1.0), ("a", None, float("nan")), (None, None, 2.0)], "s string, n int, f double")
    got = {r["column"]: r for r in missingness.missingness(df).collect()}
    assert [got[c]["missing_count"] for c in "snf"] == [2, 3, 1]
    assert got["n"]["fully_missing"] and not got["s"]["fully_missing"]
    assert got["s"]["high_missing"] and not got["f"]["high_missing"]
    top = missingness.top_missing(missingness.missingness(df), 2).collect()
    assert [r["column"] for r in top] == ["n", "s"]
    empty = missingness.missingness(df.where("f > 5 and f < 5")).collect()
    assert all(r["missing_share"] == 0.0 and not r["fully_missing"] for r in empty)


def test_dates(spark):
    df = spark.sql(
        "SELECT timestamp'2040-01-01' AS a, timestamp'2020-01-01' AS b UNION ALL "
        "SELECT timestamp'2020-01-01', null UNION ALL SELECT null, timestamp'2030-01-01'"
    )
    got = rows(leakage.future_dates(df, ["a", "b", "gone"], "2025-01-01 00:00:00"))
    assert got == [("a", 1, 1), ("b", 0, 1)]
    assert rows(leakage.date_order(df, [("a", "b"), ("a", "gone")])) == [("a", "b", 1)]


def test_findings_and_status(spark):
    spec = TableSpec(
        (
            ColumnSpec("id", "int", role="id"), ColumnSpec("y", "category", role="label"),
            ColumnSpec("churn_score", "float", role="num"), ColumnSpec("plan", "category", role="cat"),
        )
    )
    data = [(i, "Yes" if i % 2 else "No", float(i % 2), "p" if i % 2 else "q") for i in range(60)]
    df = spark.createDataFrame(data, "id long, y string, churn_score double, plan string")
    params = AuditParams(label=RULE)
    found = leakage.leakage_findings(df, spec, params, "2025-01-01 00:00:00")
    assert {(r["check"], r["column"]) for r in found.collect()} == {
        ("keyword", "churn_score"), ("near_perfect_auc", "churn_score"), ("pure_level", "plan"),
    }
    assert [r[0] for r in leakage.suspect_features(found).collect()] == ["churn_score", "plan"]
    assert leakage.leakage_status(found).first()["status"] == "needs_manual_review"
    clean = leakage.leakage_findings(df.select("id", "y"), spec, params, "2025-01-01 00:00:00")
    assert leakage.leakage_status(clean).first()["status"] == "no_leakage_detected"


def test_id_overlap(spark):
    a = spark.createDataFrame([(1,)] * 5 + [(2,)], "id long")
    b = spark.createDataFrame([(1,), (3,)], "id long")
    assert rows(leakage.id_overlap(a, b, "id")) == [(1, 5, 1)]


def test_fingerprint(spark):
    df = numbers(spark, 300)
    base = sanity.fingerprint(df).first()
    assert sanity.fingerprint(df.repartition(7).orderBy("hot")).first() == base
    assert sanity.fingerprint(df.union(df.limit(1))).first()["content_hash"] != base["content_hash"]
    changed = df.withColumn("few", F.when(F.col("few") == 0, 1).otherwise(F.col("few")))
    assert sanity.fingerprint(changed).first()["content_hash"] != base["content_hash"]
    shifted = [spark.createDataFrame([r], "a string, b string") for r in (("ab", "c"), ("a", "bc"))]
    assert sanity.fingerprint(shifted[0]).first() != sanity.fingerprint(shifted[1]).first()
    assert sanity.fingerprint(df.limit(0)).first()["n_rows"] == 0


def test_stage_flags(spark):
    spec = TableSpec((ColumnSpec("few", "int"), ColumnSpec("y", "category", role="label")))
    df = numbers(spark, 200).select("few", "y")
    stored = sanity.fingerprint(df)
    share = label.label_summary(df, RULE).first()["positive_share_all"]
    profiled = missingness.missingness(df)
    flags = sanity.sanity_flags(df, spec, AuditParams(label=RULE), share, profiled, stored, True)
    got = {r["flag"]: r["ok"] for r in flags.collect()}
    assert len(got) == 9
    assert all(got[k] for k in got)
    fewer = df.where("few > 0")
    off = {r["flag"]: r["ok"] for r in sanity.sanity_flags(fewer, spec, AuditParams(), stored=stored).collect()}
    assert not off["n_rows_match"] and not off["content_hash_match"] and off["n_cols_match"]
    only_rows = sanity.compare_fingerprints(stored, stored.select("n_rows")).first()
    assert all(only_rows)


PLANS = {
    "numeric": lambda df: profile.numeric_profile(df, ["few", "hot"]),
    "auc": lambda df: leakage.univariate_auc(df, RULE, ["few", "hot"]),
    "levels": lambda df: profile.categorical_profile(df, ["y"]),
    "missing": missingness.missingness,
    "fingerprint": sanity.fingerprint,
}


@pytest.mark.parametrize("name", sorted(PLANS))
def test_plans_keep_work_spread(spark, name, tmp_path):
    path = str(tmp_path / "t")
    numbers(spark, 200).write.parquet(path)
    df = PLANS[name](spark.read.parquet(path))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert bad not in plan
    # No window sorts a whole table in one task, and the table is scanned once.
    before_window = plan.split("Window")
    assert "SinglePartition" not in "".join(before_window[1:])
    assert plan.count("FileScan") == 1
