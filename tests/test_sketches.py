"""Profiles merged from stored sketches against profiles of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from tableaudit.operators import profile, sketches
from tableaudit.plans.profiles import _checked
from tableaudit.sources.manifest import list_files

GRID = (0.0, 0.05, 0.5, 0.95, 1.0)


def delivery(spark, n, seed):
    rng = random.Random(seed)
    rows = [
        (rng.randrange(10**6), None if i % 4 else rng.gauss(5, 2), [float("nan"), 1.5][i % 2], None, f"t{i}")
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "a long, b double, c float, none int, t string")


def merged(spark, store, data):
    return {r["column"]: r for r in sketches.merged_profile(sketches.stored_sketches(spark, store), list_files(spark, [data]), GRID).collect()}


def assert_same(got, df):
    exact = {r["column"]: r for r in profile.numeric_profile(df, quantiles=GRID).collect()}
    assert set(got) == set(exact)
    for name, want in exact.items():
        r, n = got[name], want["count"] * (1 - want["missing_share"])
        assert (r["type"], r["count"], r["min"], r["max"], r["missing_share"]) == (
            want["type"], want["count"], want["min"], want["max"], want["missing_share"],
        )
        assert r["mean"] == (want["mean"] and pytest.approx(want["mean"])) and r["std"] == (want["std"] and pytest.approx(want["std"]))
        assert abs(r["n_unique"] - want["n_unique"]) <= 0.065 * want["n_unique"] + 1
        value = F.when(~F.isnan(F.col(name).cast("double")), F.col(name).cast("double"))
        for q in GRID:
            at = r[profile.quantile_name(q)]
            if at is None:
                assert want[profile.quantile_name(q)] is None
                continue
            low, high = df.agg(F.count_if(value < at), F.count_if(value <= at)).first()
            assert low / n <= q + 0.01 and high / n >= q - 0.01


def test_merged_equals_one_pass_and_reads_new_files_only(spark, tmp_path):
    data, store = str(tmp_path / "data dir"), str(tmp_path / "store")
    delivery(spark, 3000, 1).repartition(3).write.parquet(data)
    assert sketches.update_sketches(spark, [data], store) == 3
    assert sketches.update_sketches(spark, [data], store) == 0
    assert_same(merged(spark, store, data), spark.read.parquet(data))
    before = sketches.stored_sketches(spark, store).count()
    delivery(spark, 500, 2).coalesce(1).write.mode("append").parquet(data)
    assert sketches.update_sketches(spark, [data], store) == 1
    assert sketches.stored_sketches(spark, store).count() == before + 4
    assert_same(merged(spark, store, data), spark.read.parquet(data))


def test_rows_of_files_that_are_gone_or_stored_twice_do_not_count(spark, tmp_path):
    data, store = str(tmp_path / "data"), str(tmp_path / "store")
    delivery(spark, 400, 3).repartition(2).write.parquet(data)
    sketches.update_sketches(spark, [data], store)
    sketches.stored_sketches(spark, store).write.mode("append").parquet(store + "2")
    sketches.stored_sketches(spark, store).write.mode("append").parquet(store + "2")
    assert_same(merged(spark, store + "2", data), spark.read.parquet(data))
    delivery(spark, 300, 4).repartition(2).write.mode("overwrite").parquet(data)
    assert merged(spark, store, data) == {}
    sketches.update_sketches(spark, [data], store)
    assert_same(merged(spark, store, data), spark.read.parquet(data))


def test_no_files_columns_or_values(spark, tmp_path):
    store, data = str(tmp_path / "store"), str(tmp_path / "data")
    assert sketches.stored_sketches(spark, store).count() == 0
    delivery(spark, 10, 5).select("t").write.parquet(data)
    assert sketches.update_sketches(spark, [data], store) > 0
    assert merged(spark, store, data) == {}
    nothing = str(tmp_path / "nothing")
    delivery(spark, 4, 6).select("none").coalesce(1).write.parquet(nothing)
    sketches.update_sketches(spark, [nothing], store)
    r = merged(spark, store, nothing)["none"]
    assert (r["count"], r["n_unique"], r["missing_share"], r["mean"], r["p50"]) == (4, 0, 1.0, None, None)


def test_estimates_are_checked_on_one_count_of_the_values(spark):
    lines = delivery(spark, 400, 7).select("a", "b", "none")
    found = profile.numeric_profile(lines, ["a", "b", "none"], (0.05, 0.25, 0.5, 0.75, 0.95))
    checked = _checked(found, lines, 0.001, 0.0)
    # Rows are not multiplied by the columns whose distinct values are counted.
    assert "Expand" not in checked._jdf.queryExecution().executedPlan().toString()
    assert {r["column"]: (r["n_unique_close"], r["quantiles_close"]) for r in checked.collect()} == {
        "a": (True, True), "b": (True, True), "none": (True, None)
    }
    off = found.withColumn("p50", F.col("p95")).withColumn("n_unique", F.col("n_unique") * 2 + 2)
    assert {tuple(r)[-2:] for r in _checked(off, lines, 0.001, 0.0).collect()} == {(False, False), (False, None)}
