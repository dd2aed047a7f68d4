"""Differences between two versions of a table, beside EXCEPT ALL."""

import pytest
from pyspark.sql import functions as F
from support import rows

from tableaudit import session
from tableaudit.operators import differences


def versions(spark):
    data = [(i % 300, None if i % 7 else "", f"t{i % 90}", [0.0, -0.0, float("nan")][i % 3]) for i in range(1500)]
    left = spark.createDataFrame(data, "id int, a string, t string, z double").repartition(5)
    right = left.where("id % 50 != 3").withColumn("t", F.when(F.col("id") % 41 == 1, F.lit(None)).otherwise(F.col("t")))
    right = right.union(right.where("id % 60 = 2")).withColumn("a", F.when(F.col("id") == 9, F.lit("x")).otherwise(F.col("a")))
    return left, right.select("z", "t", "id", "a")


def excess(a, b):
    names = a.columns
    return a.exceptAll(b.select(*names)).groupBy(*names).count()


@pytest.mark.parametrize("bits,levels", [(1, 1), (4, 1), (3, 4), (12, 2), (20, 3)])
def test_differences_equal_except_all(spark, bits, levels):
    left, right = versions(spark)
    got = differences.stage_differences(left, right, bits=bits, levels=levels)
    assert got.columns == ["side", *left.columns, "copies"]
    clean = lambda df: rows(df.withColumn("z", F.col("z").cast("string")))
    zero = F.when(F.col("z") == 0, F.lit(0.0)).otherwise(F.col("z"))
    for side, want in (("left", excess(left, right)), ("right", excess(right.select(*left.columns), left))):
        assert clean(got.where(F.col("side") == side).drop("side").withColumn("z", zero)) == clean(want.withColumn("z", zero))


def test_equal_versions_read_no_rows_back(spark):
    left, _ = versions(spark)
    got = differences.stage_differences(left, left.repartition(3).select("t", "z", "a", "id"))
    assert got.count() == 0 and got.columns == ["side", *left.columns, "copies"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_counts_and_odd_sides(spark):
    left, right = versions(spark)
    got = {r["side"]: (r["rows"], r["copies"]) for r in differences.difference_counts(left, right).collect()}
    for side, want in (("left", excess(left, right)), ("right", excess(right.select(*left.columns), left))):
        assert got[side] == (want.count(), want.agg(F.sum("count")).first()[0])
    none = left.limit(0)
    assert rows(differences.difference_counts(none, none)) == [("left", 0, 0), ("right", 0, 0)]
    assert differences.stage_differences(left, none, ["id"]).agg(F.sum("copies")).first()[0] == 1500
    with pytest.raises(ValueError):
        differences.stage_differences(left, left.drop("a"))


def test_many_differences_need_no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(differences, "MOST_BROADCAST", 3)
    left, right = versions(spark)
    got = differences.stage_differences(left, right, ["id"], bits=6)
    assert got.agg(F.sum("copies")).first()[0] == sum(
        r["copies"] for r in differences.difference_counts(left, right).collect()
    )


def test_digests_are_computed_once(spark, monkeypatch):
    """Looks at prefixes and counts read written digests, and do not compute the sides again."""
    seen = []
    monkeypatch.setattr(differences, "staged", lambda df, purpose: seen.append(purpose) or session.staged(df, purpose))
    left = spark.range(100).selectExpr("id", "CAST(id AS STRING) AS v")
    found = differences.stage_differences(left, left.where("id != 7"))
    assert [tuple(r) for r in found.collect()] == [("left", 7, "7", 1)]
    assert seen.count("digests") == 1
