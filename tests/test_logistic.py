"""The certified logistic fit against a plain solver, and the threshold reports."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tableaudit.operators import logistic, thresholds
from tableaudit.operators import textmodel as model
from tableaudit.plans import texts
from tableaudit.spec import LabelRule

RULE = LabelRule("y", ("0", "1"), "1")


def plain_fit(x, y, strength):
    """Newton steps on the whole matrix."""
    ones = np.hstack([x, np.ones((len(x), 1))])
    pull = np.append(np.ones(x.shape[1]), 0.0)
    w = np.zeros(ones.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-ones @ w))
        slope = pull * w + strength * ones.T @ (p - y)
        w = w - np.linalg.solve(np.diag(pull) + strength * (ones.T * (p * (1 - p))) @ ones, slope)
    z = ones @ w
    return w, 0.5 * w[:-1] @ w[:-1] + strength * (np.logaddexp(0, z) - y * z).sum()


def sparse_rows(spark, x, y, parts=3):
    rows = [
        (Vectors.sparse(x.shape[1], np.flatnonzero(r).tolist(), r[r != 0].tolist()), float(v))
        for r, v in zip(x, y, strict=True)
    ]
    return spark.createDataFrame(rows, ["features", "label"]).repartition(parts)


@pytest.mark.parametrize("strength", [0.1, 1.0, 50.0])
def test_fit_equals_a_plain_solver(spark, strength, monkeypatch):
    monkeypatch.setattr(logistic, "BLOCK_CELLS", 40)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(120, 9)) * (rng.random((120, 9)) < 0.4)
    x[:, 3] *= 1e-3
    x[7] = 0
    y = (x[:, 0] - 2 * x[:, 1] + rng.normal(size=120) > 0.7).astype(float)
    fitted = logistic.LogisticNewton(strength=strength).fit(sparse_rows(spark, x, y))
    w, least = plain_fit(x, y, strength)
    assert fitted.fitted.objective == pytest.approx(least, rel=1e-9)
    assert np.abs(fitted.coefficients - w[:-1]).max() < 1e-5 and fitted.intercept == pytest.approx(w[-1], abs=1e-5)
    assert fitted.fitted.passes <= 200 and 0 <= fitted.fitted.gap <= 1e-9 * max(1, least)


def test_product_is_summed_by_ranges_of_rows(spark, monkeypatch):
    monkeypatch.setattr(logistic, "BLOCK_CELLS", 8)
    monkeypatch.setattr(logistic, "TASK_BLOCKS", 2)
    monkeypatch.setattr(logistic, "RANGE_ROWS", 7)
    rng = np.random.default_rng(7)
    # Full columns send all rows of a range, thin ones only those they reach; the last rows have no entry at all.
    x = rng.normal(size=(50, 12)) * (rng.random((50, 12)) < np.r_[np.ones(2), np.full(10, 0.05)])
    x[43:] = 0
    v = rng.normal(size=50)
    blocks = logistic.sparse_blocks(sparse_rows(spark, x, np.arange(50) % 2), "features", "label")
    assert blocks.cells.getNumPartitions() > 4
    passes = logistic._Passes(blocks)
    # Rows are numbered by partition, so the blocks say which row is which.
    full = np.zeros((50, 12))
    for r in blocks.entries.collect():
        full[np.searchsorted(blocks.numbers, r["row"]), r["column"]] = r["value"]
    assert sorted(map(tuple, full)) == sorted(map(tuple, x))
    assert passes.product(v) == pytest.approx(full @ (full.T @ v), abs=1e-12) and passes.used == 1
    weights = {r["column"]: (r["n"], r["weight"]) for r in blocks.weights(v).collect()}
    assert set(weights) == set(np.flatnonzero(x.any(axis=0)))
    for c, (n, w) in weights.items():
        assert n == (x[:, c] != 0).sum() and w == pytest.approx(full[:, c] @ v)


def test_gap_bounds_the_distance_of_an_unfinished_fit(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(80, 6))
    y = (x[:, 0] + rng.normal(size=80) > 0.4).astype(float)
    blocks = logistic.sparse_blocks(sparse_rows(spark, x, y), "features", "label")
    _, least = plain_fit(x, y, 1.0)
    for most in (2, 4, 6, 9):
        fit = logistic.fit_blocks(blocks, 6, max_passes=most)
        assert fit.objective - least <= fit.gap + 1e-9 and fit.passes <= most + 1


def test_scores_are_the_logistic_curve(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(30, 4)) * (rng.random((30, 4)) < 0.6)
    y = (rng.random(30) < 0.5).astype(float)
    rows = sparse_rows(spark, x, y)
    fitted = logistic.LogisticNewton().fit(rows)
    for r in fitted.transform(rows).collect():
        z = r["features"].toArray() @ fitted.coefficients + fitted.intercept
        assert r["log_odds"] == pytest.approx(z) and r["score"] == pytest.approx(1 / (1 + np.exp(-z)))


def test_one_class_or_no_rows_cannot_be_fitted(spark):
    one = sparse_rows(spark, np.eye(3), np.ones(3))
    for rows in (one, one.where("label < 0")):
        with pytest.raises(ValueError):
            logistic.LogisticNewton().fit(rows)


def many_texts(spark):
    return spark.createDataFrame(
        [(i, f"word{i % 37} text {'bad' if i % 5 == 0 else 'good'} w{i % 11}", str(int(i % 5 == 0 or i % 17 == 0))) for i in range(600)],
        "a long, text string, y string",
    )


def test_optimum_holds_on_the_rows_of_a_bounded_fit(spark):
    docs = many_texts(spark)
    rows = model.training_rows(docs, "text", RULE, 200)
    assert 100 < rows.count() < 300 and rows.columns == docs.columns
    fitted = model.fit_baseline(docs, "text", RULE, max_training_rows=200)
    assert model.optimum_gap(fitted, rows, "a", "text", RULE).first()["gap"] < 1e-3
    # Over other rows the condition does not hold, which is why the rows of the fit matter.
    assert model.optimum_gap(fitted, docs, "a", "text", RULE).first()["gap"] > 1e-2


def test_queries_fit_all_labelled_rows(spark, tmp_path):
    """More rows than the 200,000 that once bounded the fit, and some without an allowed label."""
    n = 200_500
    ids = spark.range(n + 20).withColumnRenamed("id", "doc_id")
    docs = ids.selectExpr("doc_id", "concat('word', doc_id % 4001, IF(doc_id % 5 = 0, ' bad', ' good')) AS text", "1 AS n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    label = f"IF(doc_id < {n}, CAST(doc_id % 5 = 0 OR doc_id % 17 = 0 AS INT), 2)"
    ids.selectExpr("doc_id", f"{label} AS toxic").write.parquet(str(tmp_path / "labels.parquet"))
    fitted = texts.fitted_baseline(spark, str(tmp_path))
    assert len(fitted.stages[-1].fitted.dual) == n
    assert sum(r["n"] for r in fitted.stages[1].terms.collect()) == 2 * n
    rows = model.training_rows(texts.labelled_documents(spark, str(tmp_path)), "text", texts.DOCS_PARAMS.label)
    assert rows.count() == n
    check = texts.text_model_check(spark, str(tmp_path)).first().asDict()
    positive = sum(i % 5 == 0 or i % 17 == 0 for i in range(n))
    assert check == {"n_pos": positive, "n_neg": n - positive, "optimum_reached": True, "gap_certified": True, "within_passes": True}


def test_auc_equals_the_evaluator(spark):
    docs = many_texts(spark)
    scored = model.score(model.fit_baseline(docs, "text", RULE), docs, "text")
    measure = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    expected = measure.evaluate(scored.withColumn("label", F.col("y").cast("double")))
    assert model.score_auc(scored, RULE).first()["auc"] == pytest.approx(expected, abs=1e-6)


# ---------------------------------------------------------------- thresholds


def brute_table(rows, rates):
    kept = [(s, y == "1") for _, s, y in rows if y in ("0", "1")]
    n, positives = len(kept), sum(p for _, p in kept)
    out = []
    for rate in rates:
        best = (None, 0, 0)
        for t in {s for s, _ in kept if s is not None and s == s}:
            hit = [p for s, p in kept if s is not None and s >= t]
            if len(hit) <= int(np.floor(rate * n)) and len(hit) > best[1]:
                best = (t, len(hit), sum(hit))
        t, c, p = best
        out.append((rate, t, c, p, round(c / n, 6), round(p / c, 6) if c else None, round(p / positives, 6) if positives else None))
    return out


@pytest.mark.parametrize("buckets", [1, 2, 5, 64])
def test_threshold_table_equals_brute_force(spark, buckets):
    rng = np.random.default_rng(buckets)
    values = [None, float("nan"), *np.round(rng.normal(size=40), 1).tolist(), 7.0, 7.0, 7.0]
    rows = [(i, values[rng.integers(len(values))], ["0", "1", None, "x"][rng.choice(4, p=[0.5, 0.3, 0.1, 0.1])]) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, s double, y string").repartition(5)
    rates = [0.0, 0.001, 0.02, 0.1, 0.37, 0.9, 1.0, 2.0]
    got = [tuple(r) for r in thresholds.threshold_table(df, "s", RULE, rates, buckets).orderBy("rate").collect()]
    assert got == brute_table(rows, rates)
    curve = thresholds.threshold_curve(df, "s", RULE, buckets)
    levels = sorted({s for _, s, y in rows if y in ("0", "1") and s is not None and s == s})
    at = {r["threshold"]: tuple(r) for r in curve.collect()}
    assert sorted(at) == levels
    given = {r["threshold"]: tuple(r) for r in thresholds.threshold_metrics(df, "s", RULE, levels).collect()}
    assert given == at


def test_thresholds_without_rows_scores_or_positives(spark):
    empty = spark.createDataFrame([], "s double, y string")
    assert [tuple(r) for r in thresholds.threshold_table(empty, "s", RULE, [0.5]).collect()] == [(0.5, None, 0, 0, None, None, None)]
    assert thresholds.threshold_curve(empty, "s", RULE).count() == 0
    none = spark.createDataFrame([(None, "0"), (None, "1")], "s double, y string")
    assert [tuple(r)[:4] for r in thresholds.threshold_table(none, "s", RULE, [1.0]).collect()] == [(1.0, None, 0, 0)]
    negatives = spark.createDataFrame([(1, "0"), (2, "0")], "s int, y string")
    assert [tuple(r) for r in thresholds.threshold_table(negatives, "s", RULE, [0.5]).collect()] == [(0.5, 2.0, 1, 0, 0.5, 0.0, None)]
    assert thresholds.threshold_table(none, "s", RULE, []).count() == 0


def test_retain_is_never_null(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (float("nan"),)], "s double")
    assert [r["retain"] for r in thresholds.retain(df, "s", 2.0).collect()] == [False, True, False, False]
    assert [r["retain"] for r in thresholds.retain(df, "s", None).collect()] == [False] * 4


def test_no_task_sorts_the_whole_table(spark):
    df = spark.range(1000).selectExpr("id AS s", "CAST(id % 2 AS STRING) AS y")
    plan = thresholds.threshold_curve(df, "s", RULE)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line and "Specification" not in line]
    # Running sums are inside ranges; the one window and exchange without them see a row per range.
    assert any("range" in w.split("],")[-2] for w in windows)
    assert plan.count("SinglePartition") == 1
