"""Readers, writers, report store, manifest and the text baseline."""

import csv
import hashlib
import math
import os
import random
from pathlib import Path

import pytest
from support import rows
from pyspark.sql import functions as F

from tableaudit import AuditParams, ColumnSpec, TableSpec
from tableaudit.functions.parsing import ISO_PATTERNS
from tableaudit.operators import cast, leakage, sanity
from tableaudit.operators import textmodel as model
from tableaudit.session import clean_up, shared_folder
from tableaudit.sources import manifest, reports, tables
from tableaudit.sources.reports import read_report, write_report
from tableaudit.spec import LabelRule


def test_csv_cells(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(
        'id,name,note\n1,None,"two\nlines"\n2, NA ,"say ""hi"", ok"\nNA,n/a,\n4,"","x"\n5,nan,<NA>\n', encoding="utf-8"
    )
    df = tables.read_delimited(spark, str(path), multiline=True)
    assert [f.dataType.simpleString() for f in df.schema] == ["string"] * 3
    assert [tuple(r) for r in df.collect()] == [
        ("1", None, "two\nlines"), ("2", " NA ", 'say "hi", ok'), (None, None, None), ("4", None, "x"), ("5", None, None),
    ]


def test_csv_options(spark, tmp_path):
    path = tmp_path / "in.txt"
    path.write_bytes("é;-\n2;b\n".encode("latin-1"))
    params = AuditParams(delimiter=";", header=False, encoding="latin-1", null_tokens=("-",))
    df = tables.read_delimited(spark, str(path), params)
    assert df.columns == ["0", "1"]
    assert rows(df) == sorted([("é", None), ("2", "b")], key=repr)


def test_csv_round_trip_keeps_spaces_and_quotes(spark):
    df = spark.createDataFrame([(" a ", 'q"uo,te'), (" b", "back\\slash")], "a string, b string")
    path = tables.write_delimited(df, shared_folder(spark, "csv"))
    assert rows(tables.read_delimited(spark, path)) == rows(df)


def test_parquet_scan_is_pruned_and_filtered(spark):
    path = tables.write_table(spark.range(10).selectExpr("id", "id * 2 AS b", "id * 3 AS c"), shared_folder(spark, "t"))
    df = tables.read_table(spark, path).where("id > 5").select("b")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,5)" in plan and "ReadSchema: struct<id:bigint,b:bigint>" in plan


def test_report_sections_survive_each_other(spark):
    store = shared_folder(spark, "reports")
    a = spark.createDataFrame([("x", 1), ("y", None)], "k string, n int")
    b = spark.createDataFrame([(0.5,)], "share double")
    reports.write_report(a, store, "first", "r1")
    reports.write_report(b, store, "second", "r1")
    reports.write_report(a.limit(1), store, "first", "r2")
    first = reports.read_report(spark, store, "first", "k string, n int")
    assert {r["run_id"] for r in first.collect()} == {"r2"} and first.count() == 1
    assert rows(reports.read_report(spark, store, "second", "share double")) == [("r1", 0.5)]
    assert reports.read_report(spark, store, "second").first()["payload"] == '{"share":0.5}'


def test_manifest(spark, tmp_path):
    folder = tmp_path / "data dir"
    spark.range(0, 100, 1, 3).write.parquet(str(folder))
    files = {p.name: p for p in folder.glob("*.parquet")}
    table = spark.read.parquet(str(folder))
    got = manifest.manifest(spark, [str(p) for p in files.values()], table, "d", "v1", "r1").collect()
    assert sum(r["n_rows"] for r in got) == 100 and len(got) == 3
    for r in got:
        p = files[r["path"].rsplit("/", 1)[1]]
        assert r["md5"] == hashlib.md5(p.read_bytes()).hexdigest()
        assert r["file_size_bytes"] == p.stat().st_size and r["n_cols"] == 1


TOY = [(0, "hi", 0), (1, "hi hi", 0), (2, "hello", 1), (3, "goodbye", 1)]


def toy(spark):
    return spark.createDataFrame(TOY, "a int, text string, y int")


def test_tf_idf_of_the_toy_table(spark):
    got = {(r["doc"], r["term"]): (r["tf"], r["tfidf"]) for r in model.tf_idf(toy(spark), "a", "text").collect()}
    assert got == {(0, "hi"): (1, 1.0), (1, "hi"): (2, 1.0), (2, "hello"): (1, 1.0), (3, "goodbye"): (1, 1.0)}


def test_tf_idf_by_hand_with_and_without_hot_terms(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "The cat the x"), (2, "the DOG"), (3, "")], "d int, t string")
    for hot_parts in (2, 10**9):
        monkeypatch.setattr(model, "HOT_PARTS", hot_parts)
        got = {(r["doc"], r["term"]): r["tfidf"] for r in model.tf_idf(docs, "d", "t").collect()}
        the, rare = 2 * (math.log(4 / 3) + 1), math.log(4 / 2) + 1
        assert got[(1, "the")] == pytest.approx(the / math.hypot(the, rare))
        assert got[(1, "cat")] == pytest.approx(rare / math.hypot(the, rare))
        assert set(got) == {(1, "the"), (1, "cat"), (2, "the"), (2, "dog")}


def test_pairs_stay_where_their_document_was_dealt(spark):
    plan = model.tf_idf(toy(spark), "a", "text")._jdf.queryExecution().executedPlan().toString()
    # Lists of tokens are dealt by document; neither the counts nor the lengths shuffle the pairs again.
    by_doc = [line for line in plan.splitlines() if "Exchange hashpartitioning(doc" in line]
    assert by_doc and all("REPARTITION" in line for line in by_doc)


def test_baseline_on_the_toy_table(spark):
    rule = LabelRule("y", ("0", "1"), "1")
    fitted = model.fit_baseline(toy(spark), "text", rule)
    scored = model.score(fitted, toy(spark), "text")
    assert scored.columns == ["a", "text", "y", "score"]
    by_id = {r["a"]: r["score"] for r in scored.collect()}
    assert by_id[0] == pytest.approx(by_id[1]) and by_id[0] < by_id[2]
    # Optimum of the penalised likelihood: two equal rows of class 0 on one
    # axis, one row of class 1 on each of two others.
    assert by_id[2] == pytest.approx(by_id[3], abs=1e-3)
    assert model.score_auc(scored, rule).first()["auc"] == 1.0


def test_baseline_optimum(spark):
    """The gradient of the penalised loss is zero at the fitted weights."""
    rule = LabelRule("y", ("0", "1"), "1")
    scored = model.score(model.fit_baseline(toy(spark), "text", rule), toy(spark), "text")
    p = {r["a"]: r["score"] for r in scored.collect()}
    w = {"hi": -(p[0] + p[1]), "hello": 1 - p[2], "goodbye": 1 - p[3]}
    logit = lambda x: math.log(x / (1 - x))
    b = logit(p[0]) - w["hi"]
    assert logit(p[2]) == pytest.approx(b + w["hello"], abs=1e-3)
    assert sum(p.values()) == pytest.approx(2.0, abs=1e-3)


def test_training_rows_are_bounded_and_all_are_scored(spark):
    rule = LabelRule("y", ("0", "1"), "1")
    many = spark.createDataFrame([(i, f"word{i} text", str(i % 2)) for i in range(400)], "a long, text string, y string")
    fitted = model.fit_baseline(many, "text", rule, max_training_rows=100)
    assert 50 < len(fitted.stages[1].vocabulary) < 160
    assert model.score(fitted, many, "text").count() == 400


def test_the_driver_holds_a_number_per_training_row_and_none_per_term(spark):
    rule = LabelRule("y", ("0", "1"), "1")
    texts = [" ".join(f"w{i}x{k}" for k in range(60)) + " text" * (i % 3) for i in range(40)]
    docs = spark.createDataFrame([(i, t, str(i % 2)) for i, t in enumerate([*texts, "", None])], "a long, text string, y string")
    fitted = model.fit_baseline(docs, "text", rule)
    fit = fitted.stages[-1].fitted
    assert len(fit.dual) == 42 and fit.weights is None
    assert {r["term"]: r["n"] for r in fitted.stages[1].terms.collect()}["text"] == 26
    assert len(fitted.stages[1].vocabulary) == 40 * 60 + 1
    # Copies of a text, and texts of no known term.
    other = [(0, texts[5], "1"), (1, texts[5], "1"), (2, None, "0"), (3, "unseen words", "x")]
    scored = {r["a"]: r["score"] for r in model.score(fitted, spark.createDataFrame(other, docs.schema), "text").collect()}
    own = {r["a"]: r["score"] for r in model.score(fitted, docs, "text").collect()}
    assert scored[0] == pytest.approx(own[5]) and scored[1] == pytest.approx(own[5])
    assert scored[2] == scored[3] == pytest.approx(1 / (1 + math.exp(-fit.intercept)))


def test_optimum_gap_sees_an_unfinished_fit(spark):
    rule = LabelRule("y", ("0", "1"), "1")
    done = model.optimum_gap(model.fit_baseline(toy(spark), "text", rule), toy(spark), "a", "text", rule).first()
    assert (done["n_pos"], done["n_neg"]) == (2, 2) and done["gap"] < 1e-3
    early = model.fit_baseline(toy(spark), "text", rule, max_passes=3)
    assert early.stages[-1].fitted.passes <= 3 and early.stages[-1].fitted.gap > 1e-3
    assert model.optimum_gap(early, toy(spark), "a", "text", rule).first()["gap"] > 1e-2


@pytest.mark.parametrize("multiline", [False, True])
def test_surplus_cells_are_never_lost(spark, tmp_path, multiline):
    (tmp_path / "t.csv").write_text('a,b\n1,2\n3,4,5\n6\n7,8,\n"x,y",NA\n')
    path = str(tmp_path / "t.csv")
    kept = tables.read_delimited(spark, path, multiline=multiline, surplus="keep")
    got = sorted(tuple(r) for r in kept.select("a", F.coalesce("b", F.lit("null")), F.coalesce("_surplus", F.lit("null"))).collect())
    assert got == [("1", "2", "null"), ("3", "4", "5"), ("6", "null", "null"), ("7", "8", "null"), ("x,y", "null", "null")]
    with pytest.raises(Exception, match="more than 2 cells"):
        tables.read_delimited(spark, path, multiline=multiline).select("a").collect()


def test_line_breaks_need_multiline(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n"1\n2",3\n')
    assert tables.read_delimited(spark, str(tmp_path / "t.csv"), multiline=True).first()["a"] == "1\n2"


def test_empty_report_replaces_the_last_one(spark, tmp_path):
    path, shape = str(tmp_path / "store"), "n long"
    write_report(spark.createDataFrame([(1,)], shape), path, "one", "run-1")
    write_report(spark.createDataFrame([(2,)], shape), path, "two", "run-1")
    write_report(spark.createDataFrame([], shape), path, "one", "run-2")
    assert read_report(spark, path, "one", shape).collect() == []
    assert [r["n"] for r in read_report(spark, path, "two", shape).collect()] == [2]


def test_written_copies_are_removed(spark, tmp_path):
    path = str(tmp_path / "copy")
    assert all(sanity.write_read_back(spark.range(5), path).first())
    assert not os.path.exists(path)


@pytest.fixture
def new_york(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_dates_are_utc_in_any_session(new_york):
    spark = new_york
    raw = spark.createDataFrame(
        [("2024-01-01",), ("2024-07-01 12:00:00",), ("2024-03-10T02:30:00+02:00",)], "d string"
    )
    spec = TableSpec((ColumnSpec("d", "datetime"),))
    params = AuditParams(date_formats=ISO_PATTERNS)
    typed = cast.cast_table(raw, spec, params, cast.decide(raw, spec, params, per_row=True))
    micros = [r[0] for r in typed.select(F.unix_micros("d")).collect()]
    assert micros == [1704067200000000, 1719835200000000, 1710030600000000]
    wall = spark.sql("SELECT TIMESTAMP_NTZ'2025-12-31 23:30:00' AS t, DATE'2026-01-01' AS d, '2025-12-31 23:30:00' AS s")
    late = leakage.future_dates(wall, ["t", "d", "s"], "2025-12-31 23:15:00", 2025)
    assert sorted((r["column"], r["future_year_gt"], r["after_now"]) for r in late.collect()) == [("d", 1, 1), ("s", 0, 1), ("t", 0, 1)]
    here = sanity.fingerprint(wall).first()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert sanity.fingerprint(wall).first() == here


def test_renamed_columns_do_not_match(spark):
    a = sanity.fingerprint(spark.createDataFrame([(1, 2)], "a int, b int"))
    p = sanity.fingerprint(spark.createDataFrame([(1, 2)], "p int, q int"))
    assert tuple(sanity.compare_fingerprints(a, p).first()) == (True, True, False, True)


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert a.startswith(base) and a != b


def test_null_tokens_hit_whole_cells_only(spark):
    df = spark.createDataFrame([("NA", 1), ("NAN", 2), (" NA", 3), ("null", 4)], "s string, n int")
    got = tables.apply_null_tokens(df, tables.null_tokens(AuditParams())).where(F.col("s").isNull())
    assert [r["n"] for r in got.collect()] == [1, 4]


def test_clean_up_removes_what_this_application_wrote(spark):
    path = tables.write_table(spark.range(3), shared_folder(spark, "t"))
    other = Path(path).parents[1] / "another-application"
    other.mkdir(exist_ok=True)
    assert spark.read.parquet(path).count() == 3 and os.path.exists(path)
    clean_up(spark)
    assert not os.path.exists(path) and other.exists()
    clean_up(spark)
    other.rmdir()


# ------------------------------------------------------- quoted breaks, in parallel

QUOTED = {
    "breaks": 'id,note\n1,"a\nb"\n2,"""q"" x,\n\n,y"\n3,plain\n4,"",\n5,"end"\n',
    "crlf": 'id,note\r\n1,"a\r\nb\nc"\r\n2,x\r\n\r\n3,"\r\n"\r\n4,"z"',
    "long cell": 'id,note\n1,"' + "line, with \"\"quotes\"\"\n" * 9 + '"\n2,é\n3,"x\ny"\n',
    "closes and opens": 'id,note\n1,"a\nb","c\n' + "mid\n" * 4 + 'd"\n"2\n","x"\n3,"y',
    "header breaks": '"i\nd","no""te"\n1,2\n"3\n",4\n',
    "nothing": "id,note\n",
    "bom": "\ufeffid,note\n1,\"a\nb\"\n",
}


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 13, 40, 1 << 20])
def test_quoted_breaks_at_every_split_point(spark, tmp_path, size):
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for name, text in QUOTED.items():
        path = tmp_path / f"{name}.csv"
        path.write_bytes(text.encode())
        args = {"schema": tables.T.StructType([tables.T.StructField(c, tables.T.StringType()) for c in ("a", "b", "c")])} if name == "closes and opens" else {}
        if args:
            path.write_bytes(text.replace("id,note", "a,b,c").encode())
        want = rows(tables.read_delimited(spark, str(path), multiline=True, **args))
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        try:
            got = tables.read_delimited(spark, str(path), multiline="split", **args)
            assert rows(got) == want, name
            if size < 9 and len(text) > 30:
                assert got.rdd.getNumPartitions() > 3
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_quoted_breaks_in_random_files(spark, tmp_path):
    rng = random.Random(11)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cells = ["", "a", "x\ny", '"', '""\n', "\n\n", ",", "\r\n", " é ", "NA", 'q"\n"z']
    for turn in range(6):
        folder = tmp_path / f"t{turn}"
        folder.mkdir()
        for part in range(3):
            lines = [["k", "v"]] + [[f"{part}-{i}", rng.choice(cells)] for i in range(rng.randrange(12))]
            with open(folder / f"{part}.csv", "w", newline="") as f:
                csv.writer(f, lineterminator="\n").writerows(lines)
        want = rows(tables.read_delimited(spark, str(folder), multiline=True))
        for size in (4, 17):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            try:
                assert rows(tables.read_delimited(spark, str(folder), multiline="split")) == want
            finally:
                spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_quoted_breaks_with_options(spark, tmp_path):
    path = tmp_path / "in.txt"
    path.write_bytes('é;"-\nü"\n2;b;c\n'.encode("latin-1"))
    params = AuditParams(delimiter=";", header=False, encoding="latin-1", null_tokens=("-",))
    got = tables.read_delimited(spark, str(path), params, multiline="split", surplus="keep")
    assert rows(got) == rows(tables.read_delimited(spark, str(path), params, multiline=True, surplus="keep"))
    with pytest.raises(Exception, match="more than"):
        tables.read_delimited(spark, str(path), params, multiline="split").collect()
    with pytest.raises(ValueError, match="UTF-16"):
        tables.read_delimited(spark, str(path), AuditParams(encoding="utf-16", header=False), multiline="split", schema=got.schema)
    with pytest.raises(ValueError):
        tables.read_delimited(spark, str(path), multiline="yes")
