"""The registered queries and the pipeline, beside SQL where there is some."""

from collections import Counter
from zlib import crc32

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from check import plain, rows_of
from tableaudit.llm import queries
from tableaudit.llm.common import table
from test_operators import brute_components, brute_hits


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_and_its_sql(spark, sf, name):
    assert __spark_entry__.queries()[name] is queries.QUERIES[name]
    found = queries.QUERIES[name](spark, sf)
    rows = found.collect()
    assert len(rows) == table(spark, sf, "documents").count()
    if name in queries.ORACLES:
        sql = duckdb.connect()
        for t in ("documents", "benchmark"):
            sql.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        cursor = sql.execute(queries.ORACLES[name])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == sorted(found.columns)
        assert rows_of(found.columns, rows) == rows_of(names, cursor.fetchall())
    assert plain(1.0) == 1.0


def token_rows(found):
    return sorted(tuple(r) for r in found.select("doc_id", "start", "n_tokens", "ids_crc32").collect())


def brute_tokens(docs):
    """Ids of the plain tokenizer, documents in the order of their ids; copies of one document are equal."""
    encoder, start, out = Tokenizer.from_file(queries.tokenizer_path()), 0, []
    for d, text in sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()):
        ids = [*encoder.encode(text, add_special_tokens=False).ids, 1]
        out.append((d, start, len(ids), crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out)


def brute_mix(docs):
    """How often each row is in the mix, by the SQL of the mixing query."""
    sql = duckdb.connect()
    sql.register("documents", docs.toArrow())
    taken = sql.execute(queries.ORACLES["op2_source_mix"]).to_arrow_table().to_pylist()
    texts = dict(tuple(r) for r in docs.select("doc_id", "text").collect())
    return Counter({(r["doc_id"], texts[r["doc_id"]]): r["taken"] // r["size"] for r in taken if r["taken"]})


def odd_documents(spark):
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, "The MIT License. one two three four five", "en", "a", 10),
        (3, "The MIT License. one two three four five", "en", "a", 10), (None, "the and of is in to that it was for", None, "b", 7),
        (None, None, "fr", None, 7), (4, "word " * 20000, "en", "b", 1), (6, "x" * 30000 + " " + "9" * 5000, "en", "c", 1),
        (7, "Été İſ \U0001f600\nl'été x\x00y\x1cz", "fr", "c", 2), (8, "   \n\t ", "fr", "d", 2),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("n", [0, 100])
def test_pipeline_of_odd_documents_and_of_none(spark, sf, n):
    docs = odd_documents(spark).limit(n)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        rows = out.collect()
        assert n or not rows
        if name != "token_files":
            assert out.columns == docs.columns
        docs = spark.createDataFrame(rows, out.schema)


def test_pipeline_stage_by_stage(spark, sf):
    docs = table(spark, sf, "documents")
    kinds = dict(docs.dtypes)
    for name, stage in corpus_pipeline.STAGES:
        before = {(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()}
        out = stage(spark, docs, sf)
        if name == "token_files":
            assert token_rows(out) == brute_tokens(docs)
            continue
        assert dict(out.dtypes) == kinds
        rows = [(r["doc_id"], r["text"]) for r in out.select("doc_id", "text").collect()]
        assert set(rows) <= before
        if name == "language_id":
            assert len(rows) > 0.98 * len(before)
        if name == "near_dedup":
            groups = brute_components(dict(before), 80)
            assert sorted(d for d, _ in rows) == sorted(d for d, (n, c) in groups.items() if d == c or n == 0)
        if name == "decontamination":
            items = [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
            hits = brute_hits(dict(before), items)
            assert sorted(d for d, _ in rows) == sorted(d for d, (_, n, _) in hits.items() if not n)
        if name == "source_mix":
            assert Counter(rows) == brute_mix(docs)
        docs = spark.createDataFrame(out.collect(), out.schema)
