"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest
from support import TESTDATA

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, rows_of

SMALL = TESTDATA / "sf0.001"
pytestmark = pytest.mark.skipif(not SMALL.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL / t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, sql, name):
    df = queries()[name](spark, str(SMALL))
    got = df.collect()
    if name not in oracle_sql():
        assert got
        return
    cursor = sql.execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, got) == rows_of(names, cursor.fetchall())


def test_entry_has_rows(spark):
    df = entry(spark)
    assert df.columns == ["check", "column", "detail", "amount"]
    assert df.count() > 0


def test_every_check_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
