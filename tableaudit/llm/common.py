"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableaudit.session import shared_folder

# The two ways in which the operators cut words.
TOKEN = r"[^\x20\x09-\x0D]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Whether a query's shuffle files are removed when it ends.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared folder and read again.

    This cuts the lineage for results that are read more than once; a lost
    executor costs the tasks it ran, not the steps before.
    """
    return written(df, shared_folder(df.sparkSession, purpose))


def written(df: DataFrame, path: str) -> DataFrame:
    """The rows, written to a new folder and read again.

    What was shuffled for them goes as soon as they are written, not when the
    driver happens to collect its garbage.
    """
    spark = df.sparkSession
    kept = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        if kept is None:
            spark.conf.unset(_CLEAN_UP)
        else:
            spark.conf.set(_CLEAN_UP, kept)
    return spark.read.schema(df.schema).parquet(path)


def fold_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def folded(texts: pa.Array) -> list[bytes]:
    """The same on an Arrow column, as UTF-8; null is empty.  (Python lowers ASCII only in bytes.)"""
    return [b"" if t is None else t.lower() for t in texts.cast(pa.binary()).to_pylist()]
