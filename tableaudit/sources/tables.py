"""Table scans and sinks."""

from __future__ import annotations

import codecs
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import defaults
from ..functions.missing import quoted
from ..spec import AuditParams
from .quoted import read_records


# Names under which Python and the JVM know the same encoding.
SURPLUS = "_surplus"
_JVM_ENCODINGS = {"iso8859-1": "ISO-8859-1", "ascii": "US-ASCII"}


def jvm_encoding(name: str) -> str:
    known = codecs.lookup(name).name
    return _JVM_ENCODINGS.get(known, known.upper())


def null_tokens(params: AuditParams) -> list[str]:
    """The configured tokens plus the reader's standard set."""
    return sorted({*params.null_tokens, *defaults.PANDAS_NULL_TOKENS})


def apply_null_tokens(df: DataFrame, tokens: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Whole, unstripped cells equal to a token become null, but for the columns in ``keep``."""
    return df.select(
        *[
            F.when(~quoted(f.name).isin(*tokens), quoted(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType) and f.name not in keep
            else quoted(f.name)
            for f in df.schema
        ]
    )


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    params: AuditParams = AuditParams(),
    multiline: bool | str = False,
    schema: T.StructType | None = None,
    surplus: str = "raise",
) -> DataFrame:
    """A delimited text table in which every column is a string.

    Nothing is inferred.  Large files are split.  ``multiline="split"`` also reads
    quoted line breaks and still splits files; ``multiline=True`` leaves them to
    Spark, which takes each file as one split, for encodings and ways of quoting
    that the other does not know.  A row with fewer cells than columns is filled up with nulls.  A row
    with more raises an error when it is read, or, with ``surplus="keep"``, keeps
    its first surplus cell in a column ``_surplus``, which is null in all others
    and which the conformance report lists as unexpected.  An empty surplus cell
    holds nothing and counts as none.
    """
    if surplus not in ("raise", "keep"):
        raise ValueError("surplus must be 'raise' or 'keep'")
    if multiline not in (True, False, "split"):
        raise ValueError("multiline must be True, False or 'split'")
    reader = (
        spark.read.option("header", params.header)
        .option("sep", params.delimiter)
        .option("encoding", jvm_encoding(params.encoding))
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", bool(multiline))
        .option("mode", "PERMISSIVE")
    )
    paths = path if isinstance(path, str) else list(path)
    if schema is None:
        names = reader.csv(paths).columns
        if not params.header:
            names = [str(i) for i in range(len(names))]
    else:
        names = schema.fieldNames()
        found = reader.csv(paths).columns if params.header else names
        if found[: len(names)] != names[: len(found)]:
            raise ValueError(f"the header {found} does not match the schema {names}")
    # One column more than the table has: what lands there is surplus.
    wide = T.StructType([T.StructField(n, T.StringType()) for n in (*names, SURPLUS)])
    if multiline == "split":
        options = {"sep": params.delimiter, "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
        files = [paths] if isinstance(paths, str) else paths
        df = read_records(spark, files, wide, options, params.header, jvm_encoding(params.encoding))
    else:
        df = reader.schema(wide).csv(paths)
    if surplus == "raise":
        excess = F.raise_error(F.lit(f"a row has more than {len(names)} cells")).cast("boolean")
        df = df.where(F.when(F.col(SURPLUS).isNotNull(), excess).otherwise(F.lit(True))).drop(SURPLUS)
        return apply_null_tokens(df, null_tokens(params))
    return apply_null_tokens(df, null_tokens(params), keep=(SURPLUS,))


def read_table(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A Parquet table; filters and column choices reach the scan."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("compression", "snappy").parquet(path)
    return path


def write_delimited(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Delimited text with a header in every file; null and empty are written alike."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path
