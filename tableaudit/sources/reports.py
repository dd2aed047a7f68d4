"""Reports on disk: one partition per section, replaced section by section."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import small_frame


def write_report(report: DataFrame, path: str, section: str, run_id: str) -> str:
    """Replace one section of the report store and keep all others.

    Report rows differ in shape from section to section, so each is kept as
    one JSON document.  A row without payload says that the section was written,
    so that an empty report, too, replaces the rows of the last run.
    """
    rows = report.select(
        F.lit(run_id).alias("run_id"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("payload"),
        F.lit(section).alias("section"),
    )
    written = small_frame(report.sparkSession, [(run_id, None, section)], "run_id string, payload string, section string")
    rows = rows.union(written)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("section")
        .parquet(path)
    )
    return path


def read_report(
    spark: SparkSession, path: str, section: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """The rows of one section; only that partition is read."""
    rows = spark.read.parquet(path).where((F.col("section") == section) & F.col("payload").isNotNull())
    if schema is None:
        return rows
    return rows.select("run_id", F.from_json("payload", schema).alias("row")).select(
        "run_id", "row.*"
    )
