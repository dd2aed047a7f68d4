"""Session settings and shared storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def pin_settings(spark: SparkSession) -> SparkSession:
    """Dates are compared and printed in UTC everywhere in this package."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path under the folder the cluster names in ``spark.checkpoint.dir``.

    All paths of a Spark application are in one folder, which ``clean_up`` removes.

    Where that setting is absent it is a folder of the default file system, and
    set for this session.  On a cluster that file system must be a shared one: a
    local folder would be another one on every machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
        if default.startswith("file:"):
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="tableaudit-")
        else:
            base = f"{default.rstrip('/')}/tmp/tableaudit-{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{_own_folder(spark, base)}/{purpose}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession, base: str) -> str:
    return f"{base.rstrip('/')}/tableaudit/{spark.sparkContext.applicationId}"


def clean_up(spark: SparkSession) -> None:
    """Remove everything this application has written to the shared folder.

    To be called when the results made so far have been read or written elsewhere:
    DataFrames that this package returned may read those files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        remove_folder(spark, _own_folder(spark, base))


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared folder and read again; for small results that are read more than once."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_alone(df: DataFrame, purpose: str) -> DataFrame:
    """As ``staged``; what was shuffled for the rows goes once they are written, not when the driver collects its garbage."""
    spark = df.sparkSession
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        return staged(df, purpose)
    finally:
        if kept is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, kept)


def drop_staged(df: DataFrame) -> None:
    """Remove what ``staged`` has written, once nothing reads it any more."""
    for folder in {path.rsplit("/", 1)[0] for path in df.inputFiles()}:
        remove_folder(df.sparkSession, folder)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this package has made, on whatever file system it is."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def rank_buckets(spark: SparkSession) -> int:
    """How many value ranges one column is split into for exact ranks.

    It follows the shuffle width of the session without a ceiling, so a larger
    cluster gets smaller ranges.
    """
    width = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(8, 4 * width)


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows about the schema or the parameters (never table rows) as a DataFrame."""
    return spark.createDataFrame(rows, schema=schema)
