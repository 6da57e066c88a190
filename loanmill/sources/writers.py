"""Sinks: Parquet, CSV and date-partitioned Parquet."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Of Parquet files: keys are hexadecimal digests, half of which is air to it.
COMPRESSION = "zstd"


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False, compressed: bool = False) -> None:
    """CSV with a header, in as many files as there are partitions.

    ``single_file`` brings all rows to one task: for small exports only.
    ``compressed`` writes ``.csv.gz``, for files that Spark reads again.
    """
    if single_file:
        df = df.repartition(1)
    writer = df.write.mode("overwrite").option("header", True)
    writer.option("compression", "gzip" if compressed else "none").csv(path)


def write_dated(df: DataFrame, path: str, day: date, column: str = "score_date"):
    """Write one day's rows; other days in the same folder stay as they are."""
    (
        df.withColumn(column, F.lit(day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", COMPRESSION)
        .partitionBy(column)
        .parquet(path)
    )


_JOB = ContextVar("job", default="job")


@contextmanager
def job(name: str) -> Iterator[None]:
    """Work folders of what runs inside belong to this job."""
    token = _JOB.set(name)
    try:
        yield
    finally:
        _JOB.reset(token)


def work_folder(spark: SparkSession, name: str) -> str:
    """The folder of that name of the application's current job.

    It lies in the folder named by ``spark.checkpoint.dir`` and, where that is
    unset, in the warehouse: executors reach both. Names are fixed, so running a
    job again replaces what it left, and all of an application's work is in one
    folder that can be deleted when its results have been read.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"
    application = spark.sparkContext.applicationId
    return f"{base.rstrip('/')}/loanmill/{application}/{_JOB.get()}/{name}"


def stage(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage at a shuffle-free scan that survives lost executors and
    that every later use can prune and filter on its own. ``by`` is a column of
    few values with a folder each: a use of one value reads no other's files.
    """
    spark = df.sparkSession
    path = work_folder(spark, name)
    if by is None:
        write_parquet(df, path)
    else:
        writer = df.write.mode("overwrite").option("compression", COMPRESSION)
        writer.partitionBy(by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
