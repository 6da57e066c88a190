"""Sources: CSV, Parquet and catalog tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from loanmill.sources import schemas


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """CSV with a header; without a schema Spark reads the file once to infer one.

    A declared schema binds by position and malformed values become NULL.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema)
    try:
        return reader.csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no data at {path}") from error
        raise


def read_raw_text(spark: SparkSession, path: str) -> DataFrame:
    """The wide raw CSV as it is written: all columns as text."""
    try:
        return spark.read.option("header", True).csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no data at {path}") from error
        raise


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """The wide raw CSV by column name, with the declared types.

    Names, not positions: the raw file has many columns that are not used. Text
    that does not fit the declared type becomes NULL; ``quality.unparsed_values``
    counts such text.
    """
    wide = read_raw_text(spark, path)
    return wide.select(
        *[wide[f.name].try_cast(f.dataType).alias(f.name) for f in schemas.RAW]
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no data at {path}") from error
        raise


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make tables known to SQL under their names."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
