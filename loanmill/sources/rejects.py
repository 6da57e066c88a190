"""CSV rows that do not fit, with why and from which file.

Rows that are kept and rows that are rejected come from the same scan and add up
to the rows of the files: nothing turns into NULL unseen.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = "_record"
#: Reasons. A record with a quote that is not closed in its line is broken; its
#: columns cannot be counted.
SHORT, LONG, BROKEN, VALUES = "too few columns", "too many columns", "broken quotes", "values"
#: Stands after a record's last column to tell how many there are.
_END = "\u0003"


def _places(record: Column, n: int) -> Column:
    """The record's columns as texts, with a mark after the last of them; what
    comes after ``n`` columns and the mark is cut off."""
    names = [f"c{i}" for i in range(n + 1)]
    parsed = F.from_csv(
        F.concat(record, F.lit("," + _END)),
        ", ".join(f"{c} string" for c in names),
        {"mode": "PERMISSIVE", "maxCharsPerColumn": "-1"},
    )
    return F.array(*[F.coalesce(parsed[c], F.lit("")) for c in names])


def _reason(record: Column, n: int) -> Column:
    """Why a record does not fit ``n`` columns."""
    places = _places(record, n)
    end = F.array_position(places, _END)
    swallowed = F.exists(places, lambda text: text.endswith(_END) & (text != _END))
    return (
        F.when(swallowed, BROKEN)
        .when(end == 0, LONG)
        .when(end <= n, SHORT)
        .otherwise(VALUES)
    )


def _lost(record: Column, schema: T.StructType) -> Column:
    """Names of the columns whose text the declared type cannot hold."""
    places = _places(record, len(schema))
    names = [
        F.when((F.get(places, F.lit(i)) != "") & F.col(field.name).isNull(), field.name)
        for i, field in enumerate(schema)
    ]
    return F.filter(F.array(*names), lambda name: name.isNotNull())


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The rows of CSV files that fit the schema, and the others
    as ``record``, ``reason``, ``columns`` (whose values do not fit) and ``file``.

    A declared schema binds by position. A record that is too short, too long or
    broken, or has a value that its type cannot hold, is rejected as a whole.
    """
    declared = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    reader = (
        spark.read.schema(declared)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RECORD)
        .option("enforceSchema", True)
    )
    try:
        rows = reader.csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no data at {path}") from error
        raise
    # A record is judged by the columns that are read. This is true of every row
    # and has the scan read all of them, whichever are used later.
    judged = F.hash(*schema.names) <= 2**31 - 1
    kept = rows.filter(F.col(RECORD).isNull() & judged).drop(RECORD)
    bad = rows.withColumn("file", F.col("_metadata.file_path"))
    reason = _reason(F.col(RECORD), len(schema))
    none = F.array().cast("array<string>")
    rejects = bad.filter(F.col(RECORD).isNotNull() & judged).select(
        F.col(RECORD).alias("record"),
        reason.alias("reason"),
        F.when(reason == VALUES, _lost(F.col(RECORD), schema)).otherwise(none).alias("columns"),
        "file",
    )
    return kept, rejects
