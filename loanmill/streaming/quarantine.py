"""Quarantine and scores while raw rows arrive.

A borrower with one raw row is scored, a borrower with several is quarantined,
and which it is can change with every batch. The state is one streaming
aggregation: of each borrower the number of rows, when the first one came, and
that row's score. Every batch gives the borrowers it has touched, and these go
to stored tables, in a folder for each batch:

- ``scores``: scores of borrowers seen for the first time,
- ``quarantined``: borrowers that are repeated from this batch on,
- ``retracted``: scores that an earlier batch had given and this one takes back.

A batch's folder is replaced when the batch is run again, and a batch looks at
the tables of earlier ones only, so a restart after a failure changes nothing.
The state has one row for each borrower and forgets none: a row that comes years
later still quarantines. For many borrowers set the RocksDB state store
(``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loanmill.operators.quarantine import exclude_members
from loanmill.plans import single_pass
from loanmill.sources import writers

_SCORE = (
    "loan_id string, member_id string, payment_history_pts decimal(12,4), "
    "defaulters_history_pts decimal(12,4), financial_health_pts decimal(12,4), "
    "loan_score decimal(12,4), loan_final_grade string"
)
TABLES = {
    "touched": f"member_id string, total long, first_at timestamp, last_at timestamp, score struct<{_SCORE}>",
    "scores": _SCORE,
    "quarantined": "member_id string",
    "retracted": _SCORE,
}


def raw_stream(
    spark: SparkSession, path: str, schema: T.StructType, files: int = 1000
) -> DataFrame:
    """New Parquet files of raw rows with keys, at most ``files`` a batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    return reader.parquet(path)


def borrowers(rows: DataFrame) -> DataFrame:
    """Of each borrower of a stream of raw rows with keys: how many rows there
    are, when the first and the last came, and the first one's score (NULL if
    its tables would not all keep it)."""
    scored = single_pass.scored_rows(rows)
    score = F.struct(*T.StructType.fromDDL(_SCORE).names)
    arrived = scored.select(
        "member_id",
        F.when(F.col("is_scored"), score).alias("score"),
        F.current_timestamp().alias("arrived"),  # the batch's time
    )
    # Where several rows came first, together, there is no score to give, and
    # it does not matter whose is kept.
    return arrived.groupBy("member_id").agg(
        F.count("*").alias("total"),
        F.min("arrived").alias("first_at"),
        F.max("arrived").alias("last_at"),
        F.min_by("score", "arrived").alias("score"),
    )


def create_tables(spark: SparkSession, folder: str) -> None:
    """Empty tables, so that the first batch has earlier ones to look at."""
    for name, schema in TABLES.items():
        writers.write_parquet(spark.createDataFrame([], schema), f"{folder}/{name}/batch=-1")


def stored(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table's rows, each with the ``batch`` it came in."""
    schema = T.StructType.fromDDL(TABLES[name]).add("batch", "long")
    return spark.read.schema(schema).parquet(f"{folder}/{name}")


def store_batch(folder: str) -> Callable[[DataFrame, int], None]:
    """Writes the touched borrowers of a batch, and what follows from them."""

    def store(touched: DataFrame, batch: int) -> None:
        spark = touched.sparkSession

        def write(name: str, rows: DataFrame) -> None:
            writers.write_parquet(rows, f"{folder}/{name}/batch={batch}")

        write("touched", touched)  # the state is read once
        touched = stored(spark, folder, "touched").filter(F.col("batch") == batch)
        known = stored(spark, folder, "quarantined").filter(F.col("batch") < batch)
        repeated = exclude_members(touched.filter("total > 1"), known)
        write("quarantined", repeated.select("member_id"))
        # Not on the list before, so there was one row at most before.
        back = repeated.filter("first_at < last_at and score is not null")
        write("retracted", back.select("score.*"))
        write("scores", touched.filter("total = 1 and score is not null").select("score.*"))

    return store


def write_stream(rows: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Take in all raw rows that are there now, then stop."""
    create_tables(rows.sparkSession, folder)
    return (
        borrowers(rows)
        .writeStream.outputMode("update")
        .foreachBatch(store_batch(folder))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The scores that hold after all batches so far."""
    given = stored(spark, folder, "scores").drop("batch")
    return exclude_members(given, stored(spark, folder, "quarantined"))


def retracted_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores that were given and taken back, with the ``batch`` that did so."""
    return stored(spark, folder, "retracted")
