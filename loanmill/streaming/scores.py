"""Scores over a stream of cleaned repayments.

The stream meets a stored ledger of the loans (``scoring.ledger``) in one
stream-static inner join: what does not depend on payments is worked out once
and read by every micro-batch. Points depend on one row only, so the query
keeps no state, and a file sink with a checkpoint writes every row once. The
ledger is a quarantined snapshot: who is repeated shows only over a whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loanmill.operators import scoring


def repayment_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """New Parquet files of cleaned repayments under ``path``."""
    return spark.readStream.schema(schema).parquet(path)


def score_stream(repayments: DataFrame, known: DataFrame) -> DataFrame:
    """``known`` is a ledger that was stored."""
    return scoring.score_payments(repayments, known)


def write_stream(scores: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Score all repayments that are there now, then stop."""
    return (
        scores.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
