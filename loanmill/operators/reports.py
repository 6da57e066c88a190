"""Frequency tables and score reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmill.functions.scalars import issue_month
from loanmill.operators.cleaning import ingest_time

COMPONENTS = (
    "payment_history_pts",
    "defaulters_history_pts",
    "financial_health_pts",
    "loan_score",
)


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first, ties by value."""
    return (
        df.groupBy(column)
        .agg(F.count("*").alias("total"))
        .orderBy(F.desc("total"), F.asc(column))
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def row_counts(**tables: DataFrame) -> DataFrame:
    """Rows per named table."""
    counted = [
        table.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows"
        )
        for name, table in tables.items()
    ]
    rows = counted[0]
    for more in counted[1:]:
        rows = rows.unionByName(more)
    return rows


def mean_of(column: str) -> Column:
    """Mean of an exact sum; NULL where nothing is scored."""
    total = F.sum(column).cast("double")
    return F.try_divide(total, F.count(column).cast("double"))


def grade_distribution(scores: DataFrame) -> DataFrame:
    return scores.groupBy("loan_final_grade").agg(F.count("*").alias("n_loans"))


def monthly_scores(scores: DataFrame) -> DataFrame:
    """Loans and scores per month of issue and grade."""
    return (
        scores.withColumn("issue_month", issue_month(F.col("issue_date")))
        .groupBy("issue_month", "loan_final_grade")
        .agg(
            F.count("*").alias("n_loans"),
            mean_of("loan_score").alias("avg_score"),
            F.min("loan_score").alias("min_score"),
            F.max("loan_score").alias("max_score"),
        )
    )


def monthly_partials(scores: DataFrame, *keep: str) -> DataFrame:
    """What ``monthly_scores`` is made of, as sums that can be added up: per
    month of issue and grade, and per what else is to be kept apart."""
    return (
        scores.withColumn("issue_month", issue_month(F.col("issue_date")))
        .groupBy(*keep, "issue_month", "loan_final_grade")
        .agg(
            F.count("*").alias("n_loans"),
            F.count("loan_score").alias("n_scored"),
            F.sum("loan_score").alias("sum_score"),
            F.min("loan_score").alias("min_score"),
            F.max("loan_score").alias("max_score"),
        )
    )


def merged_partials(partials: DataFrame, *keep: str) -> DataFrame:
    """Partials of several days, or other parts, as those of all together."""
    total = F.sum("sum_score").cast(dict(partials.dtypes)["sum_score"])
    return partials.groupBy(*keep, "issue_month", "loan_final_grade").agg(
        F.sum("n_loans").alias("n_loans"),
        F.sum("n_scored").alias("n_scored"),
        total.alias("sum_score"),
        F.min("min_score").alias("min_score"),
        F.max("max_score").alias("max_score"),
    )


def monthly_from_partials(partials: DataFrame) -> DataFrame:
    """The same as ``monthly_scores`` of the rows that the partials are of."""
    mean = F.try_divide(F.col("sum_score").cast("double"), F.col("n_scored").cast("double"))
    return merged_partials(partials).select(
        "issue_month", "loan_final_grade", "n_loans", mean.alias("avg_score"), "min_score", "max_score"
    )


def score_report(scores: DataFrame, *dimensions: str) -> DataFrame:
    """Counts, unscored loans and component means per group, subtotals and total.

    ``grouping_level`` tells a subtotal's NULL from a missing value.
    """
    return scores.rollup(*dimensions).agg(
        F.grouping_id().cast("int").alias("grouping_level"),
        F.count("*").alias("n_loans"),
        F.count_if(F.col("loan_score").isNull()).alias("n_unscored"),
        *[mean_of(c).alias(f"avg_{c}") for c in COMPONENTS],
    )


def full_score_rows(
    scores: DataFrame, run_id: str, at: datetime | None = None
) -> DataFrame:
    """Score rows with the run they come from and its time."""
    return scores.withColumns(
        {"scored_at": ingest_time(at), "run_id": F.lit(run_id)}
    )
