"""Cleaning of the four entity tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmill.functions import scalars as s
from loanmill.operators import ingest
from loanmill.sources import schemas


def ingest_time(at: datetime | None) -> Column:
    """Now, or the given time in the session's time zone."""
    if at is None:
        return F.current_timestamp()
    return F.lit(at.isoformat(sep=" ")).cast("timestamp")


def present(names: Sequence[str]) -> Column:
    """No named column is NULL. Unlike ``na.drop`` these are plain IS NOT NULL
    tests, which reach the file scan."""
    return s.all_present(*[F.col(name) for name in names])


def named_customers(split: DataFrame) -> DataFrame:
    """Customers with a known income under their cleaned names and types."""
    money = ("annual_income", "total_high_credit_limit", "join_annual_income")
    return (
        split.withColumnsRenamed(schemas.CUSTOMER_NAMES)
        .filter(F.col("annual_income").isNotNull())  # reaches the file scan
        .withColumns({name: F.col(name).try_cast(schemas.MONEY) for name in money})
        .filter(F.col("annual_income").isNotNull())
        .withColumn("emp_length", s.digits_to_int(F.col("emp_length")))
    )


def unique_customers(split: DataFrame) -> DataFrame:
    """Distinct customers with a known income.

    The distinct is over the file's columns and drops copies before the
    shuffle; the income filter is on one of them and runs at the scan. Rows that
    are marked as their borrower's only one are distinct as they are.
    """
    alone, several = ingest.parted(split)
    several = named_customers(several.distinct())
    return several if alone is None else named_customers(alone).unionByName(several)


def mean_emp_length(customers: DataFrame) -> Column:
    """floor(avg) as a scalar subquery: lazy, one row, no driver round trip."""
    return customers.agg(F.floor(F.avg("emp_length")).cast("int")).scalar()


def clean_customers(
    split: DataFrame, at: datetime | None = None, state_mode: str = "length"
) -> DataFrame:
    """Distinct customers, employment years filled with the mean, states checked."""
    customers = unique_customers(split)
    return finish_customers(customers, mean_emp_length(customers), at, state_mode)


def finish_customers(
    customers: DataFrame,
    mean: Column,
    at: datetime | None = None,
    state_mode: str = "length",
) -> DataFrame:
    return customers.withColumns(
        {
            "emp_length": F.coalesce(F.col("emp_length"), mean),
            "address_state": s.state_code(F.col("address_state"), state_mode),
            "ingest_date": ingest_time(at),
        }
    )


def named_loans(split: DataFrame) -> DataFrame:
    return split.withColumnsRenamed(schemas.LOAN_NAMES)


def finish_loans(loans: DataFrame, at: datetime | None = None) -> DataFrame:
    return loans.select(
        "loan_id",
        "member_id",
        "loan_amount",
        "funded_amount",
        s.term_years(F.col("loan_term_months")).alias("loan_term_years"),
        s.percent_to_number(F.col("interest_rate")).alias("interest_rate"),
        "monthly_installment",
        "issue_date",
        "loan_status",
        s.purpose_bucket(F.col("loan_purpose")).alias("loan_purpose"),
        "loan_title",
        ingest_time(at).alias("ingest_date"),
        *ingest.mark(loans),
    )


def clean_loans(split: DataFrame, at: datetime | None = None) -> DataFrame:
    """Complete loans with term in years and a known purpose; a narrow job."""
    complete = named_loans(split).filter(present(schemas.LOAN_REQUIRED))
    return finish_loans(complete, at)


def named_repayments(split: DataFrame) -> DataFrame:
    return split.withColumnsRenamed(schemas.REPAYMENT_NAMES)


def complete_repayments(split: DataFrame) -> DataFrame:
    return named_repayments(split).filter(present(schemas.REPAYMENT_REQUIRED))


def unbooked_payments(repayments: DataFrame) -> DataFrame:
    """Rows with principal received and no payment booked."""
    return repayments.filter(
        s.is_unbooked_payment(
            F.col("total_principal_received"), F.col("total_payment_received")
        )
    )


def finish_repayments(repayments: DataFrame, at: datetime | None = None) -> DataFrame:
    return (
        repayments.withColumn(
            "total_payment_received",
            s.booked_payment(
                F.col("total_principal_received"),
                F.col("total_interest_received"),
                F.col("total_late_fee_received"),
                F.col("total_payment_received"),
            ).cast(schemas.TOTAL),
        )
        .filter(F.col("total_payment_received") != 0)
        .withColumns(
            {
                "last_payment_date": s.date_or_null(F.col("last_payment_date")),
                "next_payment_date": s.date_or_null(F.col("next_payment_date")),
                "ingest_date": ingest_time(at),
            }
        )
    )


def clean_repayments(split: DataFrame, at: datetime | None = None) -> DataFrame:
    """Complete repayments, unbooked totals repaired, zero totals dropped."""
    return finish_repayments(complete_repayments(split), at)


def clean_defaulters(split: DataFrame) -> DataFrame:
    """delinq_2yrs as an integer, 0 where it was missing or no number."""
    return split.withColumn("delinq_2yrs", s.whole_or_zero(F.col("delinq_2yrs")))


def delinquent(defaulters: DataFrame) -> DataFrame:
    """Rows with a delinquency, all columns."""
    return defaulters.filter(
        s.any_positive(F.col("delinq_2yrs"), F.col("mths_since_last_delinq"))
    )


def delinquencies(defaulters: DataFrame) -> DataFrame:
    """The delinquency table: four columns of the delinquent rows."""
    return delinquent(defaulters).select(
        "member_id",
        "delinq_2yrs",
        "delinq_amnt",
        F.col("mths_since_last_delinq").try_cast("int").alias("mths_since_last_delinq"),
        *ingest.mark(defaulters),
    )


def credit_issues(defaulters: DataFrame) -> DataFrame:
    """Rows with a public record, a bankruptcy or a recent enquiry, all columns."""
    return defaulters.filter(
        s.any_positive(
            F.col("pub_rec"), F.col("pub_rec_bankruptcies"), F.col("inq_last_6mths")
        )
    )


def credit_issue_members(defaulters: DataFrame) -> DataFrame:
    return credit_issues(defaulters).select("member_id")


def detail_records(defaulters: DataFrame) -> DataFrame:
    """Record and enquiry counts of every row as integers, 0 where missing."""
    counts = ("pub_rec", "pub_rec_bankruptcies", "inq_last_6mths")
    return defaulters.select(
        "member_id",
        *[s.whole_or_zero(F.col(c)).alias(c) for c in counts],
        *ingest.mark(defaulters),
    )
