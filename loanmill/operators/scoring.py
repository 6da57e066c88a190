"""Score components and the final score of the 0-800 rules.

Components keep the loan's id: joins are at loan grain, so a borrower with
several loans gets one row per loan. Quarantined borrowers are expected to be
gone from the tables that come in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmill.functions import points as p

PAYMENT_POINTS = ("last_payment_pts", "total_payment_pts")
# The numbers that all other points depend on.
NUMBERS = (
    "last_payment_amount",
    "monthly_installment",
    "total_payment_received",
    "funded_amount",
    "total_high_credit_limit",
    "delinq_2yrs",
    "pub_rec",
    "pub_rec_bankruptcies",
    "inq_last_6mths",
)
DEFAULT_POINTS = (
    "delinq_pts",
    "public_records_pts",
    "public_bankruptcies_pts",
    "enq_pts",
)
FINANCIAL_POINTS = ("loan_status_pts", "home_pts", "credit_limit_pts", "grade_pts")


def payment_point_columns(rules: p.Rules = p.RULES) -> list[Column]:
    return [
        p.last_payment_points(
            F.col("last_payment_amount"), F.col("monthly_installment"), rules.points
        ).alias("last_payment_pts"),
        p.total_payment_points(
            F.col("total_payment_received"), F.col("funded_amount"), rules.points
        ).alias("total_payment_pts"),
    ]


def default_point_columns(rules: p.Rules = p.RULES) -> list[Column]:
    return [
        p.delinquency_points(F.col("delinq_2yrs"), rules).alias("delinq_pts"),
        p.public_record_points(F.col("pub_rec"), rules).alias("public_records_pts"),
        p.bankruptcy_points(F.col("pub_rec_bankruptcies"), rules).alias(
            "public_bankruptcies_pts"
        ),
        p.enquiry_points(F.col("inq_last_6mths"), rules).alias("enq_pts"),
    ]


def text_point_columns(rules: p.Rules = p.RULES) -> list[Column]:
    """Points that depend on texts."""
    return [
        p.loan_status_points(F.col("loan_status"), rules.points).alias("loan_status_pts"),
        p.home_points(F.col("home_ownership"), rules.points).alias("home_pts"),
        p.grade_points(F.col("grade"), F.col("sub_grade"), rules.points).alias("grade_pts"),
    ]


def limit_point_columns(rules: p.Rules = p.RULES) -> list[Column]:
    return [
        p.credit_limit_points(
            F.col("funded_amount"), F.col("total_high_credit_limit"), rules.points
        ).alias("credit_limit_pts")
    ]


def financial_point_columns(rules: p.Rules = p.RULES) -> list[Column]:
    return [*text_point_columns(rules), *limit_point_columns(rules)]


def payment_points(repayments: DataFrame, loans: DataFrame) -> DataFrame:
    return repayments.join(loans, "loan_id").select(
        "loan_id", "member_id", *payment_point_columns()
    )


def default_points(detail: DataFrame, delinquencies: DataFrame) -> DataFrame:
    return detail.join(delinquencies, "member_id").select(
        "member_id", *default_point_columns()
    )


def financial_points(loans: DataFrame, customers: DataFrame) -> DataFrame:
    return loans.join(customers, "member_id").select(
        "loan_id", "member_id", *financial_point_columns()
    )


def weighted_scores(points: DataFrame, *keep: str, rules: p.Rules = p.RULES) -> DataFrame:
    """Components, total and grade from the ten point columns."""
    w = rules.weights
    parts = {
        "payment_history_pts": (w.payment_history, PAYMENT_POINTS),
        "defaulters_history_pts": (w.defaulters_history, DEFAULT_POINTS),
        "financial_health_pts": (w.financial_health, FINANCIAL_POINTS),
    }
    scored = points.select(
        "loan_id",
        "member_id",
        *keep,
        *[
            p.weighted(weight, *[F.col(c) for c in columns]).alias(name)
            for name, (weight, columns) in parts.items()
        ],
    )
    payment, default, financial = (F.col(name) for name in parts)
    total = (payment + default + financial).cast("decimal(12,4)")
    return scored.withColumn("loan_score", total).withColumn(
        "loan_final_grade", p.final_grade(F.col("loan_score"), rules.cutoffs)
    )


def ledger(
    loans: DataFrame,
    customers: DataFrame,
    delinquencies: DataFrame,
    detail: DataFrame,
    *keep: str,
) -> DataFrame:
    """What is known of each loan that can be scored, apart from its payments.

    The member tables, one row per borrower, meet the loans first: they share
    one partitioning (none at all to build if stored in buckets of the borrower)
    and leave only delinquent borrowers' loans to meet the repayments.
    """
    borrowers = (
        delinquencies.select("member_id", "delinq_2yrs")
        .join(detail, "member_id")
        .join(
            customers.select(
                "member_id",
                "home_ownership",
                "total_high_credit_limit",
                "grade",
                "sub_grade",
            ),
            "member_id",
        )
    )
    return (
        loans.select(
            "loan_id",
            "member_id",
            "funded_amount",
            "monthly_installment",
            "loan_status",
            *keep,
        )
        .join(borrowers, "member_id")
        .select(
            "loan_id",
            "member_id",
            "funded_amount",
            "monthly_installment",
            *keep,
            *default_point_columns(),
            *financial_point_columns(),
        )
    )


def score_payments(repayments: DataFrame, known: DataFrame, *keep: str) -> DataFrame:
    """Score the repayments' loans; ``known`` is a ledger. One join, no more."""
    payments = repayments.select(
        "loan_id", "last_payment_amount", "total_payment_received"
    )
    points = payments.join(known, "loan_id").select(
        "loan_id",
        "member_id",
        *keep,
        *payment_point_columns(),
        *DEFAULT_POINTS,
        *FINANCIAL_POINTS,
    )
    return weighted_scores(points, *keep)


def score_tables(
    loans: DataFrame,
    repayments: DataFrame,
    customers: DataFrame,
    delinquencies: DataFrame,
    detail: DataFrame,
    *keep: str,
) -> DataFrame:
    """Score from the five stored tables."""
    known = ledger(loans, customers, delinquencies, detail, *keep)
    return score_payments(repayments, known, *keep)


def combine_components(
    payment: DataFrame, default: DataFrame, financial: DataFrame
) -> DataFrame:
    """Final score from the three components, joined at loan grain."""
    return weighted_scores(
        payment.join(financial, ["loan_id", "member_id"]).join(default, "member_id")
    )


def grade_slice(scores: DataFrame, *grades: str) -> DataFrame:
    return scores.filter(F.col("loan_final_grade").isin(*grades))
