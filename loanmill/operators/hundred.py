"""The 20-100 rules: percentages, threshold points and a weighted score.

Weights are doubles here, as the published rules have them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmill.functions import fixed
from loanmill.functions import scalars as s
from loanmill.sources.writers import write_parquet

SAVED_COLUMNS = (
    "member_id",
    "payment_history_score",
    "defaulters_history_score",
    "financial_health_score",
    "total_score",
    "grade",
)
PROFILES = ("numeric", "as_written")


def calculate_percentage(
    df: DataFrame, numerator_col: str, denominator_col: str, output_col: str
) -> DataFrame:
    return df.withColumn(
        output_col, s.percentage(F.col(numerator_col), F.col(denominator_col))
    )


def assign_score_based_on_threshold(
    df: DataFrame, input_col: str, thresholds: Mapping[float, float], output_col: str
) -> DataFrame:
    return df.withColumn(
        output_col, s.threshold_points(F.col(input_col), thresholds)
    )


def clean_string_column(
    df: DataFrame, column_name: str, replacements: Mapping[str, str]
) -> DataFrame:
    return df.withColumn(column_name, s.mapped(F.col(column_name), replacements))


def validate_dataframe(df: DataFrame) -> bool:
    """Are the key columns there, as text? Looks at the schema only."""
    types = {field.name: field.dataType.typeName() for field in df.schema}
    return all(
        types.get(name) == kind for name, kind in fixed.REQUIRED_COLUMNS.items()
    )


def _percent_bands(profile: str) -> Mapping[float, float]:
    """'numeric' bands, or none: as first published, the bands had names in
    place of numbers, which no percentage ever reaches, so all points were 0."""
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}")
    return fixed.PERCENT_BANDS if profile == "numeric" else {}


def payment_columns(profile: str = "numeric") -> dict[str, Column]:
    bands = _percent_bands(profile)
    last = s.percentage(F.col("last_payment_amount"), F.col("monthly_installment"))
    total = s.percentage(F.col("total_payment_received"), F.col("funded_amount"))
    return {
        "last_payment_percentage": last,
        "total_payment_percentage": total,
        "last_payment_pts": s.threshold_points(last, bands),
        "total_payment_pts": s.threshold_points(total, bands),
    }


def default_columns() -> dict[str, Column]:
    counts = {
        "delinq_pts": "delinq_2yrs",
        "public_records_pts": "pub_rec",
        "public_bankruptcies_pts": "pub_rec_bankruptcies",
        "enq_pts": "inq_last_6mths",
    }
    return {
        pts: s.threshold_points(F.col(count), fixed.COUNT_BANDS)
        for pts, count in counts.items()
    }


def text_columns() -> dict[str, Column]:
    """Points that depend on texts."""
    rules = {
        "loan_status_pts": ("loan_status", fixed.STATUS_POINTS),
        "home_pts": ("home_ownership", fixed.HOME_POINTS),
        "grade_pts": ("grade", fixed.GRADE_POINTS),
    }
    return {
        name: s.first_match(
            [(F.col(column) == text, pts) for text, pts in points.items()], fixed.OTHER_POINTS
        )
        for name, (column, points) in rules.items()
    }


def limit_columns(profile: str = "numeric") -> dict[str, Column]:
    used = s.percentage(F.col("funded_amount"), F.col("total_high_credit_limit"))
    return {
        "credit_limit_utilization": used,
        "credit_limit_pts": s.threshold_points(used, _percent_bands(profile)),
    }


def financial_columns(profile: str = "numeric") -> dict[str, Column]:
    return {**text_columns(), **limit_columns(profile)}


def calculate_payment_history_score(
    loans_repayments: DataFrame, loans: DataFrame, profile: str = "numeric"
) -> DataFrame:
    joined = loans_repayments.join(loans, "loan_id")
    return joined.withColumns(payment_columns(profile))


def calculate_defaulters_history_score(
    detail: DataFrame, delinquencies: DataFrame | None = None
) -> DataFrame:
    """Points of four counts; the delinquency count may be in a second table."""
    if delinquencies is not None:
        detail = detail.join(
            delinquencies.select("member_id", "delinq_2yrs"), "member_id"
        )
    return detail.select(
        "member_id", *[value.alias(name) for name, value in default_columns().items()]
    )


def calculate_financial_health_score(
    loans: DataFrame, customers: DataFrame, profile: str = "numeric"
) -> DataFrame:
    """Columns that both tables have are taken from the loans."""
    shared = [c for c in customers.columns if c in loans.columns and c != "member_id"]
    joined = loans.join(customers.drop(*shared), "member_id")
    return joined.withColumns(financial_columns(profile))


POINT_COLUMNS = {
    "payment_history": ("last_payment_pts", "total_payment_pts"),
    "defaulters_history": (
        "delinq_pts",
        "public_records_pts",
        "public_bankruptcies_pts",
        "enq_pts",
    ),
    "financial_health": ("loan_status_pts", "home_pts", "credit_limit_pts", "grade_pts"),
}


def weighted_scores(points: DataFrame) -> DataFrame:
    """Component scores, their sum and the grade from the ten point columns."""
    parts = {}
    for name, columns in POINT_COLUMNS.items():
        total = F.col(columns[0])
        for column in columns[1:]:
            total = total + F.col(column)
        parts[f"{name}_score"] = total * F.lit(fixed.HUNDRED_WEIGHTS[name])
    payment, default, financial = (F.col(name) for name in parts)
    score = F.col("total_score")
    return (
        points.withColumns(parts)
        .withColumn("total_score", payment + default + financial)
        .withColumn(
            "grade",
            s.first_match(
                [(score > low, name) for name, low in fixed.HUNDRED_CUTOFFS.items()],
                "F",
            ),
        )
    )


def calculate_final_loan_score(
    payment_scores: DataFrame, defaulters_scores: DataFrame, financial_scores: DataFrame
) -> DataFrame:
    """Join the components at loan grain, weigh, add up and grade."""
    loan = ["loan_id", "member_id"]
    return weighted_scores(
        payment_scores.select(*loan, *POINT_COLUMNS["payment_history"])
        .join(financial_scores.select(*loan, *POINT_COLUMNS["financial_health"]), loan)
        .join(
            defaulters_scores.select("member_id", *POINT_COLUMNS["defaulters_history"]),
            "member_id",
        )
    )


def score_projection(loan_scores: DataFrame) -> DataFrame:
    return loan_scores.select(*SAVED_COLUMNS)


def save_loan_scores(loan_scores: DataFrame, output_path: str) -> None:
    write_parquet(score_projection(loan_scores), output_path)
