"""Points of the 0-800 rules as Columns.

Counts and ratios are compared with bands; the first band that holds gives the
points. Where no band holds the points are NULL, and a NULL makes the whole
score NULL, which reports count as unscored.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanmill.functions import fixed
from loanmill.functions.scalars import first_match

POINTS = fixed.RatedPoints()
CUTOFFS = fixed.GradeCutoffs()
WEIGHTS = fixed.Weights()


@dataclass(frozen=True)
class Rules:
    """A rule set: points of ratings, cut-offs of grades, weights of components."""

    points: fixed.RatedPoints = field(default=POINTS)
    cutoffs: fixed.GradeCutoffs = field(default=CUTOFFS)
    weights: fixed.Weights = field(default=WEIGHTS)


RULES = Rules()
HALF = Decimal("0.5")
ONE_AND_A_HALF = Decimal("1.5")


def last_payment_points(
    payment: Column, installment: Column, pts: fixed.RatedPoints = POINTS
) -> Column:
    """How the last payment compares with the installment.

    The published bands below and above half an installment have the same
    points. What is left after the third is above it.
    """
    return first_match(
        [
            (payment < installment, pts.very_bad),
            (payment == installment, pts.good),
            (payment <= installment * ONE_AND_A_HALF, pts.very_good),
            (payment > installment, pts.excellent),
        ],
        default=pts.unacceptable,
    )


def total_payment_points(
    payment: Column, funded: Column, pts: fixed.RatedPoints = POINTS
) -> Column:
    """How much of the funded amount has come back; a negative total gets NULL."""
    half = funded * HALF
    return first_match(
        [
            (payment >= half, pts.very_good),
            ((payment < half) & (payment > 0), pts.good),
            (payment.isNull() | (payment == 0), pts.unacceptable),
        ]
    )


def count_points(count: Column, many: int, pts: fixed.RatedPoints = POINTS) -> Column:
    """Points of a count of records; ``many`` is for above 5 and for NULL."""
    # From above, so that each band is one comparison; below zero is no count.
    return first_match(
        [
            (count > 5, many),
            (count >= 3, pts.very_bad),
            (count >= 1, pts.bad),
            (count == 0, pts.excellent),
            (count.isNull(), many),
        ]
    )


def delinquency_points(count: Column, rules: Rules = RULES) -> Column:
    # The published rule gives the grade cut-off 750 here, not the 0 points.
    return count_points(count, rules.cutoffs.unacceptable, rules.points)


def public_record_points(count: Column, rules: Rules = RULES) -> Column:
    return count_points(count, rules.points.very_bad, rules.points)


def bankruptcy_points(count: Column, rules: Rules = RULES) -> Column:
    return count_points(count, rules.points.very_bad, rules.points)


def enquiry_points(count: Column, rules: Rules = RULES) -> Column:
    return count_points(count, rules.points.unacceptable, rules.points)


def loan_status_points(status: Column, pts: fixed.RatedPoints = POINTS) -> Column:
    text = F.lower(status)
    late = text.contains("late (16-30 days)") | text.contains("late (31-120 days)")
    return first_match(
        [
            (text.contains("fully paid"), pts.excellent),
            (text.contains("current"), pts.good),
            (text.contains("in grace period"), pts.bad),
            (late, pts.very_bad),
        ],
        default=pts.unacceptable,
    )


def home_points(home: Column, pts: fixed.RatedPoints = POINTS) -> Column:
    text = F.lower(home)
    return first_match(
        [
            (text.endswith("own"), pts.excellent),
            (text.endswith("rent"), pts.good),
            (text.endswith("mortgage"), pts.bad),
            (text.isNull() | text.endswith("any"), pts.very_bad),
        ]
    )


def credit_limit_points(
    funded: Column, limit: Column, pts: fixed.RatedPoints = POINTS
) -> Column:
    """The smaller the loan against the credit limit, the better."""

    def within(share: str) -> Column:
        return funded <= limit * Decimal(share)

    return first_match(
        [
            (within("0.1"), pts.excellent),
            (within("0.2"), pts.very_good),
            (within("0.3"), pts.good),
            (within("0.5"), pts.bad),
            (within("0.7"), pts.very_bad),
        ],
        default=pts.unacceptable,
    )


def grade_points(
    grade: Column, sub_grade: Column, pts: fixed.RatedPoints = POINTS
) -> Column:
    """Points of the grade, less for a worse sub-grade; NULL if they disagree.

    All sub-grades' points are one constant map, which is little code to run.
    """
    best = dict(A=pts.excellent, B=pts.very_good, C=pts.good, D=pts.bad, E=pts.very_bad)
    table = [
        F.lit(entry)
        for name, points in best.items()
        for step, share in fixed.SUB_GRADE_SHARES.items()
        for entry in (f"{name}{step}", (points * share).quantize(Decimal("0.0001")))
    ]
    value = F.try_element_at(F.create_map(*table), sub_grade)
    return first_match(
        [
            (grade.isin("F", "G"), F.lit(pts.unacceptable)),
            (F.left(sub_grade, F.lit(1)) == grade, value),
        ]
    ).cast("decimal(12,4)")


def weighted(weight, *points: Column) -> Column:
    total = points[0]
    for point in points[1:]:
        total = total + point
    return (total * F.lit(weight)).cast("decimal(12,4)")


def final_grade(score: Column, cut: fixed.GradeCutoffs = CUTOFFS) -> Column:
    """Letter grade: A above the highest cut-off, F up to the lowest; NULL stays."""

    def at(cutoff: int) -> Column:
        # The score's own type: nothing is cast in the comparisons.
        return F.lit(cutoff).cast("decimal(12,4)")

    return first_match(
        [
            (score > at(cut.very_good), "A"),
            (score > at(cut.good), "B"),
            (score > at(cut.bad), "C"),
            (score > at(cut.very_bad), "D"),
            (score > at(cut.unacceptable), "E"),
            (score <= at(cut.unacceptable), "F"),
        ]
    )
