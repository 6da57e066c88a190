"""Values that results depend on.

Fixed values: they must equal the published rules for the results to be right,
so they are stated here as they are and nowhere else.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

# The attributes that identify a borrower, and their separator.
MEMBER_ATTRIBUTES = (
    "emp_title",
    "emp_length",
    "home_ownership",
    "annual_inc",
    "zip_code",
    "addr_state",
    "grade",
    "sub_grade",
    "verification_status",
)
MEMBER_SEPARATOR = "||"
# Fixed value: first digits of the SHA-256 of an empty string.
EMPTY_KEY_PREFIX = "e3b0c44298fc1c149"
COUNTRY = "USA"

# Loan purposes that are kept; all others become OTHER_PURPOSE.
PURPOSES = (
    "debt_consolidation",
    "credit_card",
    "home_improvement",
    "other",
    "major_purchase",
    "medical",
    "small_business",
    "car",
    "vacation",
    "moving",
    "house",
    "wedding",
    "renewable_energy",
    "educational",
)
OTHER_PURPOSE = "other"
UNKNOWN_STATE = "NA"
STATE_PATTERN = "^[A-Z]{2}$"
MISSING_DATE = "0.0"


# Points, cut-offs and weights of the 0-800 rules.
@dataclass(frozen=True)
class RatedPoints:
    unacceptable: int = 0
    very_bad: int = 100
    bad: int = 250
    good: int = 500
    very_good: int = 650
    excellent: int = 800


@dataclass(frozen=True)
class GradeCutoffs:
    unacceptable: int = 750
    very_bad: int = 1000
    bad: int = 1500
    good: int = 2000
    very_good: int = 2500


@dataclass(frozen=True)
class Weights:
    payment_history: Decimal = Decimal("0.20")
    defaulters_history: Decimal = Decimal("0.45")
    financial_health: Decimal = Decimal("0.35")


# Share of the grade's points left for sub-grades 1 to 5.
SUB_GRADE_SHARES = {
    1: Decimal("1.00"),
    2: Decimal("0.95"),
    3: Decimal("0.90"),
    4: Decimal("0.85"),
    5: Decimal("0.80"),
}


# Points, cut-offs and bands of the 20-100 rules.
HUNDRED_CUTOFFS = {"A": 90, "B": 80, "C": 70, "D": 60, "E": 50}
HUNDRED_WEIGHTS = {
    "payment_history": 0.20,
    "defaulters_history": 0.45,
    "financial_health": 0.35,
}
PERCENT_BANDS = {100: 100, 80: 80, 60: 60, 40: 40, 20: 20}
COUNT_BANDS = {0: 100, 1: 60, 2: 40, 3: 20}
STATUS_POINTS = {"Fully Paid": 100, "Current": 80, "Late": 40}
HOME_POINTS = {"OWN": 100, "MORTGAGE": 60, "RENT": 40}
GRADE_POINTS = {"A": 100, "B": 80, "C": 60, "D": 40}
OTHER_POINTS = 20

# Accepted ranges of the data-quality presets.
LOAN_CHECKS = {
    "null_checks": ["loan_id", "member_id", "funded_amount", "monthly_installment"],
    "unique_checks": ["loan_id", "member_id"],
    "range_checks": {
        "funded_amount": (0, 1_000_000),
        "monthly_installment": (0, 10_000),
    },
}
CUSTOMER_CHECKS = {
    "null_checks": ["member_id", "annual_income", "home_ownership"],
    "unique_checks": ["member_id"],
    "range_checks": {"annual_income": (0, 10_000_000)},
}
REPAYMENT_CHECKS = {
    "null_checks": ["loan_id", "last_payment_amount", "total_payment_received"],
    "unique_checks": ["loan_id"],
    "range_checks": {
        "last_payment_amount": (0, 10_000),
        "total_payment_received": (0, 1_000_000),
    },
}
REQUIRED_COLUMNS = {"member_id": "string", "loan_id": "string"}
