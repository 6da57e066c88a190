"""Each rule at its bounds: on the bound, just below, just above, NULL."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loanmill.functions import points as p


def evaluate(spark, column, records, schema):
    frame = spark.createDataFrame(records, schema)
    return [row[0] for row in frame.select(column).collect()]


D = Decimal


@pytest.mark.parametrize("money", ["decimal(14,4)", "double"])
def test_last_payment(any_mode, money):
    cast = (lambda v: v if v is None else D(str(v))) if "dec" in money else (lambda v: v)
    cases = [
        (0.0, 100.0, 100),
        (49.99, 100.0, 100),
        (50.0, 100.0, 100),
        (99.99, 100.0, 100),
        (100.0, 100.0, 500),
        (100.01, 100.0, 650),
        (150.0, 100.0, 650),
        (150.01, 100.0, 800),
        (None, 100.0, 0),
        (100.0, None, 0),
        (-3.0, -10.0, 800),
        (-12.0, -10.0, 100),
    ]
    got = evaluate(
        any_mode,
        p.last_payment_points(F.col("payment"), F.col("installment")),
        [(cast(a), cast(b)) for a, b, _ in cases],
        f"payment {money}, installment {money}",
    )
    assert got == [want for *_, want in cases]


def test_total_payment(any_mode):
    cases = [
        (50.0, 100.0, 650),
        (49.99, 100.0, 500),
        (0.01, 100.0, 500),
        (0.0, 100.0, 0),
        (None, 100.0, 0),
        (-1.0, 100.0, None),
        (10.0, None, None),
        (0.0, None, 0),
        (0.0, 0.0, 650),
    ]
    got = evaluate(
        any_mode,
        p.total_payment_points(F.col("payment"), F.col("funded")),
        [c[:2] for c in cases],
        "payment double, funded double",
    )
    assert got == [c[2] for c in cases]


@pytest.mark.parametrize(
    "rule, many",
    [
        (p.delinquency_points, 750),
        (p.public_record_points, 100),
        (p.bankruptcy_points, 100),
        (p.enquiry_points, 0),
    ],
)
def test_counts(any_mode, rule, many):
    counts = [0, 1, 2, 3, 5, 6, None, -1]
    got = evaluate(any_mode, rule(F.col("n")), [(c,) for c in counts], "n int")
    assert got == [800, 250, 250, 100, 100, many, many, None]


def test_loan_status(any_mode):
    cases = {
        "Fully Paid": 800,
        "Does not meet the credit policy. Status:Fully Paid": 800,
        "CURRENT": 500,
        "In Grace Period": 250,
        "Late (16-30 days)": 100,
        "late (31-120 DAYS)": 100,
        "Late": 0,
        "Charged Off": 0,
        "Default": 0,
        "something": 0,
        None: 0,
    }
    got = evaluate(
        any_mode,
        p.loan_status_points(F.col("status")),
        [(c,) for c in cases],
        "status string",
    )
    assert got == list(cases.values())


def test_home(any_mode):
    cases = {
        "OWN": 800,
        "own": 800,
        "Rent": 500,
        "MORTGAGE": 250,
        "ANY": 100,
        None: 100,
        "OTHER": None,
        "OWNED": None,
    }
    got = evaluate(
        any_mode, p.home_points(F.col("home")), [(c,) for c in cases], "home string"
    )
    assert got == list(cases.values())


def test_credit_limit(any_mode):
    cases = [
        ("10.00", "100", 800),
        ("10.01", "100", 650),
        ("20.00", "100", 650),
        ("20.01", "100", 500),
        ("30.00", "100", 500),
        ("30.01", "100", 250),
        ("50.00", "100", 250),
        ("50.01", "100", 100),
        ("70.00", "100", 100),
        ("70.01", "100", 0),
        ("70.00", None, 0),
        (None, "100", 0),
        ("1.00", "0", 0),
        ("0.00", "0", 800),
    ]
    got = evaluate(
        any_mode,
        p.credit_limit_points(F.col("funded"), F.col("credit")),
        [tuple(None if v is None else D(v) for v in c[:2]) for c in cases],
        "funded decimal(14,4), credit decimal(14,4)",
    )
    assert got == [c[2] for c in cases]


def test_grades(any_mode):
    base = {"A": 800, "B": 650, "C": 500, "D": 250, "E": 100}
    share = {1: "1.00", 2: "0.95", 3: "0.90", 4: "0.85", 5: "0.80"}
    cases = [
        (g, f"{g}{n}", base[g] * D(share[n])) for g in base for n in range(1, 6)
    ] + [
        ("F", "F3", D(0)),
        ("G", None, D(0)),
        ("A", "B1", None),
        ("A", "A6", None),
        ("A", None, None),
        (None, "A1", None),
        ("H", "H1", None),
    ]
    got = evaluate(
        any_mode,
        p.grade_points(F.col("grade"), F.col("sub_grade")),
        [c[:2] for c in cases],
        "grade string, sub_grade string",
    )
    assert got == [c[2] for c in cases]


def test_final_grade(any_mode):
    cases = [
        ("2500.0001", "A"),
        ("2500", "B"),
        ("2000.0001", "B"),
        ("2000", "C"),
        ("1500.0001", "C"),
        ("1500", "D"),
        ("1000.0001", "D"),
        ("1000", "E"),
        ("750.0001", "E"),
        ("750", "F"),
        ("0", "F"),
        (None, None),
    ]
    got = evaluate(
        any_mode,
        p.final_grade(F.col("score")),
        [(None if c[0] is None else D(c[0]),) for c in cases],
        "score decimal(12,4)",
    )
    assert got == [c[1] for c in cases]


def test_weights_are_exact(spark):
    got = evaluate(
        spark,
        p.weighted(p.WEIGHTS.financial_health, F.col("a"), F.col("b")),
        [(800, D("552.5000")), (None, D("1.0"))],
        "a int, b decimal(12,4)",
    )
    assert got == [D("473.3750"), None]
