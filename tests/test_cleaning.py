from datetime import datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from loanmill.operators import cleaning
from loanmill.sources import schemas

AT = datetime(2020, 5, 17, 12, 0)


def customer(member, length, income, state="CA", limit="1000"):
    return (
        member, "title", length, "OWN", None if income is None else D(income),
        state, "123xx", "USA", "A", "A1", "Verified", D(limit), "Individual", None, None,
    )


def customers_frame(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.CUSTOMERS)


def test_customers(any_mode):
    split = customers_frame(
        any_mode,
        customer("M1", "10+ years", "100"),
        customer("M1", "10+ years", "100"),
        customer("M2", "3 years", "100", state="NOWHERE"),
        customer("M3", "n/a", "100", state=None),
        customer("M4", "1 year", None),
    )
    rows = {r.member_id: r for r in cleaning.clean_customers(split, AT).collect()}
    # The copy and the row without income are gone before the mean is taken.
    assert set(rows) == {"M1", "M2", "M3"}
    assert [rows[m].emp_length for m in ("M1", "M2", "M3")] == [10, 3, 6]
    assert [rows[m].address_state for m in ("M1", "M2", "M3")] == ["CA", "NA", None]
    assert rows["M1"].total_high_credit_limit == D("1000.0000")
    assert rows["M1"].ingest_date == AT


def test_customers_regex_states(spark):
    split = customers_frame(
        spark, customer("M1", "1", "5", state="ca"), customer("M2", "1", "5", state=None)
    )
    cleaned = cleaning.clean_customers(split, AT, state_mode="regex")
    assert {r.address_state for r in cleaned.collect()} == {"NA"}


def test_customers_without_any_length(any_mode):
    split = customers_frame(any_mode, customer("M1", None, "5"))
    assert cleaning.clean_customers(split).first().emp_length is None


def test_no_customers(any_mode):
    assert cleaning.clean_customers(customers_frame(any_mode)).count() == 0


def test_ingest_time_does_not_undo_the_distinct(spark):
    split = customers_frame(spark, *[customer("M1", "1", "5")] * 5)
    assert cleaning.clean_customers(split).count() == 1


def loan(loan_id, **changed):
    row = {
        "loan_id": loan_id, "member_id": "M", "loan_amnt": D(10), "funded_amnt": D(10),
        "term": " 36 months", "int_rate": "13.5%", "installment": D(1),
        "issue_d": "Dec-2015", "loan_status": "Current", "purpose": "car", "title": "t",
    }
    return tuple({**row, **changed}[f.name] for f in schemas.LOANS)


def test_loans(any_mode):
    needed = (
        "loan_amnt", "funded_amnt", "term", "installment", "issue_d", "loan_status",
        "purpose",
    )
    split = any_mode.createDataFrame(
        [loan("L1"), loan("L2", purpose="boat", title=None, int_rate=None)]
        + [loan(f"no {name}", **{name: None}) for name in needed],
        schemas.LOANS,
    )
    rows = {r.loan_id: r for r in cleaning.clean_loans(split, AT).collect()}
    assert set(rows) == {"L1", "L2"}
    assert rows["L1"].loan_term_years == 3.0
    assert rows["L1"].interest_rate == D("13.5")
    assert rows["L1"].loan_purpose == "car"
    assert rows["L2"].loan_purpose == "other"
    assert "loan_term_months" not in rows["L1"]


def repayment(loan_id, principal, interest, fee, payment, last="1", day="Dec-2015"):
    values = [None if v is None else D(v) for v in (principal, interest, fee, payment)]
    return (loan_id, *values, None if last is None else D(last), day, "0.0")


def test_repayments(any_mode):
    split = any_mode.createDataFrame(
        [
            repayment("booked", "5", "1", "0", "6"),
            repayment("unbooked", "5", "1", "0.5", "0"),
            repayment("nothing", "0", "0", "0", "0"),
            repayment("cancels out", "5", "-5", "0", "0"),
            repayment("negative", "5", "0", "0", "-2", day="0.0"),
            repayment("no principal", None, "1", "0", "6"),
            repayment("no last payment", "5", "1", "0", "6", last=None),
        ],
        schemas.REPAYMENTS,
    )
    assert {
        r.loan_id
        for r in cleaning.unbooked_payments(
            cleaning.complete_repayments(split)
        ).collect()
    } == {"unbooked", "cancels out"}
    rows = {r.loan_id: r for r in cleaning.clean_repayments(split, AT).collect()}
    totals = {name: r.total_payment_received for name, r in rows.items()}
    assert totals == {"booked": 6, "unbooked": D("6.5"), "negative": -2}
    assert rows["booked"].last_payment_date == "Dec-2015"
    assert rows["negative"].last_payment_date is None
    assert rows["booked"].next_payment_date is None


@pytest.fixture
def raw_defaulters(any_mode):
    return any_mode.createDataFrame(
        [
            ("M1", "2.0", D(10), 0.0, 0.0, 0.0, D(0), None, None),
            ("M2", "n/a", D(10), 1.0, None, 0.0, D(0), 7.0, None),
            ("M3", None, D(10), None, 0.0, 2.0, D(0), 0.0, None),
            ("M4", "0.0", D(10), 0.0, 0.0, 0.0, D(0), None, 9.0),
        ],
        schemas.DEFAULTERS,
    )


def test_defaulters(raw_defaulters):
    cleaned = cleaning.clean_defaulters(raw_defaulters)
    counts = {r.member_id: r.delinq_2yrs for r in cleaned.collect()}
    assert counts == {"M1": 2, "M2": 0, "M3": 0, "M4": 0}
    late = cleaning.delinquencies(cleaned)
    assert {tuple(r) for r in late.collect()} == {
        ("M1", 2, D(10), None),
        ("M2", 0, D(10), 7),
    }
    assert late.schema["mths_since_last_delinq"].dataType.simpleString() == "int"
    issues = cleaning.credit_issue_members(cleaned)
    assert {r.member_id for r in issues.collect()} == {"M2", "M3"}
    assert cleaning.credit_issues(cleaned).columns == cleaned.columns
    detail = {r.member_id: tuple(r)[1:] for r in cleaning.detail_records(cleaned).collect()}
    assert detail == {
        "M1": (0, 0, 0),
        "M2": (1, 0, 0),
        "M3": (0, 0, 2),
        "M4": (0, 0, 0),
    }


def test_float_files_are_accepted(spark):
    """Loans from a file that was written with floats."""
    schema = schemas.as_float(schemas.LOANS)
    row = dict(zip([f.name for f in schema], loan("L1")))
    floats = tuple(float(v) if isinstance(v, D) else v for v in row.values())
    cleaned = cleaning.clean_loans(spark.createDataFrame([floats], schema))
    assert cleaned.select(F.col("funded_amount").cast("double")).first()[0] == 10.0
