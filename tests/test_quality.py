import pytest

from loanmill.operators import quality


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("x", 5, -1), ("y", None, 4), ("y", 75, 9), ("z", 40, None), (None, 40, 2)],
        "member_id string, amount long, count long",
    )


def test_checks(table):
    report = quality.check_data_quality(
        table,
        {
            "null_checks": ["amount"],
            "unique_checks": ["member_id", "amount"],
            "range_checks": {"amount": (10, 50), "count": (0, 4)},
        },
    )
    assert {(r.check_name, r.column_name): (r.n_hits, r.n_rows, r.pct) for r in report.collect()} == {
        ("null_checks", "amount"): (1, 5, 20.0),
        # NULL is one of the values.
        ("unique_checks", "member_id"): (4, 5, 80.0),
        ("unique_checks", "amount"): (4, 5, 80.0),
        # NULL is not out of range.
        ("range_checks", "amount"): (2, 5, 40.0),
        ("range_checks", "count"): (2, 5, 40.0),
    }


def test_unparsed_values(any_mode):
    texts = any_mode.createDataFrame(
        [("1.5", "7"), ("n/a", None), (None, "1e99"), ("20000000000", " 8 ")], "amount string, n string"
    )
    from pyspark.sql import types as T

    lost = quality.unparsed_values(texts, {"amount": T.DecimalType(28, 4), "n": T.IntegerType()})
    assert {tuple(r) for r in lost.collect()} == {("amount", 1), ("n", 1)}


def test_nested(table):
    report = quality.check_data_quality(
        table,
        {
            "null_checks": ["amount"],
            "unique_checks": ["member_id"],
            "range_checks": {"amount": (0, 5000)},
        },
    )
    assert quality.quality_dict(report) == {
        "null_checks": {
            "amount": {"null_count": 1, "total_count": 5, "null_percentage": 20.0}
        },
        "unique_checks": {
            "member_id": {
                "unique_count": 4,
                "total_count": 5,
                "uniqueness_percentage": 80.0,
            }
        },
        "range_checks": {
            "amount": {
                "out_of_range_count": 0,
                "total_count": 5,
                "out_of_range_percentage": 0.0,
            }
        },
    }


def test_empty_table(table):
    report = quality.check_data_quality(
        table.filter("false"),
        {"null_checks": ["amount"], "unique_checks": ["amount"]},
    )
    assert {(r.n_hits, r.n_rows, r.pct) for r in report.collect()} == {(0, 0, 0.0)}


def test_one_pass(table):
    """All null and range checks come from a single scan."""
    report = quality.check_data_quality(
        table, {"null_checks": ["amount", "count"], "range_checks": {"amount": (0, 1)}}
    )
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_unknown_check(table):
    with pytest.raises(ValueError):
        quality.check_data_quality(table, {"other": ["amount"]})


def test_failed(table):
    report = quality.check_data_quality(
        table,
        {"null_checks": ["amount", "count"], "unique_checks": ["member_id"]},
    )
    failed = quality.failed_checks(report, {"null_checks": 10.0, "unique_checks": 30.0})
    assert {(r.check_name, r.column_name) for r in failed.collect()} == {
        ("null_checks", "amount"),
        ("null_checks", "count"),
    }
    assert quality.failed_checks(report, {"null_checks": 30.0}).count() == 0


def test_presets(spark):
    loans = spark.createDataFrame(
        [("p", "u", 12.5, None), ("q", "u", None, 40.0)],
        "loan_id string, member_id string, funded_amount double, monthly_installment double",
    )
    customers = spark.createDataFrame(
        [("u", None, "OWN"), ("v", 1.0, None), ("w", 3.0, "RENT")],
        "member_id string, annual_income double, home_ownership string",
    )
    repayments = spark.createDataFrame(
        [("p", None, 2.0), ("q", 6.5, None)],
        "loan_id string, last_payment_amount double, total_payment_received double",
    )
    for report, column in (
        (quality.validate_loan_data(loans), "funded_amount"),
        (quality.validate_customer_data(customers), "annual_income"),
        (quality.validate_repayment_data(repayments), "last_payment_amount"),
    ):
        nested = quality.quality_dict(report)
        assert set(nested) == set(quality.CHECKS)
        assert nested["null_checks"][column]["null_count"] == 1


def test_outliers(spark):
    rows = [(f"L{i}", 10.0 + i % 3, 1.0) for i in range(50)] + [("far", 900.0, 1.0)]
    table = spark.createDataFrame(rows, "loan_id string, a double, b double")
    far = quality.outliers(table, "loan_id", ["a", "b"])
    assert [tuple(r) for r in far.collect()] == [("far", "a", 900.0)]
