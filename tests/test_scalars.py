import hashlib

import pytest
from pyspark.sql import functions as F

from loanmill.functions import fixed
from loanmill.functions import scalars as s
from loanmill.operators import ingest


def evaluate(spark, column, values, kind="string"):
    frame = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [row[0] for row in frame.select(column).collect()]


V = "v"


def test_digits(any_mode):
    got = evaluate(
        any_mode,
        s.digits_to_int(F.col(V)),
        ["10+ years", "< 1 year", "n/a", "", None, " 36 months", "9" * 30],
    )
    assert got == [10, 1, None, None, None, 36, None]


def test_term(any_mode):
    got = evaluate(
        any_mode, s.term_years(F.col(V)), [" 36 months", " 60 months", "?", None]
    )
    assert got == [3.0, 5.0, None, None]


def test_percent(any_mode):
    got = evaluate(
        any_mode, s.percent_to_number(F.col(V)), [" 13.99%", "7.5", "x", None]
    )
    assert [None if v is None else float(v) for v in got] == [13.99, 7.5, None, None]


def test_states(any_mode):
    states = ["CA", "ca", "NATION_1", "C", None]
    assert evaluate(any_mode, s.state_code(F.col(V)), states) == [
        "CA",
        "ca",
        "NA",
        "C",
        None,
    ]
    assert evaluate(any_mode, s.state_code(F.col(V), "regex"), states) == [
        "CA",
        "NA",
        "NA",
        "NA",
        "NA",
    ]
    with pytest.raises(ValueError):
        s.state_code(F.col(V), "other")


def test_purposes(any_mode):
    got = evaluate(
        any_mode,
        s.purpose_bucket(F.col(V)),
        [*fixed.PURPOSES, "zzz", "Car", None],
    )
    assert got == [*fixed.PURPOSES, "other", "other", "other"]


def test_dates(any_mode):
    got = evaluate(any_mode, s.date_or_null(F.col(V)), ["0.0", "Dec-2015", None])
    assert got == [None, "Dec-2015", None]
    got = evaluate(
        any_mode, s.issue_month(F.col(V)), ["Dec-2015", "Jan-2016", "2015", None]
    )
    assert got == ["2015-12", "2016-01", None, None]


def test_whole_or_zero(any_mode):
    got = evaluate(
        any_mode, s.whole_or_zero(F.col(V)), ["3.0", "2", "n/a", "", None, "1e99"]
    )
    assert got == [3, 2, 0, 0, 0, 0]


def test_percentage_by_zero(any_mode):
    frame = any_mode.createDataFrame(
        [(100.0, 200.0), (75.0, 100.0), (1.0, 0.0), (None, 1.0)], "a double, b double"
    )
    got = frame.select(s.percentage(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [50.0, 75.0, None, None]


def keyed_by(spark, attributes, **options):
    names = ", ".join(f"{a} string" for a in fixed.MEMBER_ATTRIBUTES)
    frame = ingest.with_member_id(spark.createDataFrame([attributes], names), **options)
    return frame.first().member_id


def test_member_key(spark):
    attributes = tuple("abcdefghi")
    want = hashlib.sha256("||".join(attributes).encode()).hexdigest()
    assert keyed_by(spark, attributes) == want


def test_member_key_skips_nulls(spark):
    left = ("a", None, "c") + (None,) * 6
    right = ("a", "c", None) + (None,) * 6
    assert keyed_by(spark, left) == keyed_by(spark, right)
    token = {"null_token": "?"}
    assert keyed_by(spark, left, **token) != keyed_by(spark, right, **token)
    assert keyed_by(spark, (None,) * 9).startswith(fixed.EMPTY_KEY_PREFIX)


def test_key_collisions(spark):
    names = ", ".join(f"{a} string" for a in fixed.MEMBER_ATTRIBUTES)
    raw = spark.createDataFrame(
        [
            ("a", None, "c") + (None,) * 6,
            ("a", "c", None) + (None,) * 6,
            ("a", "c", None) + (None,) * 6,
            ("x", "y", "z") + (None,) * 6,
            ("x", "y", "z") + (None,) * 6,
        ],
        names,
    )
    found = ingest.key_collisions(ingest.with_member_id(raw)).collect()
    assert [r.n_attribute_sets for r in found] == [2]
