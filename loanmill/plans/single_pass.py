"""Quarantined tables, wide rows and scores straight from the raw table.

A raw row holds everything about its loan, and only borrowers with a single
raw row are scored. So each job here counts the borrowers' rows, filters rows
by what their tables would keep, turns texts into points and drops the rows of
repeated borrowers by an anti join: rows that no score needs never move. The
raw table is read twice, once for the borrower's key alone; nothing is copied.
The loan id is taken to be the raw table's primary key, which the loan
checks report on; for tables that were stored apart use
``scoring.score_tables``, which joins.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmill.functions import fixed
from loanmill.functions import scalars as s
from loanmill.functions.points import RULES, Rules
from loanmill.operators import (
    cleaning,
    hundred,
    ingest,
    quarantine,
    scoring,
    serving,
)
from loanmill.sources import schemas


def customers_new(keyed: DataFrame, state_mode: str = "length") -> DataFrame:
    """Cleaned customers without the quarantined ones.

    The mean employment length is that of all customers, quarantined or not.
    """
    everyone = cleaning.unique_customers(ingest.split_customers(keyed))
    kept = cleaning.named_customers(
        ingest.split_customers(quarantine.single_rows(keyed))
    )
    return cleaning.finish_customers(
        kept, cleaning.mean_emp_length(everyone), state_mode=state_mode
    )


def _defaulters(keyed: DataFrame) -> DataFrame:
    return cleaning.clean_defaulters(ingest.split_defaulters(keyed))


def delinquencies_new(keyed: DataFrame) -> DataFrame:
    return cleaning.delinquencies(_defaulters(quarantine.single_rows(keyed)))


def detail_new(keyed: DataFrame) -> DataFrame:
    return cleaning.detail_records(_defaulters(quarantine.single_rows(keyed)))


def cleaned_rows(keyed: DataFrame) -> DataFrame:
    """Raw rows with cleaned fields and whether each table would keep the row."""
    named = keyed.withColumnsRenamed(
        {
            "id": "loan_id",
            **schemas.CUSTOMER_NAMES,
            **schemas.LOAN_NAMES,
            **schemas.REPAYMENT_NAMES,
        }
    )
    return (
        named.withColumns(
            {
                "total_payment_received": s.booked_payment(
                    F.col("total_principal_received"),
                    F.col("total_interest_received"),
                    F.col("total_late_fee_received"),
                    F.col("total_payment_received"),
                ).cast(schemas.TOTAL),
                "delinq_2yrs": s.whole_or_zero(F.col("delinq_2yrs")),
                "pub_rec": s.whole_or_zero(F.col("pub_rec")),
                "pub_rec_bankruptcies": s.whole_or_zero(F.col("pub_rec_bankruptcies")),
                "inq_last_6mths": s.whole_or_zero(F.col("inq_last_6mths")),
                "annual_income": F.col("annual_income").try_cast(schemas.MONEY),
            }
        )
        .withColumns(
            {
                "is_customer": F.col("annual_income").isNotNull(),
                "is_loan": s.all_present(*[F.col(c) for c in schemas.LOAN_REQUIRED]),
                "is_repayment": s.all_present(
                    *[F.col(c) for c in schemas.REPAYMENT_REQUIRED]
                )
                & F.coalesce(F.col("total_payment_received") != 0, F.lit(False)),
                "is_delinquent": s.any_positive(
                    F.col("delinq_2yrs"), F.col("mths_since_last_delinq")
                ),
            }
        )
    )


def _with_flags(
    keyed: DataFrame, flags: tuple[str, ...], *columns: Column | str
) -> DataFrame:
    """Columns of the rows with all flags set."""
    is_kept = reduce(Column.__and__, [F.col(flag) for flag in flags])
    return cleaned_rows(keyed).filter(is_kept).select("member_id", *columns)


def _kept_rows(
    keyed: DataFrame, flags: tuple[str, ...], *columns: Column | str
) -> DataFrame:
    """Columns of the rows with all flags set, of borrowers with a single raw
    row. Rows without the flags count as rows of the borrower too."""
    return quarantine.exclude_members(
        _with_flags(keyed, flags, *columns), quarantine_list(keyed)
    )


def _named(columns: dict[str, Column]) -> list[Column]:
    return [value.alias(name) for name, value in columns.items()]


# The tables that must keep a row for each kind of points.
PAYMENT = ("is_loan", "is_repayment")
DEFAULT = ("is_delinquent",)
FINANCIAL = ("is_loan", "is_customer")
SCORED = ("is_loan", "is_repayment", "is_delinquent", "is_customer")


def quarantine_list(keyed: DataFrame) -> DataFrame:
    return quarantine.duplicated_members(keyed)


def payment_points(keyed: DataFrame) -> DataFrame:
    return _kept_rows(keyed, PAYMENT, "loan_id", *scoring.payment_point_columns())


def default_points(keyed: DataFrame) -> DataFrame:
    return _kept_rows(keyed, DEFAULT, *scoring.default_point_columns())


def financial_points(keyed: DataFrame) -> DataFrame:
    return _kept_rows(
        keyed, FINANCIAL, "loan_id", *scoring.financial_point_columns()
    )


def ledger(keyed: DataFrame) -> DataFrame:
    """The same as ``scoring.ledger``: what is known of each loan that can be
    scored, apart from its payments."""
    points = [*scoring.default_point_columns(), *scoring.financial_point_columns()]
    kept = ("loan_id", "funded_amount", "monthly_installment")
    return _kept_rows(keyed, ("is_loan", *DEFAULT, "is_customer"), *kept, *points)


Cut = Callable[[DataFrame], DataFrame]


def _no_cut(rows: DataFrame) -> DataFrame:
    return rows


def scores(
    keyed: DataFrame, *keep: str, rules: Rules = RULES, cut: Cut = _no_cut
) -> DataFrame:
    """Scores and grades; ``keep`` names cleaned columns to carry along.

    Long texts become points before rows move. ``cut`` may store the rows that
    are to be scored, a few numbers each: where the raw table is derived by long
    expressions, these and the points would be too much generated code for one
    method, which is then not compiled.
    """
    status, home, grade = scoring.text_point_columns(rules)
    carried = [c for c in ("grade", "sub_grade") if c not in keep]
    kept = _kept_rows(
        keyed, SCORED, "loan_id", *keep, *scoring.NUMBERS, *carried, status, home
    )
    points = cut(kept).select(
        "*",
        grade,
        *scoring.payment_point_columns(rules),
        *scoring.default_point_columns(rules),
        *scoring.limit_point_columns(rules),
    )
    return scoring.weighted_scores(points, *keep, rules=rules)


def scored_rows(keyed: DataFrame) -> DataFrame:
    """Every raw row's borrower, whether its tables would all keep the row, and
    its score columns; quarantined borrowers' too. A narrow job, so a stream of
    raw rows can take it."""
    rows = cleaned_rows(keyed)
    is_scored = reduce(Column.__and__, [F.col(flag) for flag in SCORED])
    points = rows.select(
        "loan_id",
        "member_id",
        is_scored.alias("is_scored"),
        *scoring.payment_point_columns(),
        *scoring.default_point_columns(),
        *scoring.financial_point_columns(),
    )
    return scoring.weighted_scores(points, "is_scored")


def hundred_payment(keyed: DataFrame, profile: str = "numeric") -> DataFrame:
    """Points of all loans with repayments, quarantined borrowers' too."""
    return _with_flags(
        keyed, PAYMENT, "loan_id", *_named(hundred.payment_columns(profile))
    )


def hundred_defaulters(keyed: DataFrame) -> DataFrame:
    return _kept_rows(keyed, DEFAULT, *_named(hundred.default_columns()))


def hundred_financial(keyed: DataFrame, profile: str = "numeric") -> DataFrame:
    return _kept_rows(
        keyed, FINANCIAL, "loan_id", *_named(hundred.financial_columns(profile))
    )


def hundred_scores(
    keyed: DataFrame, profile: str = "numeric", cut: Cut = _no_cut
) -> DataFrame:
    """Scores and grades of the 20-100 rules; ``cut`` as in ``scores``."""
    kept = _kept_rows(
        keyed, SCORED, "loan_id", *scoring.NUMBERS, *_named(hundred.text_columns())
    )
    points = cut(kept).withColumns(
        {
            **hundred.payment_columns(profile),
            **hundred.default_columns(),
            **hundred.limit_columns(profile),
        }
    )
    names = [name for group in hundred.POINT_COLUMNS.values() for name in group]
    return hundred.weighted_scores(points.select("loan_id", "member_id", *names))


Stage = Callable[[DataFrame, str], DataFrame]


def _no_stage(rows: DataFrame, name: str) -> DataFrame:
    return rows


def wide_rows(keyed: DataFrame, state_mode: str = "length", stage: Stage = _no_stage) -> DataFrame:
    """Every loan whose borrower is a customer, once, in a wide row; and one row
    without a loan for a customer who has none that is complete.

    The records of a quarantined borrower disagree, so the columns that they
    disagree in are NULL there; the loan's own columns are not. Where a key
    stands for several sets of attributes, so are the attributes that differ.
    Rows that are marked as their borrower's only one do not move. ``stage`` may
    store the short lists of borrowers that others than they meet: where such a
    list's size is known before the rows are read, these stay as well.
    """
    everyone = cleaning.unique_customers(ingest.split_customers(keyed))
    mean = cleaning.mean_emp_length(everyone)
    cleaned = {
        "emp_length": F.coalesce(s.digits_to_int(F.col("emp_length")), mean),
        "address_state": s.state_code(F.col("address_state"), state_mode),
        "address_country": F.lit(fixed.COUNTRY),
        "total_high_credit_limit": F.col("total_high_credit_limit").try_cast(schemas.MONEY),
        "join_annual_income": F.col("join_annual_income").try_cast(schemas.MONEY),
        "loan_term_years": s.term_years(F.col("loan_term_months")),
        "interest_rate": s.percent_to_number(F.col("interest_rate")),
        "loan_purpose": s.purpose_bucket(F.col("loan_purpose")),
        "last_payment_date": s.date_or_null(F.col("last_payment_date")),
        "next_payment_date": s.date_or_null(F.col("next_payment_date")),
        "mths_since_last_delinq": F.col("mths_since_last_delinq").try_cast("int"),
    }

    def value(name: str) -> Column:
        return cleaned[name] if name in cleaned else F.col(name)

    def where(condition: Column, value: Column, name: str) -> Column:
        return F.when(condition, value).alias(name)

    alone, rows = ingest.parted(cleaned_rows(keyed).filter("is_customer"))
    attributes = s.row_hash(*[value(c) for c in serving.SHARED])
    counts = rows.groupBy("member_id").agg(
        F.count("*").alias("total"),
        F.count_if("is_loan").alias("n_loans"),
        (F.min(attributes) < F.max(attributes)).alias("collides"),
    )
    # Marked borrowers have several rows, nearly all of them with a loan. The list
    # has those who are different.
    others = stage(counts.filter("total = 1 or n_loans = 0 or collides"), "others")
    # Attributes are compared one by one only for keys that stand for several
    # sets of them: hardly any, and then the rows are not read again.
    colliding = others.filter("collides").select("member_id")
    sets = rows.join(colliding, "member_id", "left_semi").select(
        "member_id", *_named({c: value(c) for c in serving.SHARED})
    )
    differ = stage(sets.groupBy("member_id").agg(*serving.differing(serving.SHARED)), "differ")
    loan, payment = F.col("is_loan"), F.col("is_loan") & F.col("is_repayment")
    single = ~F.col("is_quarantined")

    def own(name: str) -> Column:
        if name in serving.CONFLICTING:
            return where(single, value(name), name)
        # Nothing is said of keys that do not collide.
        return F.when(F.col(f"differ_{name}"), F.lit(None)).otherwise(value(name)).alias(name)

    marked = (
        rows.join(others.drop("collides"), "member_id", "left")
        .withColumn("is_quarantined", F.coalesce(F.col("total") > 1, F.lit(True)))
        .join(differ, "member_id", "left")
    )
    wide = (
        where(loan, F.col("loan_id"), "loan_id"),
        "member_id",
        *[own(c) for c in serving.CUSTOMER_COLUMNS],
        *[where(loan, value(c), c) for c in serving.LOAN_COLUMNS],
        *[where(payment, value(c), c) for c in serving.REPAYMENT_COLUMNS],
        *[where(single & F.col("is_delinquent"), value(c), c) for c in serving.DELINQUENCY_COLUMNS],
        *[where(single, F.col(c), c) for c in serving.DETAIL_COLUMNS],
        "is_quarantined",
    )
    with_loans = marked.filter(single | loan).select(*wide)
    # The rows of such a borrower agree in all that is left of them.
    without = marked.filter("is_quarantined and n_loans = 0").select(*wide).distinct()
    whole = with_loans.unionByName(without)
    if alone is None:
        return whole
    nothing = {f"differ_{c}": F.lit(False) for c in serving.SHARED}
    return alone.withColumns({"is_quarantined": F.lit(False), **nothing}).select(*wide).unionByName(whole)
