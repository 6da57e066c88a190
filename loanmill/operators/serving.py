"""Wide customer-loan rows for serving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The wide rows' columns.
CUSTOMER_COLUMNS = (
    "emp_title",
    "emp_length",
    "home_ownership",
    "annual_income",
    "address_state",
    "address_zipcode",
    "address_country",
    "grade",
    "sub_grade",
    "verification_status",
    "total_high_credit_limit",
    "application_type",
    "join_annual_income",
    "verification_status_joint",
)
LOAN_COLUMNS = (
    "loan_amount",
    "funded_amount",
    "loan_term_years",
    "interest_rate",
    "monthly_installment",
    "issue_date",
    "loan_status",
    "loan_purpose",
)
REPAYMENT_COLUMNS = (
    "total_principal_received",
    "total_interest_received",
    "total_late_fee_received",
    "last_payment_date",
    "next_payment_date",
)
DELINQUENCY_COLUMNS = ("delinq_2yrs", "delinq_amnt", "mths_since_last_delinq")
DETAIL_COLUMNS = ("pub_rec", "pub_rec_bankruptcies", "inq_last_6mths")
# What the rows of one borrower may disagree in although their key is the same.
CONFLICTING = (
    "total_high_credit_limit",
    "application_type",
    "join_annual_income",
    "verification_status_joint",
)
# The key is made of these. Texts of several sets of them can be the same, since
# a missing attribute leaves no mark in it.
SHARED = tuple(c for c in CUSTOMER_COLUMNS if c not in CONFLICTING)
WIDE_COLUMNS = (
    "loan_id",
    "member_id",
    *CUSTOMER_COLUMNS,
    *LOAN_COLUMNS,
    *REPAYMENT_COLUMNS,
    *DELINQUENCY_COLUMNS,
    *DETAIL_COLUMNS,
    "is_quarantined",
)


def differing(columns: tuple[str, ...]) -> list[Column]:
    """For each column whether the rows of a group differ in it, named after it;
    a NULL agrees with NULLs only. Values are compared by 64-bit hashes, which
    aggregate in place where texts would be sorted."""
    return [
        (F.min(F.xxhash64(c)) < F.max(F.xxhash64(c))).alias(f"differ_{c}") for c in columns
    ]


def _folded(customers: DataFrame) -> DataFrame:
    """One row for each quarantined borrower, with what its rows agree in."""
    sets = customers.filter("is_quarantined").select("member_id", *SHARED).distinct()
    differ = sets.groupBy("member_id").agg(*differing(SHARED))
    agreed = [F.when(~F.col(f"differ_{c}"), F.col(c)).alias(c) for c in SHARED]
    return sets.join(differ, "member_id").select("member_id", *agreed).distinct()


def wide_customer_loans(
    customers: DataFrame,
    loans: DataFrame,
    repayments: DataFrame,
    delinquencies: DataFrame,
    detail: DataFrame,
) -> DataFrame:
    """Customers with their loans, repayments, delinquency and record counts.

    Left joins throughout over the cleaned tables, whose member tables have
    ``is_quarantined``. Every loan comes out once: a quarantined borrower's
    customer rows are folded to what they agree in (several people may have one
    key), and the tables that they disagree in do not meet them. Loans meet repayments before customers, so
    the joins on the borrower share one partitioning.
    """
    types = dict(customers.dtypes)
    single = customers.filter(~F.col("is_quarantined"))
    unknown = {c: F.lit(None).cast(types[c]) for c in CONFLICTING}
    folded = _folded(customers).withColumns({"is_quarantined": F.lit(True), **unknown})
    people = single.select("member_id", "is_quarantined", *CUSTOMER_COLUMNS).unionByName(folded)
    ledger = loans.select("member_id", "loan_id", *LOAN_COLUMNS).join(
        repayments.select("loan_id", *REPAYMENT_COLUMNS), "loan_id", "left"
    )

    def known(table: DataFrame, columns: tuple[str, ...]) -> DataFrame:
        return table.filter(~F.col("is_quarantined")).select("member_id", *columns)

    return (
        people.join(known(delinquencies, DELINQUENCY_COLUMNS), "member_id", "left")
        .join(known(detail, DETAIL_COLUMNS), "member_id", "left")
        .join(ledger, "member_id", "left")
        .select(*WIDE_COLUMNS)
    )


def wide_view_query(
    customers: str, loans: str, repayments: str, delinquencies: str, detail: str
) -> str:
    """The same rows as the text of a view over catalog tables; here too loans
    meet repayments first."""

    def listed(alias: str, columns: tuple[str, ...]) -> str:
        return ", ".join(f"{alias}.{column}" for column in columns)

    same = ", ".join(f"min(xxhash64({c})) = max(xxhash64({c})) AS same_{c}" for c in SHARED)
    sets = f"(SELECT DISTINCT member_id, {', '.join(SHARED)} FROM {customers} WHERE is_quarantined)"
    folded = ", ".join(
        f"NULL AS {c}" if c in CONFLICTING else f"CASE WHEN same_{c} THEN {c} END AS {c}"
        for c in CUSTOMER_COLUMNS
    )
    return (
        f"SELECT l.loan_id, c.member_id, {listed('c', CUSTOMER_COLUMNS)}, "
        f"{listed('l', LOAN_COLUMNS)}, {listed('r', REPAYMENT_COLUMNS)}, "
        f"{listed('d', DELINQUENCY_COLUMNS)}, {listed('e', DETAIL_COLUMNS)}, c.is_quarantined "
        f"FROM (SELECT member_id, is_quarantined, {', '.join(CUSTOMER_COLUMNS)} "
        f"FROM {customers} WHERE NOT is_quarantined UNION ALL "
        f"SELECT DISTINCT member_id, true AS is_quarantined, {folded} FROM {sets} s "
        f"JOIN (SELECT member_id, {same} FROM {sets} GROUP BY member_id) USING (member_id)) c "
        f"LEFT JOIN {delinquencies} d ON d.member_id = c.member_id AND NOT d.is_quarantined "
        f"LEFT JOIN {detail} e ON e.member_id = c.member_id AND NOT e.is_quarantined "
        f"LEFT JOIN ({loans} l LEFT JOIN {repayments} r ON r.loan_id = l.loan_id) "
        f"ON l.member_id = c.member_id"
    )
