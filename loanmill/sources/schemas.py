"""Declared schemas.

Money is decimal, so sums and comparisons are exact. ``as_float`` gives the
same schema with floats, for files that were written that way.
"""

from __future__ import annotations

from pyspark.sql import types as T

# No amount of a loan comes near this width, and totals over a loan's many
# payments have the same: a value is never lost for its size.
MONEY = TOTAL = T.DecimalType(28, 4)
_TEXT = T.StringType()
_COUNT = T.DoubleType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def as_float(schema: T.StructType) -> T.StructType:
    """The schema with floats for the decimals."""
    return T.StructType(
        [
            T.StructField(f.name, T.FloatType())
            if isinstance(f.dataType, T.DecimalType)
            else f
            for f in schema
        ]
    )


# The columns of the wide raw file that are used; a CSV scan with this schema
# needs no inference pass over the data.
RAW = _schema(
    ("id", _TEXT),
    ("emp_title", _TEXT),
    ("emp_length", _TEXT),
    ("home_ownership", _TEXT),
    ("annual_inc", T.DoubleType()),
    ("zip_code", _TEXT),
    ("addr_state", _TEXT),
    ("grade", _TEXT),
    ("sub_grade", _TEXT),
    ("verification_status", _TEXT),
    ("tot_hi_cred_lim", MONEY),
    ("application_type", _TEXT),
    ("annual_inc_joint", MONEY),
    ("verification_status_joint", _TEXT),
    ("loan_amnt", MONEY),
    ("funded_amnt", MONEY),
    ("term", _TEXT),
    ("int_rate", _TEXT),
    ("installment", MONEY),
    ("issue_d", _TEXT),
    ("loan_status", _TEXT),
    ("purpose", _TEXT),
    ("title", _TEXT),
    ("total_rec_prncp", TOTAL),
    ("total_rec_int", TOTAL),
    ("total_rec_late_fee", TOTAL),
    ("total_pymnt", TOTAL),
    ("last_pymnt_amnt", MONEY),
    ("last_pymnt_d", _TEXT),
    ("next_pymnt_d", _TEXT),
    ("delinq_2yrs", _TEXT),
    ("delinq_amnt", MONEY),
    ("pub_rec", _COUNT),
    ("pub_rec_bankruptcies", _COUNT),
    ("inq_last_6mths", _COUNT),
    ("mths_since_last_delinq", _COUNT),
    ("mths_since_last_record", _COUNT),
)

# The four tables that the raw file is split into, as they lie in files: a
# declared CSV schema binds by position and turns malformed values into NULL.
CUSTOMERS = _schema(
    ("member_id", _TEXT),
    ("emp_title", _TEXT),
    ("emp_length", _TEXT),
    ("home_ownership", _TEXT),
    ("annual_inc", MONEY),
    ("addr_state", _TEXT),
    ("zip_code", _TEXT),
    ("country", _TEXT),
    ("grade", _TEXT),
    ("sub_grade", _TEXT),
    ("verification_status", _TEXT),
    ("tot_hi_cred_lim", MONEY),
    ("application_type", _TEXT),
    ("annual_inc_joint", MONEY),
    ("verification_status_joint", _TEXT),
)
LOANS = _schema(
    ("loan_id", _TEXT),
    ("member_id", _TEXT),
    ("loan_amnt", MONEY),
    ("funded_amnt", MONEY),
    ("term", _TEXT),
    ("int_rate", _TEXT),
    ("installment", MONEY),
    ("issue_d", _TEXT),
    ("loan_status", _TEXT),
    ("purpose", _TEXT),
    ("title", _TEXT),
)
REPAYMENTS = _schema(
    ("loan_id", _TEXT),
    ("total_rec_prncp", TOTAL),
    ("total_rec_int", TOTAL),
    ("total_rec_late_fee", TOTAL),
    ("total_pymnt", TOTAL),
    ("last_pymnt_amnt", MONEY),
    ("last_pymnt_d", _TEXT),
    ("next_pymnt_d", _TEXT),
)
DEFAULTERS = _schema(
    ("member_id", _TEXT),
    ("delinq_2yrs", _TEXT),
    ("delinq_amnt", MONEY),
    ("pub_rec", _COUNT),
    ("pub_rec_bankruptcies", _COUNT),
    ("inq_last_6mths", _COUNT),
    ("total_rec_late_fee", TOTAL),
    ("mths_since_last_delinq", _COUNT),
    ("mths_since_last_record", _COUNT),
)
SPLITS = {
    "customers": CUSTOMERS,
    "loans": LOANS,
    "repayments": REPAYMENTS,
    "defaulters": DEFAULTERS,
}

# Column names of the cleaned tables where they differ from the files.
CUSTOMER_NAMES = {
    "annual_inc": "annual_income",
    "addr_state": "address_state",
    "zip_code": "address_zipcode",
    "country": "address_country",
    "tot_hi_cred_lim": "total_high_credit_limit",
    "annual_inc_joint": "join_annual_income",
}
LOAN_NAMES = {
    "loan_amnt": "loan_amount",
    "funded_amnt": "funded_amount",
    "term": "loan_term_months",
    "int_rate": "interest_rate",
    "installment": "monthly_installment",
    "issue_d": "issue_date",
    "purpose": "loan_purpose",
    "title": "loan_title",
}
REPAYMENT_NAMES = {
    "total_rec_prncp": "total_principal_received",
    "total_rec_int": "total_interest_received",
    "total_rec_late_fee": "total_late_fee_received",
    "total_pymnt": "total_payment_received",
    "last_pymnt_amnt": "last_payment_amount",
    "last_pymnt_d": "last_payment_date",
    "next_pymnt_d": "next_payment_date",
}

# Columns without which a row is of no use.
LOAN_REQUIRED = (
    "loan_amount",
    "funded_amount",
    "loan_term_months",
    "monthly_installment",
    "issue_date",
    "loan_status",
    "loan_purpose",
)
REPAYMENT_REQUIRED = (
    "total_principal_received",
    "total_interest_received",
    "total_late_fee_received",
    "total_payment_received",
    "last_payment_amount",
)
