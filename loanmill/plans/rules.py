"""The 0-800 rules as SQL with named parameters.

The rule set is no part of the text: points, cut-offs and weights are arguments
that ``spark.sql`` binds as literals, so one text serves every rule set, and a rule
set can come from anywhere without being pasted into SQL.
"""

from __future__ import annotations

from dataclasses import fields
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from loanmill.functions import fixed
from loanmill.functions.points import RULES, Rules
from loanmill.plans.pipeline import CleanTables
from loanmill.sources import readers

_VIEWS = ("loans", "loans_repayments", "customers", "loans_defaulters_delinq", "loans_defaulters_detail_rec_enq")


def _counted(column: str, many: str) -> str:
    return (
        f"CASE WHEN {column} > 5 OR {column} IS NULL THEN :{many} WHEN {column} >= 3 THEN :very_bad "
        f"WHEN {column} >= 1 THEN :bad WHEN {column} = 0 THEN :excellent END"
    )


_GRADES = " ".join(
    f"WHEN '{grade}' THEN :{rating}"
    for grade, rating in zip("ABCDE", ("excellent", "very_good", "good", "bad", "very_bad"), strict=True)
)
_SHARES = " ".join(f"WHEN '{step}' THEN :share_{step}" for step in fixed.SUB_GRADE_SHARES)

SCORE_QUERY = f"""
WITH points AS (
  SELECT loan_id, l.member_id,
    CASE WHEN last_payment_amount < monthly_installment THEN :very_bad
      WHEN last_payment_amount = monthly_installment THEN :good
      WHEN last_payment_amount <= monthly_installment * 1.5 THEN :very_good
      WHEN last_payment_amount > monthly_installment THEN :excellent ELSE :unacceptable END AS last_payment,
    CASE WHEN total_payment_received >= funded_amount * 0.5 THEN :very_good
      WHEN total_payment_received < funded_amount * 0.5 AND total_payment_received > 0 THEN :good
      WHEN total_payment_received IS NULL OR total_payment_received = 0 THEN :unacceptable END AS total_payment,
    {_counted("delinq_2yrs", "cut_unacceptable")} AS delinq,
    {_counted("pub_rec", "very_bad")} AS records,
    {_counted("pub_rec_bankruptcies", "very_bad")} AS bankruptcies,
    {_counted("inq_last_6mths", "unacceptable")} AS enquiries,
    CASE WHEN contains(lower(loan_status), 'fully paid') THEN :excellent
      WHEN contains(lower(loan_status), 'current') THEN :good
      WHEN contains(lower(loan_status), 'in grace period') THEN :bad
      WHEN contains(lower(loan_status), 'late (16-30 days)') OR contains(lower(loan_status), 'late (31-120 days)')
        THEN :very_bad ELSE :unacceptable END AS status,
    CASE WHEN lower(home_ownership) LIKE '%own' THEN :excellent WHEN lower(home_ownership) LIKE '%rent' THEN :good
      WHEN lower(home_ownership) LIKE '%mortgage' THEN :bad
      WHEN home_ownership IS NULL OR lower(home_ownership) LIKE '%any' THEN :very_bad END AS home,
    CASE WHEN funded_amount <= total_high_credit_limit * 0.1 THEN :excellent
      WHEN funded_amount <= total_high_credit_limit * 0.2 THEN :very_good
      WHEN funded_amount <= total_high_credit_limit * 0.3 THEN :good
      WHEN funded_amount <= total_high_credit_limit * 0.5 THEN :bad
      WHEN funded_amount <= total_high_credit_limit * 0.7 THEN :very_bad ELSE :unacceptable END AS credit,
    CAST(CASE WHEN grade IN ('F', 'G') THEN :unacceptable
      WHEN left(sub_grade, 1) = grade AND length(sub_grade) = 2 THEN
        (CASE grade {_GRADES} END) * (CASE right(sub_grade, 1) {_SHARES} END) END AS decimal(12,4)) AS grade
  FROM loans l JOIN loans_repayments USING (loan_id)
  JOIN customers c ON c.member_id = l.member_id
  JOIN loans_defaulters_delinq d ON d.member_id = l.member_id
  JOIN loans_defaulters_detail_rec_enq e ON e.member_id = l.member_id
),
parts AS (
  SELECT loan_id, member_id,
    CAST((last_payment + total_payment) * :payment_history AS decimal(12,4)) AS payment_history_pts,
    CAST((delinq + records + bankruptcies + enquiries) * :defaulters_history AS decimal(12,4)) AS defaulters_history_pts,
    CAST((status + home + credit + grade) * :financial_health AS decimal(12,4)) AS financial_health_pts
  FROM points
),
totals AS (
  SELECT *, CAST(payment_history_pts + defaulters_history_pts + financial_health_pts AS decimal(12,4)) AS loan_score
  FROM parts
)
SELECT *, CASE WHEN loan_score > :cut_very_good THEN 'A' WHEN loan_score > :cut_good THEN 'B'
  WHEN loan_score > :cut_bad THEN 'C' WHEN loan_score > :cut_very_bad THEN 'D'
  WHEN loan_score > :cut_unacceptable THEN 'E' WHEN loan_score <= :cut_unacceptable THEN 'F' END AS loan_final_grade
FROM totals"""


def arguments(rules: Rules = RULES) -> dict[str, int | Decimal]:
    """The parameters of ``SCORE_QUERY`` for a rule set."""
    named = {f.name: getattr(rules.points, f.name) for f in fields(rules.points)}
    named |= {f"cut_{f.name}": getattr(rules.cutoffs, f.name) for f in fields(rules.cutoffs)}
    named |= {f.name: getattr(rules.weights, f.name) for f in fields(rules.weights)}
    return named | {f"share_{step}": share for step, share in fixed.SUB_GRADE_SHARES.items()}


def scores(spark: SparkSession, kept: CleanTables, rules: Rules = RULES) -> DataFrame:
    """Scores by SQL of the cleaned tables without quarantined borrowers."""
    tables = kept.by_name()
    readers.register_views({name: tables[name] for name in _VIEWS})
    return spark.sql(SCORE_QUERY, args=arguments(rules))
