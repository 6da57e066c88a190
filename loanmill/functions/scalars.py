"""Cleaning expressions.

All are built-in expressions, so they stay inside whole-stage codegen, and all
give the same result with ANSI mode on or off.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanmill.functions import fixed


def member_key(
    attributes: Sequence[str] = fixed.MEMBER_ATTRIBUTES, null_token: str | None = None
) -> Column:
    """SHA-256 over the borrower's attributes.

    ``concat_ws`` skips NULLs, so two borrowers that differ only in which
    attribute is missing can share a key; a ``null_token`` keeps them apart.
    """
    parts = [F.col(name).cast("string") for name in attributes]
    if null_token is not None:
        parts = [F.coalesce(part, F.lit(null_token)) for part in parts]
    return F.sha2(F.concat_ws(fixed.MEMBER_SEPARATOR, *parts), 256)


def digits_to_int(text: Column) -> Column:
    """The digits of a text as one integer, NULL where there are none."""
    return F.regexp_replace(text, r"\D", "").try_cast("int")


def term_years(term: Column) -> Column:
    """Years of a term that is written in months."""
    return digits_to_int(term).cast("double") / F.lit(12.0)


def percent_to_number(text: Column) -> Column:
    """'13.5%' as 13.5."""
    return F.trim(F.regexp_replace(text, "%", "")).try_cast("decimal(8,4)")


def state_code(state: Column, mode: str = "length") -> Column:
    """Replace what is no state code; 'length' keeps NULL, 'regex' does not."""
    if mode == "length":
        return F.when(F.length(state) > 2, fixed.UNKNOWN_STATE).otherwise(state)
    if mode == "regex":
        return F.when(state.rlike(fixed.STATE_PATTERN), state).otherwise(
            fixed.UNKNOWN_STATE
        )
    raise ValueError(f"unknown state mode {mode!r}")


def purpose_bucket(purpose: Column) -> Column:
    return F.when(purpose.isin(*fixed.PURPOSES), purpose).otherwise(
        fixed.OTHER_PURPOSE
    )


def date_or_null(date: Column) -> Column:
    """Dates are text here; '0.0' stands for a missing one."""
    return F.nullif(date, F.lit(fixed.MISSING_DATE))


def is_unbooked_payment(principal: Column, payment: Column) -> Column:
    """Principal came in although the total payment is zero."""
    return (principal != 0) & (payment == 0)


def booked_payment(
    principal: Column, interest: Column, late_fee: Column, payment: Column
) -> Column:
    """Total payment, summed up again where it was not booked."""
    return F.when(
        is_unbooked_payment(principal, payment), principal + interest + late_fee
    ).otherwise(payment)


def whole_or_zero(number: Column) -> Column:
    """A count that may be text or a float as an integer, 0 where it is none."""
    return F.coalesce(number.try_cast("double").try_cast("int"), F.lit(0))


def all_present(*columns: Column) -> Column:
    return reduce(lambda a, b: a & b, [column.isNotNull() for column in columns])


def any_positive(*columns: Column) -> Column:
    """True where one is positive, never NULL."""
    positive = reduce(lambda a, b: a | b, [column > 0 for column in columns])
    return F.coalesce(positive, F.lit(False))


def percentage(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator * 100, NULL for a zero denominator."""
    share = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return share * F.lit(100.0)


def threshold_points(value: Column, thresholds: Mapping[float, float]) -> Column:
    """Points of the highest threshold reached, else 0 (also for NULL)."""
    if not thresholds:
        return F.lit(0)
    descending = sorted(thresholds.items(), reverse=True)
    return first_match([(value >= low, pts) for low, pts in descending], default=0)


def mapped(value: Column, mapping: Mapping[str, str]) -> Column:
    """The mapped text where there is one, else the text itself."""
    return first_match([(value == old, new) for old, new in mapping.items()], value)


def first_match(cases: Sequence[tuple[Column, object]], default: object = None):
    """CASE over (condition, result) pairs; NULL where none holds."""
    (condition, result), *rest = cases
    chain = F.when(condition, result)
    for condition, result in rest:
        chain = chain.when(condition, result)
    return chain.otherwise(default)


def issue_month(date: Column) -> Column:
    """'Dec-2015' as '2015-12', NULL for other texts."""
    parsed = F.try_to_date(F.concat(F.lit("01-"), date), "dd-MMM-yyyy")
    return F.date_format(parsed, "yyyy-MM")


def row_hash(*columns: Column, seed: int = 0) -> Column:
    """A 64-bit hash of several values that tells where a NULL is; the built-in
    one leaves NULLs out, so that (a, NULL) and (NULL, a) are the same to it."""
    marked = [part for c in columns for part in (c.isNull(), c)]
    return F.xxhash64(F.lit(seed), *marked)
