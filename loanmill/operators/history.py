"""Scores over days: validity intervals, scores as of a day, and how grades move.

A day's rows are what a run of that day has stored, one for each loan. A score
holds from its day until the next run that gives the loan another one, or none.
Windows hold the days of one loan or the months of one grade.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DAY = "score_date"
VALUES = ("loan_score", "loan_final_grade")


def next_runs(daily: DataFrame, day: str = DAY) -> DataFrame:
    """Each day with a run, and ``next_run``: the day of the one after it, NULL
    for the last. One row a day, so the window over all days is short however
    many loans there are: a century has 36,525."""
    days = daily.select(day).distinct()
    return days.withColumn("next_run", F.lead(day).over(W.orderBy(day)))


def score_history(
    daily: DataFrame, values: tuple[str, ...] = VALUES, key: str = "loan_id", day: str = DAY
) -> DataFrame:
    """The key, its values, ``valid_from`` and ``valid_to`` (that day not
    included, NULL while it holds): a row for as long as they stay the same."""
    own = W.partitionBy(key).orderBy(day)
    known = F.struct(*values)
    steps = (
        daily.select(key, day, *values)
        .join(next_runs(daily, day), day)
        .withColumn("before", F.lag(F.struct("next_run", known.alias("known"))).over(own))
    )
    goes_on = (F.col("before.next_run") == F.col(day)) & F.col("before.known").eqNullSafe(known)
    numbered = steps.withColumn(
        "stretch", F.sum(F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).over(own)
    )
    return (
        numbered.groupBy(key, "stretch", *values)
        .agg(F.min(day).alias("valid_from"), F.max_by("next_run", day).alias("valid_to"))
        .drop("stretch")
    )


def holds(day: Column) -> Column:
    """Whether a row of the history holds on the day."""
    until = F.col("valid_to").isNull() | (day < F.col("valid_to"))
    return (F.col("valid_from") <= day) & until


def scores_on(history: DataFrame, day) -> DataFrame:
    """What holds on one day; days between two runs have the earlier one's."""
    return history.filter(holds(F.lit(day))).drop("valid_from", "valid_to")


def as_of(
    asked: DataFrame, history: DataFrame, key: str = "loan_id", day: str = "asked_on"
) -> DataFrame:
    """Every asked key and day with the values that held then, NULL if none did.

    A join on the key; its few intervals are then tried against the day.
    """
    known = history.withColumnRenamed(key, "_key")
    joined = asked.join(known, (F.col(key) == F.col("_key")) & holds(F.col(day)), "left")
    return joined.drop("_key", "valid_from", "valid_to")


def grade_migration(daily: DataFrame, grade: str = "loan_final_grade", day: str = DAY) -> DataFrame:
    """How many loans went from which grade to which from one month to the next.
    A loan counts in a month with its last row there; one that has no row in
    either month has no step. NULL is a grade here."""
    own = W.partitionBy("loan_id").orderBy(day)
    month = F.trunc(day, "month")
    last = daily.select(
        "loan_id", day, grade, month.alias("to_month"), F.lead(month).over(own).alias("next_month")
    ).filter("next_month is null or next_month <> to_month")
    steps = last.select(
        "to_month",
        F.lag("to_month").over(own).alias("from_month"),
        F.lag(grade).over(own).alias("from_grade"),
        F.col(grade).alias("to_grade"),
    )
    return (
        steps.filter("from_month = add_months(to_month, -1)")
        .groupBy("to_month", "from_grade", "to_grade")
        .agg(F.count("*").alias("n_loans"))
    )


def rolling_scores(monthly: DataFrame, months: int = 3) -> DataFrame:
    """Of monthly partials (``reports.monthly_partials``, merged) the mean score
    over a month and those before it, and the change of the number of loans on
    the month before; calendar months, so one that is missing counts as none."""
    number = F.expr(
        "12 * cast(substr(issue_month, 1, 4) as int) + cast(substr(issue_month, 6, 2) as int)"
    )
    own = W.partitionBy("loan_final_grade").orderBy("month_number")
    frame, before = own.rangeBetween(1 - months, 0), own.rangeBetween(-1, -1)
    total = F.sum("sum_score").over(frame).cast("double")
    scored = F.sum("n_scored").over(frame).cast("double")
    earlier = F.coalesce(F.sum("n_loans").over(before), F.lit(0))
    return monthly.withColumn("month_number", number).select(
        "issue_month",
        "loan_final_grade",
        "n_loans",
        (F.col("n_loans") - earlier).alias("n_more_loans"),
        F.try_divide(total, scored).alias("rolling_score"),
    )
