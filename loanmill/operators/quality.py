"""Data-quality checks.

All checks on a table are computed in one pass and come back as a long table:
one row per check and column with hits, total and percentage.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmill.functions import fixed

CHECKS = ("null_checks", "unique_checks", "range_checks")
_COUNT_NAMES = {
    "null_checks": ("null_count", "null_percentage"),
    "unique_checks": ("unique_count", "uniqueness_percentage"),
    "range_checks": ("out_of_range_count", "out_of_range_percentage"),
}


def _hits(checks: Mapping) -> list[tuple[str, str, Column]]:
    unknown = set(checks) - set(CHECKS)
    if unknown:
        raise ValueError(f"unknown checks {sorted(unknown)}")
    found = [
        ("null_checks", name, F.count_if(F.col(name).isNull()))
        for name in checks.get("null_checks", ())
    ]
    for name in checks.get("unique_checks", ()):
        # NULL counts as one value.
        some_null = F.coalesce(F.max(F.col(name).isNull().cast("int")), F.lit(0))
        found.append(("unique_checks", name, F.count_distinct(name) + some_null))
    for name, (low, high) in checks.get("range_checks", {}).items():
        outside = (F.col(name) < low) | (F.col(name) > high)
        found.append(("range_checks", name, F.count_if(outside)))
    return found


def check_data_quality(df: DataFrame, checks: Mapping) -> DataFrame:
    """(check_name, column_name, n_hits, n_rows, pct); 0 % for an empty table."""
    found = _hits(checks)
    counted = df.agg(
        F.count("*").alias("n_rows"),
        *[hits.cast("bigint").alias(f"hits_{i}") for i, (_, _, hits) in enumerate(found)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(check).alias("check_name"),
                F.lit(name).alias("column_name"),
                F.col(f"hits_{i}").alias("n_hits"),
            )
            for i, (check, name, _) in enumerate(found)
        ]
    )
    share = F.try_divide(F.col("n_hits").cast("double"), F.col("n_rows").cast("double"))
    return counted.select("n_rows", F.inline(rows)).select(
        "check_name",
        "column_name",
        "n_hits",
        "n_rows",
        F.coalesce(share * F.lit(100.0), F.lit(0.0)).alias("pct"),
    )


def observed_hits(checks: Mapping) -> list[Column]:
    """Columns for ``DataFrame.observe``: rows, and hits of null and range checks."""
    found = _hits(checks)
    return [
        F.count(F.lit(1)).alias("n_rows"),
        *[hits.cast("bigint").alias(f"hits_{i}") for i, (_, _, hits) in enumerate(found)],
    ]


def observed_report(checks: Mapping, seen: Mapping[str, int]) -> list[Row]:
    """The report's rows from what was observed."""
    n_rows = seen["n_rows"]
    return [
        Row(
            check_name=check,
            column_name=name,
            n_hits=seen[f"hits_{i}"],
            n_rows=n_rows,
            pct=100.0 * (seen[f"hits_{i}"] / n_rows) if n_rows else 0.0,
        )
        for i, (check, name, _) in enumerate(_hits(checks))
    ]


def badness(row: Row) -> float:
    """The percentage of a report's row that a limit is set on."""
    return 100.0 - row.pct if row.check_name == "unique_checks" and row.n_rows else row.pct


def validate_loan_data(df: DataFrame) -> DataFrame:
    return check_data_quality(df, fixed.LOAN_CHECKS)


def validate_customer_data(df: DataFrame) -> DataFrame:
    return check_data_quality(df, fixed.CUSTOMER_CHECKS)


def validate_repayment_data(df: DataFrame) -> DataFrame:
    return check_data_quality(df, fixed.REPAYMENT_CHECKS)


def quality_dict(report: DataFrame) -> dict[str, dict[str, dict[str, float]]]:
    """The report as nested dicts; it has one row per check, never more."""
    nested: dict = {}
    for row in report.collect():
        count_name, share_name = _COUNT_NAMES[row.check_name]
        nested.setdefault(row.check_name, {})[row.column_name] = {
            count_name: row.n_hits,
            "total_count": row.n_rows,
            share_name: row.pct,
        }
    return nested


def failed_checks(report: DataFrame, fail_on: Mapping[str, float]) -> DataFrame:
    """Checks whose percentage is over the limit set for their kind.

    For unique checks the limit is on the share of rows that repeat a value.
    """
    limits = [
        (F.col("check_name") == check) & (_badness() > limit)
        for check, limit in fail_on.items()
    ]
    failed = F.lit(False)
    for limit in limits:
        failed = failed | limit
    return report.filter(failed)


def _badness() -> Column:
    unique = F.col("check_name") == "unique_checks"
    return F.when(unique, F.lit(100.0) - F.col("pct")).otherwise(F.col("pct"))


def outliers(df: DataFrame, id_col: str, columns: list[str], z: float = 3.0):
    """Values more than ``z`` standard deviations from their column's mean.

    Means and deviations come from one aggregation, read as a scalar subquery.
    """
    values = [F.col(c).cast("double").alias(c) for c in columns]
    stats = df.select(*values).agg(
        F.struct(
            *[F.avg(c).alias(f"mean_{c}") for c in columns],
            *[F.stddev_samp(c).alias(f"sd_{c}") for c in columns],
        ).alias("stats")
    )
    rows = df.select(id_col, *values).withColumn("stats", stats.scalar())
    far = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(c).alias("value"),
            (
                F.abs(F.col(c) - F.col(f"stats.mean_{c}"))
                > F.lit(float(z)) * F.col(f"stats.sd_{c}")
            ).alias("is_far"),
        )
        for c in columns
    ]
    return (
        rows.select(id_col, F.inline(F.array(*far)))
        .filter("is_far")
        .select(id_col, "column_name", "value")
    )


def unparsed_values(texts: DataFrame, kinds: Mapping[str, T.DataType]) -> DataFrame:
    """Per column of text the values that its declared type cannot hold, and
    that a read with the type would turn into NULL."""
    lost = {
        name: F.count_if(F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull())
        for name, kind in kinds.items()
    }
    counts = texts.agg(*[count.alias(name) for name, count in lost.items()])
    return counts.unpivot([], list(kinds), "column_name", "n_unparsed")
