"""Write, audit, publish: a table moves on to a new version only if it is sound.

A version is written to a folder of its own. Null and range checks are observed
while its rows are written, so neither they nor what they come from are read for
it again; unique checks need all values of a column side by side and read that
one column of the files. The table's name is a view on a version: it moves when
the checks are within their limits, else what was published stays as it is.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, Row, SparkSession

from loanmill.operators import quality
from loanmill.sources import catalog, writers


class QualityError(Exception):
    """Checks over their limits, which stopped a job."""

    def __init__(self, name: str, failed: list[Row]) -> None:
        self.name, self.failed = name, failed
        told = ", ".join(f"{r.check_name} of {r.column_name}: {r.n_hits} of {r.n_rows} rows" for r in failed)
        super().__init__(f"{name} failed its checks: {told}")


def write_observed(df: DataFrame, path: str, checks: Mapping) -> list[Row]:
    """Write the rows as Parquet and return their quality report, a row for
    each check, as ``quality.check_data_quality`` gives it."""
    observed = {k: v for k, v in checks.items() if k != "unique_checks"}
    unique = {k: v for k, v in checks.items() if k == "unique_checks"}
    seen = Observation()
    writers.write_parquet(df.observe(seen, *quality.observed_hits(observed)), path)
    report = quality.observed_report(observed, seen.get)
    if unique:
        stored = df.sparkSession.read.schema(df.schema).parquet(path)
        report += quality.check_data_quality(stored, unique).collect()
    return report


def audit(name: str, report: list[Row], fail_on: Mapping[str, float]) -> None:
    """Stop if a check of the report is over the limit set for its kind."""
    unknown = set(fail_on) - set(quality.CHECKS)
    if unknown:
        raise ValueError(f"unknown checks {sorted(unknown)}")
    failed = [r for r in report if r.check_name in fail_on and quality.badness(r) > fail_on[r.check_name]]
    if failed:
        raise QualityError(name, failed)


def publish(spark: SparkSession, database: str, table: str, path: str) -> None:
    """Let the table's name stand for the version at the path."""
    catalog.create_view(spark, database, table, f"SELECT * FROM parquet.{catalog.quoted(path)}")


def write_audit_publish(
    df: DataFrame,
    database: str,
    table: str,
    folder: str,
    version: str,
    checks: Mapping,
    fail_on: Mapping[str, float],
) -> list[Row]:
    """Write a version of a table and publish it if it passes its checks.

    A version that fails stays in its folder to be looked at and raises
    ``QualityError``; readers go on with the one before.
    """
    path = f"{folder}/{table}/{version}"
    report = write_observed(df, path, checks)
    audit(table, report, fail_on)
    publish(df.sparkSession, database, table, path)
    return report
