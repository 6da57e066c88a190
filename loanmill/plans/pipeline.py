"""The job in stored stages: clean, quarantine, score, each written and re-read.

Every table is written once and later stages read it from there, so no stage
computes another one again and a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmill.functions import fixed
from loanmill.operators import cleaning, ingest, quarantine, reports, scoring
from loanmill.plans import publish as publishing
from loanmill.sources import catalog, readers, writers

COMPONENTS = ("payment_history", "defaulters_history", "financial_health")
MEMBER_TABLES = (
    "customers",
    "loans_defaulters_delinq",
    "loans_defaulters_detail_rec_enq",
)
QUARANTINED_TABLES = (*MEMBER_TABLES, "loans")
FINAL_LIST = "bad_customer_data_final"
CHECKS = {
    "customers": fixed.CUSTOMER_CHECKS,
    "loans": fixed.LOAN_CHECKS,
    "loans_repayments": fixed.REPAYMENT_CHECKS,
}


@dataclass(frozen=True)
class CleanTables:
    customers: DataFrame
    loans: DataFrame
    loans_repayments: DataFrame
    loans_defaulters_delinq: DataFrame
    loans_defaulters_detail_rec_enq: DataFrame

    def by_name(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def _stored(df: DataFrame, path: str) -> DataFrame:
    writers.write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_keyed(keyed: DataFrame, folder: str) -> DataFrame:
    """Store the raw table with keys, marked by ``ingest.with_repeats``: of what
    is made of it, only the rows of borrowers that may repeat have to move. A table
    that has a mark is stored as it is."""
    if ingest.mark(keyed):
        return _stored(keyed, f"{folder}/raw_keyed")
    hashes = _stored(ingest.repeated_hashes(keyed), f"{folder}/repeated_hashes")
    return _stored(ingest.with_repeats(keyed, hashes), f"{folder}/raw_keyed")


def split_to_csv(keyed: DataFrame, folder: str, single_file: bool = False) -> None:
    """Export the four entity tables as CSV with a header."""
    for name, table in ingest.split(keyed).items():
        writers.write_csv(table, f"{folder}/{name}_data", single_file)


def clean_tables(
    split: dict[str, DataFrame], at: datetime | None = None, state_mode: str = "length"
) -> CleanTables:
    """The five cleaned tables from the four splits, lazily."""
    defaulters = cleaning.clean_defaulters(split["defaulters"])
    return CleanTables(
        cleaning.clean_customers(split["customers"], at, state_mode),
        cleaning.clean_loans(split["loans"], at),
        cleaning.clean_repayments(split["repayments"], at),
        cleaning.delinquencies(defaulters),
        cleaning.detail_records(defaulters),
    )


def store_bad_members(tables: CleanTables, folder: str) -> DataFrame:
    """Store who is repeated in which member table, and the lists made of it:
    one for each table and the final one, as Parquet and as CSV."""
    named = tables.by_name()
    repeated = _stored(
        quarantine.repeated_in(**{name: named[name] for name in MEMBER_TABLES}),
        f"{folder}/repeated_members",
    )
    lists = {f"bad_{name}": repeated.filter(name) for name in MEMBER_TABLES}
    lists[FINAL_LIST] = repeated
    for name, members in lists.items():
        members = members.select("member_id")
        writers.write_parquet(members, f"{folder}/{name}")
        writers.write_csv(members, f"{folder}/{name}_csv", compressed=True)
    return readers.read_parquet(repeated.sparkSession, f"{folder}/{FINAL_LIST}")


def clean_all_data(
    split: dict[str, DataFrame],
    folder: str,
    at: datetime | None = None,
    state_mode: str = "length",
    csv: bool = False,
    fail_on: Mapping[str, float] | None = None,
) -> CleanTables:
    """Clean the splits and store them as Parquet, and as CSV if asked to.

    Tables with a borrower get ``is_quarantined`` as they are written, so the
    quarantine is a filter and not a second copy. Where the splits have
    ``is_repeated`` that is it, no row meets a list, and the lists are made of the
    stored tables. CSV files, which are compressed, are written from
    the stored Parquet, not computed a second time. With ``fail_on`` the tables
    that have checks are observed as they are written; all are written before
    one over its limits raises ``publish.QualityError``.
    """
    named = clean_tables(split, at, state_mode).by_name()
    is_known = all(ingest.REPEATED in named[name].columns for name in QUARANTINED_TABLES)
    lists = f"{folder}/bad_members"
    bad = None if is_known else store_bad_members(CleanTables(**named), lists)
    for name in QUARANTINED_TABLES:
        if is_known:
            columns = [c for c in named[name].columns if c not in ingest.mark(named[name])]
            named[name] = named[name].select(*columns, F.col(ingest.REPEATED).alias("is_quarantined"))
        else:
            named[name] = quarantine.flag_members(named[name], bad)
    audits = {}
    for name, df in named.items():
        path = f"{folder}/{name}_parquet"
        if fail_on is not None and name in CHECKS:
            audits[name] = publishing.write_observed(df, path, CHECKS[name])
        else:
            writers.write_parquet(df, path)
        named[name] = df.sparkSession.read.schema(df.schema).parquet(path)
    stored = CleanTables(**named)
    if is_known:
        marked = {n: t.withColumnRenamed("is_quarantined", ingest.REPEATED) for n, t in named.items()}
        store_bad_members(CleanTables(**marked), lists)
    for name, report in audits.items():
        publishing.audit(name, report, fail_on)
    _stored(
        cleaning.credit_issue_members(cleaning.clean_defaulters(split["defaulters"])),
        f"{folder}/loans_defaulters_records_enq_parquet",
    )
    if csv:
        for name, table in stored.by_name().items():
            writers.write_csv(table, f"{folder}/{name}_csv", compressed=True)
    return stored


def without_quarantined(tables: CleanTables) -> CleanTables:
    """The cleaned tables without the borrowers that are quarantined.

    Loans are filtered too: whatever joins them later is then free of the
    borrowers that have very many.
    """
    named = tables.by_name()
    for name in QUARANTINED_TABLES:
        named[name] = named[name].filter("not is_quarantined").drop("is_quarantined")
    return CleanTables(**named)


def load_clean(spark: SparkSession, folder: str) -> CleanTables:
    """The cleaned tables that ``run`` stored."""
    names = [f.name for f in fields(CleanTables)]
    return CleanTables(
        **{n: readers.read_parquet(spark, f"{folder}/cleaned/{n}_parquet") for n in names}
    )


def publish(database: str, tables: CleanTables, folder: str) -> None:
    """External tables over what ``clean_all_data`` wrote, and the same without
    quarantined borrowers as views, named ``_new``."""
    spark = tables.customers.sparkSession
    for name, table in tables.by_name().items():
        catalog.create_external_table(
            spark,
            database,
            name,
            f"{folder}/{name}_parquet",
            catalog.column_ddl(table),
        )
    for name in QUARANTINED_TABLES:
        columns = [c for c in tables.by_name()[name].columns if c != "is_quarantined"]
        catalog.create_view(
            spark,
            database,
            f"{name}_new",
            f"SELECT {', '.join(map(catalog.quoted, columns))} "
            f"FROM {catalog.quoted(database, name)} WHERE NOT is_quarantined",
        )


def component(tables: CleanTables, name: str) -> DataFrame:
    """One score component on its own."""
    if name == "payment_history":
        return scoring.payment_points(tables.loans_repayments, tables.loans)
    if name == "defaulters_history":
        return scoring.default_points(
            tables.loans_defaulters_detail_rec_enq, tables.loans_defaulters_delinq
        )
    if name == "financial_health":
        return scoring.financial_points(tables.loans, tables.customers)
    raise ValueError(f"unknown component {name!r}, use one of {COMPONENTS}")


def score_all(kept: CleanTables, *keep: str) -> DataFrame:
    """Scores from the stored tables without quarantined borrowers."""
    return scoring.score_tables(
        kept.loans,
        kept.loans_repayments,
        kept.customers,
        kept.loans_defaulters_delinq,
        kept.loans_defaulters_detail_rec_enq,
        *keep,
    )


def daily_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The score rows that runs have stored, a partition for each day."""
    return readers.read_parquet(spark, f"{folder}/loan_score/daily")


def monthly_partials(spark: SparkSession, folder: str) -> DataFrame:
    return readers.read_parquet(spark, f"{folder}/loan_score/monthly")


def add_monthly(spark: SparkSession, folder: str, day: date) -> None:
    """Add up one day's score rows and store their monthly partials.

    Only that day's partition is read; a day that is added again replaces its
    own partials. ``reports.monthly_from_partials`` merges the days, which is
    a few rows for each of them.
    """
    scores = daily_scores(spark, folder).filter(F.col("score_date") == F.lit(day))
    partials = reports.monthly_partials(scores.drop("score_date"))
    writers.write_dated(partials.coalesce(1), f"{folder}/loan_score/monthly", day)


def run(
    keyed: DataFrame,
    folder: str,
    day: date,
    run_id: str,
    at: datetime | None = None,
    fail_on: Mapping[str, float] | None = None,
) -> DataFrame:
    """Raw rows with keys in, one day's stored score rows out.

    ``fail_on`` gives a limit in percent to kinds of checks. A run whose cleaned
    tables are over one ends there, and the scores of earlier days stay.
    """
    # Stored first: all splits are then column-pruned scans of one table.
    keyed = store_keyed(keyed, folder)
    tables = clean_all_data(ingest.split(keyed), f"{folder}/cleaned", at, fail_on=fail_on)
    kept = without_quarantined(tables)
    scores = reports.full_score_rows(score_all(kept, "issue_date"), run_id, at)
    daily = f"{folder}/loan_score/daily"
    writers.write_dated(scores, daily, day)
    return readers.read_parquet(keyed.sparkSession, daily).filter(
        F.col("score_date") == F.lit(day)
    )
