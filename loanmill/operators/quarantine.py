"""Borrowers with conflicting records.

A borrower should have one row in each of the three member tables. Those with
more are quarantined, that is left out of the member tables and of scoring.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmill.operators.ingest import mark, member_counts, parted


def duplicated_members(table: DataFrame) -> DataFrame:
    """Borrowers with more than one row in the table."""
    return member_counts(table).filter("total > 1").select("member_id")


def repeated_in(**tables: DataFrame) -> DataFrame:
    """Borrowers with more than one row in any of the tables, each once, and for
    each table whether it is that one.

    The tables' rows are counted together in one aggregation: one shuffle of
    partial counts instead of one per table and another for the distinct. Rows
    that are marked as their borrower's only one are not counted.
    """
    tagged = [
        parted(table)[1].select("member_id", *[F.lit(int(own == name)).alias(name) for name in tables])
        for own, table in tables.items()
    ]
    rows = reduce(DataFrame.unionByName, tagged)
    counts = rows.groupBy("member_id").agg(*[(F.sum(n) > 1).alias(n) for n in tables])
    return counts.filter(reduce(Column.__or__, [F.col(n) for n in tables]))


def quarantine_list(*tables: DataFrame) -> DataFrame:
    """Borrowers with more than one row in any of the tables, each once."""
    return repeated_in(**{f"in_table_{i}": t for i, t in enumerate(tables)}).select("member_id")


def flag_members(table: DataFrame, quarantined: DataFrame) -> DataFrame:
    """The rows with ``is_quarantined``: whether the borrower is on the list,
    which names each borrower once. Rows that are marked as their borrower's
    only one stay where they are; the mark is left out."""
    columns = [c for c in table.columns if c not in mark(table)]
    alone, several = parted(table)
    listed = quarantined.select("member_id", F.lit(True).alias("is_listed"))
    flagged = several.join(listed, "member_id", "left").select(
        *columns, F.coalesce("is_listed", F.lit(False)).alias("is_quarantined")
    )
    if alone is None:
        return flagged
    return alone.select(*columns, F.lit(False).alias("is_quarantined")).unionByName(flagged)


def exclude_members(table: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Rows whose borrower is not on the list.

    An anti join can shuffle, so the list may outgrow any broadcast. Read the
    list from a table: the adaptive skew join then splits a hot borrower's rows.
    Keys are never NULL here, so this equals NOT IN without its NULL trap. Rows
    that are marked as their borrower's only one stay where they are; the mark is
    left out.
    """
    alone, several = parted(table)
    kept = several.join(quarantined.select("member_id"), "member_id", "left_anti")
    return kept if alone is None else alone.unionByName(kept).drop(*mark(table))


def single_rows(keyed: DataFrame) -> DataFrame:
    """Rows of the borrowers that have exactly one row.

    When all member tables come from one raw table this is the quarantine: the
    detail table keeps every raw row, so a borrower is repeated in some table
    exactly if it has several raw rows. Only keys are counted; rows meet the
    list of repeated borrowers, which is far shorter than the table.
    """
    return exclude_members(keyed, duplicated_members(keyed))
