import random

import pytest

from loanmill.operators import quarantine


def members(spark, *ids):
    return spark.createDataFrame([(m, i) for i, m in enumerate(ids)], "member_id string, n int")


def ids(df):
    return sorted(r.member_id for r in df.collect())


def test_duplicated(spark):
    assert ids(quarantine.duplicated_members(members(spark, "a", "b", "a", "c"))) == ["a"]


def test_list_is_the_distinct_union(spark):
    found = quarantine.quarantine_list(
        members(spark, "a", "a", "b", "c"),
        members(spark, "a", "a", "b", "b"),
        members(spark, "c", "d"),
    )
    # c has one row in each of two tables, which is no conflict.
    assert ids(found) == ["a", "b"]


def test_list_of_one_table(spark):
    assert ids(quarantine.quarantine_list(members(spark, "a", "a", "b"))) == ["a"]


def test_exclude(spark):
    kept = quarantine.exclude_members(
        members(spark, "a", "b", "b", "c"), members(spark, "b", "x", "b")
    )
    assert ids(kept) == ["a", "c"]
    nothing = spark.createDataFrame([], "member_id string")
    assert ids(quarantine.exclude_members(members(spark, "a"), nothing)) == ["a"]


def test_null_on_the_list_excludes_nothing_else(spark):
    """Unlike NOT IN, a NULL on the list does not empty the table."""
    listed = spark.createDataFrame([(None,), ("b",)], "member_id string")
    assert ids(quarantine.exclude_members(members(spark, "a", "b"), listed)) == ["a"]


def test_single_rows_keep_nulls_and_types(spark):
    table = spark.createDataFrame(
        [("a", None, True, "x"), ("b", 1, None, None), ("b", 2, False, "y")],
        "member_id string, n int, flag boolean, text string",
    )
    kept = quarantine.single_rows(table)
    assert kept.schema.simpleString() == table.schema.simpleString()
    assert [tuple(r) for r in kept.collect()] == [("a", None, True, "x")]


@pytest.mark.parametrize("seed", range(3))
def test_single_rows_equal_list_and_anti_join(spark, seed):
    """A third of all rows are one borrower's."""
    pick = random.Random(seed)
    rows = ["hot"] * 300 + [f"m{pick.randrange(500)}" for _ in range(600)]
    table = members(spark, *rows)
    by_list = quarantine.exclude_members(table, quarantine.quarantine_list(table))
    want = sorted(tuple(r) for r in by_list.collect())
    assert sorted(tuple(r) for r in quarantine.single_rows(table).collect()) == want
    assert want == sorted((m, i) for i, m in enumerate(rows) if rows.count(m) == 1)
