"""Every registered query against its SQL, and the plans they get."""

import re

import compare
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from loanmill.operators import ingest
from loanmill.plans import single_pass
from loanmill.sources import derived, writers

NAMES = sorted(queries())


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connection(sf_dir)


@pytest.fixture
def large_tables(spark):
    """Plans as for tables that are too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_its_sql():
    own = {n for n in NAMES if not re.match(r"op\d+_|pipeline$", n)}
    assert own == {n for n in oracle_sql() if not re.match(r"op\d+_|pipeline$", n)}


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, sf_dir, duck, name):
    assert compare.differences(queries()[name](spark, sf_dir), duck, oracle_sql()[name]) == []


def test_entry(spark):
    assert entry(spark).columns[-1] == "loan_final_grade"


# Queries whose result is a plain read of what they have written.
READ_BACK = {
    "loan_score_stored", "hundred_saved", "wide_table_catalog", "csv_roundtrip", "parquet_roundtrip",
    "stream_scores", "cleaned_csv", "external_loans", "bad_member_lists", "grade_slice",
}
JOBS = [n for n in NAMES if n not in READ_BACK and not re.match(r"op\d+_|pipeline$", n)]


@pytest.mark.parametrize("name", JOBS)
def test_no_python_no_cross_join_no_sort_aggregate(spark, sf_dir, name):
    """The default threshold: nothing is broadcast by a hint."""
    plan = plan_of(queries()[name](spark, sf_dir))
    for word in ("Python", "Arrow", "Cartesian", "NestedLoop", "SortAggregate"):
        assert word not in plan
    assert "ResolvedHint" not in plan


SINGLE_PASS = {
    "loan_score": single_pass.scores,
    "hundred_final": single_pass.hundred_scores,
    "detail_new": single_pass.detail_new,
}


@pytest.mark.parametrize("name", SINGLE_PASS)
def test_counts_are_narrow(spark, sf_dir, large_tables, name):
    """Borrowers are counted over one column; rows move once, to the list."""
    stored = writers.stage(ingest.with_member_id(derived.raw_loans(spark, sf_dir)), "narrow_keyed")
    plan = plan_of(SINGLE_PASS[name](stored))
    assert len(re.findall(r"Exchange hashpartitioning\(member_id", plan)) == 2
    assert "LeftAnti" in plan
    assert "ReadSchema: struct<member_id:string>" in plan


@pytest.mark.parametrize("name", ["payment_points", "detail_new", "customers_new"])
def test_raw_rows_are_not_copied(spark, sf_dir, large_tables, name):
    """From the order tables themselves: payments are read once, if at all, and
    the count of borrowers reads what their keys are made of."""
    plan = plan_of(queries()[name](spark, sf_dir))
    assert "LeftAnti" in plan and "raw_keyed" not in plan
    assert len(re.findall(r"ReadSchema: struct<[^>]*l_extendedprice", plan)) == (name == "payment_points")
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>", plan)


def test_payments_of_all_loans_move_nothing(spark, sf_dir, large_tables):
    plan = plan_of(queries()["hundred_payment"](spark, sf_dir))
    assert "hashpartitioning(member_id" not in plan


def test_buckets_need_no_shuffle_by_borrower(spark, sf_dir, large_tables):
    plan = plan_of(queries()["loan_score_bucketed"](spark, sf_dir))
    assert "Exchange hashpartitioning(member_id" not in plan
    assert len(re.findall(r"Exchange hashpartitioning\(loan_id", plan)) == 2


@pytest.mark.parametrize("name", ["member_key", "split_loans", "quarantine_list"])
def test_unused_tables_are_not_read(spark, sf_dir, large_tables, name):
    assert "lineitem" not in plan_of(queries()[name](spark, sf_dir))


def test_mean_reuses_the_distinct(spark, sf_dir, large_tables):
    """The scalar subquery reads the distinct that the rows come from."""
    df = queries()["clean_customers"](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    assert "ReusedExchange" in plan_of(df)


def test_slice_is_read_by_its_filter(spark, sf_dir):
    plan = plan_of(queries()["grade_slice"](spark, sf_dir))
    assert re.search(r"PushedFilters: \[[^]]*loan_final_grade", plan)


def test_columns_are_pruned(spark, sf_dir):
    plan = queries()["date_sentinels"](spark, sf_dir)._jdf.queryExecution()
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan.executedPlan().toString())
    assert any(s == "o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz" for s in scans)
    assert "c_custkey:bigint" in scans


@pytest.mark.parametrize("name", JOBS)
def test_generated_code_is_compiled_at_run_time(spark, sf_dir, name, capsys):
    """Methods over 8000 bytes of code stay interpreted, many times slower."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        queries()[name](spark, sf_dir).explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)
    assert sizes and max(map(int, sizes)) < 8000
