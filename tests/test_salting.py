"""Borrowers with very many rows in bucketed tables."""

import re

import pytest
from pyspark.sql import functions as F

from loanmill.operators import salting
from loanmill.sources import catalog


@pytest.fixture
def large_tables(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_borrower_is_spread(spark, tmp_path, large_tables):
    """A third of the rows under one key: several files, no shuffle, right rows."""
    loans = spark.range(9000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('m', id % 500)) as member_id", "id as loan_id", "if(id % 2 = 0, 'x', null) as note"
    )
    people = loans.select("member_id").distinct().withColumn("name", F.upper("member_id"))
    heavy = salting.heavy_keys(loans, 400)
    assert {tuple(r) for r in heavy.collect()} == {("hot", 8)}
    catalog.create_database(spark, "salted", str(tmp_path / "db"), fresh=True)
    keys = ("member_id", "salt")
    catalog.save_managed(salting.salted(loans, heavy), "salted", "loans", keys, 16)
    catalog.save_managed(salting.repeated(people, heavy), "salted", "people", keys, 16)
    stored = spark.table("salted.loans")
    assert stored.select("member_id", "loan_id", "note").exceptAll(loans).count() == 0 and stored.count() == 9000
    files = stored.filter("member_id = 'hot'").groupBy("_metadata.file_name").count().collect()
    assert len(files) >= 4 and max(r["count"] for r in files) < 0.6 * 3000
    joined = stored.join(spark.table("salted.people"), list(keys)).drop("salt")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and re.search("SortMergeJoin|ShuffledHashJoin", plan)
    want = loans.join(people, "member_id")
    assert joined.count() == 9000 and joined.select(*want.columns).exceptAll(want).count() == 0


def test_no_heavy_keys(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "member_id string, n int")
    heavy = salting.heavy_keys(rows, 100)
    assert heavy.count() == 0
    assert {r.salt for r in salting.salted(rows, heavy).collect()} == {0}
    assert salting.repeated(rows, heavy).count() == 3
