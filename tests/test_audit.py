"""Audited writes, rejected rows and rule sets as parameters."""

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmill.__main__ import main
from loanmill.functions import fixed
from loanmill.functions.points import Rules
from loanmill.operators import ingest, quality
from loanmill.plans import pipeline, publish, rules, single_pass
from loanmill.sources import catalog, derived, rejects, writers


def rows(df):
    order = sorted(df.columns)
    return sorted(map(repr, df.select(*order).collect()))


CHECKS = {
    "null_checks": ["a"],
    "unique_checks": ["k"],
    "range_checks": {"b": (0, 10)},
}


def table(spark, *records):
    return spark.createDataFrame(list(records), "k string, a int, b int")


def test_observed_report_is_the_report(spark, tmp_path):
    df = table(spark, ("x", 1, 5), ("y", None, 11), ("y", 3, -1), (None, None, None), ("z", 4, 10))
    seen = publish.write_observed(df, f"{tmp_path}/t", CHECKS)
    assert {r.asDict().__repr__() for r in seen} == {r.asDict().__repr__() for r in quality.check_data_quality(df, CHECKS).collect()}
    empty = publish.write_observed(df.limit(0), f"{tmp_path}/e", CHECKS)
    assert {r.pct for r in empty} == {0.0}
    publish.audit("empty", empty, {"null_checks": 0, "unique_checks": 0, "range_checks": 0})


def test_source_is_read_once(spark, tmp_path):
    """The rows are computed for the write, and not again for the checks."""
    counted = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    df = table(spark, ("x", 1, 5), ("y", None, 11)).mapInArrow(seen, "k string, a int, b int")
    publish.write_observed(df, f"{tmp_path}/t", CHECKS)
    assert counted.value == 2


def test_pointer_moves_for_sound_versions_only(spark, tmp_path):
    catalog.create_database(spark, "audited", str(tmp_path / "db"), fresh=True)
    limits = {"null_checks": 30.0, "unique_checks": 0.0}
    where = ("audited", "t", str(tmp_path / "versions"))

    def run(version, *records):
        return publish.write_audit_publish(table(spark, *records), *where, version, CHECKS, limits)

    first = [("x", 1, 5), ("y", 2, 99)]
    assert len(run("d1", *first)) == 3
    assert rows(spark.table("audited.t")) == rows(table(spark, *first))
    with pytest.raises(publish.QualityError, match="null_checks of a: 1 of 2") as nulls:
        run("d2", ("x", 1, 5), ("y", None, 5))
    assert [r.column_name for r in nulls.value.failed] == ["a"]
    with pytest.raises(publish.QualityError, match="unique_checks of k"):
        run("d3", ("x", 1, 5), ("x", 2, 5))
    assert rows(spark.table("audited.t")) == rows(table(spark, *first))
    assert spark.read.parquet(f"{tmp_path}/versions/t/d2").count() == 2  # to be looked at
    run("d4", ("z", 1, 1))
    assert rows(spark.table("audited.t")) == rows(table(spark, ("z", 1, 1)))
    with pytest.raises(ValueError, match="unknown"):
        publish.audit("t", [], {"other": 1})


@pytest.fixture(scope="module")
def keyed(spark, sf_dir):
    return writers.stage(ingest.with_member_id(derived.raw_loans(spark, sf_dir)), "audited_keyed")


def test_failing_run_leaves_yesterdays_scores(spark, keyed, tmp_path):
    folder = str(tmp_path)
    limits = {"null_checks": 15.0}
    first = rows(pipeline.run(keyed, folder, date(2020, 1, 1), "r1", fail_on=limits).drop("scored_at"))
    broken = keyed.withColumn("home_ownership", F.when(F.col("grade") == "A", F.col("home_ownership")))
    with pytest.raises(publish.QualityError, match="customers failed its checks: null_checks of home_ownership"):
        pipeline.run(broken, folder, date(2020, 1, 2), "r2", fail_on=limits)
    assert rows(pipeline.daily_scores(spark, folder).drop("scored_at")) == first
    pipeline.run(broken, folder, date(2020, 1, 2), "r2")  # no limits, no stop
    assert pipeline.daily_scores(spark, folder).select("score_date").distinct().count() == 2


def test_command_line_limits(spark, sf_dir, tmp_path):
    raw, folder = str(tmp_path / "raw"), str(tmp_path / "out")
    writers.write_csv(derived.raw_loans(spark, sf_dir), raw)
    run = ["run", "--raw", raw, "--folder", folder, "--day", "2020-01-03"]
    with pytest.raises(publish.QualityError):
        main([*run, "--fail-on", "range_checks", "0"])
    main([*run, "--fail-on", "null_checks", "50", "--fail-on", "range_checks", "100"])
    assert pipeline.monthly_partials(spark, folder).agg(F.sum("n_loans")).first()[0] == 589


# Rejected rows

SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("amount", T.DecimalType(10, 2)),
        T.StructField("n", T.IntegerType()),
        T.StructField("t", T.StringType()),
    ]
)
LINES = [
    "1,2.5,3,x",
    "2,bad,3,x",
    "3,2.5,3",
    "4,2.5,3,x,y",
    "5,,,",
    '6,"2.5,3,x',
    '7,2.5,zz,"a,b"',
    "8,bad,zz,q",
    '9,1,2,"a, b"',
    "11,1",
    "12,1,2,3,4,5,6",
    "13,1,2,",
    ",,,",
    "15",
]


def test_kept_and_rejected_rows_are_all_rows(any_mode, tmp_path):
    for name, lines in (("a", LINES), ("b", LINES[:3]), ("c", [])):
        (tmp_path / f"{name}.csv").write_text("\n".join(["id,amount,n,t", *lines]) + "\n")
    kept, rejected = rejects.read_csv_checked(any_mode, str(tmp_path), SCHEMA)
    assert kept.columns == SCHEMA.names
    assert kept.count() + rejected.count() == len(LINES) + 3
    got = {(r.record.split(",")[0], r.reason, tuple(r.columns), r.file.split("/")[-1]) for r in rejected.collect()}
    assert got == {
        ("2", rejects.VALUES, ("amount",), "a.csv"), ("2", rejects.VALUES, ("amount",), "b.csv"),
        ("3", rejects.SHORT, (), "a.csv"), ("3", rejects.SHORT, (), "b.csv"),
        ("4", rejects.LONG, (), "a.csv"), ("6", rejects.BROKEN, (), "a.csv"),
        ("7", rejects.VALUES, ("n",), "a.csv"), ("8", rejects.VALUES, ("amount", "n"), "a.csv"),
        ("11", rejects.SHORT, (), "a.csv"), ("12", rejects.LONG, (), "a.csv"), ("15", rejects.SHORT, (), "a.csv"),
    }
    held = {r.id: (r.amount, r.n, r.t) for r in kept.collect()}
    assert held["9"] == (D("1.00"), 2, "a, b") and held["5"] == (None, None, None) and held["13"] == (D("1.00"), 2, None)
    assert set(held) == {"1", "5", "9", "13", None}


def test_rejects_do_not_depend_on_the_columns_used(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join(["id,amount,n,t", *LINES]) + "\n")
    kept, rejected = rejects.read_csv_checked(spark, str(tmp_path), SCHEMA)
    assert kept.select("id").count() == kept.select("t").count() == len(kept.collect()) == 5
    assert rejected.select("reason").count() == len(rejected.collect()) == 9
    with pytest.raises(FileNotFoundError):
        rejects.read_csv_checked(spark, str(tmp_path / "none"), SCHEMA)


# Rule sets

OTHER = Rules(
    fixed.RatedPoints(10, 90, 260, 520, 640, 790),
    fixed.GradeCutoffs(700, 900, 1400, 1900, 2400),
    fixed.Weights(D("0.30"), D("0.30"), D("0.40")),
)


@pytest.mark.parametrize("chosen", [Rules(), OTHER], ids=["published", "other"])
def test_sql_with_parameters_equals_expressions(spark, keyed, chosen):
    tables = pipeline.clean_tables(ingest.split(keyed))
    kept = pipeline.CleanTables(
        **{
            name: t if name == "loans_repayments" else t.join(single_pass.quarantine_list(keyed), "member_id", "anti")
            for name, t in tables.by_name().items()
        }
    )
    by_sql = rules.scores(spark, kept, chosen)
    by_columns = single_pass.scores(keyed, rules=chosen)
    assert by_sql.columns == by_columns.columns and by_sql.dtypes == by_columns.dtypes
    assert rows(by_sql) == rows(by_columns) and by_sql.count() == 589


def test_rule_sets_differ(keyed):
    grades = [
        {r.loan_id: r.loan_final_grade for r in single_pass.scores(keyed, rules=chosen).collect()}
        for chosen in (Rules(), OTHER)
    ]
    assert grades[0] != grades[1]
    assert "750" not in rules.SCORE_QUERY and "0.45" not in rules.SCORE_QUERY
