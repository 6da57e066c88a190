from datetime import date, datetime
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmill.__main__ import main
from loanmill.operators import ingest, quarantine, reports, scoring, serving
from loanmill.plans import pipeline, single_pass
from loanmill.sources import derived, writers
from loanmill.streaming import scores as streaming

AT = datetime(2020, 1, 1)


@pytest.fixture(scope="module")
def keyed(spark, sf_dir):
    return writers.stage(
        ingest.with_member_id(derived.raw_loans(spark, sf_dir)), "test_keyed"
    )


def spark_table(tables, path):
    return tables.customers.sparkSession.read.parquet(path)


@pytest.fixture(scope="module")
def stored(keyed, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    tables = pipeline.clean_all_data(ingest.split(keyed), folder, AT, csv=True)
    bad = spark_table(tables, f"{folder}/bad_members/{pipeline.FINAL_LIST}")
    return folder, tables, bad, pipeline.without_quarantined(tables)


def rows(df):
    order = sorted(df.columns)
    return sorted(map(repr, df.select(*order).collect()))


def test_known_sizes(stored):
    _, tables, bad, kept = stored
    assert {n: t.count() for n, t in tables.by_name().items()} == {
        "customers": 1277,
        "loans": 1484,
        "loans_repayments": 1473,
        "loans_defaulters_delinq": 854,
        "loans_defaulters_detail_rec_enq": 1500,
    }
    assert bad.count() == 162
    assert pipeline.score_all(kept).count() == 589


def test_csv_copies(spark, stored):
    folder, tables, *_ = stored
    copy = spark.read.option("header", True).csv(f"{folder}/loans_csv")
    assert copy.count() == tables.loans.count()


def test_single_pass_equals_stored_tables(keyed, stored):
    _, _, bad, kept = stored
    assert rows(single_pass.quarantine_list(keyed)) == rows(bad)
    for fused, table in (
        (single_pass.customers_new(keyed), kept.customers),
        (single_pass.delinquencies_new(keyed), kept.loans_defaulters_delinq),
        (single_pass.detail_new(keyed), kept.loans_defaulters_detail_rec_enq),
    ):
        assert rows(fused.drop("ingest_date")) == rows(table.drop("ingest_date"))
    for name, fused in (
        ("payment_history", single_pass.payment_points(keyed)),
        ("defaulters_history", single_pass.default_points(keyed)),
        ("financial_health", single_pass.financial_points(keyed)),
    ):
        assert rows(fused) == rows(pipeline.component(kept, name))
    assert rows(single_pass.scores(keyed)) == rows(pipeline.score_all(kept))
    wide = serving.wide_customer_loans(*stored[1].by_name().values())
    assert rows(single_pass.wide_rows(keyed)) == rows(wide)
    assert single_pass.wide_rows(keyed).columns == wide.columns
    assert len(wide.columns) == 36


def test_unknown_component(stored):
    with pytest.raises(ValueError):
        pipeline.component(stored[3], "other")


def test_members_are_unique_after_quarantine(stored):
    kept = stored[3]
    for name in pipeline.MEMBER_TABLES:
        top = reports.frequencies(kept.by_name()[name], "member_id").first()
        assert top.total == 1


def test_every_grade_occurs(stored):
    grades = reports.grade_distribution(pipeline.score_all(stored[3]))
    got = {r.loan_final_grade: r.n_loans for r in grades.collect()}
    assert got == {"B": 26, "C": 159, "D": 220, "E": 61, "F": 8, None: 115}


def test_run(keyed, tmp_path):
    scores = pipeline.run(keyed, str(tmp_path), date(2020, 1, 2), "r1", AT)
    assert scores.count() == 589
    first = scores.first()
    assert (first.run_id, first.scored_at, first.score_date) == (
        "r1",
        AT,
        date(2020, 1, 2),
    )


def test_split_to_csv(spark, keyed, tmp_path):
    pipeline.split_to_csv(keyed.limit(10), str(tmp_path), single_file=True)
    for name in ("customers", "loans", "repayments", "defaulters"):
        assert len(list((tmp_path / f"{name}_data").glob("*.csv"))) == 1


def test_wide_rows_hold_every_loan_once(spark):
    """Rows of a quarantined borrower do not multiply and do not go."""

    def table(columns, *records):
        filled = [f"cast('{c}' as string) as {c}" for c in columns]
        ids = spark.createDataFrame(
            list(records), "member_id string, loan_id string, is_quarantined boolean"
        )
        return ids.selectExpr("member_id", "loan_id", "is_quarantined", *filled)

    bad, good = ("Q", "", True), ("S", "", False)
    customers = table(serving.CUSTOMER_COLUMNS, bad, bad, good, ("T", "", False)).drop("loan_id")
    loans = table(serving.LOAN_COLUMNS, ("Q", "L1", True), ("Q", "L2", True), ("S", "L3", False))
    repayments = table(serving.REPAYMENT_COLUMNS, ("", "L1", False)).drop("member_id", "is_quarantined")
    delinq = table(serving.DELINQUENCY_COLUMNS, bad, bad, good).drop("loan_id")
    detail = table(serving.DETAIL_COLUMNS, bad, bad, good).drop("loan_id")
    wide = serving.wide_customer_loans(customers, loans, repayments, delinq, detail)
    got = {(r.member_id, r.loan_id): r for r in wide.collect()}
    assert wide.count() == 4
    assert set(got) == {("Q", "L1"), ("Q", "L2"), ("S", "L3"), ("T", None)}
    first = got["Q", "L1"]
    assert first.loan_amount and first.last_payment_date and first.is_quarantined
    assert first.total_high_credit_limit is first.pub_rec is first.delinq_2yrs is None
    assert got["S", "L3"].pub_rec and got["S", "L3"].total_high_credit_limit


def collided(spark, keyed):
    """Two people with one key: a state in one, the same text as zip code in the
    other; a third has the same key and attributes as the second, but no loan
    that is complete. A fourth and a fifth without complete loans collide too."""
    first = keyed.filter("loan_amnt is not null and annual_inc is not null and total_pymnt > 0").limit(1)

    def person(loan, member, state, zip_code, amount="5", grade="'B'"):
        return first.withColumns(
            {
                "id": F.lit(loan),
                "member_id": F.lit(member),
                "addr_state": F.expr(state),
                "zip_code": F.expr(zip_code),
                "loan_amnt": F.expr(amount).cast("decimal(28,4)"),
                "grade": F.expr(grade),
            }
        )

    none = "null"
    return reduce(
        DataFrame.unionByName,
        [
            person("K1", "k", "'CA'", none),
            person("K2", "k", none, "'CA'"),
            person("K3", "k", none, "'CA'", none),
            person("M1", "m", "'CA'", none, none),
            person("M2", "m", none, "'CA'", none),
            person("S1", "s", "'NY'", "'1xx'"),
        ],
    )


def test_keys_of_several_people_double_no_loan(spark, keyed, tmp_path):
    """Tables, view and single pass fold them to what they agree in."""
    several = writers.stage(collided(spark, keyed), "test_collided")
    got = single_pass.wide_rows(several)
    by_loan = {(r.member_id, r.loan_id): r for r in got.collect()}
    assert got.count() == 4 and set(by_loan) == {("k", "K1"), ("k", "K2"), ("m", None), ("s", "S1")}
    for key in (("k", "K1"), ("k", "K2"), ("m", None)):
        row = by_loan[key]
        assert row.is_quarantined and row.address_state is None and row.address_zipcode is None
        assert row.grade == "B" and row.emp_title and row.total_high_credit_limit is None
    assert by_loan["s", "S1"].address_state == "NY"
    tables = pipeline.clean_all_data(ingest.split(several), str(tmp_path), AT)
    assert rows(serving.wide_customer_loans(*tables.by_name().values())) == rows(got)
    for name, table in tables.by_name().items():
        table.createOrReplaceTempView(f"collided_{name}")
    served = ("customers", "loans", "loans_repayments", *pipeline.MEMBER_TABLES[1:])
    view = spark.sql(serving.wide_view_query(*[f"collided_{name}" for name in served]))
    assert rows(view) == rows(got)


def test_money_of_any_size_is_kept(any_mode):
    """No value is too large for its column."""
    from loanmill.operators import cleaning
    from loanmill.sources import schemas

    spark, huge = any_mode, "20000000000.5"
    texts = {f.name: "x" for f in schemas.RAW}
    money = [f.name for f in schemas.RAW if f.dataType == schemas.MONEY]
    texts |= {name: huge for name in [*money, "annual_inc"]}
    texts |= {"term": "36 months", "issue_d": "Jan-2020", "delinq_2yrs": "1"}
    raw = spark.createDataFrame([texts]).select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schemas.RAW]
    )
    split = ingest.split(ingest.with_member_id(raw))
    customer = cleaning.named_customers(split["customers"]).first()
    assert float(customer.annual_income) == float(customer.total_high_credit_limit) == 20000000000.5
    assert float(cleaning.clean_loans(split["loans"]).first().funded_amount) == 20000000000.5
    paid = cleaning.clean_repayments(split["repayments"]).first()
    assert float(paid.total_payment_received) == 20000000000.5
    flags = single_pass.cleaned_rows(ingest.with_member_id(raw)).first()
    assert flags.is_customer and flags.is_loan and flags.is_repayment


def test_several_loans_score_apart(spark, stored):
    """Scores are per loan, whichever way the borrower's loans are given."""
    kept = stored[3]
    scores = pipeline.score_all(kept)
    loan = scores.first()
    twin = kept.loans.filter(F.col("loan_id") == loan.loan_id).withColumn(
        "loan_id", F.lit("twin")
    )
    paid = kept.loans_repayments.filter(F.col("loan_id") == loan.loan_id).withColumn(
        "loan_id", F.lit("twin")
    )
    again = scoring.score_tables(
        kept.loans.unionByName(twin),
        kept.loans_repayments.unionByName(paid),
        kept.customers,
        kept.loans_defaulters_delinq,
        kept.loans_defaulters_detail_rec_enq,
    )
    assert again.filter(F.col("member_id") == loan.member_id).count() == 2
    assert again.count() == scores.count() + 1


def test_hot_borrower(spark, keyed):
    """A third of the rows under the empty key change nothing for the others."""
    blank = keyed.withColumns(
        {c: F.lit(None).cast(t) for c, t in keyed.dtypes if c not in ("id", "member_id")}
    ).withColumns({"id": F.concat(F.lit("X"), "id"), "member_id": F.lit("hot")})
    more = keyed.unionByName(blank.sample(0.5, seed=1))
    assert rows(single_pass.scores(more)) == rows(single_pass.scores(keyed))
    extra = single_pass.quarantine_list(more).exceptAll(single_pass.quarantine_list(keyed))
    assert [r.member_id for r in extra.collect()] == ["hot"]
    assert quarantine.single_rows(more).count() == quarantine.single_rows(keyed).count()


def test_stream_in_two_steps(spark, stored, tmp_path):
    """Two files in two runs give each loan's score once."""
    kept = stored[3]
    folder = str(tmp_path / "repayments")
    halves = kept.loans_repayments.randomSplit([0.5, 0.5], seed=7)
    known = writers.stage(
        scoring.ledger(
            kept.loans,
            kept.customers,
            kept.loans_defaulters_delinq,
            kept.loans_defaulters_detail_rec_enq,
        ),
        "test_ledger",
    )
    plan = streaming.score_stream(kept.loans_repayments, known)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join Inner") == 1 and "Aggregate" not in text
    out, checkpoint = str(tmp_path / "scores"), str(tmp_path / "checkpoint")
    for half in halves:
        half.write.mode("append").parquet(folder)
        stream = streaming.repayment_stream(spark, folder, half.schema)
        scored = streaming.score_stream(stream, known)
        assert scored.isStreaming
        streaming.write_stream(scored, out, checkpoint).awaitTermination()
    assert rows(spark.read.parquet(out)) == rows(pipeline.score_all(kept))


def test_command_line(spark, sf_dir, tmp_path):
    raw, folder = str(tmp_path / "raw"), str(tmp_path / "out")
    writers.write_csv(derived.raw_loans(spark, sf_dir), raw)
    main(["run", "--raw", raw, "--folder", folder, "--day", "2020-01-03"])
    scores = spark.read.parquet(f"{folder}/loan_score/daily")
    assert scores.count() == 589
    for name in pipeline.COMPONENTS:
        out = f"{tmp_path}/{name}"
        main(["component", name, "--folder", folder, "--out", out])
        assert spark.read.parquet(out).count() >= 589
    main(["split", "--raw", raw, "--folder", f"{tmp_path}/split", "--single-file"])
    assert len(list((tmp_path / "split" / "loans_data").glob("*.csv"))) == 1
    with pytest.raises(SystemExit):
        main(["component", "other", "--folder", folder, "--out", folder])
