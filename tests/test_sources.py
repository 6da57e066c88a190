from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from loanmill.functions import fixed
from loanmill.operators import ingest
from loanmill.sources import catalog, derived, readers, schemas, writers


def same(left, right):
    return left.columns == right.columns and sorted(
        map(repr, left.collect())
    ) == sorted(map(repr, right.collect()))


def test_missing_input(spark, tmp_path):
    path = str(tmp_path / "nothing")
    for read in (
        lambda: readers.read_csv(spark, path),
        lambda: readers.read_csv(spark, path, schemas.LOANS),
        lambda: readers.read_raw(spark, path),
        lambda: readers.read_parquet(spark, path),
    ):
        with pytest.raises(FileNotFoundError):
            read()


def test_csv_inferred(spark, tmp_path):
    (tmp_path / "a.csv").write_text("loan_id,amount\nL1,5\nL2,x\n")
    inferred = readers.read_csv(spark, str(tmp_path / "a.csv"))
    assert dict(inferred.dtypes) == {"loan_id": "string", "amount": "string"}


def test_csv_declared_binds_by_position(any_mode, tmp_path):
    """Other header names do not matter; malformed values become NULL."""
    (tmp_path / "a.csv").write_text("loan_id,loan_amnt\nL1,5.25\nL2,bad\nL3,\n")
    declared = readers.read_csv(
        any_mode, str(tmp_path / "a.csv"), "loan_id string, loan_amount decimal(28,4)"
    )
    assert [tuple(r) for r in declared.collect()] == [
        ("L1", D("5.2500")),
        ("L2", None),
        ("L3", None),
    ]


def test_raw_csv_binds_by_name(any_mode, tmp_path):
    names = [f.name for f in schemas.RAW]
    row = {n: "" for n in names} | {
        "id": "7", "annual_inc": "55000.0", "installment": "123.03", "pub_rec": "junk",
        "delinq_2yrs": "0.0", "emp_length": "10+ years",
    }
    order = ["unused", *reversed(names)]
    text = ",".join(order) + "\n" + ",".join(row.get(n, "u") for n in order) + "\n"
    (tmp_path / "raw.csv").write_text(text)
    raw = readers.read_raw(any_mode, str(tmp_path / "raw.csv"))
    assert raw.schema.simpleString() == schemas.RAW.simpleString()
    got = raw.first()
    assert (got.id, got.installment, got.pub_rec) == ("7", D("123.0300"), None)
    # The income enters the key as a double's text.
    known = ingest.with_member_id(raw.select(*fixed.MEMBER_ATTRIBUTES)).first()
    import hashlib

    assert known.member_id == hashlib.sha256(b"10+ years||55000.0").hexdigest()


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [("L1", 1.5), ('say "x", y', None)], "loan_id string, amount double"
    )
    writers.write_csv(df, str(tmp_path / "a"))
    assert same(readers.read_csv(spark, str(tmp_path / "a"), df.schema), df)
    writers.write_csv(df.repartition(4), str(tmp_path / "b"), single_file=True)
    assert len(list((tmp_path / "b").glob("*.csv"))) == 1


def test_dated_write_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "daily")
    rows = spark.createDataFrame([("L1", 1)], "loan_id string, score int")
    writers.write_dated(rows, path, date(2020, 1, 1))
    writers.write_dated(rows, path, date(2020, 1, 2))
    writers.write_dated(rows.withColumn("score", F.lit(9)), path, date(2020, 1, 2))
    stored = spark.read.parquet(path)
    assert sorted((str(r.score_date), r.score) for r in stored.collect()) == [
        ("2020-01-01", 1),
        ("2020-01-02", 9),
    ]
    plan = stored.filter(F.col("score_date") == F.lit(date(2020, 1, 2)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(score_date" in text


def test_views(spark):
    readers.register_views({"some_loans": spark.createDataFrame([("L1",)], "loan_id string")})
    assert spark.sql("select count(*) as n from some_loans").first().n == 1
    assert readers.read_table(spark, "some_loans").first().loan_id == "L1"


def test_catalog(spark, tmp_path):
    df = spark.createDataFrame([("L1", D("1.5"))], "loan_id string, amount decimal(28,4)")
    writers.write_parquet(df, str(tmp_path / "it's loans"))
    catalog.create_database(spark, "test_db", str(tmp_path / "db"))
    catalog.create_database(spark, "test_db")
    catalog.create_external_table(
        spark, "test_db", "loans", str(tmp_path / "it's loans"), catalog.column_ddl(df)
    )
    assert same(spark.table("test_db.loans"), df)
    catalog.create_view(spark, "test_db", "v", "SELECT loan_id FROM test_db.loans")
    catalog.create_view(spark, "test_db", "v", "SELECT amount FROM test_db.loans")
    assert spark.table("test_db.v").columns == ["amount"]
    catalog.save_managed(df, "test_db", "managed")
    catalog.save_managed(df.unionAll(df), "test_db", "managed")
    assert spark.table("test_db.managed").count() == 2
    spark.sql("DROP TABLE test_db.loans")
    assert spark.read.parquet(str(tmp_path / "it's loans")).count() == 1


def test_work_folder_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one = writers.work_folder(spark, "x")
    with writers.job("other"):
        two = writers.work_folder(spark, "x")
    assert one.startswith(shared) and two.startswith(shared) and one != two
    assert one == writers.work_folder(spark, "x")


def test_bucketed_tables_need_a_number(spark):
    with pytest.raises(ValueError):
        catalog.save_managed(spark.range(1), "default", "t", "id")


def test_derived_raw_has_the_raw_columns(spark, sf_dir):
    raw = derived.raw_loans(spark, sf_dir)
    assert raw.columns == [f.name for f in schemas.RAW]
    assert raw.count() == 1500


def test_payments_of_any_size_are_summed_exactly(spark, tmp_path):
    from loanmill.sources import derived

    lines = [(1, 9999999999.99, 0.07, 0.08, 9999999999.0, "R")] * 3000
    lines += [(2, 0.01, 0.01, 0.01, 1.0, "N"), (3, -5.25, 0.5, 0.1, 2.0, "R"), (4, None, 0.1, 0.1, None, "R")]
    names = "l_orderkey long, l_extendedprice double, l_discount double, l_tax double, l_quantity double, l_returnflag string"
    spark.createDataFrame(lines, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    payments = derived._payments(spark, str(tmp_path))
    assert {t for _, t in payments.dtypes[1:]} == {"decimal(28,4)"}
    assert {r[0]: tuple(None if v is None else str(v) for v in r[1:]) for r in payments.collect()} == {
        1: ("27899999999972.1000", "2399999999997.6000", "29999999997000.0000"),
        2: ("0.0099", "0.0001", "0.0000"),
        3: ("-2.6250", "-0.5250", "2.0000"),
        4: (None, None, None),
    }


def test_long_texts_do_not_move_to_the_payments(spark, sf_dir):
    from loanmill.sources import derived

    raw = derived.raw_loans(spark, sf_dir)
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("Join LeftOuter")
    narrow = raw.select("id", "emp_title")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in narrow and "l_orderkey" not in narrow
