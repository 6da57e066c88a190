import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parent.parent))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["true", "false"], ids=["ansi", "no_ansi"])
def any_mode(spark, request):
    """The session with ANSI mode on, then off."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield spark
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def loans(spark):
    return spark.createDataFrame(
        [
            ("a7", "kim", "Fully Paid", "A", 8250.5, 412.25),
            ("b1", "lee", "current", "D", 640.0, 160.0),
            ("c9", "max", "Late", "B", 51.0, 17.0),
            ("d4", "noa", None, None, 900.0, 0.0),
        ],
        "loan_id string, member_id string, loan_status string, grade string, "
        "funded_amount double, monthly_installment double",
    )


@pytest.fixture
def repayments(spark):
    return spark.createDataFrame(
        [("a7", 329.8, 8250.5), ("b1", 96.0, 384.0), ("c9", 3.4, 30.6), ("d4", 5.0, None)],
        "loan_id string, last_payment_amount double, total_payment_received double",
    )


@pytest.fixture
def customers(spark):
    return spark.createDataFrame(
        [("kim", "RENT", 8250.5), ("lee", "own", 1600.0), ("max", "OWN", 60.0), ("noa", None, None)],
        "member_id string, home_ownership string, total_high_credit_limit double",
    )


@pytest.fixture
def defaulters(spark):
    return spark.createDataFrame(
        [("kim", 3, 0, 1, 7), ("lee", 0, 2, 0, 2), ("max", 1, 1, 4, 0), ("noa", None, 0, -1, 1)],
        "member_id string, delinq_2yrs int, pub_rec int, "
        "pub_rec_bankruptcies int, inq_last_6mths int",
    )
