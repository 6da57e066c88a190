"""Scores over days, monthly partials, sketches and refreshed tables."""

import random
import re
from datetime import date
from decimal import Decimal as D
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loanmill.operators import history, ingest, refresh, reports, sketches
from loanmill.plans import pipeline, single_pass
from loanmill.sources import catalog, derived, writers


def rows(df):
    order = sorted(df.columns)
    return sorted(map(repr, df.select(*order).collect()))


DAYS = [date(2020, 1, 1), date(2020, 1, 3), date(2020, 1, 4), date(2020, 2, 1), date(2020, 4, 9)]


@pytest.fixture(scope="module")
def daily(spark):
    """A: the same, then another, then the first again; B: gone for one run;
    C: NULL, NULL, a score; D: the last run only; E: all runs but the last."""
    held = {
        "A": [5, 5, 7, 5, 5],
        "B": [5, None, 5, 5, None],
        "C": ["null", "null", 9, 9, 9],
        "D": [None, None, None, None, 3],
        "E": [1, 1, 1, 1, None],
    }
    data = []
    for loan, values in held.items():
        for day, v in zip(DAYS, values):
            if v is not None:
                score = None if v == "null" else D(v)
                data.append((loan, day, score, None if score is None else "ABCDEFGHIJ"[v]))
    random.Random(1).shuffle(data)
    return spark.createDataFrame(
        data, "loan_id string, score_date date, loan_score decimal(12,4), loan_final_grade string"
    )


def test_history(spark, daily):
    got = history.score_history(daily)
    told = {(r.loan_id, r.loan_score and int(r.loan_score), r.valid_from, r.valid_to) for r in got.collect()}
    a, b, c, d, e = DAYS
    assert told == {
        ("A", 5, a, c), ("A", 7, c, d), ("A", 5, d, None),
        ("B", 5, a, b), ("B", 5, c, e),
        ("C", None, a, c), ("C", 9, c, None),
        ("D", 3, e, None), ("E", 1, a, e),
    }
    assert got.count() == 9


def test_every_day_comes_back_from_the_history(daily):
    known = history.score_history(daily)
    for day in DAYS:
        want = daily.filter(F.col("score_date") == F.lit(day)).drop("score_date")
        assert rows(history.scores_on(known, day)) == rows(want)
    between = history.scores_on(known, date(2020, 3, 1))
    assert rows(between) == rows(history.scores_on(known, DAYS[3]))
    assert history.scores_on(known, date(2019, 12, 31)).count() == 0


def test_as_of_join(spark, daily):
    asked = spark.createDataFrame(
        [("A", DAYS[2], 1), ("A", DAYS[2], 2), ("B", DAYS[1], 3), ("X", DAYS[0], 4), ("D", None, 5), ("C", date(2021, 1, 1), 6)],
        "loan_id string, asked_on date, n int",
    )
    got = {r.n: (r.loan_id, r.loan_final_grade) for r in history.as_of(asked, history.score_history(daily)).collect()}
    assert got == {1: ("A", "H"), 2: ("A", "H"), 3: ("B", None), 4: ("X", None), 5: ("D", None), 6: ("C", "J")}


def test_grade_migration(daily):
    """A month counts with its last run; March has none, so April has no step."""
    got = {(r.to_month, r.from_grade, r.to_grade, r.n_loans) for r in history.grade_migration(daily).collect()}
    month = date(2020, 2, 1)
    assert got == {(month, "H", "F", 1), (month, "F", "F", 1), (month, "J", "J", 1), (month, "B", "B", 1)}


def test_rolling_scores(spark):
    monthly = spark.createDataFrame(
        [("2019-11", "A", 2, 2, D(10)), ("2020-01", "A", 4, 1, D(8)), ("2020-02", "A", 1, 0, None), ("2020-05", "A", 1, 1, D(3)), ("2020-01", None, 3, 0, None)],
        "issue_month string, loan_final_grade string, n_loans long, n_scored long, sum_score decimal(22,4)",
    )
    got = {(r.issue_month, r.loan_final_grade): (r.n_more_loans, r.rolling_score) for r in history.rolling_scores(monthly).collect()}
    assert got == {
        ("2019-11", "A"): (2, 5.0), ("2020-01", "A"): (4, 6.0), ("2020-02", "A"): (-3, 8.0),
        ("2020-05", "A"): (1, 3.0), ("2020-01", None): (3, None),
    }


@pytest.fixture(scope="module")
def keyed(spark, sf_dir):
    return writers.stage(ingest.with_member_id(derived.raw_loans(spark, sf_dir)), "history_keyed")


def test_partials_of_days_are_the_whole(spark, keyed, tmp_path):
    folder = str(tmp_path)
    whole = writers.stage(single_pass.scores(keyed, "issue_date"), "history_scores")
    for i, day in enumerate(DAYS[:3]):
        part = whole.filter(F.pmod(F.xxhash64("loan_id"), F.lit(3)) == i)
        writers.write_dated(part, f"{folder}/loan_score/daily", day)
        pipeline.add_monthly(spark, folder, day)
    pipeline.add_monthly(spark, folder, DAYS[1])  # again: it replaces its own
    merged = reports.monthly_from_partials(pipeline.monthly_partials(spark, folder))
    assert rows(merged) == rows(reports.monthly_scores(whole))


def test_only_the_new_day_is_read(spark, keyed, tmp_path):
    folder = str(tmp_path)
    whole = single_pass.scores(keyed, "issue_date")
    for day in DAYS[:2]:
        writers.write_dated(whole, f"{folder}/loan_score/daily", day)
    scores = pipeline.daily_scores(spark, folder).filter(F.col("score_date") == F.lit(DAYS[1]))
    df = reports.monthly_partials(scores)
    assert re.search(r"PartitionFilters: \[[^]]*score_date[^]]*= 2020-01-03", df._jdf.queryExecution().executedPlan().toString())


def files_of(spark, table):
    listed = {}
    for f in spark.table(table).inputFiles():
        path = Path(re.sub(r"^file:/+", "/", f))
        listed.setdefault(path.parent.name, set()).add((path.name, path.stat().st_mtime_ns))
    return listed


def test_refresh_writes_what_changed(spark, tmp_path):
    catalog.create_database(spark, "refreshed", str(tmp_path / "db"), fresh=True)
    wide = spark.range(3000).selectExpr("concat('m', id % 700) as member_id", "id as loan_id", "cast(id as decimal(28,4)) as amount", "if(id % 5 = 0, null, 'x') as note")
    refresh.store(wide, "refreshed", "wide", 16)
    before = files_of(spark, "refreshed.wide")
    assert len(before) == 16
    assert refresh.refresh(spark, wide, "refreshed", "wide", 16) == []
    assert files_of(spark, "refreshed.wide") == before
    changed = wide.withColumn("amount", F.when(F.col("member_id") == "m5", F.lit(-1)).otherwise(F.col("amount")).cast("decimal(28,4)"))
    written = refresh.refresh(spark, changed, "refreshed", "wide", 16)
    after = files_of(spark, "refreshed.wide")
    assert len(written) == 1 and [p for p in before if before[p] != after[p]] == [f"part={written[0]}"]
    assert rows(spark.table("refreshed.wide").drop("part")) == rows(changed)
    # A value that moves to another column, NULLs beside it, is a change too.
    moved = changed.withColumns({"note": F.expr("if(member_id = 'm7', null, note)"), "other": F.expr("if(member_id = 'm7', note, null)")})
    plain = changed.withColumn("other", F.lit(None).cast("string"))
    told = [refresh.contents(refresh.with_part(t, 1)).first().hash_sum for t in (plain, moved)]
    assert told[0] != told[1]
    # Rows go, come and are there twice; a partition is left without any.
    empty = refresh.with_part(changed, 16).filter("part <> 3").drop("part")
    twice = empty.unionByName(empty.filter("member_id = 'm9'"))
    refresh.refresh(spark, twice, "refreshed", "wide", 16)
    assert rows(spark.table("refreshed.wide").drop("part")) == rows(twice)
    assert "part=3" not in files_of(spark, "refreshed.wide")
    refresh.refresh(spark, wide, "refreshed", "wide", 16)
    assert rows(spark.table("refreshed.wide").drop("part")) == rows(wide)
    assert refresh.refresh(spark, wide, "refreshed", "wide", 16) == []
    refresh.refresh(spark, wide.limit(0), "refreshed", "wide", 16)
    assert spark.table("refreshed.wide").count() == 0


def test_exact_quantiles(spark, monkeypatch):
    monkeypatch.setattr(sketches, "FEW", 50)
    rng = random.Random(4)
    for n, kinds in ((1, 9), (2, 9), (3000, 10**6), (3000, 200), (5000, 3), (4000, 60)):
        data = sorted(rng.randint(0, kinds) / 4 for _ in range(n))
        df = spark.createDataFrame([(v,) for v in data] + [(None,)], "x double")
        want = {q: data[max(1, -int(-q * n // 1)) - 1] for q in sketches.QUARTILES}
        assert sketches.exact_quantiles(df, "x") == want
    none = spark.createDataFrame([(None,)], "x double")
    assert set(sketches.exact_quantiles(none, "x").values()) == {None}


def test_rank_without_a_sketch(spark):
    df = spark.createDataFrame([(float(v % 97),) for v in range(2000)], "v double")
    data = sorted(v % 97 for v in range(2000))
    for rank in (1, 500, 1999, 2000):
        assert sketches._at_rank(df, rank) == data[rank - 1]


def test_merged_sketches(spark):
    """Ranks within the stated error, distinct counts within 2 %."""
    df = spark.range(200_000).selectExpr("cast(pmod(id * 7919, 200003) as double) as x", "id % 60000 as k", "id % 4 as day")
    merged = sketches.merged_quantiles(sketches.quantile_sketches(df, ["x"], "day"), ["x"])
    q = merged.select(*[sketches.quantile("x", s) for s in (0.25, 0.5, 0.75)], "n_x").first()
    data = sorted(r.x for r in df.select("x").collect())
    for share, value in zip((0.25, 0.5, 0.75), q):
        rank = sum(1 for x in data if x <= value)
        assert abs(rank / len(data) - share) < sketches.KLL_ERROR
    assert q.n_x == 200_000
    by_day = sketches.distinct_sketches(df, ["k"], "day")
    assert by_day.count() == 4
    assert abs(sketches.distinct_counts(by_day, ["k"]).first().n_k / 60_000 - 1) < 0.02
