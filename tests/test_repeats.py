"""Rows that are marked as their borrower's only one do not move."""

from __future__ import annotations

from loanmill.operators import ingest, quarantine
from loanmill.plans import pipeline, single_pass
from loanmill.sources import derived


def _marked(spark, sf_dir, folder):
    keyed = ingest.with_member_id(derived.raw_loans(spark, sf_dir))
    return keyed, pipeline.store_keyed(keyed, str(folder))


def _rows(table):
    return sorted(map(str, table.select(sorted(table.columns)).collect()))


def test_the_mark_is_false_for_single_rows_alone(spark, sf_dir, tmp_path):
    keyed, marked = _marked(spark, sf_dir, tmp_path)
    assert _rows(marked.drop(ingest.REPEATS)) == _rows(keyed)
    repeated = ingest.repeated_members(keyed).select("member_id")
    assert marked.filter(f"not {ingest.REPEATS}").join(repeated, "member_id").count() == 0
    assert marked.filter(ingest.REPEATS).count() < marked.count() / 2


def test_two_keys_of_one_hash_are_counted_apart(spark):
    table = spark.createDataFrame([("a", 1, True), ("b", 2, True), ("c", 3, False)], f"member_id string, x int, {ingest.REPEATS} boolean")
    assert quarantine.quarantine_list(table).count() == 0
    bad = spark.createDataFrame([("b",)], "member_id string")
    assert _rows(quarantine.exclude_members(table, bad)) == ["Row(member_id='a', x=1)", "Row(member_id='c', x=3)"]
    flagged = quarantine.flag_members(table, bad)
    assert flagged.columns == ["member_id", "x", "is_quarantined"]
    assert [r.member_id for r in flagged.filter("is_quarantined").collect()] == ["b"]


def test_results_are_the_same_with_and_without_the_mark(spark, sf_dir, tmp_path):
    keyed, marked = _marked(spark, sf_dir, tmp_path / "raw")
    # Fewer rows than were marked: some borrowers are single by now.
    for some in ("true", "substring(id, 2, 20) % 2 = 0"):
        plain, known = keyed.filter(some), marked.filter(some)
        assert _rows(single_pass.wide_rows(known)) == _rows(single_pass.wide_rows(plain))
        one = pipeline.clean_all_data(ingest.split(plain), str(tmp_path / "plain")).by_name()
        two = pipeline.clean_all_data(ingest.split(known), str(tmp_path / "known")).by_name()
        for name, table in one.items():
            assert two[name].columns == table.columns
            assert _rows(two[name].drop("ingest_date")) == _rows(table.drop("ingest_date"))


def test_single_rows_are_not_joined(spark, sf_dir, tmp_path):
    _, marked = _marked(spark, sf_dir, tmp_path)
    bad = spark.createDataFrame([("x",)], "member_id string")
    plan = quarantine.flag_members(ingest.split_loans(marked), bad)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and f"NOT {ingest.REPEATS}" in plan.split("LeftOuter")[0]
