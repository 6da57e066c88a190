"""Rows that were counted as their borrower's only one, and what is made of them."""

from __future__ import annotations

import gzip

from pyspark.sql import functions as F

from loanmill.operators import ingest
from loanmill.plans import pipeline, single_pass
from loanmill.sources import derived, writers


def _keyed(spark, sf_dir):
    return ingest.with_member_id(derived.raw_loans(spark, sf_dir))


def _marked(spark, sf_dir, folder):
    single = ingest.single_ids(_keyed(spark, sf_dir), F.substring("id", 2, 20).cast("long"))
    path = f"{folder}/single"
    writers.write_parquet(single, path)
    marked = ingest.with_member_id(derived.raw_loans(spark, sf_dir, spark.read.parquet(path)))
    return pipeline.store_keyed(marked, str(folder))


def _rows(table):
    return sorted(map(str, table.select(sorted(table.columns)).collect()))


def test_rows_of_repeated_borrowers_are_marked_and_no_others(spark, sf_dir, tmp_path):
    keyed, marked = _keyed(spark, sf_dir), _marked(spark, sf_dir, tmp_path)
    assert _rows(marked.drop(ingest.REPEATED)) == _rows(keyed)
    repeated = ingest.repeated_members(keyed).select("member_id")
    expected = keyed.join(repeated, "member_id", "left_semi").select("id")
    assert 0 < expected.count() < keyed.count()
    assert _rows(marked.filter(ingest.REPEATED).select("id")) == _rows(expected)


def test_tables_lists_and_wide_rows_are_those_without_marks(spark, sf_dir, tmp_path):
    keyed, marked = _keyed(spark, sf_dir), _marked(spark, sf_dir, tmp_path / "raw")
    one = pipeline.clean_all_data(ingest.split(keyed), str(tmp_path / "plain")).by_name()
    two = pipeline.clean_all_data(ingest.split(marked), str(tmp_path / "marked"), csv=True).by_name()
    for name, table in one.items():
        assert two[name].columns == table.columns
        assert _rows(two[name].drop("ingest_date")) == _rows(table.drop("ingest_date"))
    for name in ("repeated_members", pipeline.FINAL_LIST, *[f"bad_{n}" for n in pipeline.MEMBER_TABLES]):
        plain, known = (spark.read.parquet(f"{tmp_path}/{f}/bad_members/{name}") for f in ("plain", "marked"))
        assert _rows(known) == _rows(plain) != []
    stage_of = {}

    def stage(rows, name):
        path = f"{tmp_path}/{name}"
        writers.write_parquet(rows, path)
        stage_of[name] = spark.read.parquet(path).count()
        return spark.read.schema(rows.schema).parquet(path)

    assert _rows(single_pass.wide_rows(marked, stage=stage)) == _rows(single_pass.wide_rows(keyed))
    assert stage_of["others"] < keyed.count() / 20  # so rows need not move to meet it
    files = list((tmp_path / "marked" / "loans_csv").glob("*.csv.gz"))
    lines = sum(len(gzip.decompress(f.read_bytes()).splitlines()) - 1 for f in files)
    assert lines == one["loans"].count()


def test_no_row_meets_a_list_where_the_quarantine_is_known(spark, sf_dir, tmp_path):
    """Neither a join of a cleaned table nor one of whole raw rows is left."""
    marked = _marked(spark, sf_dir, tmp_path / "raw")
    written = []
    write = writers.write_parquet
    try:
        writers.write_parquet = lambda df, path: (written.append((path, df)), write(df, path))
        pipeline.clean_all_data(ingest.split(marked), str(tmp_path / "tables"))
    finally:
        writers.write_parquet = write
    plans = {
        path.rsplit("/", 1)[1]: df._jdf.queryExecution().optimizedPlan().toString() for path, df in written
    }
    for name in pipeline.QUARANTINED_TABLES:
        assert "Join" not in plans[f"{name}_parquet"]
