"""Staged arrivals: each is read from its own files."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanmill.sources import writers


def test_one_arrival_reads_no_other_ones_files(spark):
    table = spark.range(40, numPartitions=2).select("id", (F.col("id") % 4).cast("int").alias("arrival"))
    staged = writers.stage(table, "arrivals", by="arrival")
    assert staged.dtypes == table.dtypes
    for i in range(4):
        one = staged.filter(F.col("arrival") == i)
        assert sorted(r.id for r in one.collect()) == list(range(i, 40, 4))
        files = one.select(F.input_file_name().alias("file")).distinct().collect()
        assert files and all(f"arrival={i}/" in r.file for r in files)
        scan = one._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(arrival" in scan
