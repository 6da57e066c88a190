"""Stored tables that are refreshed where they changed, and only there.

Rows are kept in partitions by a hash of their key. A partition's content is told
by its number of rows and by sums of hashes of whole rows, which do not depend on
order and are added up in the scan; those of the stored partitions are kept in a
small table beside it. A refresh compares them with those of the new rows and
writes the partitions that differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmill.functions.scalars import row_hash
from loanmill.sources.catalog import quoted
from loanmill.sources.writers import COMPRESSION

PART = "part"


def with_part(rows: DataFrame, parts: int, key: str = "member_id") -> DataFrame:
    """The rows with the number of their partition as last column."""
    part = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
    return rows.select(*[c for c in rows.columns if c != PART], part.alias(PART))


def contents(rows: DataFrame) -> DataFrame:
    """Per partition the number of rows and two independent sums of hashes."""
    columns = [F.col(c) for c in rows.columns if c != PART]
    first, second = row_hash(*columns), row_hash(*columns, seed=1)
    return rows.groupBy(PART).agg(
        F.count("*").alias("n_rows"),
        F.sum(first.cast("decimal(20,0)")).alias("hash_sum"),
        F.bit_xor(second).alias("hash_xor"),
    )


def _content_name(table: str) -> str:
    return f"{table}_content"


def store(rows: DataFrame, database: str, table: str, parts: int, key: str = "member_id") -> None:
    """Write the whole table, and what its partitions hold.

    Rows are dealt by partition and a hash of the row, so that a key with very
    many rows is written by several tasks.
    """
    writer = _dealt(with_part(rows, parts, key)).write.mode("overwrite").format("parquet")
    # An option of the table: later overwrites replace the partitions they have.
    writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(PART)
    writer = writer.option("compression", COMPRESSION)
    writer.saveAsTable(quoted(database, table))
    stored = rows.sparkSession.table(quoted(database, table))
    contents(stored).write.mode("overwrite").format("parquet").saveAsTable(
        quoted(database, _content_name(table))
    )


#: Tasks that write the rows of one partition.
TASKS_PER_PART = 4


def _dealt(rows: DataFrame) -> DataFrame:
    others = [c for c in rows.columns if c != PART]
    return rows.repartition(F.col(PART), F.pmod(F.xxhash64(*others), F.lit(TASKS_PER_PART)))


def changed_parts(rows: DataFrame, stored: DataFrame) -> tuple[list[int], list[int]]:
    """Partitions to write, and partitions that have no rows any more, from the
    new rows and the stored contents: at most as many as there are partitions."""
    new = contents(rows).select(F.col(PART).alias("new_part"), F.struct("n_rows", "hash_sum", "hash_xor").alias("new"))
    old = stored.select(F.col(PART).alias("old_part"), F.struct("n_rows", "hash_sum", "hash_xor").alias("old"))
    both = new.join(old, F.col("new_part") == F.col("old_part"), "full")
    differ = both.filter(~F.col("new").eqNullSafe(F.col("old"))).select("new_part", "old_part")
    found = differ.collect()
    changed = sorted(r.new_part for r in found if r.new_part is not None)
    return changed, sorted(r.old_part for r in found if r.new_part is None)


def refresh(
    spark: SparkSession, rows: DataFrame, database: str, table: str, parts: int, key: str = "member_id"
) -> list[int]:
    """Bring a stored table to the new rows; returns the partitions written.

    The filter on the partition is one on the key, so what the new rows are
    made of is read for the changed partitions only where it has that key. The
    contents are stored last: after a failure the next refresh writes the same
    partitions again.
    """
    name, content = quoted(database, table), quoted(database, _content_name(table))
    parted = with_part(rows, parts, key)
    columns = [c for c in spark.table(name).columns if c != PART]
    parted = parted.select(*columns, PART)
    known = spark.table(content)
    changed, gone = changed_parts(parted, known)
    if changed:
        some = parted.filter(F.col(PART).isin(changed))
        _dealt(some).write.insertInto(name, overwrite=True)
    for part in gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({PART} = {part})")
    if changed or gone:
        spark.catalog.refreshTable(name)
        now = spark.table(name).filter(F.col(PART).isin(changed)) if changed else spark.table(name).limit(0)
        kept = known.filter(~F.col(PART).isin([*changed, *gone])).collect()
        whole = contents(now).unionByName(spark.createDataFrame(kept, known.schema))
        whole.write.mode("overwrite").format("parquet").saveAsTable(content)
    return changed
