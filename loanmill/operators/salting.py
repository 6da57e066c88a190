"""Tables in buckets, with borrowers of very many rows spread over several.

A bucket is one file, so all rows of a borrower would be in one. Borrowers with
more rows than a file should have are found in the counts; their rows get a salt,
the rows that they meet are repeated for each salt, and both sides lie in buckets
of borrower and salt. The join then shuffles nothing and is spread like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmill.functions.scalars import row_hash

KEY, SALT = "member_id", "salt"


def heavy_keys(table: DataFrame, rows_per_file: int, key: str = KEY) -> DataFrame:
    """Keys with more rows than that, and into how many ``salts`` they are cut.
    There are at most as many keys as there are such files."""
    counts = table.groupBy(key).agg(F.count("*").alias("total")).filter(F.col("total") > rows_per_file)
    return counts.select(key, F.ceil(F.col("total") / rows_per_file).cast("int").alias("salts"))


def _with_salts(table: DataFrame, heavy: DataFrame, key: str, salt: Column) -> DataFrame:
    known = heavy.withColumnRenamed(key, "_key")
    joined = table.join(known, F.col(key) == F.col("_key"), "left")
    return joined.select(*table.columns, salt.alias(SALT))


def salted(table: DataFrame, heavy: DataFrame, key: str = KEY) -> DataFrame:
    """The rows with a salt: a hash of the whole row for heavy keys, else 0.

    ``heavy`` is short next to the table, so hot keys meet it in a broadcast, or
    in a sort-merge join whose hot side is split at run time.
    """
    row = row_hash(*[F.col(c) for c in table.columns])
    return _with_salts(table, heavy, key, F.coalesce(F.pmod(row, F.col("salts")), F.lit(0)).cast("int"))


def repeated(table: DataFrame, heavy: DataFrame, key: str = KEY) -> DataFrame:
    """The rows of the other side, once for each salt of their key: for a side
    with few rows per key."""
    salts = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    return _with_salts(table, heavy, key, F.explode(salts))
