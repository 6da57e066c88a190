"""Databases, external tables, views and managed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanmill.sources.writers import COMPRESSION


def quoted(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def path_text(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(
    spark: SparkSession, database: str, location: str | None = None, fresh: bool = False
) -> None:
    """Make a database; ``fresh`` drops one of that name, and its tables, first."""
    if fresh:
        spark.sql(f"DROP DATABASE IF EXISTS {quoted(database)} CASCADE")
    where = f" LOCATION {path_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}{where}")


def create_external_table(
    spark: SparkSession, database: str, table: str, path: str, columns: str
) -> None:
    """A table over Parquet files that dropping the table leaves in place.

    ``columns`` is a DDL list. The files must hold those types: the writers
    cast before they write, so declared and stored types agree.
    """
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(database, table)} ({columns}) "
        f"USING parquet LOCATION {path_text(path)}"
    )


def column_ddl(df: DataFrame) -> str:
    """The DDL list of a table's columns."""
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema)


def create_view(spark: SparkSession, database: str, view: str, query: str) -> None:
    """A view: always fresh, computed at every read."""
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(database, view)} AS {query}")


def save_managed(
    df: DataFrame,
    database: str,
    table: str,
    bucket_by: str | tuple[str, ...] | None = None,
    buckets: int = 0,
) -> None:
    """A managed table: as old as its last write, fast to read.

    Tables in equally many buckets of a join's key join without a shuffle. Rows
    are brought to their bucket before the write, so each bucket is one file:
    for tables with few rows per key, or with a salt as second key
    (``operators.salting``). Choose ``buckets`` by the size of the
    table, the same for all that are to join; it is part of the layout.
    """
    if bucket_by and buckets < 1:
        raise ValueError("say how many buckets")
    writer = df.write
    if bucket_by:
        keys = (bucket_by,) if isinstance(bucket_by, str) else bucket_by
        by_bucket = df.repartition(buckets, *keys)
        writer = by_bucket.write.bucketBy(buckets, *keys).sortBy(*keys)
    writer = writer.option("compression", COMPRESSION)
    writer.mode("overwrite").format("parquet").saveAsTable(quoted(database, table))
