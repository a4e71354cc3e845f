"""Schemas and external tables of the session's catalog."""

from __future__ import annotations

from pyspark.sql import SparkSession


def quoted(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def ensure_schema(spark: SparkSession, name: str) -> str:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(name)}")
    return name


def external_table(
    spark: SparkSession, schema: str, name: str, path: str, ddl: str, partitioned_by: tuple[str, ...] = ()
) -> str:
    """A table over Parquet files that others write below ``path``; returns its full name.

    Dropping the table leaves the files. Partitions are known to the catalog, so a read lists only the folders
    it needs, and new ones come in with ``refresh_table``.
    """
    full = quoted(ensure_schema(spark, schema), name)
    parts = f"PARTITIONED BY ({', '.join(map(quoted, partitioned_by))})" if partitioned_by else ""
    # A location is a string literal.
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {full} ({ddl}) USING parquet {parts} LOCATION '{location}'")
    return full


def refresh_table(spark: SparkSession, full: str) -> None:
    """Take in what was written since: new and removed partitions, and the files of all."""
    partitioned = any(c.isPartition for c in spark.catalog.listColumns(full))
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {full} SYNC PARTITIONS")
    spark.sql(f"REFRESH TABLE {full}")


def listed(spark: SparkSession, schema: str) -> list[tuple[str, str]]:
    """Name and kind of every table and view of a schema; temporary views belong to none."""
    found = spark.catalog.listTables(quoted(schema))
    return sorted((t.name, t.tableType) for t in found if not t.isTemporary)
