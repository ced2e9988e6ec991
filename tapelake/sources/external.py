"""Inputs kept elsewhere: exchange-info files, the scheduler's run table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapelake.sources.sqlite import SqliteTable


def read_exchange_info(
    spark: SparkSession, path: str, schema: str | None = None, one_per_line: bool = False
) -> DataFrame:
    """Exchange-info documents with the fields of a schema, or whatever they have.

    A file is one document, or holds one on each line.
    """
    reader = spark.read.option("multiLine", not one_per_line).option("primitivesAsString", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_runs(
    spark: SparkSession, path: str | None = None, jdbc: dict[str, str] | None = None
) -> DataFrame:
    """Scheduler runs from parquet files, or from a database table by JDBC options.

    Filters on the result are pushed down to either.
    """
    if jdbc:
        return spark.read.format("jdbc").options(**jdbc).load()
    return spark.read.parquet(path)


def read_sqlite(
    spark: SparkSession, path: str, table: str, schema: str, rows_per_task: int = 100_000
) -> DataFrame:
    """A table of an SQLite file, such as a scheduler's run table, read in ranges of row ids.

    The schema names the columns to read; no other is fetched. The file must lie in a
    folder that all executors reach. Filters go to the file where the session allows
    Python sources to take them (``spark.sql.python.filterPushdown.enabled``).
    """
    spark.dataSource.register(SqliteTable)
    allowed = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    options = {"path": path, "table": table, "rows_per_task": rows_per_task, "pushdown": allowed}
    return spark.read.format(SqliteTable.name()).schema(schema).options(**options).load()

