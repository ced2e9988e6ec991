"""Retention: keep the last days of every table that has a date column."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapelake.sources.tables import Lake, is_day
from tapelake.workspace import materialize, remove_folder

DEFAULT_DAYS = 5


def date_column(rows: DataFrame) -> str | None:
    """Name of the date column in whatever case, None if there is none."""
    return next((name for name in rows.columns if name.lower() == "date"), None)


def kept(rows: DataFrame, as_of: Column, days: int = DEFAULT_DAYS) -> DataFrame:
    """Rows that retention leaves. On a date-partitioned table only kept folders are read."""
    return rows.where(F.col(date_column(rows)) >= F.date_sub(as_of, days))


def retention_report(
    tables: dict[str, DataFrame], as_of: Column, days: int = DEFAULT_DAYS
) -> DataFrame:
    """Rows kept and dropped per table; tables without a date column are left out."""
    parts = []
    for name, rows in tables.items():
        column = date_column(rows)
        if column:
            parts.append(
                rows.select(
                    F.lit(name).alias("table"),
                    (F.col(column) < F.date_sub(as_of, days)).alias("old"),
                )
            )
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("table")
        .agg(
            F.count(F.when(~F.col("old") | F.col("old").isNull(), 1)).alias("rows_kept"),
            F.count(F.when(F.col("old"), 1)).alias("rows_dropped"),
        )
    )


def sweep_lake(
    lake: Lake, as_of: date, days: int = DEFAULT_DAYS, tables: list[str] | None = None
) -> dict[str, list[str]]:
    """Delete the old days of a lake's tables, in every load; the days that went, by table.

    Whole folders go, no row is rewritten.
    """
    limit = as_of - timedelta(days=days)
    return {table: lake.drop_days(table, limit) for table in tables or lake.tables()}


def sweep(
    spark: SparkSession, database: str, as_of: str, days: int = DEFAULT_DAYS
) -> dict[str, list[str]]:
    """Delete old days from every catalog table that has a date column; the days that went, by table.

    A table that is partitioned by date loses its folders, whatever partition
    columns stand around the date, and its catalog entries. Any other table with a
    date column is rewritten without the old rows.
    """
    dropped = {}
    limit = date.fromisoformat(as_of) - timedelta(days=days)
    for table in spark.catalog.listTables(database):
        if table.isTemporary:
            continue
        name = f"`{database}`.`{table.name}`"
        columns = spark.catalog.listColumns(f"{database}.{table.name}")
        column = next((c for c in columns if c.name.lower() == "date"), None)
        if column is None:
            continue
        clear = _drop_partitions if column.isPartition else _rewrite
        dropped[table.name] = clear(spark, name, column.name, limit)
    return dropped


def _location(spark: SparkSession, name: str) -> str:
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
    return details.first()["data_type"]


def _drop_partitions(spark: SparkSession, name: str, column: str, limit: date) -> list[str]:
    # The partition list holds one entry per load and day.
    # The folders of a lake's table go by its commit log, so that its readers see them go.
    location = _location(spark, name)
    root, table = location.rstrip("/").rsplit("/", 1)
    lake = Lake(spark, root)
    logged = lake.log(table).exists()
    if logged:
        lake.drop_days(table, limit)
    gone = set()
    for (partition,) in spark.sql(f"SHOW PARTITIONS {name}").collect():
        values = dict(part.split("=", 1) for part in partition.split("/"))
        day = values[column]
        if is_day(day) and date.fromisoformat(day) < limit:
            spec = ", ".join(f"`{key}`='{value}'" for key, value in values.items())
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
            if not logged:
                remove_folder(spark, f"{location}/{partition}")
            gone.add(day)
    return sorted(gone)


def _rewrite(spark: SparkSession, name: str, column: str, limit: date) -> list[str]:
    """Replace a table by its kept rows. They are complete in a folder of their own before the old ones go."""
    rows = spark.table(name)
    old = F.col(column) < F.lit(limit)
    gone = [row[0].isoformat() for row in rows.where(old).select(column).distinct().collect()]
    if gone:
        left = materialize(rows.where(~old | old.isNull()), "kept-rows")
        left.write.mode("overwrite").insertInto(name)
    return sorted(gone)
