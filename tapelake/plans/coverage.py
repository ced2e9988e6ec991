"""Coverage report over the tables of a lake, as one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.operators.reports import coverage, coverage_with_sizes
from tapelake.sources.tables import Lake, child_folders
from tapelake.specs import COVERAGE_TABLES, TABLES

COVERED = "_coverage"


def market_data_report(lake: Lake, tables: list[str] | None = None) -> DataFrame:
    """Symbols of each table with dates covered, last date and table size."""
    tables = tables or COVERAGE_TABLES
    covered = coverage({name: lake.read(name) for name in tables})
    return coverage_with_sizes(covered, lake.sizes(tables))


def covered_days(lake: Lake, table: str) -> DataFrame:
    """Distinct (symbol, date) of each load that is part of a table, with the load's name.

    They are kept beside the table, in ``_coverage/load=<load>``. Loads without a summary
    yet are read once, their two columns only, and all of them in one job; a load never
    changes, so it is never read again. Days that retention dropped are left out by the
    commit log.
    """
    spark, state = lake.spark, lake.log(table).state()
    folder = f"{lake.path(table)}/{COVERED}"
    symbol = TABLES[table].symbol
    known = {name.split("=", 1)[1] for name in child_folders(spark, folder, "load=*")}
    fresh = sorted(load for load in state.loads if load not in known)
    if fresh:
        schema = TABLES[table].schema.add("load", "string")
        reader = spark.read.schema(schema).option("basePath", lake.path(table))
        paths = [path for path in state.folders() if path.split("/")[0].removeprefix("load=") in set(fresh)]
        rows = reader.parquet(*[f"{lake.path(table)}/{path}" for path in paths])
        found = rows.select("load", F.col(symbol).alias("symbol"), "date").distinct()
        # Appended: another report that does so at the same time writes the same rows again.
        found.repartition("load").write.mode("append").partitionBy("load").parquet(folder)
    live = spark.createDataFrame(
        [(load, day) for load, days in state.loads.items() for day in days], "load string, day string"
    )
    schema = "symbol string, date date, load string"
    if not state.loads:
        return spark.createDataFrame([], schema)
    paths = [f"{folder}/load={load}" for load in state.loads]
    kept = spark.read.schema(schema).option("basePath", folder).parquet(*paths)
    on = (kept["load"] == live["load"]) & (kept["date"].cast("string") == live["day"])
    return kept.join(live, on, "left_semi")


def kept_coverage(lake: Lake, tables: list[str] | None = None) -> DataFrame:
    """``coverage`` of a lake's tables from what is kept of each load: only new loads are read."""
    parts = {}
    for table in tables or COVERAGE_TABLES:
        parts[table] = covered_days(lake, table).select("date", F.col("symbol").alias(TABLES[table].symbol))
    return coverage(parts)
