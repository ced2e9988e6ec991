"""Dashboard queries: coverage, value counts, scheduler runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.specs import TABLES


def symbol_coverage(rows: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Per symbol: number of dates with rows, and the last date.

    Grouping by (symbol, date) first leaves one row per pair on the map side, so
    a symbol with most rows sends no more than its dates to one task.
    """
    return _covered(rows.select(F.col(symbol).alias("symbol"), "date"), ["symbol"])


def _covered(dates: DataFrame, keys: list[str]) -> DataFrame:
    return (
        dates.distinct()
        .groupBy(*keys)
        .agg(F.count("date").alias("date_count"), F.max("date").alias("last_date"))
    )


def coverage(tables: dict[str, DataFrame]) -> DataFrame:
    """``symbol_coverage`` of several tables, with a ``table`` column, in two shuffles for all."""
    parts = [
        rows.select(
            F.col(TABLES[name].symbol).alias("symbol"), "date", F.lit(name).alias("table")
        )
        for name, rows in tables.items()
    ]
    return _covered(reduce(DataFrame.unionByName, parts), ["table", "symbol"])


def coverage_with_sizes(covered: DataFrame, sizes: DataFrame) -> DataFrame:
    """Coverage rows with the size of their table, NULL where it is unknown.

    ``sizes`` has one row per table, and tables are a fixed short list.
    """
    named = sizes.where(F.col("table").isin(list(TABLES)))
    return covered.join(F.broadcast(named), "table", "left")


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def runs_since(runs: DataFrame, day: Column) -> DataFrame:
    """Runs that were decided on or after a day. Reaches a source as a filter."""
    return runs.where(F.col("last_scheduling_decision") >= day)


def run_status(runs: DataFrame, day: Column) -> DataFrame:
    """Number of jobs with a run that succeeded, runs, or did neither.

    A missing state counts as neither.
    """
    state = F.coalesce("state", F.lit(""))
    status = F.when(state.isin("success", "running"), state).otherwise("failed")
    jobs = runs_since(runs, day).select("dag_id", status.alias("status")).distinct()

    def counted(name: str) -> Column:
        return F.count(F.when(F.col("status") == name, 1))

    return jobs.agg(
        counted("success").alias("dags_finished"),
        counted("running").alias("dags_running"),
        counted("failed").alias("dags_failed"),
    )


def active_runs(runs: DataFrame, day: Column) -> DataFrame:
    return runs_since(runs, day).where(F.col("state") == "running").select(
        "dag_id", "execution_date"
    )
