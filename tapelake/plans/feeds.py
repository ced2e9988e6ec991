"""Landing frames to table rows, feed by feed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.operators.messages import CONTROL, DATA, REJECT, decode
from tapelake.operators.rows import accepted, message_rows, quarantined
from tapelake.specs import TABLES, TOP_OF_BOOK

# The tables whose rows come straight from single messages.
STATELESS = [name for name in TABLES if name != TOP_OF_BOOK]


def table_rows(landing: DataFrame, table: str) -> DataFrame:
    """Good rows of one stateless feed, typed and with audit columns."""
    spec = TABLES[table]
    return accepted(message_rows(decode(landing, table), spec), spec)


def quarantine_rows(landing: DataFrame, table: str) -> DataFrame:
    return quarantined(message_rows(decode(landing, table), TABLES[table]))


def message_kinds(landing: DataFrame, tables: list[str] | None = None) -> DataFrame:
    """Number of data, control and rejected messages of each feed."""
    kinds = [decode(landing, name).select("exchange", "feed", "kind") for name in tables or TABLES]
    return (
        reduce(DataFrame.unionByName, kinds)
        .groupBy("exchange", "feed", "kind")
        .agg(F.count(F.lit(1)).alias("messages"))
    )


def ingest_counters(landing: DataFrame, tables: list[str] | None = None) -> DataFrame:
    """One line per table: messages by kind, rows taken and rows set aside.

    One pass over the frames of each table serves all its counters.
    """
    lines = [
        message_rows(decode(landing, name), TABLES[name]).select(
            F.lit(name).alias("table"), "kind", "at", "misfit"
        )
        for name in tables or STATELESS
    ]
    return reduce(DataFrame.unionByName, lines).groupBy("table").agg(*_counts())


def row_counters(rows: DataFrame, table: str) -> DataFrame:
    """``ingest_counters`` of one table from its ``message_rows``."""
    return rows.agg(*_counts()).withColumn("table", F.lit(table))


def _counts() -> list[Column]:
    is_row, good = F.col("at").isNotNull(), F.col("misfit").isNull()
    first_line = F.coalesce(F.col("at"), F.lit(0)) == 0

    def count_where(condition: Column, name: str) -> Column:
        return F.count(F.when(condition, 1)).alias(name)

    return [
        *(
            count_where(first_line & (F.col("kind") == k), f"{k}_messages")
            for k in (DATA, CONTROL, REJECT)
        ),
        count_where(is_row & good, "rows_processed"),
        count_where(is_row & ~good, "rows_rejected"),
    ]
