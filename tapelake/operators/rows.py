"""Decoded messages into typed rows, and the rows that do not fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.functions.columns import iso_nanos, utc_date
from tapelake.specs import Field, TableSpec


def coerce(text: str, type_: str) -> str:
    """Text as the declared type, NULL where it does not fit. Strings stay texts."""
    if type_ == "string":
        return text
    if type_ == "nanos":
        return iso_nanos(text)
    return f"try_cast({text} AS {type_})"


def audit_columns(recv_ts: str) -> list[Column]:
    """Ingest date (UTC) and ingest time in microseconds."""
    return [
        F.expr(f"{utc_date(recv_ts)} AS date"),
        F.expr(f"unix_micros({recv_ts}) AS insert_time"),
    ]


def message_rows(decoded: DataFrame, spec: TableSpec) -> DataFrame:
    """One line per record, and one without a record for a message that has none.

    Holds the table's columns and audit columns, ``kind`` and ``value`` of the
    message, the record's place ``at`` in it (NULL without a record), ``rejected``:
    why the message is rejected, and ``misfit``: the first column whose text does
    not fit its type; both NULL if all is well. Columns follow the key map in
    order, other keys are dropped. Good rows, bad rows and counts all come from
    this one pass.
    """
    records = decoded.select(
        "recv_ts",
        "value",
        "kind",
        "msg",
        F.col("reason").alias("rejected"),
        F.posexplode_outer("records").alias("at", "row"),
    )
    values = [F.expr(f"{coerce(_text(f), f.type)} AS `{f.column}`") for f in spec.fields]
    return records.select(
        *values,
        *audit_columns("recv_ts"),
        "kind",
        "value",
        "at",
        "rejected",
        _misfit(spec).alias("misfit"),
    )


def typed_rows(decoded: DataFrame, spec: TableSpec) -> DataFrame:
    """The records only, good and bad."""
    return message_rows(decoded, spec).where(F.col("at").isNotNull())


def accepted(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Good rows, in the columns of the table."""
    good = F.col("at").isNotNull() & F.col("misfit").isNull()
    return rows.where(good).select(spec.schema.names)


def quarantined(rows: DataFrame) -> DataFrame:
    """Raw text and reason of every rejected message and every rejected row."""
    reason = F.coalesce("rejected", "misfit")
    return rows.where(reason.isNotNull()).select(
        "value", reason.alias("reason"), "date", "insert_time"
    )


def _text(field: Field) -> str:
    return f"msg.`{field.key}`" if field.from_message else f"row.`{field.column}`"


def _misfit(spec: TableSpec) -> Column:
    symbol = next(f for f in spec.fields if f.column == spec.symbol)
    tests = [] if symbol.from_message else [
        f"CASE WHEN at IS NOT NULL AND {_text(symbol)} IS NULL THEN 'no {symbol.column}' END"
    ]
    tests += [
        f"CASE WHEN {_text(f)} IS NOT NULL AND {coerce(_text(f), f.type)} IS NULL "
        f"THEN 'bad {f.column}' END"
        for f in spec.fields
        if f.type != "string"
    ]
    return F.expr(f"coalesce({', '.join(tests)})")
