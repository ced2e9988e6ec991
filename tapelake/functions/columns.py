"""Scalar expressions. All are built-in functions, none is a Python UDF.

Expressions that are generated for every field of a table are SQL texts: a table
then costs a few calls into the JVM instead of some for each operator.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000

# Binary units of the readable size, smallest first.
SIZE_UNITS = ["B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB"]


def iso_nanos(text: str) -> str:
    """Nanoseconds since the epoch of an ISO-8601 text, NULL if it is none.

    Timestamps hold microseconds; the seventh to ninth digit of a fraction is
    read from the text, and only where the text is long enough to have one.
    """
    longest = len("2024-01-01T00:00:00.000000Z")
    below_micros = f"rpad(regexp_extract({text}, '\\\\.\\\\d{{6}}(\\\\d{{1,3}})', 1), 3, '0')"
    return (
        f"unix_micros(try_to_timestamp({text})) * 1000 + coalesce("
        f"CASE WHEN length({text}) > {longest} THEN try_cast({below_micros} AS BIGINT) END, 0)"
    )


def utc_date(ts: str) -> str:
    """UTC calendar date of a timestamp, whatever the session time zone."""
    return f"date_from_unix_date(CAST(floor(unix_micros({ts}) / {MICROS_PER_DAY}) AS INT))"


def trimmed_list(text: Column) -> Column:
    """Parts of a comma-separated list without surrounding blanks."""
    return F.transform(F.split(text, ","), lambda part: F.trim(part))


def readable_size(size: Column) -> Column:
    """Byte count as text with a 1024-based unit and two decimals."""
    size = size.cast("double")
    text = None
    for power in range(len(SIZE_UNITS) - 1, -1, -1):
        unit = float(1024**power)
        shown = F.format_string(f"%.2f {SIZE_UNITS[power]}", size / F.lit(unit))
        if text is None:
            text = F.when(size >= unit, shown)
        else:
            text = text.when((size >= unit) if power else F.lit(True), shown)
    return F.when(size.isNotNull(), text)


def size_gb(size: Column) -> Column:
    return size.cast("double") * F.lit(1e-9)
