"""What the operators of this package share: safe input columns and byte text."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_AT_ONCE = 256
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def inputs(docs: DataFrame, **wanted: str) -> DataFrame:
    """The named input columns under the operator's own names, and nothing else.

    Extra columns of any name are left behind, so they cannot clash.
    """
    return docs.select(*(docs[column].alias(name) for name, column in wanted.items()))


def spare_name(label: str) -> str:
    """A column name that no table has by chance."""
    return f"_{label}_{uuid.uuid4().hex[:12]}"


def ascii_lower(text: Column) -> Column:
    """Lower case of A-Z only; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def slices(table: pa.Array | pa.RecordBatch) -> Iterator[pa.Array | pa.RecordBatch]:
    """An Arrow batch in parts of a few rows, so that few texts are Python objects at a time."""
    for start in range(0, len(table), ROWS_AT_ONCE):
        yield table.slice(start, ROWS_AT_ONCE)


def utf8(texts: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    for part in slices(texts):
        for value in part.cast(pa.binary()).to_pylist():
            yield value or b""


def strings(texts: pa.Array) -> Iterator[str]:
    """Each text; null counts as empty."""
    for part in slices(texts):
        for value in part.to_pylist():
            yield value or ""


def crc_remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key written as text, modulo ``divisor``; a null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(divisor))
