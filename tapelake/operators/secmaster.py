"""Security master: exchange-info documents to one row per symbol filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILTERS = "filters"


def document_schema(filter_fields: list[str], scalars: list[str], lists: list[str]) -> str:
    """Schema of a document with the named filter and symbol fields, all texts."""
    filters = ",".join(f"{name}:string" for name in filter_fields)
    fields = (
        [f"{name}:string" for name in scalars]
        + [f"{name}:array<string>" for name in lists]
        + [f"{FILTERS}:array<struct<{filters}>>"]
    )
    return f"symbols array<struct<{','.join(fields)}>>"


def parse_documents(texts: DataFrame, schema: str) -> DataFrame:
    """Documents landed as texts in ``value``."""
    return texts.select(F.from_json("value", schema).alias("doc")).select("doc.*")


def security_master(documents: DataFrame) -> DataFrame:
    """One row per filter of each symbol; a symbol without filters has none.

    Columns are the union over all filter kinds, then the symbol's scalars, then
    its lists joined by a comma and a blank. Which fields there are is read off
    the schema of ``documents``.
    """
    symbol = documents.schema["symbols"].dataType.elementType
    filter_fields = symbol[FILTERS].dataType.elementType.names
    others = [field for field in symbol if field.name != FILTERS]
    lists = [f.name for f in others if isinstance(f.dataType, T.ArrayType)]
    scalars = [f.name for f in others if f.name not in lists]
    rows = documents.select(F.explode("symbols").alias("symbol")).select(
        "symbol", F.explode(f"symbol.{FILTERS}").alias("filter")
    )
    return rows.select(
        *[F.col(f"filter.{name}").alias(name) for name in filter_fields],
        *[F.col(f"symbol.{name}").alias(name) for name in scalars],
        *[F.concat_ws(", ", f"symbol.{name}").alias(name) for name in lists],
    )
