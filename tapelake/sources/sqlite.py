"""Tables of SQLite files as a Spark data source, read in ranges of row ids."""

from __future__ import annotations

import sqlite3
from collections.abc import Callable, Iterable, Iterator
from contextlib import closing
from datetime import date, datetime
from typing import Any

from pyspark.sql import datasource as D
from pyspark.sql import types as T

# Dates and times are texts in ISO form there; other values are taken as they are.
FROM_TEXT: dict[type, Callable[[Any], Any]] = {
    T.DateType: lambda value: date.fromisoformat(value[:10]),
    T.TimestampType: lambda value: datetime.fromisoformat(value),
    T.TimestampNTZType: lambda value: datetime.fromisoformat(value),
    T.BooleanType: bool,
    T.DoubleType: float,
    T.StringType: str,
}

# Row ids may be sparse; ranges grow so that no table makes more tasks.
MOST_TASKS = 10_000

COMPARISONS = {
    D.EqualTo: "=",
    D.GreaterThan: ">",
    D.GreaterThanOrEqual: ">=",
    D.LessThan: "<",
    D.LessThanOrEqual: "<=",
}


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def opened(path: str) -> closing[sqlite3.Connection]:
    """A connection that only reads."""
    place = path.removeprefix("file:").replace("?", "%3f").replace("#", "%23")
    return closing(sqlite3.connect(f"file:{place}?mode=ro", uri=True))


class RowIds(D.InputPartition):
    """Row ids from a first to a last one."""

    def __init__(self, first: int, last: int):
        self.first = first
        self.last = last


class SqliteTable(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def reader(self, schema: T.StructType) -> D.DataSourceReader:
        pushes = self.options.get("pushdown", "false") == "true"
        return (FilteredReader if pushes else Reader)(schema, self.options)


class Reader(D.DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema = schema
        self.path = options["path"]
        self.table = quoted(options["table"])
        self.step = int(options["rows_per_task"])
        self.conditions: list[str] = []
        self.values: list[Any] = []

    def partitions(self) -> list[RowIds]:
        with opened(self.path) as file:
            low, high = file.execute(f"SELECT min(rowid), max(rowid) FROM {self.table}").fetchone()
        if low is None:
            return [RowIds(1, 0)]
        step = max(self.step, -(-(high - low + 1) // MOST_TASKS))
        return [RowIds(at, min(at + step - 1, high)) for at in range(low, high + 1, step)]

    def read(self, partition: RowIds) -> Iterator[tuple]:
        columns = ", ".join(quoted(name) for name in self.schema.names) or "1"
        where = " AND ".join(["rowid BETWEEN ? AND ?", *self.conditions])
        values = [partition.first, partition.last, *self.values]
        convert = [FROM_TEXT.get(type(f.dataType), lambda value: value) for f in self.schema]
        with opened(self.path) as file:
            for row in file.execute(f"SELECT {columns} FROM {self.table} WHERE {where}", values):
                yield tuple(
                    None if value is None else change(value)
                    for change, value in zip(convert, row, strict=True)
                )


class FilteredReader(Reader):
    """Hands filters to the file. Spark tests them again, so the file may keep too many rows."""

    def pushFilters(self, filters: list[D.Filter]) -> Iterable[D.Filter]:
        for one in filters:
            self.push(one)
        return filters

    def push(self, one: D.Filter) -> None:
        column = one.attribute[0] if len(getattr(one, "attribute", ())) == 1 else None
        if column not in self.schema.names:
            return
        kind = type(self.schema[column].dataType)
        if isinstance(one, D.IsNotNull):
            self.conditions.append(f"{quoted(column)} IS NOT NULL")
        elif type(one) in COMPARISONS and kind in (T.StringType, T.LongType, T.IntegerType, T.DateType):
            name, value = quoted(column), one.value
            if kind is T.DateType:
                name, value = f"substr({name}, 1, 10)", value.isoformat()
            elif kind is T.StringType:
                name = f"CAST({name} AS TEXT) COLLATE BINARY"
            self.conditions.append(f"{name} {COMPARISONS[type(one)]} ?")
            self.values.append(value)
