"""Typed parquet tables in one folder, partitioned by load and ingest date.

All writers share one layout, ``<table>/load=<id>/date=<day>/*.parquet``, and the
commit log of the table says which of these folders are part of it: rows count from
the moment their load is committed. A batch append takes a new load, a stream writes
each micro-batch as a load named after query and batch. A name is taken in once: a
batch that is run again adds nothing, also after its rows were compacted.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapelake.functions.columns import readable_size, size_gb
from tapelake.sources.commits import CommitLog, Conflict, State
from tapelake.specs import TABLES, TableSpec
from tapelake.workspace import remove_folder


PARTITIONS_AT_ONCE = 500

# Compaction cuts a table into files of about this size.
FILE_BYTES = 256 * 1024 * 1024

NO_DAY = "__HIVE_DEFAULT_PARTITION__"  # the folder of rows without a date


class Lake:
    """Tables under ``root``, each a folder ``root/<table>/load=.../date=.../*.parquet``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def log(self, table: str) -> CommitLog:
        return CommitLog(self.spark, self.path(table))

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """A table with its declared schema, as of its newest or an earlier version.

        Other tables have the schema that was written last. What is read stays as it is
        while loads are added or compacted.
        """
        return self._rows(table, self.log(table).state(version))

    def _rows(self, table: str, state: State) -> DataFrame:
        declared = TABLES[table].schema if table in TABLES else None
        paths = [f"{self.path(table)}/{folder}" for folder in state.folders()]
        if not paths:
            if declared is None and state.schema is None:
                raise ValueError(f"{self.path(table)} holds no table")
            schema = declared or T.StructType.fromJson(json.loads(state.schema))
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.option("basePath", self.path(table))
        if declared is None:
            return reader.option("mergeSchema", True).parquet(*paths).drop("load")
        return reader.schema(declared).parquet(*paths).select(declared.names)

    def append(self, rows: DataFrame, table: str, load: str | None = None) -> str:
        """Add rows as one load, sorted by the table's sort key inside each file.

        Rows are rebalanced by date: small dates share a task, and a date that
        holds most rows is split over many. Sorted files let readers skip row
        groups by the sort key. One pass, nothing is sampled first. A load whose
        name was taken in before adds nothing; without a name it is new.
        """
        name = load or uuid.uuid4().hex
        log = self.log(table)
        if name in log.state().names:
            return name
        folder, days = self._write(rows, table, name)
        schema = rows.select(TABLES[table].schema.names).schema if table in TABLES else rows.schema

        def change(state: State) -> dict | None:
            if name in state.names:
                return None
            add = {folder: days} if days else {}
            return {"kind": "append", "add": add, "names": [name], "schema": schema.json()}

        if folder not in log.commit(change).loads:
            remove_folder(self.spark, f"{self.path(table)}/load={folder}")
        return name

    def _write(
        self, rows: DataFrame, table: str, name: str, files: dict[str, int] | None = None
    ) -> tuple[str, list[str]]:
        """Write rows to a folder of their own, not yet part of the table: its name and days.

        With the number of files of each day, a task writes one file: a whole day, or a range
        of the sort key of a day with several; a hash of the row parts rows of equal keys.
        """
        if table in TABLES:
            rows = rows.select(TABLES[table].schema.names)
        sort_key = TABLES[table].sort_key if table in TABLES else ()
        folder = f"{name}.{uuid.uuid4().hex[:8]}"
        path = f"{self.path(table)}/load={folder}"
        if files is None:
            placed = rows.hint("rebalance", F.col("date"))
        else:
            large = [day for day, number in files.items() if number > 1]
            is_large = F.coalesce(F.col("date").cast("string"), F.lit(NO_DAY)).isin(large)
            cuts = [F.when(is_large, c) for c in (*map(F.col, sort_key), F.xxhash64(*rows.columns))]
            placed = rows.repartitionByRange(max(1, sum(files.values())), "date", *(cuts if large else []))
        (
            placed.sortWithinPartitions("date", *sort_key)
            .write.partitionBy("date")
            .parquet(path)
        )
        return folder, [f.split("=", 1)[1] for f in child_folders(self.spark, path, "date=*")]

    def loads(self, table: str) -> list[str]:
        """Loads that make up a table, from its log alone."""
        return sorted(self.log(table).state().loads)

    def compact(self, table: str, file_bytes: int = FILE_BYTES) -> str:
        """Rewrite the present loads of a table as one, in one commit; the new load.

        The files of a date get ranges of the sort key that do not overlap, each of about
        ``file_bytes``, so readers leave out whole files by their footers. A task sorts the
        rows of one file, however many days there are. Spark samples the ranges, for which
        it reads the rows once more than it writes them.
        Rows and names stay the same. Readers and writers may run meanwhile: loads that
        arrive are left as they are, and the old files stay until ``vacuum``. If another
        compaction or retention took away what is being rewritten, it starts again.
        """
        log = self.log(table)
        while True:
            old = log.state()
            files = {day: max(1, math.ceil(n / file_bytes)) for day, n in self._day_bytes(table, old).items()}
            folder, days = self._write(self._rows(table, old), table, uuid.uuid4().hex, files)

            def change(state: State, old=old, folder=folder, days=days) -> dict:
                if any(state.loads.get(load) != own for load, own in old.loads.items()):
                    raise Conflict(table)
                return {"kind": "compact", "add": {folder: days} if days else {}, "drop": old.loads}

            try:
                log.commit(change)
                return folder
            except Conflict:
                remove_folder(self.spark, f"{self.path(table)}/load={folder}")

    def _bytes(self, table: str, state: State) -> int:
        return sum(self._day_bytes(table, state).values())

    def _day_bytes(self, table: str, state: State) -> dict[str, int]:
        """Bytes on disk of each day of a version."""
        paths = [f"{self.path(table)}/{folder}" for folder in state.folders()]
        if not paths:
            return {}
        day = F.regexp_extract("path", "/date=([^/]*)/", 1).alias("day")
        found = listed_files(self.spark, paths).groupBy(day).agg(F.sum("length").alias("bytes"))
        return {row["day"]: row["bytes"] for row in found.collect()}  # a line for each day

    def truncate(self, table: str) -> None:
        """Remove all rows of a table and keep the table, its schema, and the names taken in."""
        self._drop(table, lambda day: True, "truncate")

    def drop_days(self, table: str, before: date) -> list[str]:
        """Drop all days before a day, in one commit, and delete their folders; the days that went.

        The log knows the days of every load, so no folder is listed.
        """
        return self._drop(
            table, lambda day: is_day(day) and date.fromisoformat(day) < before, "retention"
        )

    def _drop(self, table: str, goes: Callable[[str], bool], kind: str) -> list[str]:
        dropped: dict[str, list[str]] = {}

        def change(state: State) -> dict | None:
            dropped.clear()
            for load, days in state.loads.items():
                if own := [day for day in days if goes(day)]:
                    dropped[load] = own
            return {"kind": kind, "drop": dict(dropped)} if dropped else None

        left = self.log(table).commit(change).loads
        for load, days in dropped.items():
            folders = [f"load={load}/date={day}" for day in days] if load in left else [f"load={load}"]
            for folder in folders:
                remove_folder(self.spark, f"{self.path(table)}/{folder}")
        return sorted({day for days in dropped.values() for day in days})

    def vacuum(self, table: str, older_than: float = 86_400) -> list[str]:
        """Delete loads that are not part of the table and were written some seconds ago; their names.

        These are what compaction replaced and what writers left behind that died before
        their commit. The limit protects running writers, and readers of earlier versions.
        """
        kept = self.log(table).state().loads
        limit = (time.time() - older_than) * 1000
        gone = []
        for folder, changed in child_statuses(self.spark, self.path(table), "load=*"):
            load = folder.split("=", 1)[1]
            if load not in kept and changed <= limit:
                remove_folder(self.spark, f"{self.path(table)}/{folder}")
                gone.append(load)
        self.log(table).forget()
        return gone

    def create(self, table: str) -> str:
        """Put a table of this folder into the catalog, with the loads it has; the statement."""
        statement = create_statement(TABLES[table], self.path(table))
        self.spark.sql(statement)
        places = [
            f"PARTITION (load='{load}', date='{day}')"
            for load, days in self.log(table).state().loads.items()
            for day in days
        ]
        for at in range(0, len(places), PARTITIONS_AT_ONCE):
            some = " ".join(places[at : at + PARTITIONS_AT_ONCE])
            self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {some}")
        return statement

    def tables(self) -> list[str]:
        """Names of the tables found in the folder."""
        return child_folders(self.spark, self.root, "*")

    def sizes(self, tables: Iterable[str]) -> DataFrame:
        """Bytes on disk of each table: ``table``, ``size_readable``, ``total_gb``.

        Only the file listing is read, not the rows, and only of loads that are part of the table.
        """
        return table_sizes(
            self.spark,
            {
                table: [f"{self.path(table)}/{f}" for f in self.log(table).state().folders()]
                for table in tables
            },
        )

    def sql(self, query: str, tables: Iterable[str]) -> DataFrame:
        """Result of a query that names tables of this folder as ``{table}``.

        Errors are raised, not printed. The session's own views are not touched.
        """
        return self.spark.sql(query, **{table: self.read(table) for table in tables})


def create_statement(spec: TableSpec, path: str) -> str:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema)
    return (
        f"CREATE TABLE IF NOT EXISTS {spec.name} ({columns}, `load` string) "
        f"USING parquet PARTITIONED BY (load, date) LOCATION '{path}'"
    )


def child_folders(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Folders below ``root`` that fit a pattern, relative to it; files are not listed."""
    return [folder for folder, _ in child_statuses(spark, root, pattern)]


def child_statuses(spark: SparkSession, root: str, pattern: str) -> list[tuple[str, int]]:
    """Folders below ``root`` that fit a pattern, and when they changed, in milliseconds."""
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = top.getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(top, pattern)) or []
    depth = pattern.count("/") + 1
    return sorted(
        ("/".join(status.getPath().toString().split("/")[-depth:]), status.getModificationTime())
        for status in found
        if status.isDirectory()
    )


def is_day(text: str) -> bool:
    try:
        date.fromisoformat(text)
    except ValueError:
        return False
    return True


def listed_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path`` and ``length`` of the parquet files below a folder or several, contents unread."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", "length")
    )


def table_sizes(spark: SparkSession, paths: dict[str, str | list[str]]) -> DataFrame:
    """Size of each named file, folder or list of folders; empty lists are left out."""
    sizes = spark.createDataFrame([], "table string, length long")
    for table, path in paths.items():
        if not path:
            continue
        one = listed_files(spark, path).select(F.lit(table).alias("table"), "length")
        sizes = sizes.unionByName(one)
    total = F.col("total_bytes")
    return (
        sizes.groupBy("table")
        .agg(F.sum("length").alias("total_bytes"))
        .select("table", total, readable_size(total).alias("size_readable"),
                size_gb(total).alias("total_gb"))
    )


def dry_run(rows: DataFrame) -> int:
    """Run the whole plan without keeping its rows and return their number."""
    counter = Observation("dry_run")
    counted = rows.observe(counter, F.count(F.lit(1)).alias("rows"))
    counted.write.format("noop").mode("overwrite").save()
    return counter.get["rows"]


def write_snapshot(rows: DataFrame, folder: str, name: str, day: date) -> str:
    """CSV snapshot ``<name>_<yyyymmdd>`` with a header line in every file."""
    path = f"{folder}/{name}_{day:%Y%m%d}"
    rows.write.option("header", True).csv(path)
    return path


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def first_messages(frames: DataFrame, n: int) -> DataFrame:
    """The ``n`` messages that arrived first; ties go by text."""
    return frames.orderBy("recv_ts", "value").limit(n)
