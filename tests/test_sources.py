"""Layout of compacted tables, pruned landing folders, tables of SQLite files."""

from __future__ import annotations

import datetime
import sqlite3

import pytest
from pyspark.sql import functions as F

from tapelake.operators import reports
from tapelake.sources import external, landing
from tapelake.sources.sqlite import FilteredReader
from tapelake.sources.tables import Lake
from tapelake.streaming import ingest
from tapelake.workspace import new_folder
from test_parsers import text

TRADES = "binance_trade_data_stream"
SCHEMA = "symbol string, event_time bigint, price double, date date"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def test_compaction_parts_the_files_of_a_date(spark):
    lake = Lake(spark, new_folder(spark, "test-lake"))
    rows = spark.range(40_000).select(
        F.concat(F.lit("s"), (F.xxhash64("id") % 7).cast("string")).alias("symbol"),
        F.when(F.col("id") % 50 > 0, F.col("id") % 3_600).alias("event_time"),
        (F.col("id") / 3).alias("price"),
        F.expr("date_add(DATE '2024-01-01', CAST(id % 9 = 0 AS INT))").alias("date"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in lake.read(TRADES).schema
          if f.name not in ("symbol", "event_time", "price", "date")],
    )
    for part in range(2):
        lake.append(rows.where(F.col("event_time") % 2 == part), TRADES)
    lake.append(rows.where("event_time IS NULL"), TRADES)
    size = lake._bytes(TRADES, lake.log(TRADES).state())
    lake.compact(TRADES, file_bytes=size // 12)
    found = lake.read(TRADES)
    columns = ["symbol", "event_time", "price", "date"]
    assert found.select(columns).exceptAll(rows.select(columns)).count() == 0
    assert found.count() == 40_000
    sort_key = [c for c in ("event_time", "symbol") if c in found.columns]
    files = {}
    for row in found.where("event_time IS NOT NULL").select("date", "event_time", "_metadata.file_path").collect():
        files.setdefault((row.date, row.file_path), []).append(row.event_time)
    assert sort_key and len(files) >= 10
    for day in {day for day, _ in files}:
        spans = sorted((min(v), max(v)) for (own, _), v in files.items() if own == day)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    hour = found.where("date = DATE '2024-01-01' AND event_time BETWEEN 100 AND 200")
    opened = hour.select("_metadata.file_path").distinct().count()
    assert opened <= 3 < len([1 for day, _ in files if day == datetime.date(2024, 1, 1)])


def test_equal_keys_are_spread_over_files(spark):
    lake = Lake(spark, new_folder(spark, "test-lake"))
    rows = spark.range(20_000).select(F.hash("id").alias("x"), F.expr("DATE '2024-01-01'").alias("date"))
    lake.append(rows, "other")
    size = lake._bytes("other", lake.log("other").state())
    lake.compact("other", file_bytes=size // 8)
    found = lake.read("other").groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(found) >= 8 and max(r["count"] for r in found) < 5_000


def test_compacting_nothing(spark):
    lake = Lake(spark, new_folder(spark, "test-lake"))
    lake.compact(TRADES)
    assert lake.read(TRADES).count() == 0


def test_feeds_nobody_asked_for_are_not_opened(spark, frames, tmp_path):
    path = str(tmp_path / "landing")
    landing.write_landing(frames("binance", "trade", text(), text(t=2)), path)
    landing.write_landing(frames("kraken", "ohlc", "[]"), path)
    # A file that cannot be read: opening it would end the query.
    (tmp_path / "landing" / "exchange=kraken" / "feed=ohlc" / "torn.gz").write_bytes(b"no gzip")
    registry = str(tmp_path / "registry")
    lines = ["table_name,subscription_id", f'{TRADES},"btcusdt@trade, dogebtc@trade"', "unknown,!x"]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(registry)
    wanted = landing.subscriptions(landing.read_registry(spark, registry), "subscription_id")
    got = landing.subscribed_frames(landing.read_landing(spark, path), wanted)
    assert got.count() == 2 and got.columns == landing.LANDING_COLUMNS
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="FAILED_READ_FILE|end of input"):
        landing.read_landing(spark, path).collect()
    assert landing.subscribed_frames(landing.read_landing(spark, path), wanted.where("false")).count() == 0


@pytest.fixture
def runs(tmp_path):
    """A run table with gaps in its row ids, missing values and an odd name."""
    path = str(tmp_path / "runs ?#.db")
    with sqlite3.connect(path) as file:
        file.execute('CREATE TABLE "dag ""run" (dag_id TEXT, state TEXT, execution_date TEXT, '
                     "last_scheduling_decision TEXT, tries INTEGER, secret BLOB)")
        rows = [(i * 7 + 1, f"d{i % 5}", ("success", "running", None)[i % 3], f"2024-01-{i % 28 + 1:02d}",
                 None if i % 11 == 0 else f"2024-02-{i % 28 + 1:02d} 10:00:00.5", i, b"x") for i in range(1_000)]
        file.executemany('INSERT INTO "dag ""run" (rowid, dag_id, state, execution_date, '
                         "last_scheduling_decision, tries, secret) VALUES (?, ?, ?, ?, ?, ?, ?)", rows)
        file.execute("CREATE TABLE empty (dag_id TEXT)")
    return path, rows


RUN_SCHEMA = "dag_id string, state string, execution_date date, last_scheduling_decision timestamp, tries bigint"


@pytest.mark.parametrize("allowed", ["false", "true"])
def test_run_table_of_an_sqlite_file(spark, runs, allowed):
    path, rows = runs
    spark.conf.set(PUSHDOWN, allowed)
    try:
        found = external.read_sqlite(spark, path, 'dag "run', RUN_SCHEMA, rows_per_task=500)
        assert found.rdd.getNumPartitions() > 10
        assert sorted(r.tries for r in found.collect()) == list(range(1_000))
        picked = found.where("state = 'running' AND execution_date >= DATE '2024-01-20' AND tries < 900")
        want = sorted(r[5] for r in rows if r[2] == "running" and r[3] >= "2024-01-20" and r[5] < 900)
        assert sorted(r.tries for r in picked.collect()) == want
        assert found.where("state IS NULL").count() == 333
        assert found.where("last_scheduling_decision IS NULL").count() == 91
        first = found.where("tries = 1").first()
        assert first.last_scheduling_decision == datetime.datetime(2024, 2, 2, 10, 0, 0, 500_000)
        kpis = reports.run_status(found, F.lit("2000-01-01").cast("date")).first()
        assert (kpis.dags_finished, kpis.dags_running, kpis.dags_failed) == (5, 5, 5)
        assert external.read_sqlite(spark, path, "empty", "dag_id string").count() == 0
    finally:
        spark.conf.unset(PUSHDOWN)


def test_filters_and_columns_reach_the_file(runs):
    from pyspark.sql import datasource as D
    from pyspark.sql import types as T

    path, rows = runs
    schema = T.StructType.fromDDL("state string, execution_date date")
    reader = FilteredReader(schema, {"path": path, "table": 'dag "run', "rows_per_task": "100000"})
    filters = [D.EqualTo(("state",), "running"), D.IsNotNull(("state",)), D.StringContains(("state",), "x"),
               D.LessThan(("execution_date",), datetime.date(2024, 1, 10))]
    assert list(reader.pushFilters(filters)) == filters
    (part,) = reader.partitions()
    got = list(reader.read(part))
    want = [r for r in rows if r[2] == "running" and r[3] < "2024-01-10"]
    assert len(got) == len(want) and all(len(row) == 2 and row[0] == "running" for row in got)


def test_errors_of_writers_side_by_side_are_raised():
    done = []

    def fails():
        raise ValueError("disk")

    with pytest.raises(ValueError, match="disk"):
        ingest.side_by_side([lambda: done.append(1), fails, *[lambda: done.append(2)] * 20])
    assert len(done) == 21


def test_a_torn_micro_batch_is_completed(spark, frames, monkeypatch):
    """A writer of the fan-out fails after others committed; the batch run again adds what lacks."""
    lake = Lake(spark, new_folder(spark, "test-lake"))
    path, offsets = new_folder(spark, "test-landing"), new_folder(spark, "test-offsets")
    landing.write_landing(frames("binance", "trade", text(), text(p="x"), "{"), path)
    landing.write_landing(frames("kraken", "trade", '[1,[["1","2","3","b","l",""]],"trade","A"]', "{}"), path)
    fed, append = [TRADES, "kraken_trade_data_stream"], Lake.append

    def torn(self, rows, table, load=None):
        if table == fed[1]:
            raise OSError("lost")
        return append(self, rows, table, load)

    monkeypatch.setattr(Lake, "append", torn)
    query = ingest.start_fanout(landing.stream_landing(spark, path), lake, offsets, fed)
    with pytest.raises(Exception, match="lost"):
        query.awaitTermination()
    monkeypatch.setattr(Lake, "append", append)
    ingest.start_fanout(landing.stream_landing(spark, path), lake, offsets, fed).awaitTermination()
    assert [lake.read(t).count() for t in fed] == [1, 1]
    assert lake.read(ingest.QUARANTINE).count() == 2
    lines = {r["table"]: r["rows_processed"] for r in lake.read(ingest.COUNTERS).collect()}
    assert lines == dict.fromkeys(fed, 1)


def test_days_of_one_file_are_not_cut(spark):
    """A task of a compaction sorts one file's rows, and small days stay whole."""
    lake = Lake(spark, new_folder(spark, "test-lake"))
    day = F.expr("date_add(DATE '2024-01-01', CAST(id % 9 AS INT))")
    lake.append(spark.range(18_000).select(F.hash("id").alias("x"), day.alias("date")), "other")
    lake.append(spark.range(5).select(F.hash("id").alias("x"), F.lit(None).cast("date").alias("date")), "other")
    size = lake._bytes("other", lake.log("other").state())
    lake.compact("other", file_bytes=size // 3)
    found = lake.read("other").groupBy("date", F.col("_metadata.file_path")).count().collect()
    assert sorted(row["count"] for row in found) == [5, *[2_000] * 9]


def test_landing_files_are_compressed_and_cut(spark, frames, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "FRAMES_PER_FILE", 10)
    path = str(tmp_path / "landing")
    values = [f"{i}\n" for i in range(25)]
    landing.write_landing(frames("kraken", "ohlc", *values).coalesce(1), path)
    files = list((tmp_path / "landing" / "exchange=kraken" / "feed=ohlc").glob("part-*"))
    assert len(files) == 3 and all(file.name.endswith(".lz4") for file in files)
    assert sorted(row["value"] for row in landing.read_landing(spark, path).collect()) == sorted(values)
