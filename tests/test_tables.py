"""Landing, registry, tables, retention, and streams."""

from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tapelake.operators.book import book_updates
from tapelake.plans import maintenance, top_of_book
from tapelake.plans.coverage import market_data_report
from tapelake.plans.feeds import quarantine_rows, table_rows
from tapelake.sources import landing, tables
from tapelake.specs import TABLES, TOP_OF_BOOK
from tapelake.streaming import ingest
from tapelake.streaming.book import start_top_of_book
from tapelake.workspace import new_folder
from test_book import random_messages
from test_parsers import text

TRADES = "binance_trade_data_stream"


@pytest.fixture
def lake(spark):
    return tables.Lake(spark, new_folder(spark, "test-lake"))


@pytest.fixture
def trades(frames):
    return table_rows(frames("binance", "trade", *[text(t=i) for i in range(20)]), TRADES)


def test_landing_roundtrip(spark, frames):
    path = new_folder(spark, "test-landing")
    df = frames("binance", "trade", text(), "not\tjson", "")
    landing.write_landing(df, path)
    got = landing.read_landing(spark, path).select(df.columns)
    assert sorted(got.collect()) == sorted(df.collect())
    spark.createDataFrame([("no stamp",)], "value string").write.text(
        f"{path}/exchange=kraken/feed=trade"
    )
    (row,) = landing.read_landing(spark, path).where("exchange = 'kraken'").collect()
    assert row.value == "no stamp" and row.recv_ts is not None


def test_registry(spark):
    path = new_folder(spark, "test-registry")
    lines = ["table_name,subscription_id,colnames_json", 't1,"btcusdt@trade, dogebtc@trade",x.json',
             "t2,!ticker@arr,y.json", "t3,XBT/USD,z.json"]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    wanted = landing.subscriptions(landing.read_registry(spark, path), "subscription_id")
    rows = spark.createDataFrame(
        [("t1", "BTCUSDT"), ("t1", "ETHUSDT"), ("t1", "DOGEBTC"), ("t2", "ANY"), ("t3", "XBT/USD"),
         ("t3", "ETH/USD"), ("t4", "BTCUSDT"), ("t1", "BTCUSDT")],
        "table_name string, symbol string",
    )
    got = sorted(tuple(r) for r in landing.subscribed(rows, wanted).collect())
    assert got == [("t1", "BTCUSDT"), ("t1", "BTCUSDT"), ("t1", "DOGEBTC"), ("t2", "ANY"),
                   ("t3", "XBT/USD")]


def test_append_keeps_schema_and_order(spark, lake, trades):
    lake.append(trades, TRADES)
    lake.append(trades, TRADES)
    read = lake.read(TRADES)
    assert [(f.name, f.dataType) for f in read.schema] == [
        (f.name, f.dataType) for f in TABLES[TRADES].schema
    ]
    assert read.count() == 40
    assert lake.tables() == [TRADES]
    (size,) = lake.sizes([TRADES]).collect()
    assert size.total_bytes > 0 and size.size_readable.endswith("KiB")


def test_truncate(lake, trades):
    lake.append(trades, TRADES)
    lake.truncate(TRADES)
    assert lake.read(TRADES).count() == 0
    lake.append(trades, TRADES)
    assert lake.read(TRADES).count() == 20


def test_hot_date_is_spread_and_sorted(spark, lake):
    schema = TABLES["gemini_multimarketdata_trades"].schema
    rows = spark.range(200_000).select(
        *[
            F.lit(datetime.date(2024, 1, 1)).alias(f.name) if f.name == "date"
            else (F.col("id") * 7919 % 200_000).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "256k")
    try:
        lake.append(rows, "gemini_multimarketdata_trades")
    finally:
        spark.conf.set(advisory, before)
    read = spark.read.parquet(lake.path("gemini_multimarketdata_trades"))
    placed = read.select("timestamp", "_metadata.file_path", "_metadata.row_index")
    in_file = Window.partitionBy("file_path").orderBy("row_index")
    steps = placed.withColumn("before", F.lag("timestamp").over(in_file))
    assert placed.count() == 200_000
    assert placed.select("file_path").distinct().count() > 1
    assert steps.where("before > timestamp").count() == 0


def test_sql_raises(lake, trades):
    lake.append(trades, TRADES)
    trades.limit(1).createOrReplaceTempView(TRADES)
    (row,) = lake.sql(f"SELECT count(*) AS n FROM {{{TRADES}}}", [TRADES]).collect()
    assert row.n == 20
    assert trades.sparkSession.table(TRADES).count() == 1
    trades.sparkSession.catalog.dropTempView(TRADES)
    with pytest.raises(Exception, match="no_such_column"):
        lake.sql(f"SELECT no_such_column FROM {{{TRADES}}}", [TRADES])


def test_dry_run_counts(trades):
    assert tables.dry_run(trades) == 20


def test_snapshot_has_one_header_per_file(spark, trades):
    path = tables.write_snapshot(trades, new_folder(spark, "test-csv"), "trades", datetime.date(2024, 1, 1))
    assert path.endswith("trades_20240101")
    back = tables.read_snapshot(spark, path, trades.schema)
    assert sorted(back.collect()) == sorted(trades.collect())


def test_first_messages(frames):
    df = frames("binance", "ticker", *[f"m{i}" for i in range(9)])
    assert [r.value for r in tables.first_messages(df, 3).collect()] == ["m0", "m1", "m2"]


def test_coverage_report(lake, trades):
    lake.append(trades, TRADES)
    (row,) = market_data_report(lake, [TRADES]).collect()
    assert (row.symbol, row.date_count, row.table) == ("BTCUSDT", 1, TRADES)
    assert row.total_gb > 0


def test_catalog_sweep(spark, lake, trades):
    days = trades.crossJoin(spark.range(4)).withColumn(
        "date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))
    )
    spark.sql("CREATE DATABASE IF NOT EXISTS sweep_test")
    spark.sql("USE sweep_test")
    try:
        lake.append(days, TRADES)
        lake.append(days, TRADES)
        lake.create(TRADES)
        spark.sql("CREATE TABLE no_date (a int) USING parquet")
        spark.sql("CREATE TABLE flat (a int, DATE date) USING parquet")
        flat = days.select(F.lit(1).alias("a"), F.col("date").alias("DATE"))
        flat.union(spark.sql("SELECT 2, CAST(NULL AS DATE)")).write.insertInto("flat")
        dropped = maintenance.sweep(spark, "sweep_test", "2024-01-04", days=2)
        assert dropped == {TRADES: ["2024-01-01"], "flat": ["2024-01-01"]}
        assert spark.table(TRADES).count() == lake.read(TRADES).count() == 120
        assert not tables.child_folders(spark, lake.path(TRADES), "load=*/date=2024-01-01")
        assert spark.table("flat").count() == 61
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE sweep_test CASCADE")


def test_retention_report_skips_tables_without_a_date(spark, trades):
    upper = trades.withColumnRenamed("date", "DATE")
    other = spark.range(3)
    as_of = F.lit("2024-01-07").cast("date")
    got = maintenance.retention_report({"a": trades, "b": upper, "c": other}, as_of).collect()
    assert sorted(tuple(r) for r in got) == [("a", 0, 20), ("b", 0, 20)]
    assert maintenance.kept(trades, F.lit("2024-01-06").cast("date")).count() == 20


def test_stream_resumes_without_duplicates(spark, lake, frames):
    path, offsets = new_folder(spark, "test-landing"), new_folder(spark, "test-offsets")
    for part in range(3):
        messages = [text(t=part * 10 + i) for i in range(10)] + ["{", '{"result":null,"id":1}']
        landing.write_landing(frames("binance", "trade", *messages), path)
        query = ingest.start_table(landing.stream_landing(spark, path, 1), TRADES, lake, offsets)
        query.awaitTermination()
        counted = ingest.counters(lake, query)
        assert counted["rows_processed"] == 10 * (part + 1)
        assert counted["rows_rejected"] == 0
    again = ingest.start_table(landing.stream_landing(spark, path), TRADES, lake, offsets)
    again.awaitTermination()
    assert ingest.counters(lake, again) == counted
    assert lake.read(ingest.QUARANTINE).count() == 3
    got = lake.read(TRADES)
    assert sorted(r.trade_id for r in got.collect()) == list(range(30))
    batch = table_rows(landing.read_landing(spark, path), TRADES)
    assert sorted(got.collect()) == sorted(batch.collect())


def test_fanout_feeds_tables_and_quarantine(spark, lake, frames):
    path = new_folder(spark, "test-landing")
    landing.write_landing(frames("binance", "trade", text(), text(p="x"), "{"), path)
    landing.write_landing(
        frames("kraken", "trade", '[1,[["1","2","3","b","l",""]],"trade","A"]', "{}"), path
    )
    fed = [TRADES, "kraken_trade_data_stream"]
    query = ingest.start_fanout(
        landing.stream_landing(spark, path), lake, new_folder(spark, "test-offsets"), fed
    )
    query.awaitTermination()
    assert [lake.read(t).count() for t in fed] == [1, 1]
    rejects = lake.read(ingest.QUARANTINE).select("table", "reason").collect()
    assert sorted(tuple(r) for r in rejects) == [(TRADES, "bad price"), (TRADES, "malformed")]


def test_run_for_stops(spark, lake, frames):
    path = new_folder(spark, "test-landing")
    landing.write_landing(frames("binance", "trade", text()), path)
    query = ingest.start_table(
        landing.stream_landing(spark, path), TRADES, lake, new_folder(spark, "test-offsets"),
        available_now=False,
    )
    counted = ingest.run_for(query, 8, lake)
    assert not query.isActive
    assert counted == {"rows_processed": 1, "rows_rejected": 0, "inserts": 1}


def test_counters_outlast_the_session_s_memory_of_updates(spark, lake, frames):
    path, offsets = new_folder(spark, "test-landing"), new_folder(spark, "test-offsets")
    for part in range(10):
        landing.write_landing(frames("binance", "trade", text(t=part)).coalesce(1), path)
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(kept, "2")
    try:
        query = ingest.start_table(landing.stream_landing(spark, path, 1), TRADES, lake, offsets)
        query.awaitTermination()
    finally:
        spark.conf.unset(kept)
    assert len(query.recentProgress) <= 2
    counted = ingest.counters(lake, query)
    assert counted == {"rows_processed": 10, "rows_rejected": 0, "inserts": 10}


def test_all_writers_share_a_table(spark, lake, frames, trades):
    """The README's example: an append, a stream, two fan-outs, and an append again."""
    path = new_folder(spark, "test-landing")
    landing.write_landing(frames("binance", "trade", *[text(t=i) for i in range(20)]), path)
    lake.append(trades, TRADES)
    for start in (
        lambda *a: ingest.start_table(a[0], TRADES, *a[1:]),
        lambda *a: ingest.start_fanout(*a, [TRADES]),
        lambda *a: ingest.start_fanout(*a, [TRADES]),
    ):
        start(landing.stream_landing(spark, path), lake, new_folder(spark, "o")).awaitTermination()
    lake.append(trades, TRADES)
    assert lake.read(TRADES).groupBy("trade_id").count().select("count").distinct().collect() == [(5,)]
    assert len(lake.loads(TRADES)) == 5
    lake.compact(TRADES)
    assert len(lake.loads(TRADES)) == 1
    assert lake.read(TRADES).count() == 100


def test_a_repeated_batch_replaces_its_own_rows(lake, trades):
    lake.append(trades, TRADES, "query-0")
    lake.append(trades, TRADES, "query-1")
    lake.append(trades, TRADES, "query-0")
    assert lake.read(TRADES).count() == 40


def test_records_are_judged_one_by_one(frames):
    both = "[" + text(t=1) + ',{"x":1}]'
    landed = frames("binance", "trade", both, '{"x":1}')
    assert [r.trade_id for r in table_rows(landed, TRADES).collect()] == [1]
    reasons = sorted(r.reason for r in quarantine_rows(landed, TRADES).collect())
    assert reasons == ["no symbol", "unknown message"]


def test_book_stream_keeps_its_rejects(spark, lake, frames):
    path = new_folder(spark, "test-landing")
    broken = ["{", '{"events":[]}']
    landing.write_landing(frames("coinbase", "level2", *random_messages(3, 20, 0.0), *broken), path)
    query = start_top_of_book(landing.stream_landing(spark, path), lake, new_folder(spark, "o"))
    query.awaitTermination()
    assert sorted(r.reason for r in lake.read(ingest.QUARANTINE).collect()) == ["malformed", "no channel"]
    counted = ingest.counters(lake, query)
    assert counted["rows_rejected"] == 2
    assert counted["rows_processed"] == lake.read(TOP_OF_BOOK).count() > 0


@pytest.mark.parametrize(("drift", "restart"), [(0.0, 0), (2.0, 0), (0.0, 130)])
def test_streamed_book_equals_batch(spark, lake, frames, drift, restart):
    """With ``restart``, the numbers begin anew behind so many messages."""
    messages = random_messages(11, 300 - restart, drift) + random_messages(12, restart, drift)
    path, offsets = new_folder(spark, "test-landing"), new_folder(spark, "test-offsets")
    whole = frames("coinbase", "level2", *messages)
    for start in range(0, 300, 100):
        seconds = F.unix_seconds("recv_ts") - 1704067200
        part = whole.where((seconds >= start) & (seconds < start + 100))
        landing.write_landing(part, path)
        start_top_of_book(landing.stream_landing(spark, path), lake, offsets).awaitTermination()
    batch = top_of_book.top_of_book(whole).collect()
    assert len(batch) > 50
    assert sorted(lake.read(TOP_OF_BOOK).collect()) == sorted(batch)


def test_updates_schema(frames):
    message = json.loads(random_messages(1, 1, 0.0)[0])
    df = book_updates(frames("coinbase", "level2", json.dumps(message)))
    assert df.count() == len(message["events"][0]["updates"])
