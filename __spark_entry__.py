"""

Every query builds exchange messages from the whole driver tables with Spark
(``tapelake.samples``) and runs the library over them.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import date
from functools import partial

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import oracles
from tapelake import samples
from tapelake.operators import book, frames, relay, reports, secmaster
from tapelake.operators.messages import CONTROL, decode, route
from tapelake.operators.rows import audit_columns, typed_rows
from tapelake.plans import feeds, maintenance, top_of_book
from tapelake.plans.coverage import kept_coverage, market_data_report
from tapelake.sources import external, landing, tables
from tapelake.specs import COVERAGE_TABLES, TABLES, TOP_OF_BOOK
from tapelake.streaming import book as stream_book
from tapelake.streaming import ingest
from tapelake.workspace import new_folder

BINANCE_TRADES = "binance_trade_data_stream"
BINANCE_TICKER = "binance_symbol_ticker_stream"
GEMINI = "gemini_multimarketdata_trades"
KRAKEN_TRADES = "kraken_trade_data_stream"

# Parameters of the queries. The oracle SQL uses the same values.
RETENTION_DAY = "2024-01-20"
RUNS_SINCE = "2001-01-01"
UPSERT_FROM = "2024-01-16"
SNAPSHOT_DAY = date(2024, 1, 31)
CAPTURED_MESSAGES = 201
SMALL_FILE_BYTES = 64 * 1024
CROSSING_SHIFT = -20.0
REGISTRY = [
    (BINANCE_TRADES, "s0@trade, s2@trade ,s4@trade"),
    (BINANCE_TICKER, "!ticker@arr"),
]

MASTER = secmaster.document_schema(
    ["filterType", "minPrice", "minQty"], ["symbol", "status"], ["orderTypes"]
)

Query = Callable[[SparkSession, str], DataFrame]

# The training-data operators are an optional part: the library works without them.
try:
    import corpus_pipeline
    from tapelake.llm import queries as llm

    LLM_QUERIES = llm.queries() | {"pipeline": corpus_pipeline.run}
    LLM_SQL = llm.oracle_sql()
except ImportError:  # without the package, or a library that only it needs
    LLM_QUERIES, LLM_SQL = {}, {}


def entry(spark: SparkSession) -> DataFrame:
    """Top of book of the level-2 feed at the smallest scale."""
    return coinbase_top_of_book(spark, "/root/testdata/sf0.001")


# Feeds -----------------------------------------------------------------------


def feed_rows(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return feeds.table_rows(samples.FEEDS[table](spark, sf_dir), table)


def feed_query(table: str) -> Query:
    return lambda spark, sf_dir: feed_rows(spark, sf_dir, table)


def coinbase_top_of_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_of_book.top_of_book(samples.coinbase_level2(spark, sf_dir))


def tob_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two connections, a year apart, that number their messages alike."""
    landed = samples.coinbase_level2(spark, sf_dir)
    again = landed.withColumn("recv_ts", F.col("recv_ts") + F.expr("INTERVAL 365 DAYS"))
    return top_of_book.top_of_book(landed.unionByName(again))


def coinbase_l2_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.book_updates(samples.coinbase_level2(spark, sf_dir)).drop("recv_us", "digest", "at")


def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "landing")
    landing.write_landing(samples.binance_trades(spark, sf_dir), path)
    return landing.read_landing(spark, path).select(
        "exchange",
        "feed",
        F.unix_micros("recv_ts").alias("recv_us"),
        F.get_json_object("value", "$.t").cast("bigint").alias("trade_id"),
    )


def subscription_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = spark.createDataFrame(REGISTRY, "table_name string, subscription_id string")
    rows = frames.union_by_name(
        [
            feed_rows(spark, sf_dir, table).select(
                F.lit(table).alias("table_name"), "symbol", "event_time"
            )
            for table in (BINANCE_TRADES, BINANCE_TICKER)
        ]
    )
    return landing.subscribed(rows, landing.subscriptions(registry, "subscription_id"))


def subscribed_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed frames of the subscribed feeds; the folders of the others are not opened."""
    path, registry = new_folder(spark, "landing"), new_folder(spark, "registry")
    landing.write_landing(samples.all_frames(spark, sf_dir), path)
    lines = spark.createDataFrame(REGISTRY, "table_name string, subscription_id string")
    lines.write.option("header", True).csv(registry)
    wanted = landing.subscriptions(landing.read_registry(spark, registry), "subscription_id")
    frames_in = landing.subscribed_frames(landing.read_landing(spark, path), wanted)
    return frames_in.groupBy("exchange", "feed").agg(F.count(F.lit(1)).alias("frames"))


def binance_control_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode(samples.binance_trades(spark, sf_dir), BINANCE_TRADES)
    return decoded.where(F.col("kind") != CONTROL).select(
        "kind", F.get_json_object("value", "$.t").cast("bigint").alias("trade_id")
    )


def numeric_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode(samples.binance_trades_with_rejects(spark, sf_dir), BINANCE_TRADES)
    return typed_rows(decoded, TABLES[BINANCE_TRADES]).select(
        "trade_id", "symbol", "price", "quantity", "market_maker", F.col("misfit").alias("reason")
    )


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.binance_book_ticker(spark, sf_dir).select(
        F.get_json_object("value", "$.u").cast("bigint").alias("order_book_updateid"),
        *audit_columns("recv_ts"),
    )


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = samples.binance_trades_with_rejects(spark, sf_dir)
    return feeds.quarantine_rows(landed, BINANCE_TRADES).select("reason", "date", "insert_time")


def message_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.message_kinds(samples.all_frames(spark, sf_dir))


def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = samples.all_frames(spark, sf_dir)
    unnamed = landed.withColumn("feed", F.when(F.col("exchange") != "kraken", F.col("feed")))
    return route(unnamed).groupBy("table").agg(F.count(F.lit(1)).alias("messages"))


def ingest_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {**samples.FEEDS, BINANCE_TRADES: samples.binance_trades_with_rejects}
    landed = frames.union_by_name([parts[name](spark, sf_dir) for name in feeds.STATELESS])
    return feeds.ingest_counters(landed)


def envelope_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    inner = relay.stream_messages(samples.envelopes(spark, sf_dir))
    return feeds.table_rows(inner, BINANCE_TRADES)


def relay_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relay.relay_latency(samples.envelopes(spark, sf_dir)).select(
        "stream", "recv_us", F.round("latency_ms", 1).alias("latency_ms")
    )


def master_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = samples.exchange_info(spark, sf_dir)
    return secmaster.security_master(secmaster.parse_documents(documents, MASTER))


def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames with line ends, tabs, backslashes, missing texts and connections, written and read."""
    between = F.element_at(
        F.array(*map(F.lit, ("\n", "\r\n", "\t", "\\n", "\\", ""))), (F.col("event_id") % 6 + 1).cast("int")
    )
    user = F.col("user_id").cast("string")
    odd = samples.events(spark, sf_dir).select(
        F.lit("binance").alias("exchange"),
        F.lit("trade").alias("feed"),
        F.when(
            F.col("event_id") % 7 != 0, F.concat(F.lit("a"), F.col("event_id").cast("string"), between, F.lit("b"))
        ).alias("value"),
        F.col("ts").alias("recv_ts"),
        F.when(F.col("user_id") % 4 != 0, F.concat(user, between)).alias("connection"),
    )
    path = new_folder(spark, "landing")
    landing.write_landing(odd, path)
    back = landing.read_landing(spark, path, connections=True)
    return back.select("value", "connection", F.unix_micros("recv_ts").alias("recv_us"))


def latency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latency of each stream and day from hourly sketches, and whether its percentiles keep their bound."""
    latency = relay.relay_latency(samples.envelopes(spark, sf_dir))
    hourly = relay.hourly_latency(latency)
    days = relay.latency_summary(relay.merged_latency(hourly, ["stream", F.to_date("hour").alias("date")]))
    days = days.withColumn("of", F.col("stream")).drop("stream")
    day = F.to_date(F.timestamp_micros("recv_us"))
    rows = latency.join(days, (F.col("stream") == F.col("of")) & (day == F.col("date")))
    ms, n = F.col("latency_ms"), F.col("messages")
    within = []
    for rank in (50, 95, 99):
        at = F.col(f"p{rank}_ms")
        below, upto = F.count(F.when(ms < at, 1)) / n, F.count(F.when(ms <= at, 1)) / n
        good = (below <= rank / 100 + 0.01) & (upto >= rank / 100 - 0.01)
        within.append(good.alias(f"p{rank}_within"))
    shown = [F.round(c, 1).alias(c) for c in ("min_ms", "mean_ms", "max_ms")]
    keys = ["stream", "date", "messages", *shown]
    return rows.groupBy(*keys, "p50_ms", "p95_ms", "p99_ms").agg(*within).drop("p50_ms", "p95_ms", "p99_ms")


def security_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through files of exchange-info documents."""
    path = new_folder(spark, "exchange-info")
    samples.exchange_info(spark, sf_dir).select("value").write.text(path)
    documents = external.read_exchange_info(spark, path, MASTER, one_per_line=True)
    return _numbers(secmaster.security_master(documents))


def _numbers(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {name: F.col(name).try_cast("double") for name in ("minPrice", "minQty")}
    )


# Tables ----------------------------------------------------------------------


def new_lake(spark: SparkSession) -> tables.Lake:
    return tables.Lake(spark, new_folder(spark, "lake"))


def sink_append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = new_lake(spark)
    rows = feed_rows(spark, sf_dir, BINANCE_TRADES)
    late = F.col("date") >= F.lit(UPSERT_FROM).cast("date")
    lake.append(rows.where(~late), BINANCE_TRADES)
    lake.append(rows.where(late), BINANCE_TRADES)
    return lake.read(BINANCE_TRADES)


def compact_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table after compaction, batches run again, and a writer that died before its commit."""
    lake = new_lake(spark)
    rows = feed_rows(spark, sf_dir, BINANCE_TRADES)
    late = F.col("date") >= F.lit(UPSERT_FROM).cast("date")
    batches = [rows.where(~late), rows.where(late)]
    for run in range(2):
        for number, batch in enumerate(batches):
            lake.append(batch, BINANCE_TRADES, f"query-{number}")
        if not run:
            lake.compact(BINANCE_TRADES)
    rows.limit(10).write.partitionBy("date").parquet(f"{lake.path(BINANCE_TRADES)}/load=died")
    return lake.read(BINANCE_TRADES)


def compact_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per date after compaction to small files, and files whose keys overlap the one before."""
    lake = new_lake(spark)
    rows = feed_rows(spark, sf_dir, GEMINI)
    for late in (False, True):
        lake.append(rows.where((F.col("date") >= F.lit(UPSERT_FROM).cast("date")) == late), GEMINI)
    lake.compact(GEMINI, file_bytes=SMALL_FILE_BYTES)
    key = F.struct("timestamp", "symbol")
    placed = lake.read(GEMINI).select("date", key.alias("key"), "_metadata.file_path")
    files = placed.groupBy("date", "file_path").agg(
        F.min("key").alias("first"), F.max("key").alias("last"), F.count(F.lit(1)).alias("rows")
    )
    before = F.lag("last").over(Window.partitionBy("date").orderBy("first", "last"))
    checked = files.withColumn("overlaps", F.coalesce(before > F.col("first"), F.lit(False)))
    return checked.groupBy("date").agg(
        F.sum("rows").alias("rows"), F.count(F.when(F.col("overlaps"), 1)).alias("overlaps")
    )


def sorted_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per date of a written table, and rows that break the sort order of a file."""
    lake = new_lake(spark)
    lake.append(feed_rows(spark, sf_dir, GEMINI), GEMINI)
    placed = lake.read(GEMINI).select(
        "date", "timestamp", "symbol", "_metadata.file_path", "_metadata.row_index"
    )
    in_file = Window.partitionBy("file_path").orderBy("row_index")
    key = F.struct("timestamp", "symbol")
    checked = placed.withColumn("breaks", F.lag(key).over(in_file) > key)
    return checked.groupBy("date").agg(
        F.count(F.lit(1)).alias("table_rows"),
        F.count(F.when(F.col("breaks"), 1)).alias("out_of_order"),
    )


def csv_snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = master_rows(spark, sf_dir)
    path = tables.write_snapshot(
        rows, new_folder(spark, "snapshots"), "binance_secmaster", SNAPSHOT_DAY
    )
    return _numbers(tables.read_snapshot(spark, path, rows.schema))


def capture_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = tables.first_messages(samples.binance_ticker(spark, sf_dir), CAPTURED_MESSAGES)
    rows = feeds.table_rows(first, BINANCE_TICKER)
    path = tables.write_snapshot(
        rows, new_folder(spark, "captures"), "binance_ticker", SNAPSHOT_DAY
    )
    return tables.read_snapshot(spark, path, rows.schema)


def sql_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = new_lake(spark)
    lake.append(feed_rows(spark, sf_dir, BINANCE_TRADES), BINANCE_TRADES)
    return lake.sql(
        "SELECT symbol, COUNT(*) AS trades, SUM(quantity) AS volume, MAX(price) AS high "
        f"FROM {{{BINANCE_TRADES}}} GROUP BY symbol",
        [BINANCE_TRADES],
    )


def _consistent_sizes() -> list[Column]:
    """What holds of a size whatever the file encoding."""
    number, unit = F.split("size_readable", " ")[0].cast("double"), F.split("size_readable", " ")[1]
    power = F.array_position(F.array(*map(F.lit, ("B", "KiB", "MiB", "GiB", "TiB"))), unit) - 1
    total = F.col("total_bytes")
    return [
        (total > 0).alias("has_bytes"),
        (F.abs(number * F.pow(F.lit(1024.0), power) - total) <= 0.01 * total).alias("readable_fits"),
        (F.abs(F.col("total_gb") - total * 1e-9) <= 1e-12 * total).alias("gb_fits"),
    ]


def table_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = (
        "region nation customer supplier part orders lineitem events documents embeddings "
        "pages benchmark labels conversations"
    )
    sizes = tables.table_sizes(spark, {n: f"{sf_dir}/{n}.parquet" for n in names.split()})
    return sizes.select("table", *_consistent_sizes())


def coverage_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return coinbase_top_of_book(spark, sf_dir) if name == TOP_OF_BOOK else feed_rows(spark, sf_dir, name)


def coverage_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: coverage_table(spark, sf_dir, name) for name in COVERAGE_TABLES}


def coverage_with_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = new_lake(spark)

    def write(name: str) -> None:
        lake.append(coverage_table(spark, sf_dir, name), name)

    # The book takes many short jobs; the other tables are written beside them.
    names = sorted(COVERAGE_TABLES, key=lambda name: name != TOP_OF_BOOK)
    ingest.side_by_side([partial(write, name) for name in names])
    return market_data_report(lake).select(
        "symbol", "date_count", "last_date", "table", *_consistent_sizes()[:1], *_consistent_sizes()[2:]
    )


# Reports ---------------------------------------------------------------------


def symbol_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.symbol_coverage(feed_rows(spark, sf_dir, BINANCE_TRADES))


def coverage_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.coverage(coverage_tables(spark, sf_dir))


def coverage_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage from what is kept of each load, after appends, a compaction and retention."""
    lake = new_lake(spark)
    names = [BINANCE_TRADES, GEMINI, KRAKEN_TRADES]
    late = F.col("date") >= F.lit(UPSERT_FROM).cast("date")
    for name in names:
        lake.append(feed_rows(spark, sf_dir, name).where(~late), name)
    kept_coverage(lake, names)
    for name in names:
        lake.append(feed_rows(spark, sf_dir, name).where(late), name)
    lake.compact(GEMINI)
    kept_coverage(lake, names)
    maintenance.sweep_lake(lake, date.fromisoformat(RETENTION_DAY))
    return kept_coverage(lake, names)


def readable_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapelake.functions.columns import readable_size, size_gb

    # Keys above a million have cubes that no bigint holds; their sizes are still shown.
    key = F.col("o_orderkey").cast("decimal(19,0)")
    size = (key * key * key * 7 + key % 1024).alias("size")
    return samples.table(spark, sf_dir, "orders").select("o_orderkey", size).select(
        "o_orderkey",
        F.col("size").try_cast("bigint").alias("total_bytes"),
        readable_size(F.col("size")).alias("size_readable"),
        size_gb(F.col("size")).alias("total_gb"),
    )


def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.value_counts(feed_rows(spark, sf_dir, GEMINI), "type")


def run_status_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.run_status(samples.job_runs(spark, sf_dir), F.lit(RUNS_SINCE).cast("date"))


def active_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.active_runs(samples.job_runs(spark, sf_dir), F.lit(RUNS_SINCE).cast("date"))


def retention_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feed_rows(spark, sf_dir, BINANCE_TRADES)
    return maintenance.kept(rows, F.lit(RETENTION_DAY).cast("date"))


def retention_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    swept = {name: feed_rows(spark, sf_dir, name) for name in feeds.STATELESS}
    swept["orders"] = samples.table(spark, sf_dir, "orders")
    return maintenance.retention_report(swept, F.lit(RETENTION_DAY).cast("date"))


# Frames ----------------------------------------------------------------------


def outer_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest level of the days before and after a day, the later one preferred."""
    latest_bins = _bins(spark, sf_dir).withColumnRenamed("sequence_num", "seq")
    keys = ["product_id", "side", "lvl"]
    cut = F.unix_micros(F.lit(UPSERT_FROM).cast("timestamp"))

    def latest(rows: DataFrame) -> DataFrame:
        level = F.max_by(F.struct("qty", "event_time", "timestamp", "seq"), "seq")
        return rows.groupBy(*keys).agg(level.alias("level")).select(*keys, "level.*")

    late = F.col("recv_us") >= cut
    return frames.outer_upsert(
        latest(latest_bins.where(~late)), latest(latest_bins.where(late)), keys
    )


def frames_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = feed_rows(spark, sf_dir, KRAKEN_TRADES).select("pair", "price", "volume")
    bars = feed_rows(spark, sf_dir, "kraken_ohlc_stream").select(
        "pair", F.col("open").alias("price"), "volume"
    )
    gemini = feed_rows(spark, sf_dir, GEMINI).select(
        F.col("symbol").alias("pair"), "price", F.col("amount").alias("volume")
    )
    pairs = {"trades and bars": (trades, bars), "gemini and kraken": (gemini, trades)}
    return frames.union_by_name(
        [
            frames.frame_difference(a, b).withColumn("frames", F.lit(name))
            for name, (a, b) in pairs.items()
        ]
    )


def frames_same(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames compared by their digests first: one pair is equal, one is not."""
    trades = feed_rows(spark, sf_dir, KRAKEN_TRADES).select("pair", "price", "volume")
    bars = feed_rows(spark, sf_dir, "kraken_ohlc_stream").select("pair", F.col("open").alias("price"), "volume")
    pairs = {"trades and trades": (trades, trades.repartition(7)), "trades and bars": (trades, bars)}
    return frames.union_by_name(
        [frames.same_rows(a, b).withColumn("frames", F.lit(name)) for name, (a, b) in pairs.items()]
    )


def view_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.distinct_rows(_views(spark, sf_dir).select("product_id", "bid_px", "offer_px"))


def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.union_by_name(
        [
            feed_rows(spark, sf_dir, KRAKEN_TRADES),
            feed_rows(spark, sf_dir, "cryptocom_trade_data_stream"),
        ]
    )


# Order book ------------------------------------------------------------------


def _views(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = top_of_book.book_table(samples.coinbase_level2(spark, sf_dir))
    return book.quote_view(book.best_levels(written))


def _level2_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level-2 frames with, for every user, a cut frame, one without channel and one with a bad price."""
    users = samples.table(spark, sf_dir, "events").select("user_id").distinct()
    bad_price = (
        '{"channel":"l2_data","timestamp":"2024-01-01T00:00:00Z","sequence_num":1,"events":[{"product_id":"X",'
        '"updates":[{"side":"bid","event_time":"2024-01-01T00:00:00Z","price_level":"x","new_quantity":"1"}]}]}'
    )
    broken = users.select(
        F.lit("coinbase").alias("exchange"),
        F.lit("level2").alias("feed"),
        F.explode(F.array(*map(F.lit, ('{"channel":"l2_da', '{"events":[]}', bad_price)))).alias("value"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("user_id") % 3 * 86400).alias("recv_ts"),
    )
    return frames.union_by_name([samples.coinbase_level2(spark, sf_dir), broken])


def book_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.book_rejects(_level2_with_rejects(spark, sf_dir)).select("reason", "date", "insert_time")


def _banded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.price_band(book.book_frames(samples.coinbase_level2(spark, sf_dir)))


def price_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _banded(spark, sf_dir).select(
        "product_id", "sequence_num", "lo_px", "hi_px", F.inline("updates")
    )


def _one_by_one(messages: DataFrame, column: str, *shared: str) -> DataFrame:
    """The structs of an array as rows.

    The filter stands behind the generator: Spark would put its own one for empty arrays
    before it, and work out the array twice.
    """
    return messages.select(*shared, F.inline_outer(column)).where("side IS NOT NULL")


def _bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    binned = book.level_bins(_banded(spark, sf_dir))
    shared = ("product_id", "sequence_num", "timestamp", "recv_us")
    return _one_by_one(binned, "bins", *shared).drop("low_px", "high_px")


def level_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bins(spark, sf_dir).drop("recv_us")


def dense_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    dense = book.dense_levels(book.level_bins(_banded(spark, sf_dir)))
    return _one_by_one(dense, "levels", "product_id", "sequence_num", "timestamp")


def best_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = top_of_book.book_table(samples.coinbase_level2(spark, sf_dir))
    sides = []
    for side in ("bid", "offer"):
        for name, field in (("px", "lvl"), ("sz", "qty"), ("time", "event_time"), ("seq", "seq")):
            sides.append(F.col(f"{side}.{field}").alias(f"{side}_{name}"))
    return book.best_levels(written).select("product_id", F.col("seq").alias("message"), *sides)


def tob_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _views(spark, sf_dir).drop("recv_us", "changed", "crossed")


def tob_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _views(spark, sf_dir).where("changed").drop("recv_us", "changed", "crossed")


def tob_with_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    crossing = samples.coinbase_level2(spark, sf_dir, CROSSING_SHIFT)
    return top_of_book.quotes_with_resets(top_of_book.book_table(crossing))


def reset_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_of_book.reset_counts(tob_with_reset(spark, sf_dir))


# Streams ---------------------------------------------------------------------


def stream_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, path = new_lake(spark), new_folder(spark, "landing")
    landing.write_landing(samples.binance_trades(spark, sf_dir), path)
    ingest.start_table(
        landing.stream_landing(spark, path), BINANCE_TRADES, lake, new_folder(spark, "offsets")
    ).awaitTermination()
    return lake.read(BINANCE_TRADES)


def stream_top_of_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings, each followed by a run that resumes from the checkpoint."""
    lake, path = new_lake(spark), new_folder(spark, "landing")
    offsets = new_folder(spark, "offsets")
    frames_ = samples.coinbase_level2(spark, sf_dir)
    late = F.col("recv_ts") >= F.lit(UPSERT_FROM).cast("timestamp")
    for part in (~late, late):
        landing.write_landing(frames_.where(part), path)
        stream_book.start_top_of_book(
            landing.stream_landing(spark, path), lake, offsets
        ).awaitTermination()
    return lake.read(TOP_OF_BOOK)


def stream_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two connections side by side, a year apart, in a stream that then gets all frames of one again.

    The files of a landing are not in the order of their messages, so it is one micro-batch
    however many there are.
    """
    lake, path = new_lake(spark), new_folder(spark, "landing")
    offsets = new_folder(spark, "offsets")
    first = samples.coinbase_level2(spark, sf_dir).withColumn("connection", F.lit("a"))
    moved = F.col("recv_ts") + F.expr("INTERVAL 365 DAYS")
    other = first.withColumns({"recv_ts": moved, "connection": F.lit("b")})
    again = first.withColumn("recv_ts", F.col("recv_ts") + F.expr("INTERVAL 2 HOURS"))
    for part in (first.unionByName(other), again):
        landing.write_landing(part, path)
        stream_book.start_top_of_book(
            landing.stream_landing(spark, path, landing.ALL_FILES, connections=True), lake, offsets
        ).awaitTermination()
    return lake.read(TOP_OF_BOOK)


def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table and date after one stream has fed several tables."""
    lake, path = new_lake(spark), new_folder(spark, "landing")
    fed = [BINANCE_TRADES, "coinbase_market_trades_stream", GEMINI]
    parts = {**samples.FEEDS, BINANCE_TRADES: samples.binance_trades_with_rejects}
    landing.write_landing(frames.union_by_name([parts[t](spark, sf_dir) for t in fed]), path)
    ingest.start_fanout(
        landing.stream_landing(spark, path), lake, new_folder(spark, "offsets"), fed
    ).awaitTermination()
    rejects = lake.read(ingest.QUARANTINE).select(F.lit(ingest.QUARANTINE).alias("table"), "date")
    written = [lake.read(t).select(F.lit(t).alias("table"), "date") for t in fed]
    return _rows_per_day([*written, rejects])


def _rows_per_day(parts: list[DataFrame]) -> DataFrame:
    """Rows per table and date of frames with those columns."""
    rows = frames.union_by_name(parts)
    return rows.groupBy("table", "date").agg(F.count(F.lit(1)).alias("table_rows"))


def stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters that streams leave in the lake, summed up."""
    lake, path = new_lake(spark), new_folder(spark, "landing")
    parts = {**samples.FEEDS, BINANCE_TRADES: samples.binance_trades_with_rejects}
    landed = [parts[name](spark, sf_dir) for name in feeds.STATELESS]
    landing.write_landing(frames.union_by_name(landed), path)
    ingest.start_fanout(
        landing.stream_landing(spark, path), lake, new_folder(spark, "offsets")
    ).awaitTermination()
    return ingest.stream_counters(lake)


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and rejects per table and date of a table's stream and of the book's stream."""
    lake, path = new_lake(spark), new_folder(spark, "landing")
    landed = [samples.binance_trades_with_rejects(spark, sf_dir), _level2_with_rejects(spark, sf_dir)]
    landing.write_landing(frames.union_by_name(landed), path)
    ingest.start_table(
        landing.stream_landing(spark, path), BINANCE_TRADES, lake, new_folder(spark, "offsets")
    ).awaitTermination()
    stream_book.start_top_of_book(
        landing.stream_landing(spark, path), lake, new_folder(spark, "offsets")
    ).awaitTermination()
    written = [lake.read(t).select(F.lit(t).alias("table"), "date") for t in (BINANCE_TRADES, TOP_OF_BOOK)]
    rejects = lake.read(ingest.QUARANTINE)
    rejects = rejects.select(F.concat_ws(" ", "table", "reason").alias("table"), "date")
    return _rows_per_day([*written, rejects])


def mixed_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per date of one table fed by two appends, a stream and two fan-outs."""
    lake, path = new_lake(spark), new_folder(spark, "landing")
    rows = feed_rows(spark, sf_dir, BINANCE_TRADES)
    landing.write_landing(samples.binance_trades(spark, sf_dir), path)
    lake.append(rows, BINANCE_TRADES)
    for start in (
        lambda *a: ingest.start_table(a[0], BINANCE_TRADES, *a[1:]),
        lambda *a: ingest.start_fanout(*a, [BINANCE_TRADES]),
        lambda *a: ingest.start_fanout(*a, [BINANCE_TRADES]),
    ):
        start(landing.stream_landing(spark, path), lake, new_folder(spark, "offsets")).awaitTermination()
    lake.append(rows, BINANCE_TRADES)
    return _rows_per_day([lake.read(BINANCE_TRADES).select(F.lit(BINANCE_TRADES).alias("table"), "date")])


def retention_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table and date that a sweep of the lake leaves, read back from its files."""
    lake = new_lake(spark)
    for name in (BINANCE_TRADES, GEMINI):
        lake.append(feed_rows(spark, sf_dir, name), name)
        lake.append(feed_rows(spark, sf_dir, name), name)
    maintenance.sweep_lake(lake, date.fromisoformat(RETENTION_DAY))
    return _rows_per_day(
        [lake.read(n).select(F.lit(n).alias("table"), "date") for n in (BINANCE_TRADES, GEMINI)]
    )


def queries() -> dict[str, Query]:
    named = {
        "binance_ticker": feed_query(BINANCE_TICKER),
        "binance_trades": feed_query(BINANCE_TRADES),
        "binance_book_ticker": feed_query("binance_ticker_order_book_stream"),
        "coinbase_trades": feed_query("coinbase_market_trades_stream"),
        "cryptocom_trades": feed_query("cryptocom_trade_data_stream"),
        "gemini_trades": feed_query(GEMINI),
        "kraken_trades": feed_query(KRAKEN_TRADES),
        "kraken_ticker": feed_query("kraken_ticker_stream"),
        "kraken_ohlc": feed_query("kraken_ohlc_stream"),
        "audit_columns": audit,
        "secmaster": security_master,
    }
    for query in (
        coinbase_top_of_book, coinbase_l2_updates, raw_landing, subscription_filter,
        binance_control_filter, numeric_coercion, quarantine, message_kinds, route_counts,
        ingest_counters, envelope_filter, relay_latency, sink_append_roundtrip, sorted_layout,
        csv_snapshot_roundtrip, capture_first_n, sql_entry, table_sizes, coverage_with_sizes,
        symbol_coverage, coverage_all, readable_size, value_counts, run_status_kpis, active_runs,
        retention_keep, retention_sweep, outer_upsert, frames_equal, view_dedup, union_by_name,
        price_band, level_bins, dense_levels, best_levels, tob_view, tob_changes, tob_with_reset,
        stream_trades, stream_top_of_book, stream_fanout, stream_counters, stream_quarantine,
        mixed_writers, retention_delete, book_rejects, tob_connections, landing_roundtrip,
        latency_summary, compact_rerun, coverage_kept, frames_same, stream_connections,
        compact_clustered, subscribed_landing, reset_counts,
    ):
        named[query.__name__] = query
    return named | LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    return oracles.sql() | LLM_SQL
