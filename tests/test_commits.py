"""The commit log of a table, landing records, kept coverage, digests and latency sketches."""

from __future__ import annotations

import datetime
import threading

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapelake.operators import frames as frame_ops
from tapelake.operators import relay
from tapelake.plans import coverage, top_of_book
from tapelake.plans.feeds import table_rows
from tapelake.sources import commits, landing, tables
from tapelake.sources.commits import CommitLog, Names
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
    rows = table_rows(frames("binance", "trade", *[text(t=i) for i in range(20)]), TRADES)
    return rows.withColumn("date", F.date_add("date", (F.col("trade_id") % 4).cast("int")))


def ids(rows) -> list[int]:
    return sorted(r.trade_id for r in rows.select("trade_id").collect())


def test_a_batch_run_again_after_compaction_adds_nothing(lake, trades):
    lake.append(trades, TRADES, "query-0")
    lake.append(trades.where("trade_id < 5"), TRADES, "query-1")
    lake.compact(TRADES)
    lake.append(trades, TRADES, "query-0")
    lake.append(trades.where("trade_id < 5"), TRADES, "query-1")
    assert ids(lake.read(TRADES)) == sorted([*range(20), *range(5)])
    lake.truncate(TRADES)
    lake.append(trades, TRADES, "query-1")
    assert lake.read(TRADES).count() == 0
    lake.append(trades, TRADES, "query-2")
    assert lake.read(TRADES).count() == 20


@pytest.mark.parametrize("step", ["append", "compact"])
def test_a_crash_before_the_commit_leaves_the_table_as_it_was(lake, trades, monkeypatch, step):
    lake.append(trades, TRADES, "query-0")
    before = lake.log(TRADES).state().version

    def crash(self, change):
        raise KeyboardInterrupt

    with monkeypatch.context() as broken:
        broken.setattr(CommitLog, "commit", crash)
        with pytest.raises(KeyboardInterrupt):
            lake.append(trades, TRADES, "query-1") if step == "append" else lake.compact(TRADES)
    assert ids(lake.read(TRADES)) == list(range(20))
    assert lake.log(TRADES).state().version == before
    assert not lake.vacuum(TRADES)  # too young to go
    assert len(lake.vacuum(TRADES, older_than=0)) == 1
    lake.append(trades, TRADES, "query-1")
    assert lake.read(TRADES).count() == 40


def test_a_reader_during_compaction_sees_its_version(lake, trades):
    lake.append(trades, TRADES)
    lake.append(trades, TRADES)
    reader = lake.read(TRADES)
    lake.compact(TRADES)
    lake.append(trades, TRADES)
    assert reader.count() == 40 and lake.read(TRADES).count() == 60
    assert [lake.read(TRADES, version).count() for version in (1, 2, 3, 4)] == [20, 40, 40, 60]
    assert len(lake.vacuum(TRADES, older_than=0)) == 2
    assert lake.read(TRADES).count() == 60
    with pytest.raises(ValueError, match="no version"):
        lake.read(TRADES, 9)


def test_compaction_beside_retention_starts_again(lake, trades, monkeypatch):
    lake.append(trades, TRADES)
    lake.append(trades, TRADES)
    limit = datetime.date(2024, 1, 2)
    write, runs = tables.Lake._write, []

    def write_late(self, rows, table, name, *files):
        written = write(self, rows, table, name, *files)
        runs.append(name)
        if len(runs) == 1:
            assert self.drop_days(table, limit) == ["2024-01-01"]
        return written

    monkeypatch.setattr(tables.Lake, "_write", write_late)
    lake.compact(TRADES)
    assert len(runs) == 2 and len(lake.loads(TRADES)) == 1
    assert lake.read(TRADES).agg(F.min("date")).first()[0] == limit
    assert lake.read(TRADES).count() == 30


def test_writers_side_by_side_lose_nothing(lake, trades):
    one = trades.where("trade_id = 1")
    threads = [threading.Thread(target=lake.append, args=(one, TRADES, f"w{i}-0")) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert lake.read(TRADES).count() == 4
    assert lake.log(TRADES).state().version == 4


def test_states_start_at_the_last_whole_one(spark, monkeypatch):
    monkeypatch.setattr(commits, "CHECKPOINT", 4)
    log = CommitLog(spark, new_folder(spark, "test-log"))
    for i in range(14):
        log.commit(lambda state, i=i: {"add": {f"l{i}": ["2024-01-01", "2024-01-02"]}, "names": [f"q-{i}"]})
    log.commit(lambda state: {"drop": {"l3": ["2024-01-01"], "l4": ["2024-01-01", "2024-01-02"]}})
    assert log.commit(lambda state: None).version == 15
    state = log.state()
    assert len(state.loads) == 13 and state.loads["l3"] == ["2024-01-02"]
    assert "load=l3/date=2024-01-02" in state.folders() and "load=l5" in state.folders()
    assert state.names.ranges == {"q-": [[0, 13]]}
    assert sum(name.endswith(".state") for name in log.files()) == 3
    assert len(log.state(6).loads) == 6
    log.forget()
    assert log.state().loads == state.loads
    assert len(log.state(9).loads) == 9
    with pytest.raises(ValueError):
        log.state(3)


def test_two_drivers_never_take_the_same_version(spark):
    path = new_folder(spark, "test-log")
    first, second = CommitLog(spark, path), CommitLog(spark, path)

    def beaten(state):
        if state.version == 0:  # the other one is quicker
            assert second._publish('{"add": {"other": ["d"]}}', f"{1:020}.json", replace=False)
        return {"add": {"own": ["d"]}}

    assert first.commit(beaten).version == 2
    assert sorted(first.state().loads) == ["other", "own"]
    assert not [name for name in first.files() if name.startswith(".") and not name.endswith(".crc")]


@given(st.lists(st.tuples(st.sampled_from(["a-", "b", "a-b-", ""]), st.integers(0, 12))))
def test_names(found):
    names, plain = Names(), set()
    for prefix, number in found:
        names.add(f"{prefix}{number}")
        plain.add(f"{prefix}{number}")
    again = Names(sorted(names.plain), names.ranges)
    for prefix in ("a-", "b", "a-b-", ""):
        for number in range(14):
            assert (f"{prefix}{number}" in again) == (f"{prefix}{number}" in plain)
    assert "a-01" not in names


def test_tables_without_rows(lake, trades):
    with pytest.raises(ValueError, match="holds no table"):
        lake.read("unknown")
    assert lake.read(TRADES).count() == 0 and lake.read(TRADES).columns == TABLES[TRADES].schema.names
    lake.append(trades.where("false").select("trade_id", "date"), "other")
    assert lake.read("other").dtypes == [("trade_id", "bigint"), ("date", "date")]
    assert lake.sizes([TRADES]).count() == 0


# Landing ---------------------------------------------------------------------


def test_landing_keeps_every_frame(spark):
    values = ["a\nb", "a\r\nb", "\r", "\n", "\\n", "\\", "\\\\n\n", "a\tb", "", None, "\\N", "+1\t2\t3", "12\tx", "é \\r"]
    rows = [(v, i, c) for i, v in enumerate(values) for c in (None, "", "a\tb\n\\", "x")]
    df = spark.createDataFrame(rows, "value string, s int, connection string").selectExpr(
        "'binance' AS exchange", "'trade' AS feed", "value", "timestamp_seconds(s - 3) AS recv_ts", "connection"
    )
    path = new_folder(spark, "test-landing")
    landing.write_landing(df, path)
    back = landing.read_landing(spark, path, connections=True)
    key = lambda r: (str(r.value), r.recv_ts, str(r.connection))
    assert sorted(back.collect(), key=key) == sorted(df.collect(), key=key)
    assert "connection" not in landing.read_landing(spark, path).columns
    legacy = [('1704067200000000\t{"a":"\\\\n"}',), ("no \\n stamp",)]
    spark.createDataFrame(legacy, "value string").write.text(f"{path}/exchange=kraken/feed=trade")
    old = landing.read_landing(spark, path, connections=True).where("exchange = 'kraken'")
    assert sorted(r.value for r in old.collect()) == ["no \\n stamp", '{"a":"\\\\n"}']


def test_streamed_connections_equal_batch(spark, lake, frames):
    """Two connections side by side, and repeated deliveries in the same and in a later batch."""
    landed = frames("coinbase", "level2", *random_messages(21, 120, 0.0))
    later = F.col("recv_ts") + F.expr("INTERVAL 1 HOUR")
    first = landed.withColumn("connection", F.lit("a"))
    second = frames("coinbase", "level2", *random_messages(22, 120, 0.0)).withColumn("connection", F.lit("b"))
    again = first.withColumn("recv_ts", later)
    early = F.unix_seconds("recv_ts") < 1704067200 + 60
    parts = [
        first.where(early).unionByName(again.where("unix_seconds(recv_ts) < 1704067200 + 3620")),
        second.where(early),
        first.where(~early).unionByName(second.where(~early)),
        again,
    ]
    path, offsets = new_folder(spark, "test-landing"), new_folder(spark, "test-offsets")
    for part in parts:
        landing.write_landing(part, path)
        start_top_of_book(landing.stream_landing(spark, path, connections=True), lake, offsets).awaitTermination()
    batch = top_of_book.top_of_book(landing.read_landing(spark, path, connections=True)).collect()
    assert len(batch) > 50
    assert sorted(lake.read(TOP_OF_BOOK).collect()) == sorted(batch)


# Kept coverage ---------------------------------------------------------------


def test_coverage_is_read_from_what_is_kept(lake, trades):
    def full():
        return sorted(coverage.coverage({TRADES: lake.read(TRADES)}).collect())

    def kept():
        return sorted(coverage.kept_coverage(lake, [TRADES]).collect())

    assert kept() == []
    lake.append(trades.where("trade_id < 3"), TRADES)
    assert kept() == full() != []
    lake.append(trades, TRADES)
    lake.append(trades.withColumn("symbol", F.lit("OTHER")), TRADES)
    assert kept() == full()
    lake.drop_days(TRADES, datetime.date(2024, 1, 2))
    assert kept() == full()
    lake.compact(TRADES)
    assert kept() == full()
    days = coverage.covered_days(lake, TRADES)
    assert days.inputFiles() and all("/_coverage/" in file for file in days.inputFiles())


# Digests and sketches --------------------------------------------------------


def test_digests_tell_multisets_apart(spark):
    schema = "a int, b string, c double"
    rows = [(1, "x", 0.5), (1, "x", 0.5), (None, "x", None), (2, None, -0.0), (None, None, float("nan"))]
    base = spark.createDataFrame(rows, schema)
    others = [rows[1:], rows[1:] + [(None, "x", 0.5)], [*rows[:2], (3, "x", None), *rows[3:]], [*rows, rows[0]]]
    digest = frame_ops.multiset_digest(base).first()
    assert frame_ops.multiset_digest(base.repartition(4).orderBy("c")).first() == digest
    same = frame_ops.same_rows(base, base.select("c", "b", "a").repartition(3))
    assert tuple(same.first()) == (0, 0, True)
    assert "Exchange" not in same._jdf.queryExecution().toString()
    for other in others:
        changed = spark.createDataFrame(other, schema)
        assert frame_ops.multiset_digest(changed).first() != digest
        assert tuple(frame_ops.same_rows(base, changed).first()) == tuple(frame_ops.frame_difference(base, changed).first())
    swapped = spark.createDataFrame([(None, "x"), ("x", None)], "a string, b string")
    assert frame_ops.multiset_digest(swapped.limit(1)).first() != frame_ops.multiset_digest(swapped.offset(1)).first()
    empty = base.limit(0)
    assert tuple(frame_ops.same_rows(empty, empty).first()) == (0, 0, True)
    assert tuple(frame_ops.same_rows(base, empty).first()) == (5, 0, False)


def test_merged_sketches_keep_their_error_bound(spark):
    rows = spark.range(40_000).selectExpr(
        "concat('s', id % 2) AS stream", "1704067200000000 + id * 9000000 AS recv_us",
        "pow(id * 7919 % 40000 / 400.0, 2) AS latency_ms",
    )
    k = 200
    hourly = relay.hourly_latency(rows, k)
    assert hourly.count() > 150
    days = relay.merged_latency(hourly, ["stream", F.to_date("hour").alias("date")], k)
    whole = relay.latency_summary(relay.merged_latency(days, ["stream"], k)).collect()
    exact = {s: sorted(r.latency_ms for r in rows.where(F.col("stream") == s).collect()) for s in ("s0", "s1")}
    for r in whole:
        own = exact[r.stream]
        assert r.messages == len(own) and (r.min_ms, r.max_ms) == (own[0], own[-1])
        assert r.mean_ms == pytest.approx(sum(own) / len(own))
        for rank, at in ((0.5, r.p50_ms), (0.95, r.p95_ms), (0.99, r.p99_ms)):
            assert abs(sum(x <= at for x in own) / len(own) - rank) < 0.02
    missing = relay.hourly_latency(rows.withColumn("latency_ms", F.lit(None).cast("double")))
    assert missing.count() == 0


def test_one_table_reads_its_frames_once_and_keeps_no_copy(spark, lake, frames, monkeypatch):
    path = new_folder(spark, "test-landing")
    landing.write_landing(frames("kraken", "ohlc", "[]", "[]"), path)
    kept, persist = [], type(spark.range(1)).persist

    def counted(self, *level):
        kept.append(self.columns)
        return persist(self, *level)

    monkeypatch.setattr(type(spark.range(1)), "persist", counted)
    offsets = new_folder(spark, "test-offsets")
    ingest.start_fanout(landing.stream_landing(spark, path), lake, offsets, ["kraken_ohlc_stream"]).awaitTermination()
    assert len(kept) == 1 and "misfit" in kept[0]


def test_several_tables_keep_frames_but_no_decoded_rows(spark, lake, frames, monkeypatch):
    """A decoded row holds its frame's text again, for each record of the frame."""
    path = new_folder(spark, "test-landing")
    landing.write_landing(frames("kraken", "ohlc", "[]").unionByName(frames("gemini", "trades", "{")), path)
    kept, persist = [], type(spark.range(1)).persist

    def counted(self, *level):
        kept.append(self.columns)
        return persist(self, *level)

    monkeypatch.setattr(type(spark.range(1)), "persist", counted)
    offsets = new_folder(spark, "test-offsets")
    tables = ["kraken_ohlc_stream", "gemini_multimarketdata_trades"]
    query = ingest.start_fanout(landing.stream_landing(spark, path), lake, offsets, tables)
    query.awaitTermination()
    assert kept == [landing.LANDING_COLUMNS]
    assert ingest.counters(lake, query) == {"rows_processed": 0, "rows_rejected": 0, "inserts": 0}
    assert lake.read(ingest.QUARANTINE).count() == 2
