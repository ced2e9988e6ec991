"""Golden messages of every feed: rows, kinds, and what is set aside."""

from __future__ import annotations

import datetime
import json

import pytest

from tapelake.operators.messages import decode, route
from tapelake.operators.relay import relay_latency, stream_messages
from tapelake.operators.secmaster import document_schema, parse_documents, security_master
from tapelake.plans.feeds import ingest_counters, quarantine_rows, table_rows
from tapelake.sources.external import read_exchange_info
from tapelake.specs import TABLES
from tapelake.workspace import new_folder

TRADE = {"e": "trade", "E": 1704067207179, "s": "BTCUSDT", "t": 1, "p": "6.55", "q": "3", "b": 8,
         "a": 9, "T": 1704067207178, "m": True, "M": False}
NS = 1704067207179575000


def text(**changes):
    return json.dumps({**TRADE, **changes})


def kinds(df, table):
    return [(r.kind, r.reason) for r in decode(df, table).orderBy("recv_ts").collect()]


def rows(df, table):
    return [tuple(r)[:-2] for r in table_rows(df, table).collect()]


def test_binance_trade(frames):
    table = "binance_trade_data_stream"
    df = frames(
        "binance", "trade",
        '{"result":null,"id":1}',
        text(),
        text(extra="x", p="7"),
        text(p="bad"),
        text()[:40],
        '{"result":null,"id":2}',
        '{"result":5,"id":1}',
        '{"id":1}',
        "[]",
        f"[{text(t=5)},{text(t=6)}]",
        "not json",
    )
    assert [kind for kind, _ in kinds(df, table)] == [
        "control", "data", "data", "data", "reject", "reject", "reject", "reject", "control",
        "data", "reject",
    ]
    good = ("trade", 1704067207179, "BTCUSDT", 1, 6.55, 3.0, 8, 9, 1704067207178, True, False)
    got = table_rows(df, table).orderBy("insert_time", "trade_id").collect()
    assert [tuple(r)[:-2] for r in got] == [
        good,
        (*good[:4], 7.0, *good[5:]),
        (*good[:3], 5, *good[4:]),
        (*good[:3], 6, *good[4:]),
    ]
    assert (got[0].date, got[0].insert_time) == (datetime.date(2024, 1, 1), 1704067201000000)
    set_aside = [(r.reason, r.value) for r in quarantine_rows(df, table).orderBy("insert_time").collect()]
    assert set_aside == [
        ("bad price", text(p="bad")),
        ("malformed", text()[:40]),
        ("unknown message", '{"result":null,"id":2}'),
        ("unknown message", '{"result":5,"id":1}'),
        ("unknown message", '{"id":1}'),
        ("malformed", "not json"),
    ]


def test_binance_keys_that_differ_by_case(frames):
    ticker = dict(zip("eEspPwxcQbBaAohlvqOCFLn", ["24hrTicker", 1, "X", *range(3, 23)]))
    df = frames("binance", "ticker", json.dumps([ticker, {**ticker, "s": "Y"}]))
    got = rows(df, "binance_symbol_ticker_stream")
    assert got == [
        ("24hrTicker", 1, symbol, *[float(v) for v in range(3, 18)], *range(18, 23))
        for symbol in "XY"
    ]
    book = frames("binance", "bookTicker", '{"u":1,"s":"X","b":"6.5","B":"3","a":"6.6","A":"2"}')
    assert rows(book, "binance_ticker_order_book_stream") == [(1, "X", 6.5, 3.0, 6.6, 2.0)]


def coinbase(trades, channel="market_trades", more=()):
    message = {
        "channel": channel, "client_id": "", "timestamp": "2024-01-01T00:00:07.179575Z",
        "sequence_num": 4,
        "events": [{"type": "update", "trades": trades}, *more],
    }
    return json.dumps({k: v for k, v in message.items() if v is not None})


def test_coinbase_trades(frames):
    table = "coinbase_market_trades_stream"
    trade = {"trade_id": "1", "product_id": "BTC-USDT", "price": "6.55", "size": "3",
             "side": "BUY", "time": "2024-01-01T00:00:07.179575123Z"}
    df = frames(
        "coinbase", "market_trades",
        coinbase([trade, {**trade, "trade_id": "2", "time": "2024-01-01T00:00:07Z"}]),
        coinbase([trade], more=[{"type": "update", "trades": [{**trade, "trade_id": "9"}]}]),
        coinbase([]),
        coinbase([trade], channel="heartbeats"),
        coinbase([trade], channel=None),
        '{"channel":"market_trades","events":[]}',
        '{"channel":',
    )
    assert kinds(df, table) == [
        ("data", None), ("data", None), ("control", None), ("control", None),
        ("reject", "no channel"), ("reject", "no events"), ("reject", "malformed"),
    ]
    first = ("BTC-USDT", 1, 6.55, 3.0, NS + 123, "BUY", "market_trades", NS, 4)
    assert rows(df, table) == [
        first,
        ("BTC-USDT", 2, 6.55, 3.0, 1704067207000000000, "BUY", "market_trades", NS, 4),
        first,
    ]


def test_cryptocom(frames):
    table = "cryptocom_trade_data_stream"
    trade = {"s": "BUY", "p": "6.55", "q": "3", "t": 1704067207179, "d": "1", "i": "BTCUSD-PERP"}
    df = frames(
        "cryptocom", "trade",
        json.dumps({"id": 1, "result": {"channel": "trade", "data": [trade, trade]}}),
        '{"id":7,"method":"public/heartbeat"}',
        '{"id":1,"method":"subscribe","code":0}',
        '{"result":{"channel":"ticker","data":[]}}',
        "{",
    )
    assert [k for k, _ in kinds(df, table)] == ["data", "control", "control", "control", "reject"]
    assert rows(df, table) == [("BUY", 6.55, 3.0, 1704067207179, 1, "BTCUSD-PERP")] * 2


def test_gemini_gate_is_the_first_event(frames):
    table = "gemini_multimarketdata_trades"

    def message(*types):
        events = [
            {"type": t, "tid": i, "price": "6.55", "amount": "3", "makerSide": "bid",
             "symbol": "BTCUSD"}
            for i, t in enumerate(types)
        ]
        return json.dumps({"type": "update", "eventId": 5, "socket_sequence": 3,
                           "timestamp": 1704067207, "timestampms": 1704067207179,
                           "events": events})

    df = frames(
        "gemini", "trades",
        message("trade", "change"), message("change", "trade"), message(),
        '{"type":"heartbeat","socket_sequence":4}', "[1",
    )
    assert [k for k, _ in kinds(df, table)] == ["data", "control", "control", "control", "reject"]
    tail = (6.55, 3.0, "bid", "BTCUSD", 5, 3, 1704067207, 1704067207179)
    assert rows(df, table) == [("trade", 0, *tail), ("change", 1, *tail)]


def test_kraken(frames):
    trades = frames(
        "kraken", "trade",
        '[337,[["6.55","3","1704067207.5","s","l",""],["7","1","1704067208.5","b","m","x"]],'
        '"trade","XBT/USD"]',
        '{"event":"systemStatus","status":"online"}',
        '{"event":"heartbeat"}',
        '[337,"x","trade","XBT/USD"]',
        '[1,[[]],"book-10","XBT/USD"]',
        "[337",
    )
    table = "kraken_trade_data_stream"
    assert [k for k, _ in kinds(trades, table)] == [
        "data", "control", "control", "reject", "reject", "reject",
    ]
    assert rows(trades, table) == [
        (6.55, 3.0, 1704067207.5, "s", "l", "trade", "XBT/USD"),
        (7.0, 1.0, 1704067208.5, "b", "m", "trade", "XBT/USD"),
    ]
    bars = frames(
        "kraken", "ohlc", '[42,["1.5","2.5","1","4","0.5","2","1.9","10",7],"ohlc-1","XBT/USD"]'
    )
    assert rows(bars, "kraken_ohlc_stream") == [
        (1.5, 2.5, 1.0, 4.0, 0.5, 2.0, 1.9, 10.0, 7, "ohlc-1", "XBT/USD")
    ]


def test_kraken_ticker_is_ragged(frames):
    payload = ('{"a":["6.6",1],"b":["6.5",2,"2.0"],"c":["6.55","3"],"v":["4","5"],'
               '"p":["6","7"],"t":[10,20],"l":["1","2"],"h":["8","9"],"o":["3","4"]}')
    df = frames("kraken", "ticker", f'[340,{payload},"ticker","XBT/USD"]')
    (row,) = table_rows(df, "kraken_ticker_stream").collect()
    assert row.ask_lot_vol is None
    assert (row.best_ask_price, row.ask_wholelot_vol, row.bid_lot_vol) == (6.6, 1, 2.0)
    assert (row.n_trades_today, row.n_trades_24hrs, row.ticker) == (10, 20, "XBT/USD")
    assert (row.vol_24hrs, row.low_price_24hrs, row.open_price_24hrs) == (5.0, 2.0, 4.0)


def test_table_schemas(frames):
    for name, spec in TABLES.items():
        if name == "coinbase_top_of_book_stream":
            continue
        df = table_rows(frames(spec.exchange, spec.feed, "{}"), name)
        assert [(f.name, f.dataType) for f in df.schema] == [
            (f.name, f.dataType) for f in spec.schema
        ]


def test_routing(frames):
    df = frames("kraken", "trade", '[1,[],"trade","A"]', '[1,[],"ohlc-5","A"]', '{"event":"x"}')
    unnamed = route(df.selectExpr("exchange", "string(null) AS feed", "value", "recv_ts"))
    got = [r.table for r in unnamed.orderBy("recv_ts").collect()]
    assert got == ["kraken_trade_data_stream", "kraken_ohlc_stream", None]
    assert route(frames("binance", "nothing", "{}")).first().table is None


def test_counters_add_up(frames):
    df = frames(
        "binance", "trade", '{"result":null,"id":1}', text(), text(p="x"), "{", f"[{text()},{text()}]"
    )
    (row,) = ingest_counters(df, ["binance_trade_data_stream"]).collect()
    assert tuple(row) == ("binance_trade_data_stream", 3, 1, 1, 3, 1)


def test_relay(frames):
    inner = json.dumps({"stream": "btcusdt@trade", "data": TRADE})
    other = json.dumps({"stream": "!ticker@arr", "data": [TRADE]})
    df = frames(
        "binance", "relay",
        json.dumps({"timestamp": 1704067199.75, "data": inner}),
        json.dumps({"timestamp": 1704067200.5, "data": other}),
    )
    assert rows(stream_messages(df), "binance_trade_data_stream")[0][3] == 1
    assert stream_messages(df).count() == 1
    got = {r.stream: r.latency_ms for r in relay_latency(df).collect()}
    assert got["btcusdt@trade"] == pytest.approx(250)
    assert got["!ticker@arr"] == pytest.approx(500)


def test_security_master(spark, frames):
    doc = {"symbols": [
        {"symbol": "A", "status": "TRADING", "orderTypes": ["LIMIT", "MARKET"],
         "filters": [{"filterType": "PRICE_FILTER", "minPrice": "0.01"},
                     {"filterType": "LOT_SIZE", "minQty": "0.1"}]},
        {"symbol": "B", "status": "BREAK", "orderTypes": [], "filters": []},
    ]}
    expected = [
        ("PRICE_FILTER", "0.01", None, "A", "TRADING", "LIMIT, MARKET"),
        ("LOT_SIZE", None, "0.1", "A", "TRADING", "LIMIT, MARKET"),
    ]
    schema = document_schema(
        ["filterType", "minPrice", "minQty"], ["symbol", "status"], ["orderTypes"]
    )
    texts = frames("binance", "info", json.dumps(doc))
    got = security_master(parse_documents(texts, schema))
    assert got.columns == ["filterType", "minPrice", "minQty", "symbol", "status", "orderTypes"]
    assert [tuple(r) for r in got.collect()] == expected

    path = new_folder(spark, "test-info")
    lines = spark.createDataFrame([(json.dumps(doc, indent=2),)], "value string")
    lines.coalesce(1).write.text(path)
    found = security_master(read_exchange_info(spark, path))
    assert sorted(tuple(r) for r in found.select(got.columns).collect()) == sorted(expected)
