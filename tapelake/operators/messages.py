"""Frames into classified messages with their data rows.

Each exchange has one decoder. It parses the frame once and adds

* ``msg``      fields of the message that every row of it shares,
* ``records``  the data rows, an array of structs of texts with the table's column
  names, NULL unless data,
* ``kind``     data, control or reject,
* ``reason``   why a message is rejected, NULL otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.specs import TABLES, TableSpec

DATA, CONTROL, REJECT = "data", "control", "reject"

# Kraken sends positions instead of names. Names in order.
KRAKEN_TRADE = ["price", "volume", "time", "side", "orderType"]
KRAKEN_OHLC = ["time", "etime", "open", "high", "low", "close", "vwap", "volume", "count"]
KRAKEN_TICKER = {
    "a": ["best_ask_price", "ask_wholelot_vol", "ask_lot_vol"],
    "b": ["best_bid_price", "bid_wholelot_vol", "bid_lot_vol"],
    "c": ["close_price", "close_lot_vol"],
    "v": ["vol_today", "vol_24hrs"],
    "p": ["vol_wavg_price_today", "vol_wavg_price_24hrs"],
    "t": ["n_trades_today", "n_trades_24hrs"],
    "l": ["low_price_today", "low_price_24hrs"],
    "h": ["high_price_today", "high_price_24hrs"],
    "o": ["open_price_today", "open_price_24hrs"],
}

_CORRUPT = {"columnNameOfCorruptRecord": "_corrupt"}


def _record(spec: TableSpec, name: str, *more: str) -> str:
    """Struct type of a row's texts, fields named by raw ``key`` or by ``column``."""
    names = [getattr(f, name) for f in spec.fields if not f.from_message]
    return "struct<" + ",".join(f"`{n}`:string" for n in [*names, *more]) + ">"


def _decoded(
    frames: DataFrame,
    parsed: Column,
    kind: Column,
    reason: Column,
    msg: Column,
    records: Column,
    payload: Column | None = None,
) -> DataFrame:
    """Parse into ``_p`` first, so that the expressions over it share one parse.

    ``payload`` parses a text nested in ``_p`` and becomes ``_payload``.
    """
    also = [name for name in ("connection",) if name in frames.columns]
    staged = frames.select("exchange", "feed", "value", "recv_ts", *also, parsed.alias("_p"))
    if payload is not None:
        staged = staged.select("*", payload.alias("_payload"))
    classified = staged.select("*", kind.alias("kind"))
    return classified.select(
        "exchange",
        "feed",
        "value",
        "recv_ts",
        *also,
        "kind",
        F.when(F.col("kind") == REJECT, reason).alias("reason"),
        msg.alias("msg"),
        F.when(F.col("kind") == DATA, records).alias("records"),
    )


def _binance(frames: DataFrame, spec: TableSpec) -> DataFrame:
    """A frame is one object or an array of objects; parsed as an array it is both.

    Raw keys differ only by case, so the fields are renamed by position before
    any of them is looked up. One record with a symbol makes the frame data;
    records without one are set aside row by row.
    """
    p = F.col("_p")
    keys = _record(spec, "key", "result", "id")
    columns = _record(spec, "column", "result", "id")
    parsed = F.from_json("value", f"array<{keys}>").cast(f"array<{columns}>")
    first = F.get(p, F.lit(0))
    # A struct cannot tell a JSON null from a missing key, the key list can.
    ack = (
        (first["id"] == "1")
        & first["result"].isNull()
        & F.array_contains(F.json_object_keys("value"), "result")
    )
    kind = (
        F.when(F.size(p) == 0, CONTROL)
        .when(ack, CONTROL)
        .when(F.exists(p, lambda record: record["symbol"].isNotNull()), DATA)
        .otherwise(REJECT)
    )
    reason = F.when(first.isNull(), "malformed").otherwise("unknown message")
    return _decoded(frames, parsed, kind, reason, F.struct(F.lit(None).alias("none")), p)


def _coinbase(
    frames: DataFrame, channel: str, rows: str, record: str, renamed: str
) -> DataFrame:
    """Rows come from the first event only; other channels are control."""
    p = F.col("_p")
    parsed = F.from_json(
        "value",
        "channel string, timestamp string, sequence_num string, _corrupt string, "
        f"events array<struct<product_id:string,{rows}:array<{record}>>>",
        _CORRUPT,
    )
    event = F.get(p["events"], F.lit(0))
    records = event[rows]
    kind = (
        F.when(F.coalesce(p["channel"], F.lit("")) == "", REJECT)
        .when((p["channel"] == channel) & event.isNull(), REJECT)
        .when((p["channel"] == channel) & (F.size(records) > 0), DATA)
        .otherwise(CONTROL)
    )
    reason = (
        F.when(p["_corrupt"].isNotNull(), "malformed")
        .when(event.isNull() & (p["channel"] == channel), "no events")
        .otherwise("no channel")
    )
    msg = F.struct(
        p["channel"].alias("channel"),
        p["timestamp"].alias("timestamp"),
        p["sequence_num"].alias("sequence_num"),
        event["product_id"].alias("product_id"),
    )
    return _decoded(frames, parsed, kind, reason, msg, records.cast(f"array<{renamed}>"))


def _coinbase_trades(frames: DataFrame, spec: TableSpec) -> DataFrame:
    return _coinbase(
        frames, "market_trades", "trades", _record(spec, "key"), _record(spec, "column")
    )


def coinbase_level2(frames: DataFrame, spec: TableSpec | None = None) -> DataFrame:
    update = "struct<side:string,event_time:string,price_level:string,new_quantity:string>"
    return _coinbase(frames, "l2_data", "updates", update, update)


def _cryptocom(frames: DataFrame, spec: TableSpec) -> DataFrame:
    p = F.col("_p")
    result = f"struct<channel:string,data:array<{_record(spec, 'key')}>>"
    parsed = F.from_json("value", f"method string, _corrupt string, result {result}", _CORRUPT)
    kind = (
        F.when(p["_corrupt"].isNotNull() | p.isNull(), REJECT)
        .when(p["result"]["channel"] == "trade", DATA)
        .otherwise(CONTROL)
    )
    records = p["result"]["data"].cast(f"array<{_record(spec, 'column')}>")
    return _decoded(frames, parsed, kind, F.lit("malformed"), F.struct(p["method"]), records)


def _gemini(frames: DataFrame, spec: TableSpec) -> DataFrame:
    """All events of a message are rows if the first one is a trade."""
    p = F.col("_p")
    shared = [f.key for f in spec.fields if f.from_message]
    fields = [f"{name} string" for name in shared]
    events = f"events array<{_record(spec, 'key')}>"
    parsed = F.from_json("value", ", ".join([*fields, "_corrupt string", events]), _CORRUPT)
    kind = (
        F.when(p["_corrupt"].isNotNull() | p.isNull(), REJECT)
        .when(F.get(p["events"], F.lit(0))["type"] == "trade", DATA)
        .otherwise(CONTROL)
    )
    msg = F.struct(*[p[name].alias(name) for name in shared])
    records = p["events"].cast(f"array<{_record(spec, 'column')}>")
    return _decoded(frames, parsed, kind, F.lit("malformed"), msg, records)


def _kraken(frames: DataFrame, channel: str, payload: Column, records: Column) -> DataFrame:
    """Lists are data, whatever object is control.

    The second element becomes ``_payload``, from which ``records`` are taken.
    """
    value, p = F.col("value"), F.col("_p")
    parsed = F.from_json(value, "array<string>")
    name, pair = F.get(p, F.lit(2)), F.get(p, F.lit(3))
    kind = (
        F.when(p.isNull() & F.json_object_keys(value).isNotNull(), CONTROL)
        .when(p.isNull(), REJECT)
        .when(F.substring_index(name, "-", 1) != channel, REJECT)
        .when(pair.isNull() | F.col("_payload").isNull(), REJECT)
        .otherwise(DATA)
    )
    reason = F.when(p.isNull(), "malformed").otherwise("unknown message")
    msg = F.struct(name.alias("channelName"), pair.alias("pair"))
    return _decoded(frames, parsed, kind, reason, msg, records, payload)


def _kraken_trades(frames: DataFrame, spec: TableSpec) -> DataFrame:
    payload = F.from_json(_second(), "array<array<string>>")
    records = F.expr(f"transform(_payload, row -> {_named('row', KRAKEN_TRADE)})")
    return _kraken(frames, "trade", payload, records)


def _kraken_ohlc(frames: DataFrame, spec: TableSpec) -> DataFrame:
    payload = F.from_json(_second(), "array<string>")
    return _kraken(frames, "ohlc", payload, F.expr(f"array({_named('_payload', KRAKEN_OHLC)})"))


def _kraken_ticker(frames: DataFrame, spec: TableSpec) -> DataFrame:
    """Object of ragged arrays; a position past the end of its array is NULL."""
    fields = ",".join(f"{key}:array<string>" for key in KRAKEN_TICKER)
    payload = F.from_json(_second(), f"struct<{fields}>")
    names = [
        f"get(_payload.{key}, {i}) AS {column}"
        for key, columns in KRAKEN_TICKER.items()
        for i, column in enumerate(columns)
    ]
    return _kraken(frames, "ticker", payload, F.expr(f"array(struct({', '.join(names)}))"))


def _second() -> Column:
    return F.get(F.col("_p"), F.lit(1))


def _named(row: str, names: list[str]) -> str:
    fields = [f"get({row}, {i}) AS `{name}`" for i, name in enumerate(names)]
    return f"struct({', '.join(fields)})"


DECODERS: dict[str, Callable[[DataFrame, TableSpec], DataFrame]] = {
    "binance_symbol_ticker_stream": _binance,
    "binance_trade_data_stream": _binance,
    "binance_ticker_order_book_stream": _binance,
    "coinbase_market_trades_stream": _coinbase_trades,
    "coinbase_top_of_book_stream": coinbase_level2,
    "cryptocom_trade_data_stream": _cryptocom,
    "gemini_multimarketdata_trades": _gemini,
    "kraken_trade_data_stream": _kraken_trades,
    "kraken_ticker_stream": _kraken_ticker,
    "kraken_ohlc_stream": _kraken_ohlc,
}


def frames_of(landing: DataFrame, table: str) -> DataFrame:
    """The frames one table is fed from (partition filter on a landing folder)."""
    spec = TABLES[table]
    return landing.where(
        (F.col("exchange") == spec.exchange) & (F.col("feed") == spec.feed)
    )


def decode(landing: DataFrame, table: str) -> DataFrame:
    return DECODERS[table](frames_of(landing, table), TABLES[table])


def route(landing: DataFrame) -> DataFrame:
    """Add the target ``table`` of each frame, NULL where no table takes it.

    The landing columns decide. A Kraken frame without a feed carries the
    channel name as its third element.
    """
    named = F.get(F.from_json("value", "array<string>"), F.lit(2))
    feed = F.coalesce(
        F.col("feed"), F.when(F.col("exchange") == "kraken", F.substring_index(named, "-", 1))
    )
    table = F.lit(None).cast("string")
    for spec in TABLES.values():
        table = F.when(
            (F.col("exchange") == spec.exchange) & (feed == spec.feed), spec.name
        ).otherwise(table)
    return landing.withColumn("table", table)
