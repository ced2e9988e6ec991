"""The ten typed tables: raw key, column, type and sort key of each.

A field is ``key:column:type``. A key that starts with ``@`` is read from the
message, any other from the row inside it. Types are Spark's, plus ``nanos``:
an ISO-8601 text kept as BIGINT nanoseconds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

SPARK_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "nanos": T.LongType(),
}

AUDIT_FIELDS = [T.StructField("date", T.DateType()), T.StructField("insert_time", T.LongType())]


@dataclass(frozen=True)
class Field:
    key: str
    column: str
    type: str
    from_message: bool


@dataclass(frozen=True)
class TableSpec:
    name: str
    exchange: str
    feed: str
    symbol: str
    sort_key: tuple[str, ...]
    fields: tuple[Field, ...]

    @property
    def columns(self) -> list[str]:
        return [f.column for f in self.fields]

    @property
    def schema(self) -> T.StructType:
        data = [T.StructField(f.column, SPARK_TYPES[f.type]) for f in self.fields]
        return T.StructType(data + AUDIT_FIELDS)


def _fields(text: str) -> tuple[Field, ...]:
    fields = []
    for item in text.split():
        key, column, type_ = item.split(":")
        fields.append(Field(key.lstrip("@"), column, type_, key.startswith("@")))
    return tuple(fields)


# Table names, raw keys, columns, types and sort keys.
_TABLES = [
    TableSpec(
        "binance_symbol_ticker_stream", "binance", "ticker", "symbol", ("event_time", "symbol"),
        _fields("""
            e:event_type:string E:event_time:bigint s:symbol:string p:px_change:double
            P:px_change_percent:double w:weighted_average_px:double x:first_trade_f_1_px:double
            c:last_px:double Q:last_quantity:double b:best_bid_px:double B:best_bid_quantity:double
            a:best_ask_px:double A:best_ask_quantity:double o:open_px:double h:high_px:double
            l:low_px:double v:total_traded_base_asset_volume:double
            q:total_traded_quote_asset_volume:double O:statistics_open_time:bigint
            C:statistics_close_time:bigint F:first_trade_id:bigint L:last_trade_id:bigint
            n:total_number_of_trades:bigint
        """),
    ),
    TableSpec(
        "binance_trade_data_stream", "binance", "trade", "symbol", ("event_time", "symbol"),
        _fields("""
            e:event_type:string E:event_time:bigint s:symbol:string t:trade_id:bigint
            p:price:double q:quantity:double b:buyer_order_id:bigint a:seller_order_id:bigint
            T:trade_time:bigint m:market_maker:boolean M:ignore:boolean
        """),
    ),
    TableSpec(
        "binance_ticker_order_book_stream", "binance", "bookTicker", "symbol",
        ("order_book_updateid", "symbol"),
        _fields("""
            u:order_book_updateid:bigint s:symbol:string b:best_bid_price:double
            B:best_bid_qty:double a:best_ask_price:double A:best_ask_qty:double
        """),
    ),
    TableSpec(
        "coinbase_market_trades_stream", "coinbase", "market_trades", "symbol", ("time", "symbol"),
        _fields("""
            product_id:symbol:string trade_id:trade_id:bigint price:price:double size:size:double
            time:time:nanos side:side:string @channel:channel:string @timestamp:timestamp:nanos
            @sequence_num:sequence_num:bigint
        """),
    ),
    TableSpec(
        "coinbase_top_of_book_stream", "coinbase", "level2", "symbol", ("event_time", "symbol"),
        _fields("""
            product_id:symbol:string event_time:event_time:bigint BidPx:bid_px:double
            BidSz:bid_sz:double OfferPx:offer_px:double OfferSz:offer_sz:double
            sequence_num:sequence_num:bigint channel:channel:string timestamp:timestamp:bigint
        """),
    ),
    TableSpec(
        "cryptocom_trade_data_stream", "cryptocom", "trade", "symbol", ("trade_timestmp", "symbol"),
        _fields("""
            s:side:string p:trade_price:double q:trade_qty:double t:trade_timestmp:bigint
            d:trade_id:bigint i:symbol:string
        """),
    ),
    TableSpec(
        "gemini_multimarketdata_trades", "gemini", "trades", "symbol", ("timestamp", "symbol"),
        _fields("""
            type:type:string tid:tid:bigint price:price:double amount:amount:double
            makerSide:makerSide:string symbol:symbol:string @eventId:eventId:bigint
            @socket_sequence:socket_sequence:bigint @timestamp:timestamp:bigint
            @timestampms:timestampms:bigint
        """),
    ),
    TableSpec(
        "kraken_trade_data_stream", "kraken", "trade", "pair", ("time", "pair"),
        _fields("""
            price:price:double volume:volume:double time:time:double side:side:string
            orderType:orderType:string @channelName:channelName:string @pair:pair:string
        """),
    ),
    TableSpec(
        "kraken_ticker_stream", "kraken", "ticker", "ticker", ("ticker",),
        _fields("""
            best_ask_price:best_ask_price:double best_bid_price:best_bid_price:double
            close_price:close_price:double vol_today:vol_today:double
            vol_wavg_price_today:vol_wavg_price_today:double n_trades_today:n_trades_today:bigint
            low_price_today:low_price_today:double high_price_today:high_price_today:double
            open_price_today:open_price_today:double ask_wholelot_vol:ask_wholelot_vol:bigint
            bid_wholelot_vol:bid_wholelot_vol:bigint close_lot_vol:close_lot_vol:double
            vol_24hrs:vol_24hrs:double vol_wavg_price_24hrs:vol_wavg_price_24hrs:double
            n_trades_24hrs:n_trades_24hrs:bigint low_price_24hrs:low_price_24hrs:double
            high_price_24hrs:high_price_24hrs:double open_price_24hrs:open_price_24hrs:double
            ask_lot_vol:ask_lot_vol:double bid_lot_vol:bid_lot_vol:double @pair:ticker:string
        """),
    ),
    TableSpec(
        "kraken_ohlc_stream", "kraken", "ohlc", "pair", ("time", "pair"),
        _fields("""
            time:time:double etime:etime:double open:open:double high:high:double low:low:double
            close:close:double vwap:vwap:double volume:volume:double count:count:bigint
            @channelName:channelName:string @pair:pair:string
        """),
    ),
]

TABLES: dict[str, TableSpec] = {spec.name: spec for spec in _TABLES}

TOP_OF_BOOK = "coinbase_top_of_book_stream"

# The tables of the coverage report.
COVERAGE_TABLES = [
    "binance_ticker_order_book_stream",
    "binance_trade_data_stream",
    "coinbase_market_trades_stream",
    "coinbase_top_of_book_stream",
    "cryptocom_trade_data_stream",
    "gemini_multimarketdata_trades",
    "kraken_ohlc_stream",
    "kraken_trade_data_stream",
]


def table_for(exchange: str, feed: str) -> TableSpec:
    for spec in TABLES.values():
        if (spec.exchange, spec.feed) == (exchange, feed):
            return spec
    raise KeyError(f"no table takes {exchange}/{feed}")
