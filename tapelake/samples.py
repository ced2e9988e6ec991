"""Exchange messages built by Spark from the driver's tables (FIXTURES.md §3).

Every function returns landing frames ``(exchange, feed, value, recv_ts)`` and
covers its whole source table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS_PER_MESSAGE = 10
EVENTS_PER_BOOK_MESSAGE = 20
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

ACK = '{"result":null,"id":1}'


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the shorthand columns of the recipes."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        "value",
        F.concat(F.lit("S"), (F.col("user_id") % 5).cast("string")).alias("sym"),
        (F.col("event_id") % 7 + 1).alias("qty"),
        F.floor(F.col("event_id") / EVENTS_PER_MESSAGE).alias("g"),
    )


def _text(column: Column) -> Column:
    return column.cast("string")


def _ms(ts: Column | str) -> Column:
    return F.unix_millis(ts)


def _iso(ts: Column) -> Column:
    return F.date_format(ts, ISO)


def _frames(df: DataFrame, exchange: str, feed: str, value: Column, recv: Column) -> DataFrame:
    return df.select(
        F.lit(exchange).alias("exchange"),
        F.lit(feed).alias("feed"),
        value.alias("value"),
        recv.alias("recv_ts"),
    )


def _grouped(ev: DataFrame, keys: list[str], item: Column) -> DataFrame:
    """Up to ten events per group as an array ordered by event id."""
    return ev.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("event_id", item.alias("item")))).alias("items"),
        F.max("ts").alias("last_ts"),
    )


def _items() -> Column:
    return F.transform("items", lambda x: x["item"])


def _trade_object(price: Column) -> Column:
    return F.struct(
        F.lit("trade").alias("e"),
        _ms("ts").alias("E"),
        F.col("sym").alias("s"),
        F.col("event_id").alias("t"),
        price.alias("p"),
        _text(F.col("qty")).alias("q"),
        F.col("user_id").alias("b"),
        (F.col("user_id") + 1).alias("a"),
        _ms("ts").alias("T"),
        (F.col("event_id") % 2 == 0).alias("m"),
        F.lit(True).alias("M"),
    )


def binance_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("event_type") == "error", ACK).otherwise(
        F.to_json(_trade_object(_text(F.col("value"))))
    )
    return _frames(events(spark, sf_dir), "binance", "trade", value, F.col("ts"))


def binance_trades_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.when(F.col("event_id") % 97 == 0, "bad").otherwise(_text(F.col("value")))
    text = F.to_json(_trade_object(price))
    value = (
        F.when(F.col("event_type") == "error", ACK)
        .when(F.col("event_id") % 89 == 0, F.expr("left(text, length(text) div 2)"))
        .otherwise(F.col("text"))
    )
    return _frames(
        events(spark, sf_dir).withColumn("text", text), "binance", "trade", value, F.col("ts")
    )


def binance_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("value")
    item = F.struct(
        F.lit("24hrTicker").alias("e"),
        _ms("ts").alias("E"),
        F.col("sym").alias("s"),
        _text(price - 1).alias("p"),
        _text(price / 4).alias("P"),
        _text(price).alias("w"),
        _text(price - 2).alias("x"),
        _text(price + 2).alias("c"),
        _text(F.col("qty")).alias("Q"),
        _text(price).alias("b"),
        _text(F.col("qty")).alias("B"),
        _text(price + 1).alias("a"),
        _text(F.col("qty") + 1).alias("A"),
        _text(price).alias("o"),
        _text(price + 3).alias("h"),
        _text(price).alias("l"),
        _text(F.col("qty") * 10).alias("v"),
        _text(F.col("qty") * 100).alias("q"),
        (_ms("ts") - 86_400_000).alias("O"),
        _ms("ts").alias("C"),
        F.col("event_id").alias("F"),
        (F.col("event_id") + F.col("qty")).alias("L"),
        F.col("qty").alias("n"),
    )
    grouped = _grouped(events(spark, sf_dir), ["g"], item)
    return _frames(grouped, "binance", "ticker", F.to_json(_items()), F.col("last_ts"))


def binance_book_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.to_json(
        F.struct(
            F.col("event_id").alias("u"),
            F.col("sym").alias("s"),
            _text(F.col("value")).alias("b"),
            _text(F.col("qty")).alias("B"),
            _text(F.col("value") + 1).alias("a"),
            _text(F.col("qty") + 1).alias("A"),
        )
    )
    return _frames(events(spark, sf_dir), "binance", "bookTicker", value, F.col("ts"))


def coinbase_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct(
        _text(F.col("event_id")).alias("trade_id"),
        F.col("sym").alias("product_id"),
        _text(F.col("value")).alias("price"),
        _text(F.col("qty")).alias("size"),
        F.when(F.col("event_id") % 2 == 0, "BUY").otherwise("SELL").alias("side"),
        _iso(F.col("ts")).alias("time"),
    )
    control = F.col("g") % 10 == 0
    value = F.to_json(
        F.struct(
            F.when(control, "subscriptions").otherwise("market_trades").alias("channel"),
            F.lit("").alias("client_id"),
            _iso(F.col("last_ts")).alias("timestamp"),
            F.col("g").alias("sequence_num"),
            F.array(
                F.struct(F.lit("update").alias("type"), _items().alias("trades"))
            ).alias("events"),
        )
    )
    grouped = _grouped(events(spark, sf_dir), ["g"], item)
    return _frames(grouped, "coinbase", "market_trades", value, F.col("last_ts"))


def coinbase_level2(spark: SparkSession, sf_dir: str, offer_shift: float = 0.0) -> DataFrame:
    """Book updates; ``offer_shift`` moves all offers, a negative one crosses books."""
    k = F.round(F.col("value") * 100).cast("bigint") % 3000 + 1
    is_bid = F.floor(F.col("user_id") / 5) % 2 == 0
    offer = F.lit(1000.0) + k / F.lit(100)
    if offer_shift:
        offer = offer + F.lit(offer_shift)
    ev = events(spark, sf_dir).select(
        "*",
        F.concat(F.lit("P"), (F.col("user_id") % 5).cast("string")).alias("product"),
        F.floor(F.col("event_id") / EVENTS_PER_BOOK_MESSAGE).alias("seq"),
    )
    item = F.struct(
        F.when(is_bid, "bid").otherwise("offer").alias("side"),
        _iso(F.col("ts")).alias("event_time"),
        _text(F.when(is_bid, F.lit(1000.0) - k / F.lit(100)).otherwise(offer)).alias(
            "price_level"
        ),
        _text(F.when(F.col("event_type") == "error", F.lit(0)).otherwise(F.col("qty"))).alias(
            "new_quantity"
        ),
    )
    value = F.to_json(
        F.struct(
            F.lit("l2_data").alias("channel"),
            _iso(F.col("last_ts")).alias("timestamp"),
            F.col("seq").alias("sequence_num"),
            F.array(
                F.struct(
                    F.lit("update").alias("type"),
                    F.col("product").alias("product_id"),
                    _items().alias("updates"),
                )
            ).alias("events"),
        )
    )
    grouped = _grouped(ev, ["product", "seq"], item)
    return _frames(grouped, "coinbase", "level2", value, F.col("last_ts"))


def cryptocom_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct(
        F.when(F.col("event_id") % 2 == 0, "BUY").otherwise("SELL").alias("s"),
        _text(F.col("value")).alias("p"),
        _text(F.col("qty")).alias("q"),
        _ms("ts").alias("t"),
        _text(F.col("event_id")).alias("d"),
        F.col("sym").alias("i"),
    )
    data = F.to_json(
        F.struct(
            F.lit(1).alias("id"),
            F.lit("subscribe").alias("method"),
            F.lit(0).alias("code"),
            F.struct(F.lit("trade").alias("channel"), _items().alias("data")).alias("result"),
        )
    )
    heartbeat = F.to_json(
        F.struct(F.col("g").alias("id"), F.lit("public/heartbeat").alias("method"))
    )
    value = F.when(F.col("g") % 10 == 0, heartbeat).otherwise(data)
    grouped = _grouped(events(spark, sf_dir), ["g"], item)
    return _frames(grouped, "cryptocom", "trade", value, F.col("last_ts"))


def gemini_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct(
        F.when(F.col("event_type") == "view", "change").otherwise("trade").alias("type"),
        F.col("event_id").alias("tid"),
        _text(F.col("value")).alias("price"),
        _text(F.col("qty")).alias("amount"),
        F.when(F.col("event_id") % 2 == 0, "bid").otherwise("ask").alias("makerSide"),
        F.col("sym").alias("symbol"),
    )
    value = F.to_json(
        F.struct(
            F.lit("update").alias("type"),
            F.col("g").alias("eventId"),
            F.col("g").alias("socket_sequence"),
            F.unix_seconds("last_ts").alias("timestamp"),
            _ms("last_ts").alias("timestampms"),
            _items().alias("events"),
        )
    )
    grouped = _grouped(events(spark, sf_dir), ["g"], item)
    return _frames(grouped, "gemini", "trades", value, F.col("last_ts"))


def _epoch_text(ts: Column) -> Column:
    """Seconds with six decimals as text."""
    micros = F.unix_micros(ts)
    return F.concat(
        F.floor(micros / 1_000_000).cast("string"),
        F.lit("."),
        F.lpad((micros % 1_000_000).cast("string"), 6, "0"),
    )


def _json_list(*parts: Column) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def kraken_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per (group, pair), a heartbeat object per group."""
    item = F.array(
        _text(F.col("value")),
        _text(F.col("qty")),
        _epoch_text(F.col("ts")),
        F.when(F.col("event_id") % 2 == 0, "b").otherwise("s"),
        F.lit("l"),
        F.lit(""),
    )
    grouped = _grouped(events(spark, sf_dir), ["g", "sym"], item)
    data = _frames(
        grouped,
        "kraken",
        "trade",
        _json_list(
            F.lit("337"), F.to_json(_items()), F.lit('"trade"'), _quoted(F.col("sym"))
        ),
        F.col("last_ts"),
    )
    groups = events(spark, sf_dir).groupBy("g").agg(F.max("ts").alias("last_ts"))
    beats = _frames(
        groups, "kraken", "trade", F.lit('{"event":"heartbeat"}'), F.col("last_ts")
    )
    return data.unionByName(beats)


def kraken_ohlc(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = _quoted(_text(F.col("value")))
    bar = _json_list(
        _quoted(_epoch_text(F.col("ts"))),
        _quoted(_epoch_text(F.col("ts") + F.expr("INTERVAL 60 SECONDS"))),
        price,
        _quoted(_text(F.col("value") + 1)),
        price,
        price,
        price,
        _quoted(_text(F.col("qty"))),
        _text(F.col("event_id") % 10),
    )
    value = _json_list(F.lit("42"), bar, F.lit('"ohlc-1"'), _quoted(F.col("sym")))
    return _frames(events(spark, sf_dir), "kraken", "ohlc", value, F.col("ts"))


def kraken_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fiftieth message has a short ``a`` array."""
    value, qty = F.col("value"), F.col("qty")

    def pair(first: Column, second: Column) -> Column:
        return _json_list(_quoted(_text(first)), _quoted(_text(second)))

    full = _json_list(_quoted(_text(value + 1)), _text(qty), _quoted(_text(qty)))
    short = _json_list(_quoted(_text(value + 1)), _text(qty))
    parts = {
        "a": F.when(F.col("event_id") % 50 == 0, short).otherwise(full),
        "b": _json_list(_quoted(_text(value)), _text(qty + 1), _quoted(_text(qty + 1))),
        "c": pair(value, qty),
        "v": pair(qty * 2, qty * 3),
        "p": pair(value, value + 2),
        "t": _json_list(_text(qty), _text(F.col("event_id"))),
        "l": pair(value - 1, value - 2),
        "h": pair(value + 1, value + 2),
        "o": pair(value, value),
    }
    payload = F.concat(
        F.lit("{"),
        F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), v) for k, v in parts.items()]),
        F.lit("}"),
    )
    text = _json_list(F.lit("340"), payload, F.lit('"ticker"'), _quoted(F.col("sym")))
    return _frames(events(spark, sf_dir), "kraken", "ticker", text, F.col("ts"))


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relay envelopes: a stream message as text inside an outer object."""
    inner = F.to_json(
        F.struct(
            F.when(F.col("user_id") % 2 == 0, "btcusdt@trade")
            .otherwise("!ticker@arr")
            .alias("stream"),
            _trade_object(_text(F.col("value"))).alias("data"),
        )
    )
    value = F.to_json(
        F.struct((F.unix_micros("ts") / 1e6).alias("timestamp"), inner.alias("data"))
    )
    recv = F.timestamp_micros(F.unix_micros("ts") + F.col("event_id") % 100 * 1000)
    return _frames(events(spark, sf_dir), "binance", "relay", value, recv)


def exchange_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One exchange-info document per part, each with a single symbol."""
    price = F.struct(
        F.lit("PRICE_FILTER").alias("filterType"),
        _text(F.col("p_retailprice")).alias("minPrice"),
        F.lit(None).cast("string").alias("minQty"),
    )
    lot = F.struct(
        F.lit("LOT_SIZE").alias("filterType"),
        F.lit(None).cast("string").alias("minPrice"),
        _text(F.col("p_size")).alias("minQty"),
    )
    filters = (
        F.when(F.col("p_size") > 30, F.array(price, lot))
        .when(F.col("p_size") > 10, F.array(price))
        .otherwise(F.array().cast(
            "array<struct<filterType:string,minPrice:string,minQty:string>>"
        ))
    )
    symbol = F.struct(
        F.col("p_name").alias("symbol"),
        F.lit("TRADING").alias("status"),
        F.array("p_brand", "p_type").alias("orderTypes"),
        filters.alias("filters"),
    )
    return table(spark, sf_dir, "part").select(
        F.to_json(F.struct(F.array(symbol).alias("symbols"))).alias("value")
    )


def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheduler runs derived from orders."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("d"), (F.col("o_custkey") % 20).cast("string")).alias("dag_id"),
        F.col("o_orderdate").alias("execution_date"),
        F.when(F.col("o_orderstatus") == "F", "success")
        .when(F.col("o_orderstatus") == "O", "running")
        .alias("state"),
        F.col("o_orderdate").alias("last_scheduling_decision"),
    )


FEEDS = {
    "binance_symbol_ticker_stream": binance_ticker,
    "binance_trade_data_stream": binance_trades,
    "binance_ticker_order_book_stream": binance_book_ticker,
    "coinbase_market_trades_stream": coinbase_trades,
    "coinbase_top_of_book_stream": coinbase_level2,
    "cryptocom_trade_data_stream": cryptocom_trades,
    "gemini_multimarketdata_trades": gemini_trades,
    "kraken_trade_data_stream": kraken_trades,
    "kraken_ticker_stream": kraken_ticker,
    "kraken_ohlc_stream": kraken_ohlc,
}


def all_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frames of all ten feeds."""
    frames = None
    for make in FEEDS.values():
        part = make(spark, sf_dir)
        frames = part if frames is None else frames.unionByName(part)
    return frames
