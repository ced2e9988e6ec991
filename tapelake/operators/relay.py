"""Relay envelopes: unwrap, filter by stream, measure the relay's latency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRADE_STREAM = "btcusdt@trade"


def unwrap(envelopes: DataFrame) -> DataFrame:
    """``sent`` (seconds), ``stream``, ``value`` (inner message), ``recv_ts``.

    The outer ``data`` is itself a JSON text, so it is parsed in a second step.
    """
    outer = envelopes.select(
        "exchange",
        "recv_ts",
        F.from_json("value", "timestamp double, data string").alias("outer"),
    )
    inner = outer.select(
        "exchange",
        "recv_ts",
        F.col("outer.timestamp").alias("sent"),
        F.from_json("outer.data", "stream string, data string").alias("inner"),
    )
    return inner.select(
        "exchange",
        "recv_ts",
        "sent",
        F.col("inner.stream").alias("stream"),
        F.col("inner.data").alias("value"),
    )


def stream_messages(envelopes: DataFrame, stream: str = TRADE_STREAM) -> DataFrame:
    """Inner messages of one stream, as landing frames of its feed."""
    feed = F.substring_index("stream", "@", -1).alias("feed")
    return (
        unwrap(envelopes)
        .where(F.col("stream") == stream)
        .select("exchange", feed, "value", "recv_ts")
    )


def relay_latency(envelopes: DataFrame) -> DataFrame:
    """Milliseconds between sending and receiving of each message."""
    latency = (F.unix_micros("recv_ts") / F.lit(1e6) - F.col("sent")) * 1000
    return unwrap(envelopes).select(
        "stream", "sent", F.unix_micros("recv_ts").alias("recv_us"), latency.alias("latency_ms")
    )


SKETCH_SIZE = 1_000  # k of the sketch: its ranks are off by about 2.3 / k ** 0.92 at most
SUMMED = ("messages", "total_ms", "min_ms", "max_ms", "sketch")


def hourly_latency(latency: DataFrame, k: int = SKETCH_SIZE) -> DataFrame:
    """One line per stream and UTC hour: count, sum, least and largest latency, and a quantile sketch.

    Lines of the same or of different hours can be merged, so they can be kept and added
    to. Sketches are made before the shuffle: a stream with most messages sends one for
    each task and hour.
    """
    hour = F.timestamp_micros(F.floor(F.col("recv_us") / 3_600_000_000) * 3_600_000_000).alias("hour")
    ms = F.col("latency_ms")
    return latency.where(ms.isNotNull()).groupBy("stream", hour).agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum(ms).alias("total_ms"),
        F.min(ms).alias("min_ms"),
        F.max(ms).alias("max_ms"),
        F.kll_sketch_agg_double(ms, F.lit(k)).alias("sketch"),
    )


def merged_latency(hourly: DataFrame, keys: list[str | Column], k: int = SKETCH_SIZE) -> DataFrame:
    """Lines of ``hourly_latency`` merged by other keys, as stream and day; they can be merged on."""
    return hourly.groupBy(*keys).agg(
        F.sum("messages").alias("messages"),
        F.sum("total_ms").alias("total_ms"),
        F.min("min_ms").alias("min_ms"),
        F.max("max_ms").alias("max_ms"),
        F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"),
    )


def latency_summary(merged: DataFrame, ranks: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Messages, least, mean and largest latency and some percentiles (``p50_ms``, ...) of merged lines."""
    keys = [name for name in merged.columns if name not in SUMMED]
    percentiles = [
        F.kll_sketch_get_quantile_double("sketch", F.lit(rank)).alias(f"p{round(rank * 100)}_ms")
        for rank in ranks
    ]
    mean = (F.col("total_ms") / F.col("messages")).alias("mean_ms")
    return merged.select(*keys, "messages", "min_ms", mean, "max_ms", *percentiles)
