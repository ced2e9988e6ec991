"""Level-2 messages to the change-only top-of-book table.

The DataFrame form is exact for a product up to its first crossing. From the chunk of
that crossing on, the rows come from the chunked fold, which knows resets.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.operators.book import (
    best_levels,
    book_frames,
    book_points,
    level_bins,
    level_spans,
    price_band,
    product_of,
    quote_view,
    written_levels,
)
from tapelake.operators.fold import (
    NEVER,
    Book,
    compose,
    follow,
    read_chunk,
    read_steps,
    replay,
    reset_steps,
)
from tapelake.operators.rows import audit_columns
from tapelake.specs import TABLES, TOP_OF_BOOK
from tapelake.workspace import materialize

# Chunks whose step functions one task joins.
STRETCH = 4096

STEPS = "product_id string, {place} bigint, upto bigint, last_reset bigint"
STARTS = "product_id string, {place} bigint, last_reset bigint"
QUOTES = (
    "product_id string, message bigint, recv_us bigint, reset boolean, k int, "
    "event_time bigint, bid_px double, bid_sz double, offer_px double, offer_sz double, "
    "sequence_num bigint, timestamp bigint"
)


def book_table(landing: DataFrame, width: int = 1) -> DataFrame:
    """Level writes as a table that later steps read; each frame is parsed once."""
    binned = materialize(level_bins(price_band(book_frames(landing)), width), "book-frames")
    return materialize(written_levels(binned, width), "book-writes")


def top_of_book(
    landing: DataFrame, symmetric: bool = False, width: int = 1
) -> DataFrame:
    """Rows of ``coinbase_top_of_book_stream``."""
    written = book_table(landing, width)
    views = quote_view(best_levels(written), symmetric, width)
    views = materialize(views.where(F.col("changed") | F.col("crossed")), "quotes")
    quotes = views.where("changed")
    crossed = views.where("crossed").groupBy("product_id").agg(F.min("message").alias("first_crossed"))
    if not crossed.isEmpty():
        since = (
            book_points(written)
            .join(crossed, "product_id")
            .where("seq = first_crossed")
            .select("product_id", "first_crossed", F.col("chunk").alias("first_chunk"))
        )
        since = materialize(since, "first-crossings")
        folded = quotes_with_resets(written, symmetric, width, since)
        before = quotes.join(since.drop("first_chunk"), "product_id", "left").where(
            "first_crossed IS NULL OR message < first_crossed"
        )
        quotes = before.drop("first_crossed").unionByName(folded, allowMissingColumns=True)
    return as_table(quotes)


def as_table(quotes: DataFrame) -> DataFrame:
    """Quote rows in the columns of the table."""
    return quotes.select(
        product_of("product_id").alias("symbol"),
        "event_time",
        "bid_px",
        "bid_sz",
        "offer_px",
        "offer_sz",
        "sequence_num",
        F.lit("l2_data").alias("channel"),
        "timestamp",
        *audit_columns("timestamp_micros(recv_us)"),
    ).select(TABLES[TOP_OF_BOOK].schema.names)


def quotes_with_resets(
    written: DataFrame, symmetric: bool = False, width: int = 1, since: DataFrame | None = None
) -> DataFrame:
    """Emitted quote rows of ``written_levels``, with ``reset`` marking resets.

    ``since`` names the first crossed message of each product to fold, and its chunk
    (product_id, first_crossed, first_chunk). Nothing was reset before it, so the levels
    carried into that chunk are whole, and only rows from that message on are given.
    """
    levels = _chunk_levels(written)
    if since is not None:
        levels = _from_first(levels, since)
    levels = materialize(levels, "book-levels")
    starts = materialize(_chunk_starts(levels), "chunk-starts")
    known = levels.join(starts, ["product_id", "chunk"]).where(
        (F.col("pos") > 0) | (F.col("seq") >= F.col("last_reset"))
    )

    def emit(key: tuple, chunk: pa.Table) -> pa.Table:
        carried, messages = read_chunk(chunk.to_pydict())
        rows, _ = replay(Book(carried), messages, symmetric, width)
        columns = [[key[0].as_py()] * len(rows), *(zip(*rows) if rows else [[]] * 11)]
        return _table(columns, QUOTES)

    quotes = known.groupBy("product_id", "chunk").applyInArrow(emit, QUOTES)
    if since is None:
        return quotes
    return (
        quotes.join(since.drop("first_chunk"), "product_id")
        .where("message >= first_crossed")
        .drop("first_crossed")
    )


def _from_first(levels: DataFrame, since: DataFrame) -> DataFrame:
    """Levels and messages of the chunks from a product's first crossing on."""
    return (
        levels.join(since.drop("first_crossed"), "product_id").where("chunk >= first_chunk").drop("first_chunk")
    )


def reset_counts(quotes: DataFrame) -> DataFrame:
    """Number of messages that reset the book of each product."""
    resets = quotes.where(F.col("reset") & (F.col("k") == 1))
    return resets.groupBy("product_id").agg(F.count(F.lit(1)).alias("resets"))


def _chunk_levels(written: DataFrame) -> DataFrame:
    """Live levels of each chunk with their spans, and a row without level per message."""
    points = book_points(written)
    return level_spans(written, resets=True).unionByName(points, allowMissingColumns=True)


def _chunk_starts(levels: DataFrame) -> DataFrame:
    """Last reset before each chunk, -1 if there is none."""

    def chunk_steps(key: tuple, chunk: pa.Table) -> pa.Table:
        steps = reset_steps(*read_chunk(chunk.to_pydict()))
        return _steps_table(key, steps, "chunk")

    def stretch_steps(key: tuple, chunks: pa.Table) -> pa.Table:
        _, functions = read_steps(chunks.to_pydict(), "chunk")
        return _steps_table(key, compose(functions), "stretch")

    def stretch_starts(key: tuple, stretches: pa.Table) -> pa.Table:
        places, functions = read_steps(stretches.to_pydict(), "stretch")
        starts = list(follow(functions, NEVER))
        return _table([[key[0].as_py()] * len(places), places, starts], STARTS.format(place="stretch"))

    def chunk_starts(key: tuple, chunks: pa.Table) -> pa.Table:
        columns = chunks.to_pydict()
        places, functions = read_steps(columns, "chunk")
        starts = list(follow(functions, columns["start"][0]))
        return _table([[key[0].as_py()] * len(places), places, starts], STARTS.format(place="chunk"))

    steps = levels.groupBy("product_id", "chunk").applyInArrow(
        chunk_steps, STEPS.format(place="chunk")
    )
    steps = materialize(steps, "chunk-steps").withColumn(
        "stretch", F.floor(F.col("chunk") / STRETCH)
    )
    stretches = steps.groupBy("product_id", "stretch").applyInArrow(
        stretch_steps, STEPS.format(place="stretch")
    )
    starts = (
        stretches.groupBy("product_id")
        .applyInArrow(stretch_starts, STARTS.format(place="stretch"))
        .withColumnRenamed("last_reset", "start")
    )
    return (
        steps.join(starts, ["product_id", "stretch"])
        .groupBy("product_id", "stretch")
        .applyInArrow(chunk_starts, STARTS.format(place="chunk"))
    )


def _steps_table(key: tuple, steps: list[tuple[int, int | None]], place: str) -> pa.Table:
    upto, last_reset = zip(*steps, strict=True)
    labels = [[part.as_py()] * len(steps) for part in key]
    return _table([*labels, upto, last_reset], STEPS.format(place=place))


ARROW_TYPES = {
    "string": pa.string(),
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
}


def _table(columns: list, ddl: str) -> pa.Table:
    """Arrow table with the types of a DDL text, columns by position."""
    fields = [field.split() for field in ddl.split(", ")]
    arrays = [
        pa.array(list(values), type=ARROW_TYPES[type_])
        for values, (_, type_) in zip(columns, fields, strict=True)
    ]
    return pa.table(dict(zip([name for name, _ in fields], arrays, strict=True)))
