"""Order book of level-2 updates in DataFrame form.

A message is one row until its levels are known: band, bins and dense fill are array
functions over its updates, worked out where the frame is parsed. The messages of a
product are numbered, and the book is cut into chunks of consecutive messages; a
message's bins are shuffled by (product, chunk), and the life of each written level is
worked out inside the chunk. A product with a large share of all updates is thereby
spread over many tasks.

A written level stays in the book until the next write of that level. The best
level at a message is the best among all levels whose span covers the message.
Spans are split into the nodes of binary trees: one over the chunks of a product,
for the chunks that a level outlives untouched, and one over the positions of each
chunk. A node keeps only its best level; a chunk looks at the chunk nodes above
it, a message at the nodes above its position. However long a level stays, it is
at most two nodes for each halving of the whole run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapelake.functions.columns import iso_nanos
from tapelake.operators.messages import coinbase_level2, frames_of
from tapelake.operators.ordered import BUCKET, following
from tapelake.operators.rows import audit_columns
from tapelake.specs import TOP_OF_BOOK

BAND = 50.0
SIDES = ("bid", "offer")

BOOK_MARK = "\x1f"  # between a product and the number of its connection
HOUR_US = 3_600_000_000

# Positions of a chunk: 0 is its start, 1..255 are sequence numbers.
TREE_DEPTH = 8
POSITIONS = 1 << TREE_DEPTH
CHUNK = POSITIONS - 1

LEVEL = ["lvl", "qty", "event_time", "timestamp", "seq"]

# Keys of windows and groups, the most selective one first: sorts compare that
# one by its prefix and rarely reach the text.
IN_CHUNK = ["chunk", "product_id"]


def _typed_updates(landing: DataFrame) -> DataFrame:
    """One line per update, and one for a message without any; ``reason``: what is wrong with it."""
    decoded = coinbase_level2(frames_of(landing, TOP_OF_BOOK))
    messages = decoded.select(
        "value",
        "recv_ts",
        "records",
        F.col("reason").alias("rejected"),
        F.col("msg.product_id").alias("product_id"),
        F.col("msg.channel").alias("channel"),
        F.col("msg.sequence_num").try_cast("bigint").alias("sequence_num"),
        F.expr(iso_nanos("msg.timestamp")).alias("timestamp"),
        *(["connection"] if "connection" in decoded.columns else []),
    )
    rows = messages.select("*", F.posexplode_outer("records").alias("at", "row"))
    typed = rows.select(
        F.col("row").isNotNull().alias("is_update"),
        "at",
        "rejected",
        F.col("row.side").alias("side"),
        F.expr(iso_nanos("row.event_time")).alias("event_time"),
        F.col("row.price_level").try_cast("double").alias("price_level"),
        F.col("row.new_quantity").try_cast("double").alias("new_quantity"),
        "channel",
        "timestamp",
        "sequence_num",
        "product_id",
        "recv_ts",
        "value",
        *(["connection"] if "connection" in decoded.columns else []),
    )
    numeric = ["event_time", "price_level", "new_quantity", "timestamp", "sequence_num"]
    bad = [F.when(F.col(name).isNull(), F.lit(f"bad {name}")) for name in numeric]
    reason = F.when(F.col("is_update"), F.coalesce(*bad)).otherwise(F.col("rejected"))
    return typed.withColumn("reason", reason)


def book_updates(landing: DataFrame) -> DataFrame:
    """One row per good level-2 update, with the shared fields of its message.

    ``digest`` is a hash of the frame's text, ``at`` the update's place in the frame.
    """
    return (
        _typed_updates(landing)
        .where(F.col("is_update") & F.col("reason").isNull())
        .withColumns({"recv_us": F.unix_micros("recv_ts"), "digest": F.xxhash64("value")})
        .drop("recv_ts", "value", "reason", "rejected", "is_update")
    )


def book_rejects(landing: DataFrame) -> DataFrame:
    """Raw text and reason of rejected level-2 messages and of bad updates, from one decoding."""
    bad = F.col("reason").isNotNull()
    return _typed_updates(landing).where(bad).select("value", "reason", *audit_columns("recv_ts"))


WHOLE_MESSAGE = "sequence_num IS NOT NULL AND timestamp IS NOT NULL AND size(updates) > 0"


def book_frames(landing: DataFrame) -> DataFrame:
    """One row per level-2 message with a good update: its fields, and its good ``updates``.

    ``digest`` is a hash of the frame's text. The best prices of the message and what it
    writes follow from the array alone, so nothing is shuffled for them.
    """
    decoded = coinbase_level2(frames_of(landing, TOP_OF_BOOK))
    return decoded.select(*_message_fields(decoded)).where(WHOLE_MESSAGE)


def book_frames_parsed_once(landing: DataFrame) -> DataFrame:
    """``book_frames`` with its filter behind a generator.

    Spark puts the filter below the parse and writes the parse out for each field that it
    names; a generator's own columns it leaves where they are.
    """
    decoded = coinbase_level2(frames_of(landing, TOP_OF_BOOK))
    fields = F.struct(*_message_fields(decoded))
    return decoded.select(F.inline_outer(F.array(fields))).where(WHOLE_MESSAGE)


def _message_fields(decoded: DataFrame) -> list[Column]:
    typed = F.expr(
        "transform(records, r -> named_struct('side', r.side, "
        "'price_level', try_cast(r.price_level AS DOUBLE), "
        "'new_quantity', try_cast(r.new_quantity AS DOUBLE), "
        f"'event_time', {iso_nanos('r.event_time')}))"
    )
    good = F.filter(
        typed,
        lambda u: u["price_level"].isNotNull() & u["new_quantity"].isNotNull() & u["event_time"].isNotNull(),
    )
    return [
        F.col("msg.product_id").alias("product_id"),
        *([F.col("connection")] if "connection" in decoded.columns else []),
        F.col("msg.sequence_num").try_cast("bigint").alias("sequence_num"),
        F.expr(iso_nanos("msg.timestamp")).alias("timestamp"),
        F.unix_micros("recv_ts").alias("recv_us"),
        F.xxhash64("value").alias("digest"),
        good.alias("updates"),
    ]


def in_chunks(messages: DataFrame) -> DataFrame:
    """Shuffle messages by (book, chunk); ``pos`` is a message's place in its chunk.

    Chunks hold CHUNK messages of one book, however many other products share the
    sequence numbers. ``product_id`` becomes the name of the book.
    """
    numbered = books(messages)
    chunk = F.floor(F.col("_ord") / F.lit(CHUNK))
    return (
        numbered.withColumn("chunk", chunk)
        .withColumn("pos", (F.col("_ord") - F.col("chunk") * CHUNK + 1).cast("int"))
        .withColumn("product_id", F.col("_book"))
        .drop("_book", "_ord", "connection", "digest")
        .repartition(*IN_CHUNK)
    )


def books(messages: DataFrame) -> DataFrame:
    """Messages with the ``_book`` they belong to and their number ``_ord`` in it, from 0.

    Numbers start anew with each connection, and so does the book. With a column
    ``connection`` a number that comes again is a repeated delivery, and the first one
    counts. Without it, a message whose number is not above that of the message
    received before it starts a new connection, unless both were received in the same
    microsecond under the same number: that is a repeated delivery too.

    The book of a product's first connection has the product's name; later ones add
    their number, which ``product_of`` takes off again.

    Messages are numbered inside buckets, hours of receipt or ranges of sequence
    numbers, and one row per bucket carries the numbers across the cuts.
    """
    named = "connection" in messages.columns
    keys = ["product_id", "connection"] if named else ["product_id"]
    order = ["sequence_num", "recv_us", "digest"] if named else ["recv_us", "sequence_num", "digest"]
    bucket = F.col("sequence_num") / F.lit(BUCKET) if named else F.col("recv_us") / F.lit(HOUR_US)
    in_bucket = Window.partitionBy(*keys, "_bucket").orderBy(*order)

    before = F.lag("sequence_num").over(in_bucket)
    again = before == F.col("sequence_num")
    if not named:
        again = again & (F.lag("recv_us").over(in_bucket) == F.col("recv_us"))
    falls = F.lit(False) if named else F.coalesce(F.col("sequence_num") <= before, F.lit(False))
    kept = (
        messages.withColumn("_bucket", F.floor(bucket))
        .withColumns({"_again": F.coalesce(again, F.lit(False)), "_falls": falls})
        .where("NOT _again")
        .withColumn("_at", (F.row_number().over(in_bucket) - 1).cast("bigint"))
        .withColumns({
            "_inside": F.sum(F.col("_falls").cast("int")).over(in_bucket),
            "_mark": F.max(F.when(F.col("_falls"), F.col("_at"))).over(in_bucket),
        })
    )
    place = F.struct(*order)
    buckets = kept.groupBy(*keys, "_bucket").agg(
        F.min_by("sequence_num", place).alias("_head"),
        F.max_by("sequence_num", place).alias("_tail"),
        F.sum(F.col("_falls").cast("int")).alias("_sum"),
        F.max("_mark").alias("_last"),
        F.count(F.lit(1)).alias("_size"),
    )
    # One row per bucket of a product that has messages.
    across = Window.partitionBy(*keys).orderBy("_bucket")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    starts = F.lit(False) if named else F.coalesce(F.col("_head") <= F.lag("_tail").over(across), F.lit(False))
    start_rows = F.when(F.col("_starts"), F.col("_rows"))
    carried = (
        buckets.withColumns({"_starts": starts, "_rows": F.coalesce(F.sum("_size").over(earlier), F.lit(0))})
        .withColumns({
            "_earlier": F.coalesce(F.sum(F.col("_sum") + F.col("_starts").cast("int")).over(earlier), F.lit(0))
            + F.col("_starts").cast("int"),
            "_from": F.coalesce(
                start_rows,
                F.max(F.coalesce(F.col("_rows") + F.col("_last"), start_rows)).over(earlier),
                F.lit(0),
            ),
        })
        .select(*keys, "_bucket", "_rows", "_earlier", "_from")
    )
    number = F.col("_earlier") + F.col("_inside")
    later = F.concat_ws(BOOK_MARK, "product_id", number.cast("string"))
    first = F.coalesce(F.col("_rows") + F.col("_mark"), F.col("_from"))
    if named:
        book = F.concat_ws(BOOK_MARK, "product_id", "connection")
    else:
        book = F.when(number == 0, F.col("product_id")).otherwise(later)
    return kept.join(carried, [*keys, "_bucket"]).select(
        *messages.columns,
        book.alias("_book"),
        (F.col("_rows") + F.col("_at") - first).alias("_ord"),
    )


def product_of(book: str) -> Column:
    """Product of a book's name."""
    return F.substring_index(book, BOOK_MARK, 1)


def _bound(value: Column | str, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it.

    Spark puts a filter on the result, also one that it derives itself, below the columns
    the result is made of and writes their expressions out wherever they are named: a
    column named inside a lambda is then worked out anew for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def price_band(messages: DataFrame, band: float = BAND) -> DataFrame:
    """Keep the ``updates`` between the best bid less and the best offer plus ``band``.

    Bounds are those of the update's message. A message without one of the sides
    has no bound there and loses all its updates.
    """

    def prices(updates: Column, side: str) -> Column:
        own = F.filter(updates, lambda u: u["side"] == side)
        return F.transform(own, lambda u: u["price_level"])

    def low(updates: Column) -> Column:
        return F.array_max(prices(updates, "bid")) - F.lit(band)

    def high(updates: Column) -> Column:
        return F.array_min(prices(updates, "offer")) + F.lit(band)

    def inside(updates: Column) -> Column:
        bounds = F.struct(low(updates).alias("lo"), high(updates).alias("hi"))
        return _bound(
            bounds,
            lambda b: F.filter(
                updates, lambda u: u["side"].isin(*SIDES) & u["price_level"].between(b["lo"], b["hi"])
            ),
        )

    bounded = messages.withColumns({"lo_px": low(F.col("updates")), "hi_px": high(F.col("updates"))})
    return bounded.withColumn("updates", _bound("updates", inside))


def _bin(update: Column, width: int) -> Column:
    """A bid is in the bin that starts at or below it, an offer in the one that ends there."""
    scaled = update["price_level"] / F.lit(float(width))
    return F.when(update["side"] == "bid", F.floor(scaled)).otherwise(F.ceil(scaled))


def level_bins(banded: DataFrame, width: int = 1) -> DataFrame:
    """Array ``bins``: quantity and latest time of each bin a message touches.

    ``lvl`` counts bins of ``width``; ``low_px`` and ``high_px`` are the bin's
    extreme prices. The updates of a message are sorted by bin and cut where it
    changes, so a long message costs no more than its sort.
    """
    by_bin = F.array_sort(
        F.transform(
            "updates",
            lambda u: F.struct(
                u["side"].alias("side"),
                _bin(u, width).alias("lvl"),
                u["price_level"].alias("price"),
                u["new_quantity"].alias("qty"),
                u["event_time"].alias("event_time"),
            ),
        )
    )

    def starts(ordered: Column) -> Column:
        def starts_bin(u: Column, i: Column) -> Column:
            before = F.get(ordered, i - 1)
            return ~(before["side"].eqNullSafe(u["side"]) & before["lvl"].eqNullSafe(u["lvl"]))

        return F.array_compact(F.transform(ordered, lambda u, i: F.when(starts_bin(u, i), i)))

    def runs(ordered: Column, cuts: Column) -> Column:
        def run(start: Column, k: Column) -> Column:
            end = F.coalesce(F.get(cuts, k + 1), F.size(ordered))
            return F.slice(ordered, start + 1, end - start)

        return F.transform(cuts, run)

    def summed(u: Column) -> Column:
        return F.struct(
            u[0]["side"].alias("side"),
            u[0]["lvl"].alias("lvl"),
            F.aggregate(u, F.lit(0.0), lambda total, x: total + x["qty"]).alias("qty"),
            F.array_max(u["event_time"]).alias("event_time"),
            u[0]["price"].alias("low_px"),
            F.element_at(u, -1)["price"].alias("high_px"),
        )

    parts = _bound(by_bin, lambda ordered: _bound(starts(ordered), lambda cuts: runs(ordered, cuts)))
    bins = F.coalesce(F.transform(parts, summed), F.array())  # never NULL, so no filter asks and works it out
    return banded.withColumn("bins", bins).drop("updates", "lo_px", "hi_px")


def dense_levels(binned: DataFrame, width: int = 1) -> DataFrame:
    """Array ``levels``: ``bins`` and after them the empty bins around, with quantity 0 and no time.

    The filled range reaches one bin beyond the message's own extremes: bids from
    floor(min)-1 to ceil(max), offers from floor(min) to ceil(max)+1.
    """

    def empty(bins: Column, side: str) -> Column:
        is_bid = side == "bid"

        def missing(own: Column) -> Column:
            low = F.floor(F.array_min(own["low_px"]) / float(width)) - (1 if is_bid else 0)
            high = F.ceil(F.array_max(own["high_px"]) / float(width)) + (0 if is_bid else 1)
            return F.array_except(F.sequence(low, high), own["lvl"])

        gaps = _bound(F.filter(bins, lambda b: b["side"] == side), missing)
        return F.transform(
            F.coalesce(gaps, F.array().cast("array<bigint>")),
            lambda lvl: F.struct(
                F.lit(side).alias("side"),
                lvl.alias("lvl"),
                F.lit(0.0).alias("qty"),
                F.lit(None).cast("bigint").alias("event_time"),
            ),
        )

    def filled(bins: Column) -> Column:
        names = ("side", "lvl", "qty", "event_time")
        own = F.transform(bins, lambda b: F.struct(*(b[name].alias(name) for name in names)))
        return F.concat(own, *(empty(bins, side) for side in SIDES))

    return binned.withColumn("levels", F.coalesce(_bound("bins", filled), F.array())).drop("bins")


def written_levels(binned: DataFrame, width: int = 1) -> DataFrame:
    """Level writes that matter later, each with its life inside the chunk.

    Takes ``level_bins``; the empty bins are filled in where the message has arrived in
    its chunk. ``pos`` is the message's position in the chunk, ``until`` that of the
    chunk's next write of the level, ``first_pos`` that of its first; ``head`` marks one
    level of each message. An empty bin only ends the life of the write before it; it is
    kept if it is the chunk's last word on the level, or the head of its message.
    """
    dense = dense_levels(in_chunks(binned), width).select(
        "product_id",
        "chunk",
        "pos",
        F.col("sequence_num").alias("seq"),
        "timestamp",
        "recv_us",
        F.posexplode("levels").alias("_i", "_level"),
    )
    by_level = Window.partitionBy("lvl", *IN_CHUNK, "side").orderBy("pos")
    lived = dense.select(
        "product_id", "chunk", "pos", "seq", "timestamp", "recv_us", "_level.*", (F.col("_i") == 0).alias("head")
    ).withColumns({"until": F.lead("pos").over(by_level), "first_pos": F.min("pos").over(by_level)})
    return lived.where((F.col("qty") != 0) | F.col("until").isNull() | F.col("head"))


def book_points(written: DataFrame) -> DataFrame:
    """The messages that write to the book."""
    return written.where("head").select("product_id", "chunk", "pos", "seq", "recv_us")


def level_lives(written: DataFrame) -> DataFrame:
    """Levels that outlive their chunk, with the chunk that writes them ``next``, if any.

    Works on one row per (product, chunk, level): its last write. ``chunks`` is the
    number of chunks of the product.
    """
    last = written.where(F.col("until").isNull()).select(
        "product_id", "chunk", "side", *LEVEL, "first_pos"
    )
    chunks = last.groupBy("product_id").agg((F.max("chunk") + 1).alias("chunks"))
    spans = following(
        last, ["product_id", "side", "lvl"], "chunk", F.struct("chunk", "first_pos"), "next"
    )
    return spans.where(F.col("qty") != 0).join(chunks, "product_id")


def ended_levels(lives: DataFrame) -> DataFrame:
    """Levels from earlier chunks in the chunk that writes them next, one row per life.

    They stand at position 0 and last until the chunk's first write of the level.
    """
    return lives.where(F.col("next").isNotNull()).select(
        "product_id",
        F.col("next.chunk").alias("chunk"),
        "side",
        *LEVEL,
        F.lit(0).alias("pos"),
        F.col("next.first_pos").alias("until"),
    )


def chunk_nodes(lives: DataFrame) -> DataFrame:
    """Levels at the tree nodes over the chunks that they outlive untouched.

    Node (height h, index i) holds the chunks i * 2**h to (i + 1) * 2**h - 1. A life
    is at most two nodes of each height.
    """
    end = F.coalesce("next.chunk", "chunks")
    return (
        lives.withColumns({"first": F.col("chunk") + 1, "end": end})
        .where("first < end")
        .withColumn("node", F.explode(F.expr(_chunk_cover("first", "end"))))
        .select("product_id", "side", *LEVEL, "node.h", "node.i")
    )


def _chunk_cover(first: str, end: str) -> str:
    """Nodes that together hold the chunks ``first`` to ``end`` - 1."""
    low = f"shiftright({first} + shiftleft(1L, h) - 1, h)"
    high = f"shiftright({end}, h)"

    def node(test: str, at: str) -> str:
        return f"CASE WHEN {low} < {high} AND {test} % 2 = 1 THEN named_struct('h', h, 'i', {at}) END"

    heights = f"sequence(0, CAST(ceil(log2({end} + 1)) AS INT))"
    return (
        f"array_compact(flatten(transform({heights}, h -> "
        f"array({node(low, low)}, {node(high, high + ' - 1')}))))"
    )


def chunks_under(nodes: DataFrame, written: DataFrame) -> DataFrame:
    """Levels of the nodes at each chunk of ``written`` below them, each chunk under at most log2 nodes."""
    chunks = written.select(*IN_CHUNK).distinct()
    tops = written.groupBy("product_id").agg(F.max("chunk").alias("top"))
    heights = F.sequence(F.lit(0), F.ceil(F.log2(F.col("top") + 2)).cast("int"))
    above = (
        chunks.join(tops, "product_id")
        .withColumn("h", F.explode(heights))
        .select(*IN_CHUNK, "h", F.expr("shiftright(chunk, h)").alias("i"))
    )
    return above.join(nodes, ["product_id", "h", "i"]).drop("h", "i")


def standing_levels(nodes: DataFrame, written: DataFrame) -> DataFrame:
    """Best level per side among those that stand through a whole chunk."""
    level = F.struct(*LEVEL)
    best = F.when(F.col("side") == "bid", F.max(level)).otherwise(F.min(level)).alias("best")

    def reduced(levels: DataFrame, *keys: str) -> DataFrame:
        return levels.groupBy(*keys, "side").agg(best).select(*keys, "side", "best.*")

    by_node = reduced(nodes, "product_id", "h", "i")
    return _standing(reduced(chunks_under(by_node, written), *IN_CHUNK))


def contenders(nodes: DataFrame, written: DataFrame) -> DataFrame:
    """Levels that stand through a whole chunk and could be the best one after some reset.

    A reset removes all levels written before it. So a level shows only if no newer
    one is at least as good; the others are left out, at the nodes and at the chunks.
    """
    better = F.when(F.col("side") == "bid", F.col("lvl")).otherwise(-F.col("lvl"))

    def front(levels: DataFrame, *keys: str) -> DataFrame:
        newer = (
            Window.partitionBy(*keys, "side")
            .orderBy(F.desc("seq"), F.desc("_better"))
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        ranked = levels.withColumn("_better", better).withColumn("_newer", F.max("_better").over(newer))
        kept = F.col("_newer").isNull() | (F.col("_better") > F.col("_newer"))
        return ranked.where(kept).drop("_better", "_newer")

    by_node = front(nodes, "product_id", "h", "i")
    return _standing(front(chunks_under(by_node, written), *IN_CHUNK))


def _standing(levels: DataFrame) -> DataFrame:
    return levels.select(
        *IN_CHUNK, "side", *LEVEL, F.lit(0).alias("pos"), F.lit(POSITIONS).alias("until")
    )


def level_spans(written: DataFrame, resets: bool = False) -> DataFrame:
    """Live levels of each chunk, from position ``pos`` to before ``until``.

    Of the levels that stand through a whole chunk only the best is given, or with
    ``resets`` all that could become the best once older ones are removed.
    """
    own = written.where(F.col("qty") != 0).select(
        "product_id",
        "chunk",
        "side",
        *LEVEL,
        "pos",
        F.coalesce("until", F.lit(POSITIONS)).alias("until"),
    )
    lives = level_lives(written)
    standing = (contenders if resets else standing_levels)(chunk_nodes(lives), written)
    return own.unionByName(ended_levels(lives)).unionByName(standing)


def _tree_nodes(first: str, until: str) -> Column:
    """Nodes that together cover positions ``first`` to ``until`` - 1.

    Node 1 is the whole chunk, nodes 2n and 2n+1 are the halves of node n, and
    position p is node POSITIONS + p.
    """
    nodes = []
    for height in range(TREE_DEPTH + 1):
        low = f"shiftright({first} + {POSITIONS + (1 << height) - 1}, {height})"
        high = f"shiftright({until} + {POSITIONS}, {height})"
        nodes.append(f"CASE WHEN {low} < {high} AND {low} % 2 = 1 THEN {low} END")
        nodes.append(f"CASE WHEN {low} < {high} AND {high} % 2 = 1 THEN {high} - 1 END")
    return F.expr(f"array_compact(array({', '.join(nodes)}))")


def _nodes_above(pos: str) -> Column:
    heights = range(TREE_DEPTH + 1)
    return F.expr(f"array({', '.join(f'shiftright({pos} + {POSITIONS}, {h})' for h in heights)})")


def best_levels(written: DataFrame) -> DataFrame:
    """Best bid and offer after each message, and those before it.

    One row per (product, message): ``bid``, ``offer``, ``old_bid``,
    ``old_offer``, each a level or NULL. A chunk's first message finds those
    before it at the chunk's start. Reads ``written`` several times.

    Spans and messages are shuffled once, by (product, chunk). Both are unfolded
    to tree nodes there; a window hands each node's best level to the messages
    that look at it.
    """
    spans = level_spans(written).withColumnRenamed("seq", "level_seq")
    points = book_points(written)
    starts = points.select(*IN_CHUNK).distinct().withColumn("pos", F.lit(0))
    points = points.unionByName(starts, allowMissingColumns=True)
    placed = spans.unionByName(points, allowMissingColumns=True).repartition(*IN_CHUNK)

    is_span = F.col("side").isNotNull()
    nodes = F.when(is_span, _tree_nodes("pos", "until")).otherwise(_nodes_above("pos"))
    by_node = Window.partitionBy("node", *IN_CHUNK)
    level = F.struct("lvl", "qty", "event_time", "timestamp", F.col("level_seq").alias("seq"))
    looked_up = (
        placed.withColumn("node", F.explode(nodes))
        .withColumns(
            {
                "bid": F.max(F.when(F.col("side") == "bid", level)).over(by_node),
                "offer": F.min(F.when(F.col("side") == "offer", level)).over(by_node),
            }
        )
        .where(~is_span)
    )
    best = looked_up.groupBy("pos", *IN_CHUNK).agg(
        F.max("seq").alias("seq"),
        F.max("recv_us").alias("recv_us"),
        F.max("bid").alias("bid"),
        F.min("offer").alias("offer"),
    )
    in_order = Window.partitionBy(*IN_CHUNK).orderBy("pos")
    return best.withColumns(
        {"old_bid": F.lag("bid").over(in_order), "old_offer": F.lag("offer").over(in_order)}
    ).where(F.col("pos") > 0)


def quote_view(best: DataFrame, symmetric: bool = False, width: int = 1) -> DataFrame:
    """Quote rows of each message: one, or two where the sides moved apart in time.

    A missing side is taken from the book before. With a complete earlier book,
    a bid that is older than the offer first meets the earlier offer in a row of
    its own, if both its time and its price are new; the last row carries the
    later of the two times. ``symmetric`` adds the mirrored extra row for an
    offer that is older than the bid. ``changed`` tells whether the best levels
    differ from those before, ``crossed`` whether the message's first row has a
    bid at or above its offer.
    """
    sides = best.selectExpr(
        "product_id",
        "seq AS message",
        "recv_us",
        "coalesce(bid, old_bid) AS nb",
        "coalesce(offer, old_offer) AS na",
        "old_bid AS ob",
        "old_offer AS oa",
        "old_bid IS NOT NULL AND old_offer IS NOT NULL AS had_book",
        "NOT (bid <=> old_bid AND offer <=> old_offer) AS changed",
    ).where("nb IS NOT NULL AND na IS NOT NULL")

    def quote(k: int, time: str, bid: str, offer: str, seq: str) -> str:
        return (
            f"named_struct('k', {k}, 'event_time', {time}.event_time, "
            f"'bid_px', {bid}.lvl * {float(width)}D, 'bid_sz', {bid}.qty, "
            f"'offer_px', {offer}.lvl * {float(width)}D, 'offer_sz', {offer}.qty, "
            f"'sequence_num', {seq}.seq, 'timestamp', nb.timestamp)"
        )

    def moved(new: str, old: str) -> str:
        return f"{new}.event_time <> {old}.event_time AND {new}.lvl <> {old}.lvl"

    bid_first = "had_book AND nb.event_time < na.event_time"
    offer_first = "had_book AND nb.event_time >= na.event_time"
    rows = [
        f"CASE WHEN {bid_first} AND {moved('nb', 'ob')} "
        f"THEN {quote(0, 'nb', 'nb', 'oa', 'nb')} END"
    ]
    if symmetric:
        rows.append(
            f"CASE WHEN {offer_first} AND {moved('na', 'oa')} "
            f"THEN {quote(0, 'na', 'ob', 'na', 'na')} END"
        )
    rows.append(
        f"CASE WHEN {bid_first} THEN {quote(1, 'na', 'nb', 'na', 'na')} "
        f"WHEN {offer_first} THEN {quote(1, 'nb', 'nb', 'na', 'nb')} "
        f"ELSE {quote(1, 'na', 'nb', 'na', 'nb')} END"
    )
    viewed = sides.withColumn("rows", F.expr(f"array_compact(array({', '.join(rows)}))"))
    return viewed.selectExpr(
        "product_id",
        "message",
        "recv_us",
        "changed",
        "rows[0].bid_px >= rows[0].offer_px AS crossed",
        "inline(rows)",
    )
