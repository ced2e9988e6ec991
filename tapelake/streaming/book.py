"""Top of book as a stream: the book of each product is keyed state.

A micro-batch hands all new updates of a product to its state function, which
takes them in the order in which they were received; ``maxFilesPerTrigger`` of the
landing stream bounds how many that are. Messages of different micro-batches are
taken in the order of the batches. The state holds the last number and the live
levels: the best levels before a message follow from them.

Where the frames name their ``connection``, each connection of a product has a state of
its own, and a message whose number is not above the last one is a repeated delivery
and passed over. Elsewhere such a message starts a new connection, and with it an
empty book.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.storagelevel import StorageLevel

from tapelake.operators.book import BAND, SIDES, book_frames_parsed_once, book_rejects
from tapelake.operators.fold import NEVER, Book, Level, Message, message_levels, replay
from tapelake.plans.top_of_book import QUOTES, as_table
from tapelake.sources.tables import Lake
from tapelake.specs import TOP_OF_BOOK
from tapelake.streaming.ingest import start, write_counts, write_rejects

STATE = (
    "last bigint, side array<int>, lvl array<bigint>, qty array<double>, event_time array<bigint>, "
    "timestamp array<bigint>, seq array<bigint>"
)
MESSAGE = ["sequence_num", "timestamp", "recv_us", "digest"]
UPDATES = {"sides": "int8", "prices": "float64", "quantities": "float64", "times": "int64"}
MESSAGES_AT_ONCE = 10_000
LARGEST_BIN = 2.0**62  # whole numbers of this size have room in a bigint
QUOTE_COLUMNS = [field.split()[0] for field in QUOTES.split(", ")]


def stream_quotes(frames: DataFrame, symmetric: bool = False, width: int = 1) -> DataFrame:
    """Emitted quote rows of streaming level-2 frames.

    A message comes as one row with its updates in arrays, and is kept in flat arrays of
    numbers until its turn; quotes are handed on in pieces.
    """

    def advance(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        last, book = _load(state.get) if state.exists else (NEVER, Book())
        messages = Messages(batches, last if named else None)
        for run in messages.first_deliveries() if named else messages.connections():
            if messages.number(run[0]) <= last:
                book = Book()
            for at in range(0, len(run), MESSAGES_AT_ONCE):
                some = messages.read(run[at : at + MESSAGES_AT_ONCE], width)
                emitted, book = replay(book, some, symmetric, width)
                quotes = pd.DataFrame(emitted, columns=QUOTE_COLUMNS[1:])
                quotes.insert(0, QUOTE_COLUMNS[0], key[0])
                yield quotes
            last = messages.number(run[-1])
        state.update(_store(last, book))

    messages = book_frames_parsed_once(frames)
    messages = messages.withColumn("updates", F.filter("updates", lambda u: u["side"].isin(*SIDES)))
    named = "connection" in messages.columns
    keys = ["product_id", *(["connection"] if named else [])]
    return (
        messages.select(*keys, *MESSAGE, *_flat_updates())
        .groupBy(*keys)
        .applyInPandasWithState(advance, QUOTES, STATE, "append", GroupStateTimeout.NoTimeout)
    )


def _flat_updates() -> list[Column]:
    """The updates, an array for each field."""
    return [
        F.transform("updates.side", lambda side: (side == SIDES[1]).cast("tinyint")).alias("sides"),
        F.col("updates.price_level").alias("prices"),
        F.col("updates.new_quantity").alias("quantities"),
        F.col("updates.event_time").alias("times"),
    ]


class Messages:
    """A micro-batch's messages of one book as arrays, a row each, and their updates one after another."""

    def __init__(self, batches: Iterator[pd.DataFrame], above: int | None = None):
        """``above``: leave out messages whose number is not above it."""
        kinds = dict.fromkeys([*MESSAGE, "sizes"], "int64") | UPDATES
        # They grow in place: arrays of each batch would be kept apart by what is freed between them.
        grown = {name: bytearray() for name in kinds}
        for batch in batches:
            if above is not None:
                batch = batch[batch["sequence_num"] > above]
            if not len(batch):
                continue
            for name in MESSAGE:
                grown[name] += batch[name].to_numpy("int64").tobytes()
            grown["sizes"] += batch["sides"].map(len).to_numpy("int64").tobytes()
            for name, kind in UPDATES.items():
                grown[name] += np.concatenate(batch[name].to_list()).astype(kind, copy=False).tobytes()
        self.columns = {name: np.frombuffer(grown[name], kind) for name, kind in kinds.items()}
        self.starts = np.concatenate([[0], np.cumsum(self.columns.pop("sizes"))])

    def number(self, at: int) -> int:
        return int(self.columns["sequence_num"][at])

    def _once(self, order: list[str], same: list[str]) -> np.ndarray:
        """Places in an order, the first of those that are the same."""
        places = np.lexsort([self.columns[name] for name in reversed(order)])
        again = np.ones(max(len(places) - 1, 0), bool)
        for name in same:
            values = self.columns[name][places]
            again &= values[1:] == values[:-1]
        return places[np.concatenate([np.ones(min(len(places), 1), bool), ~again])]

    def connections(self) -> Iterator[np.ndarray]:
        """Runs of messages in which the number rises, in the order in which they came.

        Of messages with one number, received in one microsecond, the one with the smallest
        digest counts.
        """
        places = self._once(["recv_us", "sequence_num", "digest"], ["recv_us", "sequence_num"])
        numbers = self.columns["sequence_num"][places]
        cuts = [i + 1 for i in (numbers[1:] <= numbers[:-1]).nonzero()[0].tolist()]
        for start, end in pairwise([0, *cuts, len(places)]):
            if end > start:
                yield places[start:end]

    def first_deliveries(self) -> Iterator[np.ndarray]:
        """Messages in the order of their numbers, each as it came first."""
        run = self._once(["sequence_num", "recv_us", "digest"], ["sequence_num"])
        if len(run):
            yield run

    def read(self, places: np.ndarray, width: int) -> Iterator[Message]:
        """The messages at some places that write levels.

        Bands and bins of all of them are worked out at once; the empty bins around are left
        to the book as ranges. A message with a price that no bin can hold goes through
        ``message_levels``.
        """
        seqs, timestamps, received = (
            self.columns[name][places] for name in ("sequence_num", "timestamp", "recv_us")
        )
        sizes = self.starts[places + 1] - self.starts[places]
        message = np.repeat(np.arange(len(places)), sizes)
        first = np.cumsum(sizes) - sizes
        at = np.arange(len(message)) + np.repeat(self.starts[places] - first, sizes)
        side, price, quantity, event_time = (self.columns[name][at] for name in UPDATES)
        odd = np.zeros(len(places), bool)
        odd[message[~(np.abs(price / width) < LARGEST_BIN)]] = True

        best_bid, best_offer = np.full(len(places), -np.inf), np.full(len(places), np.inf)
        is_bid, is_offer = (side == 0) & ~odd[message], (side == 1) & ~odd[message]
        np.maximum.at(best_bid, message[is_bid], price[is_bid])
        np.minimum.at(best_offer, message[is_offer], price[is_offer])
        both = np.isfinite(best_bid) & np.isfinite(best_offer)
        low, high = best_bid - BAND, best_offer + BAND
        inside = both[message] & (low[message] <= price) & (price <= high[message])
        message, side, quantity, event_time = (x[inside] for x in (message, side, quantity, event_time))
        scaled = price[inside] / width
        down, up = np.floor(scaled).astype("int64"), np.ceil(scaled).astype("int64")

        sides = message * 2 + side
        lvl = np.where(side == 0, down, up)
        order = np.lexsort([lvl, sides])
        starts_side = np.diff(sides[order], prepend=-1) != 0
        starts_bin = starts_side | (np.diff(lvl[order], prepend=0) != 0)
        bin_of, side_of = np.empty_like(order), np.empty_like(order)
        bin_of[order], side_of[order] = np.cumsum(starts_bin) - 1, np.cumsum(starts_side) - 1
        heads, ranges = order[starts_bin], order[starts_side]
        latest = np.zeros(len(heads), "int64")
        np.maximum.at(latest, bin_of, event_time)
        lowest, highest = down[ranges], up[ranges]
        np.minimum.at(lowest, side_of, down)
        np.maximum.at(highest, side_of, up)

        of_bin, of_range = message[heads], message[ranges]
        total = np.bincount(bin_of, quantity, len(heads))  # adds in the order of the updates
        values = (lvl[heads], total, latest, timestamps[of_bin], seqs[of_bin])
        levels = list(zip(side[heads].tolist(), map(Level._make, zip(*(v.tolist() for v in values)))))
        range_side = side[ranges].astype("int64")
        cleared = (range_side, lowest - (range_side == 0), highest + range_side)
        cleared = list(zip(*(v.tolist() for v in cleared)))
        number = np.arange(len(places) + 1)
        bounds = np.searchsorted(of_bin, number).tolist(), np.searchsorted(of_range, number).tolist()
        for i, (seq, recv_us, is_odd) in enumerate(zip(seqs.tolist(), received.tolist(), odd.tolist(), strict=True)):
            (bins, bins_end), (own, own_end) = (b[i : i + 2] for b in bounds)
            if is_odd:
                written = message_levels(self._updates(int(places[i])), int(timestamps[i]), seq, BAND, width)
                if written:
                    yield Message(seq, recv_us, written)
            elif own < own_end:
                yield Message(seq, recv_us, levels[bins:bins_end], cleared[own:own_end])

    def _updates(self, place: int) -> Iterator[tuple]:
        """Updates of one message as (side, price, quantity, event time)."""
        own = slice(int(self.starts[place]), int(self.starts[place + 1]))
        sides, *values = (self.columns[name][own].tolist() for name in UPDATES)
        return zip([SIDES[side] for side in sides], *values, strict=True)


def start_top_of_book(
    frames: DataFrame, lake: Lake, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Quote rows to their table, rejected messages and updates to the quarantine, and counts of both."""
    quotes, rejects = as_table(stream_quotes(frames)), book_rejects(frames)
    both = quotes.withColumn("value", F.lit(None).cast("string")).unionByName(
        rejects, allowMissingColumns=True
    )
    rejected = F.col("reason").isNotNull()

    def write(batch: DataFrame, load: str) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            lake.append(batch.where(~rejected), TOP_OF_BOOK, load)
            write_rejects(batch.where(rejected).select(rejects.columns), TOP_OF_BOOK, lake, load)
            counts = batch.agg(
                F.count(F.when(~rejected, 1)).alias("rows_processed"),
                F.count(F.when(rejected, 1)).alias("rows_rejected"),
            )
            write_counts([counts.withColumn("table", F.lit(TOP_OF_BOOK)).first()], lake, load)
        finally:
            batch.unpersist()

    return start(both, write, checkpoint, available_now, TOP_OF_BOOK)


def _load(state: tuple) -> tuple[int, Book]:
    last, sides, *columns = state
    levels = zip(sides, zip(*columns, strict=True), strict=True)
    return int(last), Book((int(side), Level(*level)) for side, level in levels)


def _store(last: int, book: Book) -> tuple:
    levels = [(side, *level) for side in (0, 1) for level in book.live[side].values()]
    columns = [list(column) for column in zip(*levels, strict=True)] if levels else [[]] * 6
    return (last, *columns)
