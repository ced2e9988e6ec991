"""The book as a fold over messages, for books that cross.

When the first quote row of a message has its bid at or above its offer, the
book is reset to the levels of that message alone. Whether that happens depends
on the resets before it, so the step is sequential. It still runs in parallel:

* the book at the start of a chunk depends on earlier resets only through the
  sequence number s of the last one: it is the carried levels written at or
  after s;
* so a chunk is a function from s to the last reset at its end, constant between
  a few thresholds. ``reset_steps`` finds them (one task per chunk), ``compose``
  joins the functions of neighbouring chunks, ``follow`` runs s through them;
* with its s known, each chunk emits its rows on its own (``replay``).

The functions here work on one bounded chunk, or on one short list of steps.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from heapq import heappop, heappush
from itertools import groupby
from math import ceil, floor
from typing import NamedTuple

NEVER = -1
ANY = 2**63 - 1


class Level(NamedTuple):
    lvl: int
    qty: float
    event_time: int
    timestamp: int
    seq: int


class Message(NamedTuple):
    """``cleared``: ranges (side, lowest, highest) that are emptied before ``levels`` are written."""

    seq: int
    recv_us: int
    levels: list[tuple[int, Level]]
    cleared: Sequence[tuple[int, int, int]] = ()


Best = tuple[Level | None, Level | None]
Steps = list[tuple[int, int | None]]


class Book:
    """Live levels of one product, bids first. Heaps give the best level and hold each level once."""

    def __init__(self, levels: Iterable[tuple[int, Level]] = ()):
        self.live: tuple[dict[int, Level], dict[int, Level]] = ({}, {})
        self.heaps: tuple[list[int], list[int]] = ([], [])
        self.queued: tuple[set[int], set[int]] = (set(), set())
        self.write(levels)

    def clear(self, side: int, low: int, high: int) -> None:
        """Empty the levels from ``low`` to ``high``."""
        live = self.live[side]
        for lvl in range(low, high + 1):
            if lvl in live:
                del live[lvl]

    def write(self, levels: Iterable[tuple[int, Level]]) -> None:
        for side, level in levels:
            live = self.live[side]
            if level.qty == 0:
                live.pop(level.lvl, None)
                continue
            if level.lvl not in self.queued[side]:
                heappush(self.heaps[side], level.lvl if side else -level.lvl)
                self.queued[side].add(level.lvl)
            live[level.lvl] = level

    def best(self) -> Best:
        return self._best(0), self._best(1)

    def _best(self, side: int) -> Level | None:
        heap, live = self.heaps[side], self.live[side]
        while heap:
            lvl = heap[0] if side else -heap[0]
            if lvl in live:
                return live[lvl]
            heappop(heap)
            self.queued[side].remove(lvl)
        return None


def quotes(old: Best, new: Best, symmetric: bool = False) -> list[tuple]:
    """Quote rows (event_time, bid, offer, sequence_num) of one message."""
    old_bid, old_ask = old
    bid, ask = new[0] or old_bid, new[1] or old_ask
    if bid is None or ask is None:
        return []
    if old_bid is None or old_ask is None:
        return [(ask.event_time, bid, ask, bid.seq)]
    if bid.event_time < ask.event_time:
        last = (ask.event_time, bid, ask, ask.seq)
        if bid.event_time != old_bid.event_time and bid.lvl != old_bid.lvl:
            return [(bid.event_time, bid, old_ask, bid.seq), last]
        return [last]
    last = (bid.event_time, bid, ask, bid.seq)
    if symmetric and ask.event_time != old_ask.event_time and ask.lvl != old_ask.lvl:
        return [(ask.event_time, old_bid, ask, ask.seq), last]
    return [last]


def message_levels(
    updates: Iterable[tuple], timestamp: int, seq: int, band: float, width: int = 1
) -> list[tuple[int, Level]]:
    """Levels one message writes: band, bins, and the empty bins around them.

    ``updates`` are (side, price, quantity, event time).
    """
    updates = list(updates)
    bids = [u[1] for u in updates if u[0] == "bid"]
    offers = [u[1] for u in updates if u[0] == "offer"]
    if not bids or not offers:
        return []
    low, high = max(bids) - band, min(offers) + band
    levels = []
    for side, name in enumerate(("bid", "offer")):
        own = [u for u in updates if u[0] == name and low <= u[1] <= high]
        if not own:
            continue
        scaled = [u[1] / width for u in own]
        bins = {
            lvl: Level(lvl, 0.0, 0, timestamp, seq)
            for lvl in range(floor(min(scaled)) - (not side), ceil(max(scaled)) + side + 1)
        }
        for (_, _, qty, event_time), at in zip(own, scaled, strict=True):
            before = bins[ceil(at) if side else floor(at)]
            bins[before.lvl] = before._replace(
                qty=before.qty + qty, event_time=max(before.event_time, event_time)
            )
        levels += [(side, level) for level in bins.values()]
    return levels


def step(book: Book, old: Best, message: Message, symmetric: bool = False):
    """Apply one message: (book, rows, best before any reset, best after, reset?)."""
    for cleared in message.cleared:
        book.clear(*cleared)
    book.write(message.levels)
    seen = new = book.best()
    rows = quotes(old, new, symmetric)
    reset = bool(rows) and rows[0][1].lvl >= rows[0][2].lvl
    if reset:
        book = Book(message.levels)
        new = book.best()
        rows = quotes(old, new, symmetric)
    return book, rows if new != old else [], seen, new, reset


def replay(
    book: Book, messages: Iterable[Message], symmetric: bool = False, width: int = 1
) -> tuple[list[tuple], Book]:
    """Emitted rows of a run of messages, in order, and the book after it."""
    emitted = []
    old = book.best()
    for message in messages:
        book, rows, _, new, reset = step(book, old, message, symmetric)
        for k, (event_time, bid, ask, seq) in enumerate(rows, start=2 - len(rows)):
            emitted.append((
                message.seq, message.recv_us, reset, k, event_time,
                bid.lvl * float(width), bid.qty, ask.lvl * float(width), ask.qty,
                seq, rows[-1][1].timestamp,
            ))
        old = new
    return emitted, book


def reset_steps(carried: list[tuple[int, Level]], messages: list[Message]) -> Steps:
    """The chunk as a step function of the last reset before it.

    Steps are (upto, last reset): for an earlier reset s <= upto, and above the
    step before, the chunk's last reset is the given one, or s itself if None.

    A run that starts with all levels written at or after s is the same for all
    s up to the oldest carried level that was ever the best one before the first
    reset, since the others never show. The next run leaves out everything up to
    that level.
    """
    steps: Steps = []
    above = NEVER
    first_seq = messages[0].seq
    while True:
        book = Book((side, level) for side, level in carried if level.seq > above)
        old = book.best()
        oldest = min((b.seq for b in old if b), default=ANY)
        last_reset = None
        for message in messages:
            book, _, seen, old, reset = step(book, old, message)
            if last_reset is None:
                oldest = min([oldest, *[b.seq for b in seen if b]])
            if reset:
                last_reset = message.seq
        if oldest >= first_seq:
            return [*steps, (ANY, last_reset)]
        steps.append((oldest, last_reset))
        above = oldest


def apply_steps(steps: Steps, last_reset: int) -> int:
    for upto, value in steps:
        if last_reset <= upto:
            return last_reset if value is None else value
    raise ValueError("steps do not cover every reset")


def compose(functions: Iterable[Steps]) -> Steps:
    """Step function of several chunks in a row."""
    joined: Steps = [(ANY, None)]
    for steps in functions:
        split: Steps = []
        below = NEVER - 1
        for upto, value in joined:
            if value is not None:
                split.append((upto, apply_steps(steps, value)))
            else:
                for step_upto, step_value in steps:
                    if step_upto > below:
                        split.append((min(step_upto, upto), step_value))
                    if step_upto >= upto:
                        break
            below = upto
        joined = [
            (upto, value)
            for i, (upto, value) in enumerate(split)
            if i + 1 == len(split) or split[i + 1][1] != value
        ]
    return joined


def follow(functions: Iterable[Steps], last_reset: int) -> Iterator[int]:
    """Last reset before each chunk, given the one before the first."""
    for steps in functions:
        yield last_reset
        last_reset = apply_steps(steps, last_reset)


# Columns in, columns out ------------------------------------------------------

Columns = dict[str, list]


def read_chunk(columns: Columns) -> tuple[list[tuple[int, Level]], list[Message]]:
    """Carried levels (position 0) and the messages in sequence order.

    A row without a level stands for a message. The end of a level's span is the
    position of the message that empties or overwrites it.
    """
    carried: list[tuple[int, Level]] = []
    messages: dict[int, Message] = {}
    writes: list[tuple[int, int, int, Level]] = []
    spans = zip(columns["side"], columns["pos"], columns["until"], strict=True)
    values = zip(*[columns[name] for name in Level._fields], strict=True)
    for (side, pos, until), level, recv_us in zip(spans, values, columns["recv_us"], strict=True):
        if side is None:
            messages[pos] = Message(level[-1], recv_us, [])
        else:
            writes.append((pos, until, int(side == "offer"), Level(*level)))
    for _, until, side, level in writes:
        if until in messages:
            messages[until].levels.append((side, level._replace(qty=0.0)))
    for pos, _, side, level in writes:
        (messages[pos].levels if pos else carried).append((side, level))
    return carried, [messages[pos] for pos in sorted(messages)]


def read_steps(columns: Columns, place: str) -> tuple[list[int], list[Steps]]:
    """Places in order, and the step function of each."""
    rows = sorted(
        zip(columns[place], columns["upto"], columns["last_reset"], strict=True),
        key=lambda row: row[:2],
    )
    places, functions = [], []
    for at, group in groupby(rows, key=lambda row: row[0]):
        places.append(at)
        functions.append([row[1:] for row in group])
    return places, functions
