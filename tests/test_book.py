"""Order book: rules on hand-made messages, both forms against each other."""

from __future__ import annotations

import json
import math
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapelake.operators import book
from tapelake.operators.fold import (
    NEVER,
    Book,
    Level,
    Message,
    apply_steps,
    compose,
    follow,
    message_levels,
    quotes,
    replay,
    reset_steps,
)
from tapelake.plans import top_of_book
from tapelake.sources import landing
from tapelake.streaming.book import Messages
from tapelake.workspace import materialize

BASE_S = 1704067200
BASE = BASE_S * 10**9


def iso(second: int) -> str:
    return f"2024-01-01T00:{second // 60:02d}:{second % 60:02d}.000000Z"


def l2(seq: int, *updates, product: str = "P") -> str:
    """Updates are (side, price, quantity, second)."""
    return json.dumps({
        "channel": "l2_data", "timestamp": iso(3000), "sequence_num": seq,
        "events": [{"type": "update", "product_id": product, "updates": [
            {"side": side, "event_time": iso(second), "price_level": str(price),
             "new_quantity": str(qty)} for side, price, qty, second in updates]}],
    })


FIRST = (("bid", 99, 2, 1), ("offer", 102, 3, 2))
FIRST_ROW = (1, 2, 99.0, 2.0, 102.0, 3.0)

# Case: messages by sequence number, expected rows (sequence, second, bid, offer).
CASES = {
    "first message takes the offer's time": (
        {1: (("bid", 99.5, 2, 5), ("offer", 101.5, 3, 4))},
        [(1, 4, 99.0, 2.0, 102.0, 3.0)],
    ),
    "older new bid first meets the old offer": (
        {1: FIRST, 2: (("bid", 100, 4, 5), ("offer", 101, 6, 7))},
        [FIRST_ROW, (2, 5, 100.0, 4.0, 102.0, 3.0), (2, 7, 100.0, 4.0, 101.0, 6.0)],
    ),
    "older bid at the same price has no extra row": (
        {1: FIRST, 2: (("bid", 99, 4, 5), ("offer", 101, 6, 7))},
        [FIRST_ROW, (2, 7, 99.0, 4.0, 101.0, 6.0)],
    ),
    "older offer has no extra row": (
        {1: FIRST, 2: (("bid", 100, 4, 8), ("offer", 101, 6, 7))},
        [FIRST_ROW, (2, 8, 100.0, 4.0, 101.0, 6.0)],
    ),
    "equal times count as older offer": (
        {1: FIRST, 2: (("bid", 100, 4, 7), ("offer", 101, 6, 7))},
        [FIRST_ROW, (2, 7, 100.0, 4.0, 101.0, 6.0)],
    ),
    "one-sided message is dropped": (
        {1: FIRST, 2: (("bid", 100, 4, 5),)},
        [FIRST_ROW],
    ),
    "empty bins overwrite the book": (
        # Bids at 99 (emptied) and 96: the bins between are emptied too.
        {1: (("bid", 98, 2, 1), ("bid", 97, 1, 1), ("offer", 102, 3, 2)),
         2: (("bid", 99, 0, 5), ("bid", 96, 7, 5), ("offer", 102, 3, 2))},
        [(1, 2, 98.0, 2.0, 102.0, 3.0), (2, 5, 96.0, 7.0, 102.0, 3.0)],
    ),
    "updates outside the band are dropped": (
        {1: (("bid", 100, 0, 1), ("bid", 49.9, 9, 1), ("offer", 101, 1, 1))},
        [],
    ),
    "quantities of a bin are summed within the message": (
        {1: (("bid", 99.2, 2, 1), ("bid", 99.7, 1, 3), ("offer", 101.1, 3, 2),
             ("offer", 101.9, 1, 1)),
         2: (("bid", 99.4, 5, 6), ("offer", 101.5, 3, 5))},
        [(1, 2, 99.0, 3.0, 102.0, 4.0), (2, 6, 99.0, 5.0, 102.0, 3.0)],
    ),
    "a side left empty is carried for one message": (
        # Message 3 finds no bid in the book before it either.
        {1: FIRST, 2: (("bid", 99, 0, 5), ("offer", 102, 4, 6)),
         3: (("bid", 98, 0, 7), ("offer", 102, 5, 8))},
        [FIRST_ROW, (2, 6, 99.0, 2.0, 102.0, 4.0)],
    ),
    "unchanged best levels give no row": (
        {1: FIRST, 2: (("bid", 90, 1, 5), ("offer", 110, 1, 6))},
        [FIRST_ROW],
    ),
    "a number that falls starts a new connection with an empty book": (
        {2: (("bid", 100, 4, 5), ("offer", 101, 6, 7)), 1: FIRST},
        [(2, 7, 100.0, 4.0, 101.0, 6.0), FIRST_ROW],
    ),
    "crossing resets the book": (
        # Message 2 meets the offer left at 102, so only its own levels survive:
        # when its bid is emptied, the bid at 99 is gone and 104 is carried.
        {1: FIRST, 2: (("bid", 104, 1, 4), ("offer", 105, 1, 3)),
         3: (("bid", 104, 0, 6), ("offer", 105, 2, 6))},
        [FIRST_ROW, (2, 4, 104.0, 1.0, 105.0, 1.0), (3, 6, 104.0, 1.0, 105.0, 2.0)],
    ),
    "the extra row alone can reset": (
        # The new bid 100 is older than the new offer 101 and meets the old offer
        # 100. Without the bid at 99, emptying 100 leaves no bid.
        {1: (("bid", 98, 2, 1), ("offer", 100, 3, 2)),
         2: (("bid", 100, 4, 5), ("offer", 100, 0, 6), ("offer", 101, 6, 7)),
         3: (("bid", 100, 0, 8), ("offer", 101, 7, 9))},
        [(1, 2, 98.0, 2.0, 100.0, 3.0), (2, 5, 100.0, 4.0, 100.0, 3.0),
         (2, 7, 100.0, 4.0, 101.0, 6.0), (3, 9, 100.0, 4.0, 101.0, 7.0)],
    ),
    "a crossed first message keeps its levels": (
        {1: (("bid", 103, 2, 1), ("offer", 102, 3, 2))},
        [(1, 2, 103.0, 2.0, 102.0, 3.0)],
    ),
}


def run_cases(frames, **options) -> dict[str, list[tuple]]:
    """All cases in one run, one product each."""
    messages = [
        l2(seq, *updates, product=name)
        for name, (sequence, _) in CASES.items()
        for seq, updates in sequence.items()
    ]
    rows = top_of_book.top_of_book(frames("coinbase", "level2", *messages), **options).collect()
    got = {name: [] for name in CASES}
    for r in sorted(rows, key=lambda r: (r.insert_time, r.event_time)):
        second = (r.event_time - BASE) // 10**9
        got[r.symbol].append(
            (r.sequence_num, second, r.bid_px, r.bid_sz, r.offer_px, r.offer_sz)
        )
    return {name: sorted(rows) for name, rows in got.items()}


def test_rules(frames):
    assert run_cases(frames) == {name: sorted(rows) for name, (_, rows) in CASES.items()}


def test_symmetric_adds_the_mirrored_row(frames):
    got = run_cases(frames, symmetric=True)
    assert got["older offer has no extra row"] == [
        FIRST_ROW, (2, 7, 99.0, 2.0, 101.0, 6.0), (2, 8, 100.0, 4.0, 101.0, 6.0),
    ]
    assert got["older new bid first meets the old offer"] == sorted(
        CASES["older new bid first meets the old offer"][1]
    )


def test_bad_updates_are_set_aside(frames):
    good = l2(1, ("bid", 99, 2, 1), ("offer", 102, 3, 2), ("bid", "x", 1, 1))
    df = frames("coinbase", "level2", good, "{", '{"type":"error"}')
    assert book.book_updates(df).count() == 2
    got = [r.reason for r in book.book_rejects(df).orderBy("insert_time").collect()]
    assert got == ["bad price_level", "malformed", "no channel"]


def random_messages(seed: int, n: int, drift: float, products: int = 2) -> list[str]:
    """Messages around a moving price. Gaps in the sequence span whole chunks."""
    rng = random.Random(seed)
    out, seq, mid = [], 0, [1000.0] * products
    for _ in range(n):
        seq += rng.choice([1, 1, 1, 2, 3, 300 if rng.random() < 0.05 else 1])
        p = rng.randrange(products)
        mid[p] += rng.uniform(-drift, drift)
        updates = []
        for _ in range(rng.randrange(1, 6)):
            side = rng.choice(["bid", "offer"])
            away = rng.choice([0.5, 1, 2.25, 4, 8, 60])
            price = mid[p] - away if side == "bid" else mid[p] + away
            updates.append((side, round(price, 2), rng.choice([0, 0, 1, 2, 5]), rng.randrange(50)))
        out.append(l2(seq, *updates, product=f"P{p}"))
    return out


def folded(messages: list[str]) -> tuple[list[tuple], int]:
    """Plain sequential fold of the texts, with the number of resets."""
    rows, resets = [], 0
    by_product: dict[str, list] = {}
    for message in map(json.loads, messages):
        event = message["events"][0]
        by_product.setdefault(event["product_id"], []).append((message["sequence_num"], event))
    for product, sequence in sorted(by_product.items()):
        parsed = []
        for seq, event in sorted(sequence, key=lambda item: item[0]):
            updates = [
                (u["side"], float(u["price_level"]), float(u["new_quantity"]),
                 BASE + int(u["event_time"][17:19]) * 10**9)
                for u in event["updates"]
            ]
            levels = message_levels(updates, 0, seq, book.BAND)
            if levels:
                parsed.append(Message(seq, 0, levels))
        emitted_rows, _ = replay(Book(), parsed)
        resets += sum(row[2] and row[3] == 1 for row in emitted_rows)
        rows += [(product, row[0], row[3], *row[4:10]) for row in emitted_rows]
    return rows, resets


@pytest.mark.parametrize(("seed", "drift"), [(1, 0.0), (2, 0.4), (3, 3.0)])
def test_both_forms_agree_with_the_plain_fold(frames, seed, drift):
    messages = random_messages(seed, 900, drift)
    expected, resets = folded(messages)
    assert bool(resets) == (drift > 0)
    written = top_of_book.book_table(frames("coinbase", "level2", *messages))

    def read(df):
        return sorted(
            (r.product_id, r.message, r.k, r.event_time, r.bid_px, r.bid_sz, r.offer_px,
             r.offer_sz, r.sequence_num)
            for r in df.collect()
        )

    quotes_ = top_of_book.quotes_with_resets(written)
    assert read(quotes_) == sorted(expected)
    assert sum(r.resets for r in top_of_book.reset_counts(quotes_).collect()) == resets
    if not resets:
        view = book.quote_view(book.best_levels(written)).where("changed")
        assert read(view) == sorted(expected)


def test_invariants(frames):
    messages = random_messages(5, 400, 0.0)
    written = top_of_book.book_table(frames("coinbase", "level2", *messages))
    view = book.quote_view(book.best_levels(written))
    assert view.where("bid_px >= offer_px").count() == 0
    assert view.where("changed AND k = 1").groupBy("product_id", "message").count().where(
        "count > 1"
    ).count() == 0


def test_a_level_carried_over_many_chunks(frames):
    """The bid of message 1 is still the best after a thousand sequence numbers."""
    messages = [l2(1, ("bid", 99, 2, 1), ("offer", 102, 3, 2))]
    messages += [
        l2(seq, ("bid", 90, 1, 5), ("offer", 102, 1 + seq % 3, 6)) for seq in range(2, 1200, 7)
    ]
    written = top_of_book.book_table(frames("coinbase", "level2", *messages))
    best = book.best_levels(written).select("seq", "bid.lvl", "bid.qty").collect()
    assert len(best) == len(messages)
    assert {(r.lvl, r.qty) for r in best} == {(99, 2.0)}


messages_strategy = st.lists(
    st.lists(
        st.tuples(
            st.sampled_from(["bid", "offer"]),
            st.integers(0, 12),
            st.sampled_from([0.0, 1.0, 2.0]),
            st.integers(1, 6),
        ),
        min_size=1,
        max_size=4,
    ),
    min_size=1,
    max_size=40,
)


@settings(max_examples=300, deadline=None)
@given(messages_strategy, st.integers(1, 7))
def test_chunks_joined_equal_one_run(updates, size):
    """Resets found per chunk and joined are those of a single run."""
    messages = []
    for seq, update in enumerate(updates):
        levels = message_levels(update, 0, seq, 50.0)
        if levels:
            messages.append(Message(seq, 0, levels))
    if not messages:
        return
    whole, _ = replay(Book(), messages)

    chunks, live = [], {}
    for start in range(0, len(messages), size):
        chunk = messages[start : start + size]
        chunks.append((list(live.values()), chunk))
        for message in chunk:
            for side, level in message.levels:
                live.pop((side, level.lvl), None)
                if level.qty:
                    live[side, level.lvl] = (side, level)
    functions = [reset_steps(carried, chunk) for carried, chunk in chunks]
    starts = list(follow(functions, NEVER))
    joined = []
    for (carried, chunk), start in zip(chunks, starts, strict=True):
        known = [(side, level) for side, level in carried if level.seq >= start]
        joined += replay(Book(known), chunk)[0]
    assert joined == whole

    for cut in range(1, len(functions)):
        first, second = compose(functions[:cut]), compose(functions[cut:])
        for last_reset in range(NEVER, messages[0].seq + 1):
            through = apply_steps(second, apply_steps(first, last_reset))
            assert through == apply_steps(compose(functions), last_reset)


def test_quotes_without_a_complete_old_book():
    bid, ask = Level(9, 1.0, 5, 0, 3), Level(11, 1.0, 7, 0, 4)
    assert quotes((None, ask), (bid, ask)) == [(7, bid, ask, 3)]
    assert quotes((None, None), (bid, None)) == []


@pytest.fixture
def small_chunks(monkeypatch):
    """Seven messages to a chunk, so that few messages make many chunks."""
    monkeypatch.setattr(book, "TREE_DEPTH", 3)
    monkeypatch.setattr(book, "POSITIONS", 8)
    monkeypatch.setattr(book, "CHUNK", 7)


@pytest.mark.parametrize(("seed", "drift"), [(4, 0.0), (5, 0.4), (6, 3.0)])
def test_many_chunks_agree_with_the_plain_fold(frames, small_chunks, seed, drift):
    test_both_forms_agree_with_the_plain_fold(frames, seed, drift)


def walking_messages(n: int, products: int) -> list[str]:
    """A price that rises for ever and leaves its levels behind; products share the numbers."""
    return [
        l2(seq, ("bid", 100 + seq // products, 1, 1), ("offer", 200_000, 1 + seq % 5, 2),
           product=f"P{seq % products}")
        for seq in range(n)
    ]


@pytest.mark.parametrize("products", [1, 20])
def test_carried_rows_stay_below_the_writes_times_a_logarithm(
    frames, small_chunks, monkeypatch, products
):
    n = 800
    messages = book.book_frames(frames("coinbase", "level2", *walking_messages(n, products)))
    binned = book.level_bins(book.price_band(messages, band=1e6))
    written = materialize(book.written_levels(binned), "test-writes")
    writes = written.count()
    assert writes >= 2 * n
    bound = 2 * math.log2(n) * writes
    lives = book.level_lives(written)
    nodes = book.chunk_nodes(lives)
    steps = {
        "lives": lives, "ended": book.ended_levels(lives), "nodes": nodes,
        "standing": book.standing_levels(nodes, written),
        "contenders": book.contenders(nodes, written),
        "spans": book.level_spans(written),
        "spans with resets": book.level_spans(written, resets=True),
    }
    counts = {name: rows.count() for name, rows in steps.items()}
    assert all(count <= bound for count in counts.values()), counts
    assert counts["spans"] <= 4 * writes
    best = book.best_levels(written).select("product_id", "seq", "bid.lvl").collect()
    assert {(r.product_id, r.seq, r.lvl) for r in best} == {
        (f"P{seq % products}", seq, 100 + seq // products) for seq in range(n)
    }


def table_of(rows) -> list[tuple]:
    return sorted(tuple(r)[1:8] for r in rows.collect())


def test_connections_have_books_of_their_own(frames, small_chunks):
    first, second = random_messages(7, 60, 0.0), random_messages(8, 50, 0.0)
    both = top_of_book.top_of_book(frames("coinbase", "level2", *first, *second))
    apart = [top_of_book.top_of_book(frames("coinbase", "level2", *part)) for part in (first, second)]
    assert table_of(both) == sorted(table_of(apart[0]) + table_of(apart[1]))
    assert {r.symbol for r in both.collect()} == {"P0", "P1"}


def test_the_fold_starts_at_the_first_crossing(frames, small_chunks, monkeypatch):
    """Product P0 crosses in its last chunk, P1 in the middle, P2 never."""
    def quiet(seq, product):
        return l2(seq, ("bid", 90 + seq % 7, 1 + seq % 3, 5), ("offer", 110 - seq % 5, 2, 6), product=product)

    crossing = {"P0": 48, "P1": 20}
    messages = [
        l2(seq, ("bid", 120, 1, 4), ("offer", 125, 1, 3), product=product)
        if crossing.get(product) == seq else quiet(seq, product)
        for product in ("P0", "P1", "P2") for seq in range(49)
    ]
    read = []
    whole = top_of_book._from_first
    monkeypatch.setattr(top_of_book, "_from_first", lambda *a: read.append(whole(*a)) or read[-1])
    rows = top_of_book.top_of_book(frames("coinbase", "level2", *messages)).collect()
    chunks = {(r.product_id, r.chunk) for r in read[0].select("product_id", "chunk").distinct().collect()}
    assert chunks == {("P0", 6)} | {("P1", chunk) for chunk in range(2, 7)}
    expected, resets = folded(messages)
    assert resets >= 2
    got = sorted((r.symbol, r.event_time, r.bid_px, r.bid_sz, r.offer_px, r.offer_sz, r.sequence_num) for r in rows)
    assert got == sorted((row[0], *row[3:9]) for row in expected)


def test_what_a_message_writes_needs_no_shuffle(frames, spark):
    """Array form against the plain fold; sides of other names write nothing."""
    rng = random.Random(11)
    sent = [
        [(rng.choice(["bid", "offer", "ask", ""]), rng.choice([95, 100, 120, 160]) + rng.random(),
          rng.choice([0, 1, 2.5]), rng.randint(1, 50)) for _ in range(rng.choice([1, 2, 9, 40]))]
        for _ in range(60)
    ]
    landed = frames("coinbase", "level2", *(l2(i, *updates) for i, updates in enumerate(sent)))
    for width in (1, 5):
        binned = book.level_bins(book.price_band(book.book_frames(landed)), width)
        dense = book.dense_levels(binned, width)
        plan = dense._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" not in plan and "Generate" not in plan
        got = {r.sequence_num: sorted((u.side, u.lvl, round(u.qty, 9), u.event_time or 0) for u in r.levels)
               for r in dense.collect()}
        for seq, updates in enumerate(sent):
            typed = [(side, price, qty, BASE + second * 10**9) for side, price, qty, second in updates]
            expected = message_levels(typed, 0, seq, book.BAND, width)
            assert got[seq] == sorted(
                (book.SIDES[side], level.lvl, round(level.qty, 9), level.event_time) for side, level in expected
            )


def test_a_frame_landed_twice_in_one_microsecond_counts_once(frames):
    landed = frames("coinbase", "level2", *random_messages(12, 60, 0.4))
    once = table_of(top_of_book.top_of_book(landed))
    assert table_of(top_of_book.top_of_book(landed.unionByName(landed))) == once
    assert table_of(top_of_book.top_of_book(landed.unionByName(landed).withColumn("connection", F.lit("a")))) == once


def test_repeated_deliveries_count_once(frames):
    landed = frames("coinbase", "level2", *random_messages(9, 40, 0.0))
    again = landed.withColumn("recv_ts", landed["recv_ts"] + F.expr("INTERVAL 2 HOURS"))
    connected = landed.unionByName(again).withColumn("connection", F.lit("a"))
    other = landed.withColumn("connection", F.lit("b"))
    once = table_of(top_of_book.top_of_book(landed))
    assert table_of(top_of_book.top_of_book(connected)) == once
    assert table_of(top_of_book.top_of_book(connected.unionByName(other))) == sorted(once + once)


def test_bins_and_dense_levels_are_worked_out_once(frames):
    """Also under a generator, for which Spark filters out empty arrays below the columns they are made of."""
    banded = book.price_band(book.book_frames(frames("coinbase", "level2", *random_messages(3, 5, 0.0))))
    for rows in (
        book.level_bins(banded).select(F.inline("bins")),
        book.dense_levels(book.level_bins(banded)).select(F.inline("levels")),
    ):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        # In the generator's filter and in its input, neither inside a lambda.
        assert plan.count("array_sort(") <= 2, plan.count("array_sort(")
        assert plan.count("array_max(transform(") <= 2


def test_a_streamed_book_is_kept_in_flat_arrays():
    """About 35 bytes an update, whatever the number of batches; repeats are passed over."""
    n = 1000

    def batches():
        for at in range(0, 5 * n, n):
            numbers = np.arange(at, at + n)
            pairs = [np.array([1.0, 2.0])] * n
            yield pd.DataFrame(
                {"product_id": "P", "connection": "a", "sequence_num": numbers, "timestamp": numbers,
                 "recv_us": numbers, "digest": numbers, "sides": [np.array([0, 1], "int8")] * n,
                 "prices": pairs, "quantities": pairs, "times": [np.array([at, at])] * n}
            )

    messages = Messages(batches())
    assert sum(column.nbytes for column in messages.columns.values()) <= 50 * 2 * 5 * n
    assert [len(run) for run in messages.connections()] == [5 * n]
    (first,) = messages.read(np.array([4 * n]), 1)
    assert (first.seq, first.recv_us) == (4 * n, 4 * n) and len(first.levels) > 1

    again = Messages((batch for _ in range(2) for batch in batches()), n - 1)
    assert [len(run) for run in again.first_deliveries()] == [4 * n]
    assert len(list(Messages(iter(())).connections())) == 0


def test_a_streamed_frame_is_parsed_once(spark, frames, tmp_path):
    """Neither the landed line's parts nor the parse are written out for each field that a filter names."""
    odd = [l2(3, ("bid", 99.5, 1, 1)), "{", '{"events":[]}']
    landed = frames("coinbase", "level2", *random_messages(7, 20, 0.0), *odd).withColumn("connection", F.lit("a"))
    landing.write_landing(landed, f"{tmp_path}/landing")
    back = landing.read_landing(spark, f"{tmp_path}/landing", connections=True)
    once = book.book_frames_parsed_once(back)
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("RLIKE(") == 2
    assert sorted(map(str, once.collect())) == sorted(map(str, book.book_frames(landed).collect()))
    assert once.count() == 21


@pytest.mark.parametrize("width", [1, 5])
def test_messages_read_at_once_equal_the_plain_fold(width):
    """Also with prices that no bin holds, quantities that add up to nothing, and times before 1970."""
    rng = random.Random(width)
    sent = []
    for seq in range(300):
        crossed = rng.random() < 0.02
        sent.append([
            (side, (140 if crossed else 100) - 60 * rng.random() if side == "bid" else 101 + 60 * rng.random(),
             rng.choice([0, 1, 2.5, 0.1, -0.1]), rng.choice([-5, 0, 1, 10**18]))
            for side in rng.choices(book.SIDES, k=rng.choice([0, 1, 2, 9, 40]))
        ])
        if sent[-1] and rng.random() < 0.02:
            sent[-1].append((rng.choice(book.SIDES), float("nan"), 1.0, 1))
    fields = [[np.array([u[i] for u in updates], float) for updates in sent] for i in (1, 2)]
    columns = {
        "sequence_num": range(300), "timestamp": range(300), "recv_us": range(300), "digest": 0,
        "sides": [np.array([u[0] == "offer" for u in updates], "int8") for updates in sent],
        "prices": fields[0], "quantities": fields[1],
        "times": [np.array([u[3] for u in updates], "int64") for updates in sent],
    }
    messages = Messages(iter([pd.DataFrame(columns).sample(frac=1, random_state=1)]))
    (run,) = messages.first_deliveries()
    plain = [
        Message(seq, seq, levels)
        for seq, updates in enumerate(sent)
        if (levels := message_levels(updates, seq, seq, book.BAND, width))
    ]
    expected, old = replay(Book(), plain, width=width)
    for pieces in (7, 300):
        read = [m for at in range(0, 300, pieces) for m in messages.read(run[at : at + pieces], width)]
        got, new = replay(Book(), read, width=width)
        assert [m.seq for m in read] == [m.seq for m in plain]
        assert str(got) == str(expected) and any(row[2] for row in got)
        assert new.live == old.live
        assert all(len(heap) == len(set(heap)) for heap in new.heaps)
