"""DuckDB SQL for the queries of ``__spark_entry__``.

No oracle parses JSON: each computes the expected rows from the columns the
messages were built from.
"""

from __future__ import annotations

EVENTS = """
ev AS (
    SELECT event_id, ts, user_id, event_type, value,
           'S' || (user_id % 5) AS sym,
           event_id % 7 + 1 AS qty,
           event_id // 10 AS g,
           epoch_us(ts) AS us,
           epoch_us(ts) // 1000 AS ms
    FROM events
),
grp AS (
    SELECT g, max(ts) AS last_ts, arg_min(event_type, event_id) AS first_type FROM ev GROUP BY g
)"""


def _audit(ts: str) -> str:
    return f"CAST({ts} AS DATE) AS date, epoch_us({ts}) AS insert_time"


BINANCE_TRADE = f"""
SELECT 'trade' AS event_type, ms AS event_time, sym AS symbol, event_id AS trade_id,
       value AS price, CAST(qty AS DOUBLE) AS quantity, user_id AS buyer_order_id,
       user_id + 1 AS seller_order_id, ms AS trade_time, event_id % 2 = 0 AS market_maker,
       true AS ignore, {_audit("ts")}
FROM ev"""

BINANCE_TICKER = f"""
SELECT '24hrTicker' AS event_type, ms AS event_time, sym AS symbol, value - 1 AS px_change,
       value / 4 AS px_change_percent, value AS weighted_average_px,
       value - 2 AS first_trade_f_1_px, value + 2 AS last_px,
       CAST(qty AS DOUBLE) AS last_quantity, value AS best_bid_px,
       CAST(qty AS DOUBLE) AS best_bid_quantity, value + 1 AS best_ask_px,
       CAST(qty + 1 AS DOUBLE) AS best_ask_quantity, value AS open_px, value + 3 AS high_px,
       value AS low_px, CAST(qty * 10 AS DOUBLE) AS total_traded_base_asset_volume,
       CAST(qty * 100 AS DOUBLE) AS total_traded_quote_asset_volume,
       ms - 86400000 AS statistics_open_time, ms AS statistics_close_time,
       event_id AS first_trade_id, event_id + qty AS last_trade_id,
       qty AS total_number_of_trades, {_audit("last_ts")}
FROM ev JOIN grp USING (g)"""

BOOK_TICKER = f"""
SELECT event_id AS order_book_updateid, sym AS symbol, value AS best_bid_price,
       CAST(qty AS DOUBLE) AS best_bid_qty, value + 1 AS best_ask_price,
       CAST(qty + 1 AS DOUBLE) AS best_ask_qty, {_audit("ts")}
FROM ev"""

COINBASE_TRADE = f"""
SELECT sym AS symbol, event_id AS trade_id, value AS price, CAST(qty AS DOUBLE) AS size,
       us * 1000 AS time, CASE WHEN event_id % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS side,
       'market_trades' AS channel, epoch_us(last_ts) * 1000 AS timestamp, g AS sequence_num,
       {_audit("last_ts")}
FROM ev JOIN grp USING (g) WHERE g % 10 <> 0"""

CRYPTOCOM_TRADE = f"""
SELECT CASE WHEN event_id % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS side, value AS trade_price,
       CAST(qty AS DOUBLE) AS trade_qty, ms AS trade_timestmp, event_id AS trade_id,
       sym AS symbol, {_audit("last_ts")}
FROM ev JOIN grp USING (g) WHERE g % 10 <> 0"""

GEMINI_TRADE = f"""
SELECT CASE WHEN event_type = 'view' THEN 'change' ELSE 'trade' END AS type, event_id AS tid,
       value AS price, CAST(qty AS DOUBLE) AS amount,
       CASE WHEN event_id % 2 = 0 THEN 'bid' ELSE 'ask' END AS "makerSide", sym AS symbol,
       g AS "eventId", g AS socket_sequence, epoch_us(last_ts) // 1000000 AS timestamp,
       epoch_us(last_ts) // 1000 AS timestampms, {_audit("last_ts")}
FROM ev JOIN grp USING (g) WHERE first_type <> 'view'"""

KRAKEN_TRADE = f"""
SELECT value AS price, CAST(qty AS DOUBLE) AS volume, us / 1e6 AS time,
       CASE WHEN event_id % 2 = 0 THEN 'b' ELSE 's' END AS side, 'l' AS "orderType",
       'trade' AS "channelName", sym AS pair, {_audit("msg_ts")}
FROM (SELECT *, max(ts) OVER (PARTITION BY g, sym) AS msg_ts FROM ev)"""

KRAKEN_TICKER = f"""
SELECT value + 1 AS best_ask_price, value AS best_bid_price, value AS close_price,
       CAST(qty * 2 AS DOUBLE) AS vol_today, value AS vol_wavg_price_today,
       qty AS n_trades_today, value - 1 AS low_price_today, value + 1 AS high_price_today,
       value AS open_price_today, qty AS ask_wholelot_vol, qty + 1 AS bid_wholelot_vol,
       CAST(qty AS DOUBLE) AS close_lot_vol, CAST(qty * 3 AS DOUBLE) AS vol_24hrs,
       value + 2 AS vol_wavg_price_24hrs, event_id AS n_trades_24hrs,
       value - 2 AS low_price_24hrs, value + 2 AS high_price_24hrs, value AS open_price_24hrs,
       CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(qty AS DOUBLE) END AS ask_lot_vol,
       CAST(qty + 1 AS DOUBLE) AS bid_lot_vol, sym AS ticker, {_audit("ts")}
FROM ev"""

KRAKEN_OHLC = f"""
SELECT us / 1e6 AS time, (us + 60000000) / 1e6 AS etime, value AS open, value + 1 AS high,
       value AS low, value AS close, value AS vwap, CAST(qty AS DOUBLE) AS volume,
       event_id % 10 AS count, 'ohlc-1' AS "channelName", sym AS pair, {_audit("ts")}
FROM ev"""

TRADES = f"{BINANCE_TRADE} WHERE event_type <> 'error'"
GOOD_TRADES = f"{TRADES} AND event_id % 97 <> 0 AND event_id % 89 <> 0"

# Level-2 book, step by step. ``seq`` is the message, ``recv`` its arrival.
BOOK = """
l2 AS (
    SELECT 'P' || (user_id % 5) AS product_id, event_id // 20 AS seq,
           CASE WHEN (user_id // 5) % 2 = 0 THEN 'bid' ELSE 'offer' END AS side,
           CAST(round(value * 100) AS BIGINT) % 3000 + 1 AS k,
           CAST(CASE WHEN event_type = 'error' THEN 0 ELSE event_id % 7 + 1 END AS DOUBLE) AS qty,
           epoch_us(ts) * 1000 AS event_time, epoch_us(ts) AS us
    FROM events
),
upd AS (
    SELECT product_id, seq, side, qty, event_time,
           CASE WHEN side = 'bid' THEN 1000.0::DOUBLE - k / 100
                ELSE 1000.0::DOUBLE + k / 100 END AS price,
           max(us) OVER (PARTITION BY product_id, seq) AS recv,
           max(us) OVER (PARTITION BY product_id, seq) * 1000 AS timestamp
    FROM l2
),
band AS (
    SELECT product_id, seq,
           max(CASE WHEN side = 'bid' THEN price END) - 50 AS lo_px,
           min(CASE WHEN side = 'offer' THEN price END) + 50 AS hi_px
    FROM upd GROUP BY product_id, seq
),
inb AS (
    SELECT upd.*, lo_px, hi_px,
           CAST(CASE WHEN side = 'bid' THEN floor(price) ELSE ceil(price) END AS BIGINT) AS lvl
    FROM upd JOIN band USING (product_id, seq) WHERE price BETWEEN lo_px AND hi_px
),
bins AS (
    SELECT product_id, seq, side, lvl, sum(qty) AS qty, max(event_time) AS event_time,
           max(timestamp) AS timestamp, max(recv) AS recv
    FROM inb GROUP BY product_id, seq, side, lvl
),
rng AS (
    SELECT product_id, seq, side, max(timestamp) AS timestamp, max(recv) AS recv,
           CAST(floor(min(price)) AS BIGINT) - CASE WHEN side = 'bid' THEN 1 ELSE 0 END AS lo,
           CAST(ceil(max(price)) AS BIGINT) + CASE WHEN side = 'bid' THEN 0 ELSE 1 END AS hi
    FROM inb GROUP BY product_id, seq, side
),
dense AS (
    SELECT product_id, seq, side, unnest(range(lo, hi + 1)) AS lvl, timestamp, recv FROM rng
),
ups AS (
    SELECT d.product_id, d.seq, d.side, d.lvl, coalesce(b.qty, 0) AS qty, b.event_time,
           d.timestamp, d.recv
    FROM dense d LEFT JOIN bins b USING (product_id, seq, side, lvl)
)"""

BEST = BOOK + """,
live AS (
    SELECT *, lead(seq) OVER (PARTITION BY product_id, side, lvl ORDER BY seq) AS nxt FROM ups
),
msg AS (
    SELECT product_id, seq, max(recv) AS recv FROM inb GROUP BY product_id, seq
),
at_msg AS (
    SELECT m.product_id, m.seq AS message, l.side, l.lvl, l.qty, l.event_time, l.timestamp, l.seq
    FROM msg m JOIN live l ON m.product_id = l.product_id AND m.seq >= l.seq
         AND (l.nxt IS NULL OR m.seq < l.nxt)
    WHERE l.qty <> 0
),
ranked AS (
    SELECT *, row_number() OVER (
        PARTITION BY product_id, message, side
        ORDER BY CASE WHEN side = 'bid' THEN -lvl ELSE lvl END) AS place
    FROM at_msg
),
best AS (
    SELECT m.product_id, m.seq AS message, m.recv,
           b.lvl AS bp, b.qty AS bq, b.event_time AS bt, b.timestamp AS bts, b.seq AS bs,
           a.lvl AS ap, a.qty AS aq, a.event_time AS aet, a.timestamp AS ats, a.seq AS az
    FROM msg m
    LEFT JOIN (SELECT * FROM ranked WHERE side = 'bid' AND place = 1) b
        ON b.product_id = m.product_id AND b.message = m.seq
    LEFT JOIN (SELECT * FROM ranked WHERE side = 'offer' AND place = 1) a
        ON a.product_id = m.product_id AND a.message = m.seq
)"""

VIEW = BEST + """,
prev AS (
    SELECT *, lag(bp) OVER w AS obp, lag(bq) OVER w AS obq, lag(bt) OVER w AS obt,
           lag(bts) OVER w AS obts, lag(bs) OVER w AS obs,
           lag(ap) OVER w AS oap, lag(aq) OVER w AS oaq, lag(aet) OVER w AS oat,
           lag(az) OVER w AS oas
    FROM best WINDOW w AS (PARTITION BY product_id ORDER BY message)
),
sides AS (
    SELECT product_id, message, recv,
           obp IS NOT NULL AND oap IS NOT NULL AS had_book,
           coalesce(bp, obp) AS nbp, CASE WHEN bp IS NULL THEN obq ELSE bq END AS nbq,
           CASE WHEN bp IS NULL THEN obt ELSE bt END AS nbt,
           CASE WHEN bp IS NULL THEN obts ELSE bts END AS nbts,
           CASE WHEN bp IS NULL THEN obs ELSE bs END AS nbs,
           coalesce(ap, oap) AS nap, CASE WHEN ap IS NULL THEN oaq ELSE aq END AS naq,
           CASE WHEN ap IS NULL THEN oat ELSE aet END AS nat,
           CASE WHEN ap IS NULL THEN oas ELSE az END AS nas,
           obp, obt, oap, oaq,
           bp IS DISTINCT FROM obp OR bq IS DISTINCT FROM obq OR bt IS DISTINCT FROM obt
           OR bs IS DISTINCT FROM obs OR ap IS DISTINCT FROM oap OR aq IS DISTINCT FROM oaq
           OR aet IS DISTINCT FROM oat OR az IS DISTINCT FROM oas AS changed
    FROM prev
),
quotes AS (
    SELECT product_id, message, recv, changed, 0 AS k, nbt AS event_time, nbp AS bid_px,
           nbq AS bid_sz, oap AS offer_px, oaq AS offer_sz, nbs AS sequence_num,
           nbts AS timestamp
    FROM sides
    WHERE nbp IS NOT NULL AND nap IS NOT NULL AND had_book AND nbt < nat AND nbt <> obt
      AND nbp <> obp
    UNION ALL
    SELECT product_id, message, recv, changed, 1 AS k,
           CASE WHEN had_book AND nbt >= nat THEN nbt ELSE nat END, nbp, nbq, nap, naq,
           CASE WHEN had_book AND nbt < nat THEN nas ELSE nbs END, nbts
    FROM sides WHERE nbp IS NOT NULL AND nap IS NOT NULL
)"""

# Offers 20 lower, so that books cross. ``walk`` takes the messages of all products side by
# side, one number a step; of the book it only needs the number of the last reset.
TOB_WITH_RESET = (
    "WITH RECURSIVE "
    + BOOK.replace("ELSE 1000.0::DOUBLE + k / 100 END", "ELSE 1000.0::DOUBLE + k / 100 - 20.0::DOUBLE END")
    + """,
live AS (
    SELECT *, lead(seq) OVER (PARTITION BY product_id, side, lvl ORDER BY seq) AS nxt FROM ups
),
spans AS MATERIALIZED (
    SELECT product_id, side, lvl, seq, coalesce(nxt, 9223372036854775807) AS nxt,
           {'lvl': lvl, 'qty': qty, 'et': event_time, 'ts': timestamp, 'seq': seq} AS level
    FROM live WHERE qty <> 0
),
msg AS MATERIALIZED (
    SELECT product_id, seq, max(recv) AS recv,
           row_number() OVER (PARTITION BY product_id ORDER BY seq) AS n
    FROM inb GROUP BY product_id, seq
),
walk AS (
    SELECT product_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS message, CAST(NULL AS BIGINT) AS recv,
           CAST(-1 AS BIGINT) AS since, false AS reset,
           any_value(level) FILTER (WHERE false) AS ob, any_value(level) FILTER (WHERE false) AS oa,
           any_value(level) FILTER (WHERE false) AS b, any_value(level) FILTER (WHERE false) AS a
    FROM spans GROUP BY product_id
    UNION ALL
    SELECT product_id, n, message, recv, CASE WHEN crossed THEN message ELSE since END, crossed, ob, oa,
           CASE WHEN crossed THEN own_b ELSE seen_b END, CASE WHEN crossed THEN own_a ELSE seen_a END
    FROM (
        SELECT *, coalesce(
            nb.lvl >= CASE WHEN ob IS NOT NULL AND oa IS NOT NULL AND nb.et < na.et AND nb.et <> ob.et
                                AND nb.lvl <> ob.lvl THEN oa.lvl ELSE na.lvl END
            AND na IS NOT NULL, false) AS crossed
        FROM (
            SELECT *, coalesce(seen_b, ob) AS nb, coalesce(seen_a, oa) AS na
            FROM (
                SELECT m.product_id, m.n, m.seq AS message, m.recv, w.since, w.b AS ob, w.a AS oa,
                       arg_max(s.level, s.lvl) FILTER (WHERE s.side = 'bid' AND s.seq >= w.since) AS seen_b,
                       arg_min(s.level, s.lvl) FILTER (WHERE s.side = 'offer' AND s.seq >= w.since) AS seen_a,
                       arg_max(s.level, s.lvl) FILTER (WHERE s.side = 'bid' AND s.seq = m.seq) AS own_b,
                       arg_min(s.level, s.lvl) FILTER (WHERE s.side = 'offer' AND s.seq = m.seq) AS own_a
                FROM walk w JOIN msg m ON m.product_id = w.product_id AND m.n = w.n + 1
                LEFT JOIN spans s ON s.product_id = m.product_id AND s.seq <= m.seq AND s.nxt > m.seq
                GROUP BY ALL
            )
        )
    )
),
sides AS (
    SELECT product_id, message, recv AS recv_us, reset, coalesce(b, ob) AS nb, coalesce(a, oa) AS na, ob, oa,
           ob IS NOT NULL AND oa IS NOT NULL AS had_book
    FROM walk
    WHERE message IS NOT NULL AND (b IS DISTINCT FROM ob OR a IS DISTINCT FROM oa)
)
SELECT product_id, message, recv_us, reset, 0 AS k, nb.et AS event_time,
       CAST(nb.lvl AS DOUBLE) AS bid_px, nb.qty AS bid_sz, CAST(oa.lvl AS DOUBLE) AS offer_px,
       oa.qty AS offer_sz, nb.seq AS sequence_num, nb.ts AS timestamp
FROM sides
WHERE na IS NOT NULL AND had_book AND nb.et < na.et AND nb.et <> ob.et AND nb.lvl <> ob.lvl
UNION ALL
SELECT product_id, message, recv_us, reset, 1, CASE WHEN had_book AND nb.et >= na.et THEN nb.et ELSE na.et END,
       CAST(nb.lvl AS DOUBLE), nb.qty, CAST(na.lvl AS DOUBLE), na.qty,
       CASE WHEN had_book AND nb.et < na.et THEN na.seq ELSE nb.seq END, nb.ts
FROM sides WHERE nb IS NOT NULL AND na IS NOT NULL"""
)

QUOTE_COLUMNS = """product_id, message, k, event_time, CAST(bid_px AS DOUBLE) AS bid_px, bid_sz,
       CAST(offer_px AS DOUBLE) AS offer_px, offer_sz, sequence_num, timestamp"""

TOP_OF_BOOK = """
SELECT product_id AS symbol, event_time, CAST(bid_px AS DOUBLE) AS bid_px, bid_sz,
       CAST(offer_px AS DOUBLE) AS offer_px, offer_sz, sequence_num, 'l2_data' AS channel,
       timestamp, CAST(make_timestamp(recv) AS DATE) AS date, recv AS insert_time
FROM quotes WHERE changed"""

SECMASTER = """
WITH kinds AS (SELECT 'PRICE_FILTER' AS kind, 10 AS above UNION ALL SELECT 'LOT_SIZE', 30)
SELECT kind AS "filterType",
       CASE WHEN kind = 'PRICE_FILTER' THEN p_retailprice END AS "minPrice",
       CASE WHEN kind = 'LOT_SIZE' THEN CAST(p_size AS DOUBLE) END AS "minQty",
       p_name AS symbol, 'TRADING' AS status, p_brand || ', ' || p_type AS "orderTypes"
FROM part JOIN kinds ON p_size > above"""

JOB_RUNS = """
runs AS (
    SELECT 'd' || (o_custkey % 20) AS dag_id, o_orderdate AS execution_date,
           CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'running' END AS state,
           o_orderdate AS last_scheduling_decision
    FROM orders WHERE o_orderdate >= DATE '2001-01-01'
)"""

STATELESS = {
    "binance_symbol_ticker_stream": BINANCE_TICKER,
    "binance_trade_data_stream": TRADES,
    "binance_ticker_order_book_stream": BOOK_TICKER,
    "coinbase_market_trades_stream": COINBASE_TRADE,
    "cryptocom_trade_data_stream": CRYPTOCOM_TRADE,
    "gemini_multimarketdata_trades": GEMINI_TRADE,
    "kraken_trade_data_stream": KRAKEN_TRADE,
    "kraken_ticker_stream": KRAKEN_TICKER,
    "kraken_ohlc_stream": KRAKEN_OHLC,
}

# Messages of each feed by kind.
KINDS = """
SELECT 'binance' AS exchange, 'ticker' AS feed, 'data' AS kind, count(*) AS messages FROM grp
UNION ALL SELECT 'binance', 'trade', CASE WHEN event_type = 'error' THEN 'control' ELSE 'data' END,
          count(*) FROM ev GROUP BY ALL
UNION ALL SELECT 'binance', 'bookTicker', 'data', count(*) FROM ev
UNION ALL SELECT 'coinbase', 'market_trades', CASE WHEN g % 10 = 0 THEN 'control' ELSE 'data' END,
          count(*) FROM grp GROUP BY ALL
UNION ALL SELECT 'coinbase', 'level2', 'data', count(*)
          FROM (SELECT DISTINCT user_id % 5, event_id // 20 FROM ev)
UNION ALL SELECT 'cryptocom', 'trade', CASE WHEN g % 10 = 0 THEN 'control' ELSE 'data' END,
          count(*) FROM grp GROUP BY ALL
UNION ALL SELECT 'gemini', 'trades',
          CASE WHEN first_type = 'view' THEN 'control' ELSE 'data' END, count(*)
          FROM grp GROUP BY ALL
UNION ALL SELECT 'kraken', 'trade', 'data', count(*) FROM (SELECT DISTINCT g, sym FROM ev)
UNION ALL SELECT 'kraken', 'trade', 'control', count(*) FROM grp
UNION ALL SELECT 'kraken', 'ticker', 'data', count(*) FROM ev
UNION ALL SELECT 'kraken', 'ohlc', 'data', count(*) FROM ev"""

FEED_TABLES = """
feed_tables(exchange, feed, "table") AS (VALUES
    ('binance', 'ticker', 'binance_symbol_ticker_stream'),
    ('binance', 'trade', 'binance_trade_data_stream'),
    ('binance', 'bookTicker', 'binance_ticker_order_book_stream'),
    ('coinbase', 'market_trades', 'coinbase_market_trades_stream'),
    ('coinbase', 'level2', 'coinbase_top_of_book_stream'),
    ('cryptocom', 'trade', 'cryptocom_trade_data_stream'),
    ('gemini', 'trades', 'gemini_multimarketdata_trades'),
    ('kraken', 'trade', 'kraken_trade_data_stream'),
    ('kraken', 'ticker', 'kraken_ticker_stream'),
    ('kraken', 'ohlc', 'kraken_ohlc_stream'))"""


def _ev(select: str) -> str:
    return f"WITH {EVENTS} {select}"


def _coverage(rows: str, symbol: str) -> str:
    return f"""SELECT {symbol} AS symbol, count(DISTINCT date) AS date_count,
                      max(date) AS last_date FROM ({rows}) GROUP BY {symbol}"""


def _coverage_all() -> str:
    parts = []
    for table, rows in STATELESS.items():
        if table in ("binance_symbol_ticker_stream", "kraken_ticker_stream"):
            continue
        symbol = "pair" if table.startswith("kraken") else "symbol"
        parts.append(f"SELECT *, '{table}' AS \"table\" FROM ({_coverage(rows, symbol)})")
    book = _coverage(TOP_OF_BOOK, "symbol")
    parts.append(f"SELECT *, 'coinbase_top_of_book_stream' AS \"table\" FROM ({book})")
    return f"WITH {EVENTS}, {VIEW} " + " UNION ALL ".join(parts)


def _retention_sweep() -> str:
    parts = [
        f"""SELECT '{table}' AS "table", count(*) FILTER (date >= DATE '2024-01-15') AS rows_kept,
                   count(*) FILTER (date < DATE '2024-01-15') AS rows_dropped FROM ({rows})"""
        for table, rows in STATELESS.items()
    ]
    return _ev(" UNION ALL ".join(parts))


def _ingest_counters() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", count(*) AS n FROM ({sql})"
        for table, sql in {**STATELESS, "binance_trade_data_stream": GOOD_TRADES}.items()
    )
    return f"""
    WITH {EVENTS}, {FEED_TABLES}, kinds AS ({KINDS}), counted AS ({rows}),
    truncated AS (
        SELECT count(*) FILTER (event_id % 89 = 0) AS messages,
               count(*) FILTER (event_id % 89 <> 0 AND event_id % 97 = 0) AS bad
        FROM ev WHERE event_type <> 'error'
    )
    SELECT "table",
           CAST(sum(CASE WHEN kind = 'data' THEN kinds.messages ELSE 0 END)
                - max(CASE WHEN feed_tables.feed = 'trade' AND feed_tables.exchange = 'binance'
                           THEN truncated.messages ELSE 0 END) AS BIGINT) AS data_messages,
           CAST(sum(CASE WHEN kind = 'control' THEN kinds.messages ELSE 0 END) AS BIGINT)
               AS control_messages,
           max(CASE WHEN feed_tables.feed = 'trade' AND feed_tables.exchange = 'binance'
                    THEN truncated.messages ELSE 0 END) AS reject_messages,
           max(n) AS rows_processed,
           max(CASE WHEN feed_tables.feed = 'trade' AND feed_tables.exchange = 'binance'
                    THEN bad ELSE 0 END) AS rows_rejected
    FROM feed_tables JOIN kinds USING (exchange, feed) JOIN counted USING ("table"), truncated
    GROUP BY "table" """


def _readable_size() -> str:
    units = ["B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB"]
    ladder = " ".join(
        f"WHEN total_bytes >= {1024 ** p} OR {p} = 0 "
        f"THEN format('{{:.2f}} {units[p]}', round(total_bytes::DOUBLE / {1024 ** p}, 2))"
        for p in range(len(units) - 1, -1, -1)
    )
    return f"""
    WITH sizes AS (
        SELECT o_orderkey, o_orderkey * o_orderkey * o_orderkey * 7 + o_orderkey % 1024
            AS total_bytes
        FROM orders
    )
    SELECT *, CASE {ladder} END AS size_readable,
           total_bytes::DOUBLE * 1e-9::DOUBLE AS total_gb
    FROM sizes"""


KRAKEN_PRICES = f"SELECT pair, price, volume FROM ({KRAKEN_TRADE})"
KRAKEN_BARS = f"SELECT pair, open AS price, volume FROM ({KRAKEN_OHLC})"


def _compared(pairs: dict[str, tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"""
        SELECT '{name}' AS frames, only_left, only_right,
               only_left = 0 AND only_right = 0 AS equal
        FROM (SELECT (SELECT count(*) FROM (({a}) EXCEPT ALL ({b}))) AS only_left,
                     (SELECT count(*) FROM (({b}) EXCEPT ALL ({a}))) AS only_right)"""
        for name, (a, b) in pairs.items()
    )


def _frames_equal() -> str:
    gemini = f"SELECT symbol AS pair, price, amount AS volume FROM ({GEMINI_TRADE})"
    return _ev(_compared({
        "trades and bars": (KRAKEN_PRICES, KRAKEN_BARS), "gemini and kraken": (gemini, KRAKEN_PRICES)}))


OUTER_UPSERT = f"""
WITH {BOOK},
cut AS (
    SELECT product_id, side, lvl, qty, event_time, timestamp, seq,
           recv >= epoch_us(TIMESTAMP '2024-01-16') AS late,
           row_number() OVER (
               PARTITION BY product_id, side, lvl, recv >= epoch_us(TIMESTAMP '2024-01-16')
               ORDER BY seq DESC) AS place
    FROM bins
),
old AS (SELECT * FROM cut WHERE place = 1 AND NOT late),
new AS (SELECT * FROM cut WHERE place = 1 AND late)
SELECT coalesce(new.product_id, old.product_id) AS product_id,
       coalesce(new.side, old.side) AS side, coalesce(new.lvl, old.lvl) AS lvl,
       coalesce(new.qty, old.qty) AS qty, coalesce(new.event_time, old.event_time) AS event_time,
       coalesce(new.timestamp, old.timestamp) AS timestamp, coalesce(new.seq, old.seq) AS seq
FROM old FULL JOIN new
  ON old.product_id = new.product_id AND old.side = new.side AND old.lvl = new.lvl"""

STREAM_FANOUT = f"""
WITH {EVENTS},
fed AS (
    SELECT 'binance_trade_data_stream' AS "table", date FROM ({GOOD_TRADES})
    UNION ALL SELECT 'coinbase_market_trades_stream', date FROM ({COINBASE_TRADE})
    UNION ALL SELECT 'gemini_multimarketdata_trades', date FROM ({GEMINI_TRADE})
    UNION ALL SELECT 'quarantine', CAST(ts AS DATE) FROM ev
              WHERE event_type <> 'error' AND (event_id % 97 = 0 OR event_id % 89 = 0)
)
SELECT "table", date, count(*) AS table_rows FROM fed GROUP BY ALL"""


TRADE_REJECTS = f"""
    SELECT CASE WHEN event_id % 89 = 0 THEN 'malformed' ELSE 'bad price' END AS reason, {_audit("ts")}
    FROM ev WHERE event_type <> 'error' AND (event_id % 97 = 0 OR event_id % 89 = 0)"""

TRADES_TABLE = "binance_trade_data_stream"

BOOK_REJECTS = """
    SELECT reason, CAST(to_timestamp(1704067200 + user_id % 3 * 86400) AT TIME ZONE 'UTC' AS DATE) AS date,
           (1704067200 + user_id % 3 * 86400) * 1000000 AS insert_time
    FROM (SELECT DISTINCT user_id FROM events),
         (SELECT unnest(['malformed', 'no channel', 'bad price_level']) AS reason)"""

# Every table has bytes, and its readable size and GB fit them, however it is encoded.
TABLE_SIZES = """
    SELECT unnest(string_split('region nation customer supplier part orders lineitem events documents
        embeddings pages benchmark labels conversations', ' ')) AS "table",
        true AS has_bytes, true AS readable_fits, true AS gb_fits""".replace("\n        ", " ")


def sql() -> dict[str, str]:
    return {
        "binance_ticker": _ev(BINANCE_TICKER),
        "binance_trades": _ev(TRADES),
        "binance_book_ticker": _ev(BOOK_TICKER),
        "coinbase_trades": _ev(COINBASE_TRADE),
        "cryptocom_trades": _ev(CRYPTOCOM_TRADE),
        "gemini_trades": _ev(GEMINI_TRADE),
        "kraken_trades": _ev(KRAKEN_TRADE),
        "kraken_ticker": _ev(KRAKEN_TICKER),
        "kraken_ohlc": _ev(KRAKEN_OHLC),
        "coinbase_top_of_book": f"WITH {VIEW} {TOP_OF_BOOK}",
        "tob_connections": f"""
            WITH {VIEW}, tob AS ({TOP_OF_BOOK})
            SELECT * FROM tob UNION ALL
            SELECT * REPLACE (CAST(date + 365 AS DATE) AS date,
                              insert_time + 365 * 86400000000 AS insert_time) FROM tob""",
        "coinbase_l2_updates": f"""
            WITH {BOOK}
            SELECT side, event_time, price AS price_level, qty AS new_quantity,
                   'l2_data' AS channel, timestamp, seq AS sequence_num, product_id FROM upd""",
        "landing_roundtrip": _ev("""
            SELECT CASE WHEN event_id % 7 <> 0 THEN 'a' || event_id || mark || 'b' END AS value,
                   CASE WHEN user_id % 4 <> 0 THEN user_id || mark END AS connection, us AS recv_us
            FROM (SELECT *, [chr(10), chr(13) || chr(10), chr(9), chr(92) || 'n', chr(92), ''][event_id % 6 + 1]
                            AS mark FROM ev)"""),
        "latency_summary": _ev("""
            SELECT CASE WHEN user_id % 2 = 0 THEN 'btcusdt@trade' ELSE '!ticker@arr' END AS stream,
                   CAST(make_timestamp(us + event_id % 100 * 1000) AS DATE) AS date, count(*) AS messages,
                   CAST(min(event_id % 100) AS DOUBLE) AS min_ms, round(avg(event_id % 100), 1) AS mean_ms,
                   CAST(max(event_id % 100) AS DOUBLE) AS max_ms,
                   true AS p50_within, true AS p95_within, true AS p99_within
            FROM ev GROUP BY ALL"""),
        "compact_rerun": _ev(TRADES),
        "coverage_kept": _ev(" UNION ALL ".join(
            f"SELECT *, '{table}' AS \"table\" FROM "
            f"({_coverage(f"SELECT * FROM ({STATELESS[table]}) WHERE date >= DATE '2024-01-15'", symbol)})"
            for table, symbol in (("binance_trade_data_stream", "symbol"),
                                  ("gemini_multimarketdata_trades", "symbol"),
                                  ("kraken_trade_data_stream", "pair")))),
        "frames_same": _ev(_compared({
            "trades and trades": (KRAKEN_PRICES, KRAKEN_PRICES), "trades and bars": (KRAKEN_PRICES, KRAKEN_BARS)})),
        "stream_connections": f"""
            WITH {VIEW}, tob AS ({TOP_OF_BOOK})
            SELECT * FROM tob UNION ALL
            SELECT * REPLACE (CAST(date + 365 AS DATE) AS date,
                              insert_time + 365 * 86400000000 AS insert_time) FROM tob""",
        "raw_landing": _ev("""
            SELECT 'binance' AS exchange, 'trade' AS feed, us AS recv_us,
                   CASE WHEN event_type <> 'error' THEN event_id END AS trade_id FROM ev"""),
        "subscription_filter": _ev(f"""
            SELECT 'binance_trade_data_stream' AS table_name, symbol, event_time FROM ({TRADES})
            WHERE symbol IN ('S0', 'S2', 'S4')
            UNION ALL
            SELECT 'binance_symbol_ticker_stream', symbol, event_time FROM ({BINANCE_TICKER})"""),
        "binance_control_filter": _ev(
            "SELECT 'data' AS kind, event_id AS trade_id FROM ev WHERE event_type <> 'error'"
        ),
        "numeric_coercion": _ev("""
            SELECT event_id AS trade_id, sym AS symbol,
                   CASE WHEN event_id % 97 <> 0 THEN value END AS price,
                   CAST(qty AS DOUBLE) AS quantity, event_id % 2 = 0 AS market_maker,
                   CASE WHEN event_id % 97 = 0 THEN 'bad price' END AS reason
            FROM ev WHERE event_type <> 'error' AND event_id % 89 <> 0"""),
        "audit_columns": _ev(f"SELECT event_id AS order_book_updateid, {_audit('ts')} FROM ev"),
        "quarantine": _ev(TRADE_REJECTS),
        "message_kinds": _ev(KINDS),
        "route_counts": f"""
            WITH {EVENTS}, {FEED_TABLES}, kinds AS ({KINDS})
            SELECT CASE WHEN exchange = 'kraken' AND kind = 'control' THEN NULL
                        ELSE "table" END AS "table",
                   CAST(sum(messages) AS BIGINT) AS messages
            FROM kinds JOIN feed_tables USING (exchange, feed) GROUP BY 1""",
        "ingest_counters": _ingest_counters(),
        "envelope_filter": _ev(f"""
            SELECT * EXCLUDE (relayed)
                     REPLACE (CAST(relayed AS DATE) AS date, epoch_us(relayed) AS insert_time)
            FROM (SELECT t.*, ev.ts + to_milliseconds(event_id % 100) AS relayed
                  FROM ({BINANCE_TRADE}) t JOIN ev ON t.trade_id = ev.event_id
                  WHERE user_id % 2 = 0)"""),
        "relay_latency": _ev("""
            SELECT CASE WHEN user_id % 2 = 0 THEN 'btcusdt@trade' ELSE '!ticker@arr' END AS stream,
                   us + event_id % 100 * 1000 AS recv_us,
                   CAST(event_id % 100 AS DOUBLE) AS latency_ms FROM ev"""),
        "secmaster": SECMASTER,
        "csv_snapshot_roundtrip": SECMASTER,
        "sink_append_roundtrip": _ev(TRADES),
        "sorted_layout": _ev(f"""
            SELECT date, count(*) AS table_rows, 0 AS out_of_order
            FROM ({GEMINI_TRADE}) GROUP BY date"""),
        "compact_clustered": _ev(f"""
            SELECT date, count(*) AS rows, 0 AS overlaps FROM ({GEMINI_TRADE}) GROUP BY date"""),
        "subscribed_landing": f"""
            WITH {EVENTS}, kinds AS ({KINDS})
            SELECT exchange, feed, CAST(sum(messages) AS BIGINT) AS frames FROM kinds
            WHERE exchange = 'binance' AND feed IN ('trade', 'ticker') GROUP BY ALL""",
        "capture_first_n": f"""
            WITH ev AS (
                SELECT * FROM ({_ev("SELECT * FROM ev")})
                WHERE g IN (SELECT event_id // 10 FROM events GROUP BY 1
                            ORDER BY max(ts) LIMIT 201)
            ), grp AS (SELECT g, max(ts) AS last_ts FROM ev GROUP BY g)
            {BINANCE_TICKER}""",
        "sql_entry": _ev(f"""
            SELECT symbol, count(*) AS trades, sum(quantity) AS volume, max(price) AS high
            FROM ({TRADES}) GROUP BY symbol"""),
        "symbol_coverage": _ev(_coverage(TRADES, "symbol")),
        "coverage_all": _coverage_all(),
        "readable_size": _readable_size(),
        "value_counts": _ev(f"SELECT type, count(*) AS count FROM ({GEMINI_TRADE}) GROUP BY type"),
        "run_status_kpis": f"""
            WITH {JOB_RUNS}
            SELECT count(DISTINCT CASE WHEN state = 'success' THEN dag_id END) AS dags_finished,
                   count(DISTINCT CASE WHEN state = 'running' THEN dag_id END) AS dags_running,
                   count(DISTINCT CASE WHEN state IS NULL THEN dag_id END) AS dags_failed
            FROM runs""",
        "active_runs": f"""
            WITH {JOB_RUNS} SELECT dag_id, execution_date FROM runs WHERE state = 'running'""",
        "retention_keep": _ev(f"SELECT * FROM ({TRADES}) WHERE date >= DATE '2024-01-15'"),
        "retention_sweep": _retention_sweep(),
        "outer_upsert": OUTER_UPSERT,
        "frames_equal": _frames_equal(),
        "view_dedup": f"""
            WITH {VIEW}
            SELECT DISTINCT product_id, CAST(bid_px AS DOUBLE) AS bid_px,
                   CAST(offer_px AS DOUBLE) AS offer_px FROM quotes""",
        "union_by_name": _ev(
            f"SELECT * FROM ({KRAKEN_TRADE}) UNION ALL BY NAME SELECT * FROM ({CRYPTOCOM_TRADE})"
        ),
        "price_band": f"""
            WITH {BOOK}
            SELECT product_id, seq AS sequence_num, side, price AS price_level,
                   qty AS new_quantity, event_time, lo_px, hi_px FROM inb""",
        "level_bins": f"""
            WITH {BOOK} SELECT product_id, seq AS sequence_num, side, lvl, qty, event_time,
                               timestamp FROM bins""",
        "dense_levels": f"""
            WITH {BOOK} SELECT product_id, seq AS sequence_num, side, lvl, qty, event_time,
                               timestamp FROM ups""",
        "best_levels": f"""
            WITH {BEST}
            SELECT product_id, message, bp AS bid_px, bq AS bid_sz, bt AS bid_time, bs AS bid_seq,
                   ap AS offer_px, aq AS offer_sz, aet AS offer_time, az AS offer_seq FROM best""",
        "tob_view": f"WITH {VIEW} SELECT {QUOTE_COLUMNS} FROM quotes",
        "tob_changes": f"WITH {VIEW} SELECT {QUOTE_COLUMNS} FROM quotes WHERE changed",
        "tob_with_reset": TOB_WITH_RESET,
        "reset_counts": f"""
            SELECT product_id, count(*) AS resets FROM ({TOB_WITH_RESET}) WHERE reset AND k = 1 GROUP BY product_id""",
        "stream_trades": _ev(TRADES),
        "stream_top_of_book": f"WITH {VIEW} {TOP_OF_BOOK}",
        "stream_fanout": STREAM_FANOUT,
        "stream_counters": _ingest_counters(),
        "mixed_writers": _ev(f"""
            SELECT '{TRADES_TABLE}' AS "table", date, 5 * count(*) AS table_rows
            FROM ({TRADES}) GROUP BY date"""),
        "retention_delete": _ev(f"""
            SELECT "table", date, 2 * count(*) AS table_rows
            FROM (SELECT '{TRADES_TABLE}' AS "table", date FROM ({TRADES})
                  UNION ALL SELECT 'gemini_multimarketdata_trades', date FROM ({GEMINI_TRADE}))
            WHERE date >= DATE '2024-01-15' GROUP BY ALL"""),
        "book_rejects": BOOK_REJECTS,
        "stream_quarantine": f"""
            WITH {VIEW}, good AS ({_ev(GOOD_TRADES)}), bad AS ({_ev(TRADE_REJECTS)}),
            book_bad AS ({BOOK_REJECTS})
            SELECT "table", date, count(*) AS table_rows FROM (
                SELECT '{TRADES_TABLE}' AS "table", date FROM good
                UNION ALL SELECT 'coinbase_top_of_book_stream', date FROM ({TOP_OF_BOOK})
                UNION ALL SELECT '{TRADES_TABLE} ' || reason, date FROM bad
                UNION ALL SELECT 'coinbase_top_of_book_stream ' || reason, date FROM book_bad
            ) GROUP BY ALL""",
        "table_sizes": TABLE_SIZES,
        "coverage_with_sizes": f"SELECT *, true AS has_bytes, true AS gb_fits FROM ({_coverage_all()})",
    }
