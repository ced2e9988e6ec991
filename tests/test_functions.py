"""Column expressions, ordered look-ups, whole-frame operators."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tapelake.functions.columns import iso_nanos, readable_size, trimmed_list, utc_date
from tapelake.operators import ordered
from tapelake.operators.frames import frame_difference, outer_upsert
from tapelake.operators.reports import active_runs, run_status
from tapelake.sources.external import read_runs
from tapelake.workspace import new_folder


def one(spark, expression):
    return spark.range(1).select(expression).first()[0]


def test_readable_size(spark):
    cases = {
        0: "0.00 B", 1023: "1023.00 B", 1024: "1.00 KiB", 1152: "1.13 KiB",
        192851925: "183.92 MiB", 3 * 1024**4: "3.00 TiB",
    }
    for size, text in cases.items():
        assert one(spark, readable_size(F.lit(size))) == text


def test_iso_nanos(spark):
    base = 1704067207 * 10**9
    cases = {
        "2024-01-01T00:00:07Z": base,
        "2024-01-01T00:00:07.5Z": base + 500_000_000,
        "2024-01-01T00:00:07.179575Z": base + 179_575_000,
        "2024-01-01T00:00:07.1795751Z": base + 179_575_100,
        "2024-01-01T00:00:07.179575123Z": base + 179_575_123,
        "no time": None,
    }
    for text, nanos in cases.items():
        assert one(spark, F.expr(iso_nanos(f"'{text}'"))) == nanos


def test_utc_date_ignores_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        late = f"timestamp_seconds({1704067200 + 23 * 3600})"
        assert one(spark, F.expr(utc_date(late)).cast("string")) == "2024-01-01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_trimmed_list(spark):
    assert one(spark, trimmed_list(F.lit("a, b ,1c1 "))) == ["a", "b", "1c1"]


@pytest.fixture
def small_buckets(monkeypatch):
    monkeypatch.setattr(ordered, "BUCKET", 4)


def test_ordered_lookups(spark, small_buckets):
    rng = random.Random(7)
    rows = [(key, at) for key in "ab" for at in sorted(rng.sample(range(100), 30))]
    df = spark.createDataFrame(rows, "key string, at bigint")
    counted = ordered.running_count(df, ["key"], "at", "n", "total").collect()
    followed = ordered.following(df, ["key"], "at", F.col("at"), "next").collect()
    assert {r.total for r in counted} == {30}
    for key in "ab":
        places = [at for k, at in rows if k == key]
        assert sorted((r.n, r.at) for r in counted if r.key == key) == list(enumerate(places))
        assert sorted((r.at, r.next) for r in followed if r.key == key) == list(
            zip(places, [*places[1:], None])
        )


def test_outer_upsert(spark):
    state = spark.createDataFrame([(1, 10, 5), (2, 20, 6)], "k int, q int, t int")
    update = spark.createDataFrame([(2, 0, None), (3, 30, 7)], "k int, q int, t int")
    got = outer_upsert(state, update, ["k"]).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, 10, 5), (2, 0, 6), (3, 30, 7)]


def test_frame_difference_counts_copies(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([("x", 2), (None, 1), ("y", 3)], "v string, k int")
    assert tuple(frame_difference(a, b).first()) == (1, 1, False)
    assert tuple(frame_difference(a, a.orderBy("v")).first()) == (0, 0, True)


def test_run_status(spark):
    runs = spark.sql("""
        SELECT * FROM VALUES
            ('a', 'success', TIMESTAMP_NTZ '2024-01-02 01:00:00'),
            ('a', 'running', TIMESTAMP_NTZ '2024-01-02 02:00:00'),
            ('b', NULL, TIMESTAMP_NTZ '2024-01-02 00:00:00'),
            ('c', 'failed', TIMESTAMP_NTZ '2024-01-02 00:00:00'),
            ('d', 'running', TIMESTAMP_NTZ '2024-01-01 23:59:59')
        AS t(dag_id, state, last_scheduling_decision)""").selectExpr(
        "*", "last_scheduling_decision AS execution_date"
    )
    day = F.lit("2024-01-02").cast("date")
    assert run_status(runs, day).first().asDict() == {
        "dags_finished": 1, "dags_running": 1, "dags_failed": 2,
    }
    assert [r.dag_id for r in active_runs(runs, day).collect()] == ["a"]
    path = new_folder(spark, "test-runs")
    runs.write.parquet(path)
    stored = active_runs(read_runs(spark, path), day)
    assert [r.dag_id for r in stored.collect()] == ["a"]
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(last_scheduling" in plan


def test_sizes_that_no_bigint_holds(spark, tmp_path):
    """``readable_size`` shows them; only their number of bytes is missing."""
    keys = spark.createDataFrame([(1,), (1_100_000,), (9_000_000,), (None,)], "o_orderkey long")
    keys.write.parquet(str(tmp_path / "orders.parquet"))
    rows = entry_points.readable_size(spark, str(tmp_path)).orderBy(F.asc_nulls_last("o_orderkey")).collect()
    assert [row["total_bytes"] for row in rows[:3]] == [8, None, None]
    assert [row["size_readable"] for row in rows] == ["8.00 B", "8.08 EiB", "4426.15 EiB", None]
    assert rows[2]["total_gb"] == pytest.approx(7 * 9_000_000.0**3 * 1e-9)
