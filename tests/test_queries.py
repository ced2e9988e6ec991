"""Every registered query against its oracle on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
import compare
from tapelake.sources import landing

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    verdict, _ = compare.compare(spark, duck, SF_DIR, QUERIES[name], ORACLES.get(name))
    assert verdict == "ok" if name in ORACLES else verdict != "rows 0"


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_connections_in_more_files_than_a_trigger_takes(spark, duck, monkeypatch):
    """Files hold messages in any order, so a second micro-batch would pass over what it gets."""
    monkeypatch.setattr(landing, "FRAMES_PER_FILE", 1)
    name = "stream_connections"
    verdict, _ = compare.compare(spark, duck, SF_DIR, QUERIES[name], ORACLES[name])
    assert verdict == "ok"
