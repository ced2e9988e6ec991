from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tapelake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frames(spark):
    """Landing frames of one feed from texts, one second apart."""

    def make(exchange: str, feed: str, *values: str):
        rows = [(exchange, feed, value, i) for i, value in enumerate(values)]
        df = spark.createDataFrame(rows, "exchange string, feed string, value string, s int")
        return df.selectExpr(
            "exchange", "feed", "value", "timestamp_seconds(1704067200 + s) AS recv_ts"
        )

    return make
