"""Ordered look-ups that never put a whole key into one task.

A window over a hot key is one task. These helpers cut the order of a key into
buckets, run the window inside the buckets, and run a second window over one
row per bucket to carry values across the cuts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = 4096


def _bucket(order: str) -> Column:
    return F.floor(F.col(order) / F.lit(BUCKET))


def running_count(df: DataFrame, keys: list[str], order: str, out: str, total: str) -> DataFrame:
    """Number of earlier rows of the same key by ``order`` (unique there), and of all."""
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order)
    numbered = df.withColumn("_bucket", _bucket(order)).withColumn(
        "_at", F.row_number().over(inside) - 1
    )
    sizes = numbered.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    across = Window.partitionBy(*keys).orderBy("_bucket")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    whole = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = sizes.select(
        *keys,
        "_bucket",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
        F.sum("_size").over(whole).alias(total),
    )
    return (
        numbered.join(starts, [*keys, "_bucket"])
        .withColumn(out, F.col("_start") + F.col("_at"))
        .drop("_bucket", "_at", "_start")
    )


def following(df: DataFrame, keys: list[str], order: str, value: Column, out: str) -> DataFrame:
    """``value`` of the next row of the same key, by ``order`` (unique in the key)."""
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order)
    marked = df.withColumn("_bucket", _bucket(order)).withColumn("_value", value)
    marked = marked.withColumn("_next", F.lead("_value").over(inside))
    heads = marked.groupBy(*keys, "_bucket").agg(F.min_by("_value", order).alias("_head"))
    across = Window.partitionBy(*keys).orderBy("_bucket")
    heads = heads.select(*keys, "_bucket", F.lead("_head").over(across).alias("_next_head"))
    return (
        marked.join(heads, [*keys, "_bucket"])
        .withColumn(out, F.coalesce("_next", "_next_head"))
        .drop("_bucket", "_value", "_next", "_next_head")
    )
