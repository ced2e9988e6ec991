"""Connected components of a table of links, by alternating star steps.

A large-star step ties every larger neighbour of a node to the node's smallest
neighbour; a small-star step does so for the smaller ones. Both keep the
components and never add links, and a handful of rounds leaves one star per
component. Every round is written to the shared folder, so a lost executor costs
one round. Before the first round each task reduces its own links to a forest.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.workspace import materialize

MAX_ROUNDS = 60


def local_forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stars over the links of each batch."""
    for batch in batches:
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while (above := up.setdefault(x, x)) != x:
                up[x] = up[above]
                x = above
            return x

        for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            x, y = root(a), root(b)
            if x != y:
                up[max(x, y)] = min(x, y)
        nodes = list(up)
        yield pd.DataFrame({"a": nodes, "b": [root(x) for x in nodes]}).query("a != b")


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """One step. Hubs may be huge, so the least neighbour is aggregated and joined, not windowed."""
    if larger:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        turned = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        turned = moved.union(least.select("a", F.col("m").alias("b")))
    return turned.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``links`` (a, b). Loops are ignored."""
    state = materialize(links.mapInPandas(local_forest, "a long, b long"), "links")
    before = None
    for _ in range(MAX_ROUNDS):
        state = materialize(_star(_star(state, True), False), "links")
        after = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after
    raise RuntimeError("components did not settle")
