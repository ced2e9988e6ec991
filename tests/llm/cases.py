"""Small hostile tables for the operators of tapelake.llm."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, fp long, words string, digest string, rank int, ghost string"

WORDS = "the of cat dog tree runs and house to mit apache license general public blue Kelvin É ß 日本 it is".split()


def rows() -> list[tuple]:
    """Ordinary texts, copies, near copies, nulls, empties, odd spaces, and long texts."""
    random.seed(3)
    texts = [" ".join(random.choices(WORDS, k=random.randint(1, 60))) for _ in range(60)]
    long = " ".join(random.choices(WORDS, k=9000))
    texts += texts[:12] + [t.upper() for t in texts[:4]]
    texts += [f"{t} end" for t in texts[:8]]
    texts += [None, None, "", "", " ", "\n\t ", "a", "A", "é", "É", "!!! ###", "x y", long, long + " tail"]
    texts += ["Released under the MIT License.", "mit license MIT LICENSE mit, license", "the apache LICENSE, version 2.0"]
    texts += ["the " * 30_000 + "cat", "the of " * 2000, "x" * 20_000]
    texts += ["general public license", "general public public license", "İstanbul mİt license"]
    ids = [i * 7 % 1009 for i in range(len(texts))]
    found = [(i, t, "en", 1, "w", "d", 1, "g") for i, t in zip(ids, texts, strict=True)]
    found += [found[0], found[0], found[61]]
    found += [(None, "no id", None, None, None, None, None, None), (None, texts[2], "en", 1, "w", "d", 1, "g")]
    return found


def documents(spark: SparkSession, chosen: list[tuple] | None = None) -> DataFrame:
    return spark.createDataFrame(rows() if chosen is None else chosen, SCHEMA).repartition(3)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def with_ids(chosen: list[tuple] | None = None) -> list[tuple[int, str]]:
    return [(r[0], r[1] or "") for r in (rows() if chosen is None else chosen)]
