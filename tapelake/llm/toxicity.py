"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

The lexicon of hostile words and word stems is learned from labelled documents: terms
that are far more frequent in toxic documents than in others. Features are densities
of lexicon words, their closeness to second-person words, capitals, punctuation and
obfuscation (digits or signs inside words, and words that are hostile only once
look-alike digits are read as letters). Lexicon, trees and calibration are fitted on
separate parts of a bounded labelled sample (``MAX_LABELLED``); scoring sees whole texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.llm.columns import crc_remainder, spare_name, strings
from tapelake.llm.training import labelled_sample
from tapelake.workspace import materialize

MAX_LABELLED = 24_000
FOLDS = 3
HELD_OUT = 1
TOXIC_FROM = 0.7
MAX_LEXICON = 2_000
MIN_SUPPORT = 5
MIN_LOG_ODDS = 2.3
STEM_LENGTHS = (4, 5, 6)
NEAR = 5
TREES, DEPTH, SHRINKAGE = 20, 4, 0.3
CACHED_WORDS = 200_000
PARTS, LEXICON_PARTS, TREE_PARTS = 10, 4, 8

# Second-person words of the corpus languages, and look-alike signs.
SECOND_PERSON = (
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine "
    "ihr euch euer usted ustedes vosotros tus ti"
)
LOOK_ALIKES = str.maketrans("0134578@$!", "oieastbasi")

EDGES = ".,;:!?\"'()[]{}<>*#%&$|-_/\\"
INNER_SIGN = re.compile(r"[^\W\d_][\d@$*!_.]+[^\W\d_]")


def terms_of(word: str) -> list[str]:
    """The word and its stems; a stem ends in a star."""
    return [word, *(f"{word[:n]}*" for n in STEM_LENGTHS if len(word) > n)]


def term_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of each class per term, summed up per task."""
    counts = {0: Counter(), 1: Counter()}
    for batch in batches:
        for label, text in zip(batch["label"], batch["text"], strict=True):
            words = {w.strip(EDGES) for w in set(text.lower().split())}
            counts[int(label)].update({t for w in words if w for t in terms_of(w)})
    terms = [t for t, n in counts[1].items()]
    yield pd.DataFrame(
        {"term": terms, "toxic": [counts[1][t] for t in terms], "clean": [0] * len(terms)}
    )
    terms = list(counts[0])
    yield pd.DataFrame({"term": terms, "toxic": [0] * len(terms), "clean": [counts[0][t] for t in terms]})


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """At most MAX_LEXICON terms with their log-odds of being in a toxic document."""
    classes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = classes.get(1, 0), classes.get(0, 0)
    if not toxic or not clean:
        return {}
    counts = (
        sample.mapInPandas(term_counts, "term string, toxic long, clean long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    found = (
        counts.where(F.col("toxic") >= MIN_SUPPORT)
        .withColumn("odds", odds)
        .where(F.col("odds") >= MIN_LOG_ODDS)
        .orderBy(F.desc(F.col("odds") * F.log1p("toxic")), "term")
        .limit(MAX_LEXICON)
    )
    return {r["term"]: r["odds"] for r in found.collect()}


class Features(dict):
    """Feature vector of a text. As a mapping: a word's (hostility, after look-alikes are read)."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon
        self.second = frozenset(SECOND_PERSON.split())

    def weight(self, word: str) -> float:
        return max((self.lexicon.get(t, 0.0) for t in terms_of(word)), default=0.0) if word else 0.0

    def __missing__(self, raw: str) -> tuple[float, float, bool, bool]:
        word = raw.strip(EDGES)
        weight = self.weight(word)
        read = self.weight(re.sub(r"[_.*]", "", word.translate(LOOK_ALIKES)))
        found = (weight, max(weight, read), word in self.second, bool(INNER_SIGN.search(word)))
        if len(self) < CACHED_WORDS:
            self[raw] = found
        return found

    def of(self, text: str) -> list[float]:
        words = text.lower().split()
        n = max(1, len(words))
        kinds = list(map(self.__getitem__, words))
        hits = [(i, k[0]) for i, k in enumerate(kinds) if k[0]]
        disguised = sum(1 for k in kinds if k[1] > k[0])
        second = np.array([i for i, k in enumerate(kinds) if k[2]])
        near = 0
        if len(second) and hits:
            at = np.array([i for i, _ in hits])
            right = np.searchsorted(second, at).clip(max=len(second) - 1)
            gap = np.minimum(abs(second[right] - at), abs(second[(right - 1).clip(min=0)] - at))
            near = int((gap <= NEAR).sum())
        weights = [w for _, w in hits]
        chars = max(1, len(text))
        capitals = len(CAPITALS.findall(text))
        return [
            len(hits) / n,
            math.log1p(len(hits)),
            sum(weights) / n,
            math.log1p(sum(weights)),
            max(weights, default=0.0),
            len({words[i] for i, _ in hits}),
            near / n,
            float(near),
            len(second) / n,
            capitals / chars,
            len(SHOUTED.findall(text)) / n,
            len(SIGNS.findall(text)) / chars,
            text.count("!") / chars,
            disguised / n,
            sum(1 for k in kinds if k[3]) / n,
            math.log1p(len(words)),
        ]


CAPITALS = re.compile(r"[A-Z]")
SHOUTED = re.compile(r"\b[A-Z]{3,}\b")
SIGNS = re.compile(r"[!-/:-@\[-`{-~]")


def features_udf(lexicon: dict[str, float]):
    features = Features(lexicon)

    @F.arrow_udf("array<double>")
    def dense(texts: pa.Array) -> pa.Array:
        return pa.array([features.of(t) for t in strings(texts)], pa.list_(pa.float64()))

    return dense


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    trees: object
    calibration: object
    prior: float

    def score(self, docs: DataFrame, text_col: str, name: str) -> DataFrame:
        """``docs`` with the calibrated probability of being toxic in a new column."""
        if self.trees is None:
            return docs.withColumn(name, F.lit(self.prior))
        vector, raw = spare_name("vector"), spare_name("raw")
        dense = array_to_vector(features_udf(self.lexicon)(docs[text_col]))
        trees = self.trees.setFeaturesCol(vector).setProbabilityCol(raw)
        for unused in (trees.setPredictionCol, trees.setRawPredictionCol):
            unused("")
        calibrated = self.calibration.setFeaturesCol(raw).setPredictionCol(name)
        rows = trees.transform(docs.withColumn(vector, dense))
        rows = rows.withColumn(raw, vector_to_array(raw)[1])
        return calibrated.transform(rows).drop(vector, raw)


def held_out(key: Column) -> Column:
    return crc_remainder(key, FOLDS) == HELD_OUT


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> ToxicityModel:
    """Fit lexicon, trees and calibration, each on its own part of the sample.

    Without both classes in each part, the share of toxic documents is every score.
    """
    label = F.when(F.col("toxic").isin(0, 1), F.col("toxic")).cast("long")
    allowed = ~held_out(labels["doc_id"])
    sample = labelled_sample(docs, labels, label, MAX_LABELLED, allowed, id_col, text_col)
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(PARTS))
    lexicon = learn_lexicon(sample.where(part < LEXICON_PARTS))
    dense = array_to_vector(features_udf(lexicon)("text")).alias("features")
    rows = materialize(
        sample.where(part >= LEXICON_PARTS).select(part.alias("part"), F.col("label").cast("double"), dense),
        "toxicity-features",
    )
    grown, ironed = rows.where(F.col("part") < TREE_PARTS), rows.where(F.col("part") >= TREE_PARTS)
    counts = [(r[0], r[1]) for r in (x.agg(F.sum("label"), F.count(F.lit(1))).first() for x in (grown, ironed))]
    if any(not n or not s or s == n for s, n in counts):
        total = sum(n for _, n in counts)
        return ToxicityModel(lexicon, None, None, sum(s or 0 for s, _ in counts) / max(1, total))
    booster = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH, stepSize=SHRINKAGE, minInstancesPerNode=10, seed=7, cacheNodeIds=False
    )
    trees = booster.fit(grown.coalesce(4))
    raw = trees.transform(ironed).select(vector_to_array("probability")[1].alias("raw"), "label")
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label").fit(raw)
    return ToxicityModel(lexicon, trees, calibration, 0.0)


def toxicity(
    docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    Null texts count as empty and are scored like others. A missing doc_id counts as
    empty text in the fold. Repeated rows give repeated results; other columns are ignored.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    scored = model.score(rows, "text", "score")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns kept."""
    name = spare_name("score")
    return model.score(docs, text_col, name).where(F.col(name) < TOXIC_FROM).drop(name)
