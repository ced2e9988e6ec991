"""Quality classifier: ordinal cumulative-link regression over hashed text.

Documents carry graded ratings 0..K-1. One weight vector over hashed words and word
shapes gives a document's score, the mean over its words; ordered thresholds turn
the score into P(grade >= k) = sigmoid(score - threshold k) for every k at once.
Expected grade and tail probabilities follow. The fit sees a bounded sample of rated
documents (``MAX_RATED``); scoring sees all words of all documents.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.llm.columns import crc_remainder, spare_name, utf8
from tapelake.llm.training import labelled_sample

MAX_RATED = 12_000
HASH_BITS = 17
SCALE = 8.0
ROUNDS = 120
STEP = 0.3
DECAY = 1e-4
MIN_GAP = 0.05
CACHED_WORDS = 200_000
HELD_OUT_OF = 5
KEPT_FROM = 0.5

LETTERS = re.compile(rb"[a-z\x80-\xff]+")
CAPITALS = re.compile(rb"[A-Z]+")
DIGITS = re.compile(rb"[0-9]+")


def shape(word: bytes) -> bytes:
    """The word with runs of letters, capitals and digits as one sign each."""
    return DIGITS.sub(b"9", CAPITALS.sub(b"X", LETTERS.sub(b"x", word)))


def features_of(word: bytes) -> tuple[int, int]:
    """Hashed places of a word and of its shape."""
    mask = (1 << HASH_BITS) - 1
    return zlib.crc32(word.lower()) & mask, zlib.crc32(b"shape " + shape(word)) & mask


@dataclass
class OrdinalModel:
    """Shared weights, ordered thresholds, and the number of grades."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1..K-1, a column each."""
        return 1 / (1 + np.exp(-(np.asarray(score)[:, None] - self.thresholds)))


def word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hashed features of each document: places and shares of its words."""
    for batch in batches:
        rows = []
        for doc_id, label, text in zip(batch["doc_id"], batch["label"], batch["text"], strict=True):
            words = Counter(text.encode().split())
            total = sum(words.values())
            share: Counter[int] = Counter()
            for word, n in words.items():
                for place in features_of(word):
                    share[place] += n
            places = np.fromiter(share.keys(), np.int32, len(share))
            values = np.fromiter(share.values(), np.float32, len(share)) * (SCALE / max(1, total))
            rows.append((doc_id, label, places.tobytes(), values.tobytes()))
        yield pd.DataFrame(rows, columns=["doc_id", "label", "places", "shares"])


def fit(sample: DataFrame, grades: int) -> OrdinalModel:
    """Maximum likelihood with Adam over the collected, bounded sample."""
    schema = "doc_id long, label long, places binary, shares binary"
    rows = sample.mapInPandas(word_counts, schema).toPandas().sort_values("doc_id")
    model = OrdinalModel(np.zeros(1 << HASH_BITS), np.linspace(-1.0, -0.5, grades - 1))
    if not len(rows):
        return model
    places = [np.frombuffer(p, np.int32) for p in rows["places"]]
    row = np.repeat(np.arange(len(rows)), [len(p) for p in places])
    column = np.concatenate(places)
    value = np.concatenate([np.frombuffer(s, np.float32) for s in rows["shares"]]).astype(np.float64)
    grade = rows["label"].to_numpy(np.int64)
    moments = [np.zeros(len(model.weights) + grades - 1) for _ in range(2)]
    for t in range(1, ROUNDS + 1):
        score = np.bincount(row, value * model.weights[column], len(rows))
        up_score, up_thresholds = slopes(model, score, grade)
        gradient = np.bincount(column, value * up_score[row], len(model.weights)) / len(rows)
        gradient = np.concatenate([gradient - DECAY * model.weights, up_thresholds / len(rows)])
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.99 * moments[1] + 0.01 * gradient**2
        step = STEP * (moments[0] / (1 - 0.9**t)) / (np.sqrt(moments[1] / (1 - 0.99**t)) + 1e-8)
        model.weights += step[: len(model.weights)]
        moved = model.thresholds + step[len(model.weights) :]
        gaps = np.maximum(np.diff(moved), MIN_GAP)
        model.thresholds = np.concatenate([moved[:1], moved[:1] + np.cumsum(gaps)])
    return model


def slopes(model: OrdinalModel, score: np.ndarray, grade: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives of the log-likelihood by each score and by the thresholds.

    P(grade = k) = tail k - tail k+1, with tail 0 = 1 and tail K = 0.
    """
    inner = model.tails(score)
    tail = np.column_stack([np.ones(len(score)), inner, np.zeros(len(score))])
    slope = tail * (1 - tail)
    at = np.arange(len(score))
    p = np.maximum(tail[at, grade] - tail[at, grade + 1], 1e-9)
    low, high = slope[at, grade] / p, slope[at, grade + 1] / p
    thresholds = np.array(
        [high[grade + 1 == k].sum() - low[grade == k].sum() for k in range(1, model.thresholds.size + 1)]
    )
    return low - high, thresholds


class WordScores(dict):
    """Weight of a word and its shape, worked out once per worker and word."""

    def __init__(self, model: OrdinalModel):
        super().__init__()
        self.model = model

    def __missing__(self, word: bytes) -> float:
        a, b = features_of(word)
        weight = float(self.model.weights[a] + self.model.weights[b])
        if len(self) < CACHED_WORDS:
            self[word] = weight
        return weight

    def score(self, text: bytes) -> float:
        words = text.split()
        return SCALE * sum(map(self.__getitem__, words)) / max(1, len(words))


def tails_udf(model: OrdinalModel):
    """Column function: text to the array of tail probabilities."""
    model = OrdinalModel(model.weights.astype(np.float32), model.thresholds)
    scores = WordScores(model)

    @F.arrow_udf("array<double>")
    def tails(texts: pa.Array) -> pa.Array:
        score = np.array([scores.score(t) for t in utf8(texts)])
        return pa.array(list(model.tails(score)), pa.list_(pa.float64()))

    return tails


def grade_of_labels() -> Column:
    """Graded rating of a label row: 0 poor, 1 fluent but toxic, 2 good."""
    toxic = F.when(F.col("toxic") == 1, 1).otherwise(2)
    return F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, toxic).cast("long")


GRADES = 3


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel:
    """Fit on at most MAX_RATED rated documents, none of which is held out."""
    allowed = crc_remainder(labels["doc_id"], HELD_OUT_OF) != 0
    sample = labelled_sample(docs, labels, grade_of_labels(), MAX_RATED, allowed, id_col, text_col)
    return fit(sample, GRADES)


def grades(
    docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, held_out, expected_grade, p_grade_1, ..., selected) of every row.

    Null texts count as empty; a text without words has score 0, so the thresholds
    alone grade it. Repeated rows give repeated results; other columns are ignored.
    """
    tails = docs.select(
        docs[id_col].alias("doc_id"), tails_udf(model)(docs[text_col]).alias("tails")
    )
    size = len(model.thresholds)
    return tails.select(
        "doc_id",
        (crc_remainder(F.col("doc_id"), HELD_OUT_OF) == 0).alias("held_out"),
        sum((F.col("tails")[k] for k in range(size)), F.lit(0.0)).alias("expected_grade"),
        *(F.col("tails")[k].alias(f"p_grade_{k + 1}") for k in range(size)),
        (F.col("tails")[0] >= KEPT_FROM).alias("selected"),
    )


def select_quality(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose tail probability P(grade >= 1) reaches KEPT_FROM, all columns kept."""
    tails = spare_name("tails")
    scored = docs.withColumn(tails, tails_udf(model)(docs[text_col]))
    return scored.where(F.col(tails)[0] >= KEPT_FROM).drop(tails)
