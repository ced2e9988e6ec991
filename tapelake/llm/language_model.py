"""Language-model scoring by a weighted backoff automaton.

Smoothed n-grams up to an order become an automaton. A state is a context h of fewer
words than the order that training texts hold, the empty one being the root; an n-gram
h w of training is an arc from state h over w, weighted log10 P(w | h); each state has a
failure arc to the state of h without its first word, weighted with what h leaves to
words it was never followed by; the root has an arc for every word, weighted log10 P(w).

    P(w)     = (c(w) + 0.1) / (N + 0.1 (V + 1))
    P(w | h) = (c(h w) + M P(w | h')) / (c(h) + M),  h' being h without its first word,
    so the failure arc of h weighs log10 M / (c(h) + M)

A text is read once from left to right. At each word the state in hand is left by its arc
over the word, or else by failure arcs, one after another, until a state has the arc;
the weights passed are added up. The state carried on is the longest context that ends
in the word just read.

The counts grow with the corpus and never meet in one place. Documents are cut into
blocks; each block asks for the counts of its distinct n-grams, once each, under
64-bit hashes. Requests are dealt by ranges of the hash, which are even whatever the
words; a range adds up what the blocks' training documents contribute and answers
every block. Requests and answers are packed arrays, so that a count costs a few
bytes on the way. Some two of a corpus' n distinct words and bigrams share a hash with a
chance of about n^2 / 2^65; longer n-grams are known by 56 bits, so n^2 / 2^57 pairs of
them are expected to be counted as one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.columns import crc_remainder, utf8
from tapelake.workspace import materialize

FOLDS = 10
ADDED = 0.1
PRIOR_WEIGHT = 16.0
ORDER = 3
BLOCK_TOKENS = 1_500_000
RANGE_TOKENS = 1_000_000
END, START = b" end", b" start"  # no word holds a space
WORDS, PAIRS = 1, 2
LONG_DROPPED = np.uint64(8)  # low bits of the hashes of longer n-grams that are left out

BLOCK = "block long, tokens long, doc_ids array<long>, held_out array<boolean>, lengths binary, ids binary, keys binary"
REQUEST = "part long, block long, kind int, size long, keys binary, counts binary"
ANSWER = "part long, block long, kind int, size long, counts binary, total long, types long"
SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def packed(values: np.ndarray) -> bytes:
    """Numbers with their bytes laid out place by place, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, size: int, kind: type) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    planes = np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, size)
    return np.ascontiguousarray(planes.T).view(kind).reshape(size)


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted hashes as steps, whose high bytes are mostly zero."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes, size: int) -> np.ndarray:
    return np.cumsum(unpacked(data, size, np.uint64), dtype=np.uint64)


def hash_of(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of a bigram from the hashes of its words."""
    mixed = (first ^ (first >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed + second) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return mixed ^ (mixed >> np.uint64(30))


class Vocabulary(dict):
    """Numbers of words, in order of first appearance."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of about BLOCK_TOKENS tokens; documents stay whole."""
    task = TaskContext.get().partitionId()
    done, tokens = 0, 0
    vocabulary, parts, doc_ids, held_out = Vocabulary(), [], [], []

    def block() -> pa.RecordBatch:
        ids = np.concatenate(parts)
        uses = np.bincount(ids, minlength=len(vocabulary))
        order = np.argsort(-uses, kind="stable")
        number = np.empty(len(order), np.uint32)
        number[order] = np.arange(len(order), dtype=np.uint32)
        keys = np.fromiter(map(hash_of, vocabulary), np.uint64, len(vocabulary))[order]
        lengths = np.array([len(p) for p in parts], np.uint32)
        row = {
            "block": task << 24 | done,
            "tokens": tokens,
            "doc_ids": doc_ids,
            "held_out": held_out,
            "lengths": packed(lengths),
            "ids": packed(number[ids]),
            "keys": packed(keys),
        }
        types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_())] + [pa.binary()] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(row.values(), types, strict=True)], names=list(row)
        )

    for batch in batches:
        known = [batch.column(name).to_pylist() for name in ("doc_id", "held_out")]
        for doc_id, out, text in zip(*known, utf8(batch.column("text")), strict=True):
            words = text.lower().split()
            words.append(END)
            parts.append(np.fromiter(map(vocabulary.__getitem__, words), np.uint32, len(words)))
            doc_ids.append(doc_id)
            held_out.append(out)
            tokens += len(words)
            if tokens >= BLOCK_TOKENS:
                yield block()
                done, tokens = done + 1, 0
                vocabulary, parts, doc_ids, held_out = Vocabulary(), [], [], []
    if parts:
        yield block()


class Block:
    """A block's tokens as hashes, and the n-grams that end at each token."""

    def __init__(self, row: pd.Series):
        self.id = int(row["block"])
        self.doc_ids = row["doc_ids"]
        self.held_out = np.array(row["held_out"], bool)
        self.lengths = unpacked(row["lengths"], len(self.held_out), np.uint32).astype(np.int64)
        tokens = int(self.lengths.sum())
        self.ids = unpacked(row["ids"], tokens, np.uint32)
        self.keys = unpacked(row["keys"], int(self.ids.max()) + 1, np.uint64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.place = np.arange(tokens) - np.repeat(self.starts, self.lengths)
        self.trained = np.repeat(~self.held_out, self.lengths)

    def grams(self, order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, sorted distinct hashes, where each token's n-gram stands among them) for n up to an order.

        An n-gram may begin with the start of its text; -1 marks tokens that fewer
        words precede.
        """
        by_hash = np.argsort(self.keys)
        rank = np.empty(len(by_hash), np.int64)
        rank[by_hash] = np.arange(len(by_hash))
        yield WORDS, self.keys[by_hash], rank[self.ids]
        hashes = before = self.keys[self.ids]
        for n in range(PAIRS, order + 1):
            before = np.roll(before, 1)
            if n == PAIRS:
                before[self.starts] = hash_of(START)
            before = pair_hash(before, hashes)
            full = self.place >= n - PAIRS
            own = before[full] if n == PAIRS else before[full] >> LONG_DROPPED << LONG_DROPPED
            keys, found = np.unique(own, return_inverse=True)
            at = np.full(len(full), -1)
            at[full] = found
            yield n, keys, at


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Range of the hash that a key falls into."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def requests(parts: int, order: int):
    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                block = Block(row)
                for kind, keys, at in block.grams(order):
                    counts = np.bincount(at[block.trained & (at >= 0)], minlength=len(keys)).astype(np.uint32)
                    bounds = np.searchsorted(part_of(keys, parts), np.arange(parts + 1))
                    spans = [(p, a, b) for p, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)) if b > a]
                    yield pd.DataFrame(
                        {
                            "part": [p for p, _, _ in spans],
                            "block": block.id,
                            "kind": kind,
                            "size": [b - a for _, a, b in spans],
                            "keys": [packed_keys(keys[a:b]) for _, a, b in spans],
                            "counts": [packed(counts[a:b]) for _, a, b in spans],
                        }
                    )

    return ask


def answer(asked: pd.DataFrame) -> pd.DataFrame:
    """Adds up the counts of one range and answers each block; totals go with the words' answers."""
    rows = []
    for kind, own in asked.groupby("kind"):
        keys = [unpacked_keys(k, n) for k, n in zip(own["keys"], own["size"], strict=True)]
        counts = [unpacked(c, n, np.uint32) for c, n in zip(own["counts"], own["size"], strict=True)]
        known, at = np.unique(np.concatenate(keys), return_inverse=True)
        summed = np.bincount(at, np.concatenate(counts), len(known)).astype(np.int64)
        total, types = int(summed.sum()), int((summed > 0).sum())
        found = np.split(summed[at], np.cumsum([len(k) for k in keys])[:-1])
        for (part, block, size), values in zip(
            own[["part", "block", "size"]].itertuples(index=False), found, strict=True
        ):
            rows.append((part, block, kind, size, packed(values.astype(np.uint64)), total, types))
    return pd.DataFrame(rows, columns=["part", "block", "kind", "size", "counts", "total", "types"])


class Automaton:
    """The arcs that a block's texts can take, one array over the tokens for each length.

    ``ends[n]`` holds the training count of the n-gram that ends at each token, and so
    ``contexts[n]`` that of the n words before it, 0 where there are not as many.
    """

    def __init__(self, ends: dict[int, np.ndarray], starts: np.ndarray, texts: int, total: int, types: int):
        self.order = max(ends)
        self.ends = ends
        self.contexts = {}
        for n in range(1, self.order):
            self.contexts[n] = np.roll(ends[n], 1)
            self.contexts[n][starts] = texts if n == 1 else 0
        self.root = np.log10((ends[1] + ADDED) / (total + ADDED * (types + 1)))
        self.starts = starts

    def arcs(self) -> list[np.ndarray]:
        """Weight of the arc over each token from the state of the 0, 1, ... words before it."""
        weights = [self.root]
        for n, uses in self.contexts.items():
            smoothed = (self.ends[n + 1] + PRIOR_WEIGHT * 10 ** weights[-1]) / (uses + PRIOR_WEIGHT)
            weights.append(np.log10(smoothed))
        return weights

    def states(self) -> np.ndarray:
        """Words in the state that each token is read from.

        Whatever arcs led to it, it is the longest context known: a context's own ends are
        contexts too, so none is known behind an unknown one.
        """
        return sum((uses > 0).astype(np.int64) for uses in self.contexts.values()) + np.zeros(len(self.root), np.int64)

    def steps(self) -> np.ndarray:
        """Weight of each step: failure arcs are followed until a state has the arc."""
        state, weights = self.states(), self.arcs()
        passed = np.zeros(len(state))
        for n in range(self.order - 1, 0, -1):
            here = state == n
            taken = here & (self.ends[n + 1] > 0)
            passed[taken] += weights[n][taken]
            state[taken] = -1
            fails = here & ~taken
            passed[fails] += np.log10(PRIOR_WEIGHT / (self.contexts[n][fails] + PRIOR_WEIGHT))
            state[fails] = n - 1
        left = state == 0
        passed[left] += weights[0][left]
        return passed

    def read(self) -> np.ndarray:
        """Log-probability of every text of the block."""
        return np.add.reduceat(self.steps(), self.starts)


def scorer(total: int, types: int, texts: int, order: int):
    def score(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        block = Block(blocks.iloc[0])
        ends = {}
        for kind, _, at in block.grams(order):
            own = answers[answers["kind"] == kind].sort_values("part")
            values = [unpacked(c, n, np.uint64) for c, n in zip(own["counts"], own["size"], strict=True)]
            counts = np.concatenate([*values, np.zeros(1, np.uint64)]).astype(np.int64)
            ends[kind] = counts[at]  # the last one stands for n-grams that are not there
        automaton = Automaton(ends, block.starts, texts, total, types)
        return pd.DataFrame(
            {
                "doc_id": pd.array(block.doc_ids, "Int64"),
                "held_out": block.held_out,
                "n_tokens": block.lengths,
                "n_known": np.add.reduceat((ends[WORDS] > 0).astype(np.int64), block.starts),
                "train_tokens": total,
                "base_score": np.add.reduceat(automaton.root, block.starts),
                "score": automaton.read(),
            }
        )

    return score


def score_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER
) -> DataFrame:
    """Scores of every row under a model of the rows that are not held out, of n-grams up to an order.

    Words are lower-cased in A-Z and followed by one end token; a null text counts as
    empty and has the end token only. Rows whose crc32(doc_id as text) mod 10 is 0 are
    held out; a missing doc_id counts as empty text there. Repeated rows count
    repeatedly. Without training rows every token is unknown. Other columns are ignored.
    """
    key = docs[id_col].cast("long")
    rows = docs.select(
        key.alias("doc_id"),
        (crc_remainder(docs[id_col], FOLDS) == 0).alias("held_out"),
        docs[text_col].alias("text"),
    )
    blocks = materialize(rows.mapInArrow(blocks_of, BLOCK), "blocks")
    trained = F.size(F.filter("held_out", lambda out: ~out))
    tokens, texts = blocks.agg(F.sum("tokens"), F.sum(trained)).first()
    parts = max(1, -(-(tokens or 0) // RANGE_TOKENS))
    asked = blocks.mapInPandas(requests(parts, order), REQUEST)
    answers = materialize(asked.groupBy("part").applyInPandas(answer, ANSWER), "answers")
    sums = answers.where(F.col("kind") == WORDS).groupBy("part").agg(
        F.max("total").alias("total"), F.max("types").alias("types")
    )
    total, types = sums.agg(F.sum("total"), F.sum("types")).first()
    return (
        blocks.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInPandas(scorer(total or 0, types or 0, texts or 0, order), SCORED)
    )
