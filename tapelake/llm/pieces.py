"""SentencePiece encoding with the N best segmentations, and decoding.

A text is a lattice: an edge for every piece of the model that matches somewhere,
and a byte edge for a character that no piece covers. The best segmentation is
Viterbi's. For the others, the forward Viterbi scores are the exact cost still to
come, so a backward A* search pops complete segmentations in order of score.

No piece runs on over the start of a word, so the lattice of a text is a chain of
word lattices. A word whose second-best segmentation loses more than those of N - 1
other words plays no part in the N best, so only N - 1 words of a text are searched;
the others are looked up. Alternatives are given as edits of the best ids.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator, Sequence
from functools import cache
from math import inf
from struct import pack

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.columns import ROWS_AT_ONCE, inputs, utf8

MODEL = "piece_bpe_32k.model"
N_BEST = 4
SPACE = "▁"
WORDS = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+")
PREFIX, BYTES = (), -1
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 400_000
CACHED_LENGTH = 48
NEVER = -1e8  # pieces of spaces score far below this; they cost as much as an unknown character

EDIT = "struct<start:int,length:int,ids:array<int>>"

Word = tuple[bytes, float, float]  # ids, score, what the second best loses


class Lattice:
    """Segmentations of words under one model."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        special = (model.is_byte, model.is_control, model.is_unknown, model.is_unused)
        usable = [i for i in range(len(self.names)) if not any(kind(i) for kind in special)]
        scores = {i: model.get_score(i) for i in usable}
        self.unknown = min(s for s in scores.values() if s > NEVER) - UNKNOWN_PENALTY
        self.pieces = {self.names[i]: (s if s > NEVER else self.unknown, i) for i, s in scores.items()}
        # One look-up tells a piece, the beginning of one, and neither.
        self.known = {piece[:n]: PREFIX for piece in self.pieces for n in range(1, len(piece))} | self.pieces
        self.bytes = {b: model.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
        self.spelled = [name.encode() for name in self.names]
        for byte, i in self.bytes.items():
            self.spelled[i] = bytes([byte])
        across = re.compile(f"[^{SPACE}]{SPACE}|\n")
        self.split = not any(across.search(piece) for piece in self.pieces)
        # Marks that no piece holds behind a letter: there a word can be cut.
        tied = {piece[i + 1] for piece in self.pieces for i in range(len(piece) - 1) if piece[i].isalpha()}
        self.marks = {mark for mark in ".,;:!?" if mark not in tied}
        self.cached = Segmented(self)

    def edges(self, word: str) -> list[tuple[int, int, float, int]]:
        """(from, to, score, piece) by start; piece BYTES stands for a character's bytes."""
        found, known, n = [], self.known, len(word)
        for a in range(n):
            if word[a] not in self.pieces:
                found.append((a, a + 1, self.unknown, BYTES))
            for b in range(a + 1, n + 1):
                piece = known.get(word[a:b])
                if piece is None:
                    break
                if piece:
                    found.append((a, b, *piece))
        return found

    def forward(self, word: str, edges: list) -> list[float]:
        """Best score of every beginning of the word."""
        best = [0.0] + [-inf] * len(word)
        for a, b, score, _ in edges:
            best[b] = max(best[b], best[a] + score)
        return best

    def ids(self, word: str, path: list) -> list[int]:
        out = []
        for a, b, _, piece in path:
            if piece >= 0:
                out.append(piece)
            else:
                out += [self.bytes[x] for x in word[a:b].encode()]
        return out

    def best(self, word: str) -> Word:
        """The best segmentation, and how much the second best loses.

        One forward pass with the two best scores of every beginning of the word.
        """
        n, known, unknown = len(word), self.known, self.unknown
        first, second = [0.0] + [-inf] * n, [-inf] * (n + 1)
        last: list = [None] * (n + 1)
        for a in range(n):
            high, low = first[a], second[a]
            b = a + 1
            piece = known.get(word[a:b])
            if not piece:
                score = high + unknown
                if score > first[b]:
                    second[b] = max(first[b], low + unknown)
                    first[b], last[b] = score, (a, b, unknown, BYTES)
                elif score > second[b]:
                    second[b] = score
            while piece is not None:
                if piece:
                    more, number = piece
                    score = high + more
                    if score > first[b]:
                        other = low + more
                        second[b] = other if other > first[b] else first[b]
                        first[b] = score
                        last[b] = (a, b, more, number)
                    elif score > second[b]:
                        second[b] = score
                b += 1
                if b > n:
                    break
                piece = known.get(word[a:b])
        path, at = [], n
        while at:
            path.append(last[at])
            at = last[at][0]
        ids = self.ids(word, path[::-1])
        return pack(f"<{len(ids)}I", *ids), first[n], first[n] - second[n]

    def search(self, word: str, most: int) -> Iterator[tuple[float, list[int]]]:
        """Segmentations from the best down, by A* from the end of the word to its start.

        The ``most`` best go through a place with one of its ``most`` best endings, so a
        place is taken that often and no more: a run of equal letters has thousands of
        segmentations that score alike. Among equal scores the one nearest the start goes first.
        """
        edges = self.edges(word)
        before = self.forward(word, edges)
        ending: list[list] = [[] for _ in range(len(word) + 1)]
        for edge in edges:
            ending[edge[1]].append(edge)
        taken = [0] * (len(word) + 1)
        queue, number = [(-before[-1], len(word), 0, 0.0, None)], 0
        while queue and taken[0] < most:
            cost, at, _, behind, path = heapq.heappop(queue)
            if taken[at] == most:
                continue
            taken[at] += 1
            if not at:
                steps = []
                while path:
                    steps.append(path[0])
                    path = path[1]
                yield -cost, self.ids(word, steps)
                continue
            for edge in ending[at]:
                number += 1
                score = behind + edge[2]
                heapq.heappush(queue, (-(score + before[edge[0]]), edge[0], number, score, (edge, path)))

    def words(self, text: str) -> tuple[Sequence[str], list[Word]]:
        """The text in the model's alphabet, cut where no piece runs on, and what is known of each word."""
        if not text:
            return [], []
        if self.split and text[0] != " " and "  " not in text and SPACE not in text:
            words = text.split(" ")
            return Spaced(words), list(map(self.cached.__getitem__, words))
        plain = SPACE + text.replace(" ", SPACE)
        words = WORDS.findall(plain) if self.split else [plain]
        return words, list(map(self.best, words))

    def encode(self, text: str, n: int) -> tuple[bytes, float, list[tuple[float, list]]]:
        """Best ids, their score, and the next n - 1 segmentations as (score, edits)."""
        words, found = self.words(text)
        parts, score = [w[0] for w in found], sum([w[1] for w in found])
        losses = np.array([w[2] for w in found])
        varied = np.argsort(losses) if len(losses) < n else np.argpartition(losses, n - 1)[: n - 1]
        varied = [i for i in varied.tolist() if losses[i] < inf]
        combined: list[tuple[float, list]] = [(0.0, [])]
        for i in sorted(varied):
            start = sum(map(len, parts[:i])) // 4
            own = np.frombuffer(found[i][0], "<u4").tolist()
            others = [(found[i][1] - s, x) for s, x in self.search(words[i], n) if x != own][: n - 1]
            changed = [(loss, [(start, len(own), x)]) for loss, x in others]
            combined = heapq.nsmallest(n, [(a + b, c + d) for a, c in combined for b, d in [(0.0, []), *changed]])
        return b"".join(parts), score, [(score - loss, edits) for loss, edits in combined[1:]]

    def decode(self, ids: list[int]) -> str:
        """The text of a sequence of ids."""
        raw = b"".join(map(self.spelled.__getitem__, ids))
        return raw.decode(errors="replace").replace(SPACE, " ").removeprefix(" ")


class Spaced(list):
    """Words as they stand in a text; looked at one by one, each has the space before it."""

    def __getitem__(self, at: int) -> str:
        return SPACE + super().__getitem__(at)


class Segmented(dict):
    """Best segmentations of words with the space before them, by the word without it.

    Short words are kept, CACHED_WORDS of them. A mark at the end is a word of its own.
    """

    def __init__(self, lattice: Lattice):
        super().__init__()
        self.lattice = lattice
        self.tails = {mark: lattice.best(mark) for mark in lattice.marks}

    def __missing__(self, word: str) -> Word:
        tail = self.tails.get(word[-1:])
        if tail and word[-2:-1].isalpha():
            ids, score, loss = self[word[:-1]]
            return ids + tail[0], score + tail[1], min(loss, tail[2])
        found = self.lattice.best(SPACE + word)
        if len(word) <= CACHED_LENGTH and len(self) < CACHED_WORDS:
            self[word] = found
        return found


@cache
def lattice(path: str) -> Lattice:
    return Lattice(path)


def model_path(model: str | None) -> str:
    return model or public_tokenizers.path(MODEL)


def edited(ids: list[int], edits: list[tuple[int, int, list[int]]]) -> list[int]:
    """Ids of an alternative: the best ids with its edits, whose starts rise."""
    out, at = [], 0
    for start, length, other in edits:
        out += ids[at:start] + list(other)
        at = start + length
    return out + ids[at:]


def encode(
    docs: DataFrame,
    n: int = N_BEST,
    model: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, ids, score, alternatives) of every row.

    ``ids`` are little-endian 32-bit numbers; ``alternatives`` are up to n - 1 further
    segmentations, best first, as edits (start, length, ids) of them. A null or empty
    text has no ids, score 0 and no alternatives. Of segmentations that score alike any
    may come first, but the same each time. The model writes a space as ▁, so a text
    that holds this sign itself comes back from decoding with a space there. Repeated rows give repeated results; other
    columns are ignored.
    """
    path = model_path(model)

    def segment(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = lattice(path)
        for batch in (b.iloc[a : a + ROWS_AT_ONCE] for b in batches for a in range(0, len(b), ROWS_AT_ONCE)):
            rows = [model.encode(text or "", n) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "ids": [r[0] for r in rows],
                    "score": [float(r[1]) for r in rows],
                    "alternatives": [
                        [
                            {
                                "score": s,
                                "edits": [{"start": a, "length": k, "ids": x} for a, k, x in edits],
                            }
                            for s, edits in r[2]
                        ]
                        for r in rows
                    ],
                }
            )

    rows = inputs(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    alternatives = f"array<struct<score:double,edits:array<{EDIT}>>>"
    schema = f"doc_id long, ids binary, score double, alternatives {alternatives}"
    return rows.mapInPandas(segment, schema)


def decode_udf(model: str | None = None):
    """Column function: ids, as little-endian 32-bit numbers, to their text."""
    path = model_path(model)

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        known = lattice(path)
        return pa.array([known.decode(np.frombuffer(x, "<u4").tolist()) for x in utf8(ids)], pa.string())

    return decode
