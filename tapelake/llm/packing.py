"""Packing of tokenised documents into sequences: Martello-Toth reduction, then best fit.

How well sequences fill depends on the pieces' lengths alone, and there are at most
``capacity`` of them. So the plan is made from the number of pieces of each length:
first the reduction fixes small sets of pieces that dominate every other way to
fill a sequence around their largest piece, then best fit by falling length takes
what is left. The plan is a short list of runs ("pieces 0 to 9,999 of length 700 go
to sequences 40,000 to 49,999 at offset 0"), of bounded size whatever the corpus.
Pieces are numbered within their length side by side and look their run up.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapelake.llm.columns import inputs, slices, strings
from tapelake.workspace import materialize

CAPACITY = 1024
END_ID = 2
ID_BYTES = 4
CACHED_WORDS = 200_000
ROWS_PER_SALT = 200_000
VOCABULARY = "byte_bpe_50k.tiktoken"
SPECIAL_TOKENS = {"<|endoftext|>": 50256}

PIECE_COLUMNS = ["doc_id", "piece", "start", "length", "ids"]
PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
PIECES = "doc_id long, piece int, start long, length long, ids binary"


class WordIds(dict):
    """Token ids, as bytes, of a word with the space before it."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL_TOKENS
        )

    def encode(self, text: str) -> bytes:
        return np.array(self.encoding.encode(text, allowed_special="all"), "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(f" {word}")
        if len(self) < CACHED_WORDS:
            self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        """The ids of a text. No token crosses a space that something other than space follows."""
        words = re.split(r" (?=\S)", text)
        return self.encode(words[0]) + b"".join(map(self.__getitem__, words[1:]))


@cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def cut(length: int, capacity: int) -> list[int]:
    """Bounds of the pieces: all of full length but the first, which takes the rest."""
    first = (length - 1) % capacity + 1
    return [0, *range(first, length + 1, capacity)]


def pieces(
    docs: DataFrame,
    capacity: int = CAPACITY,
    vocabulary: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Tokenised pieces (doc_id, piece, start, length, ids) with ids as little-endian 32-bit numbers.

    Every document ends with END_ID, so an empty or null text is one piece of one
    token. Repeated rows give repeated pieces, a missing doc_id stays missing, and
    other columns are ignored.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(path)
        end = END_ID.to_bytes(ID_BYTES, "little")
        for batch in batches:
            for part in slices(batch):
                rows = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), strings(part.column("text")), strict=True):
                    ids = encoder.ids(text) + end
                    for piece, (a, b) in enumerate(pairwise(cut(len(ids) // ID_BYTES, capacity))):
                        rows.append((doc_id, piece, a, b - a, ids[a * ID_BYTES : b * ID_BYTES]))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), PIECE_TYPES, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=PIECE_COLUMNS)

    rows = inputs(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(tokenise, PIECES)


class Plan:
    """Runs of pieces: which sequences and offsets the pieces of each length take."""

    def __init__(self, lengths: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = dict(sorted((length, n) for length, n in lengths.items() if n))
        self.used = dict.fromkeys(self.left, 0)
        self.runs: list[tuple[int, int, int, int, int, int]] = []
        self.sequences = 0
        self._reduce()
        self._best_fit()

    def _take(self, length: int, count: int, first_sequence: int, each: int, offset: int) -> None:
        """``count`` pieces of a length, ``each`` to a sequence, from a sequence and offset on."""
        self.runs.append((length, self.used[length], count, first_sequence, each, offset))
        self.used[length] += count
        self.left[length] -= count
        if not self.left[length]:
            del self.left[length]

    def _fix(self, times: int, chosen: tuple[int, ...]) -> None:
        """The chosen lengths, falling, fill ``times`` new sequences."""
        offset = 0
        for length in dict.fromkeys(chosen):
            each = chosen.count(length)
            self._take(length, times * each, self.sequences, each, offset)
            offset += length * each
        self.sequences += times

    def _reduce(self) -> None:
        """Fix dominant sets around each length, from the longest down."""
        for length in sorted(self.left, reverse=True):
            while length in self.left and (chosen := self._dominant(length)):
                times = min(self.left[x] // chosen.count(x) for x in set(chosen))
                self._fix(times, chosen)

    def _dominant(self, length: int) -> tuple[int, ...] | None:
        """A set around a piece of this length that dominates every other, or None.

        A set dominates another if the other's pieces fit, several to one, into its
        pieces. With nothing beside it, the piece stays alone. A partner that fills
        the sequence can stand for any set. If two more never fit, the longest that
        fits does; if three more never fit, so does the longest one if no two are
        longer together, or else the longest one with the longest that still fits
        beside it, unless some pair has a longer second piece.
        """
        room = self.capacity - length
        small = self._smallest(length, 3)
        fits = [x for x in self.left if x <= room and (x != length or self.left[x] > 1)]
        if not fits:
            return (length,)
        longest = fits[-1]
        if longest == room or len(small) < 2 or small[0] + small[1] > room:
            return tuple(sorted((length, longest), reverse=True))
        if len(small) > 2 and sum(small) <= room:
            return None
        best_sum, second = self._pairs(length, room)
        if best_sum <= longest:
            return tuple(sorted((length, longest), reverse=True))
        beside = [x for x in fits if x <= room - longest and self._spare(x, (length, longest)) > 0]
        if beside and second <= beside[-1]:
            return tuple(sorted((length, longest, beside[-1]), reverse=True))
        return None

    def _spare(self, length: int, used: tuple[int, ...]) -> int:
        return self.left.get(length, 0) - used.count(length)

    def _smallest(self, without: int, most: int) -> list[int]:
        """The smallest pieces left beside one of length ``without``."""
        found: list[int] = []
        for x in self.left:
            found += [x] * min(most, self._spare(x, (without,)))
            if len(found) >= most:
                break
        return found[:most]

    def _pairs(self, length: int, room: int) -> tuple[int, int]:
        """The longest sum, and the longest second piece, of two pieces that fit into the room."""
        sizes = [x for x in self.left if self._spare(x, (length,)) > 0]
        best = second = 0
        for small in sizes:
            if 2 * small > room:
                break
            at = bisect_left(sizes, room - small + 1) - 1
            if sizes[at] == small and self._spare(small, (length,)) < 2:
                at -= 1
            if at >= 0 and sizes[at] >= small:
                best, second = max(best, small + sizes[at]), max(second, small)
        return best, second

    def _best_fit(self) -> None:
        """Longest first, each piece to the fullest sequence that has room for it."""
        opened: dict[int, list[tuple[int, int]]] = {}
        for length in sorted(self.left, reverse=True):
            while count := self.left.get(length, 0):
                room = min((r for r in opened if r >= length), default=None)
                if room is None:
                    room = self.capacity
                    wanted = -(-count // (room // length))
                    opened[room] = [(self.sequences, wanted)]
                    self.sequences += wanted
                first, bins = opened[room].pop()
                each = min(room // length, count)
                filled = min(bins, count // each)
                self._take(length, filled * each, first, each, self.capacity - room)
                opened.setdefault(room - each * length, []).append((first, filled))
                if bins > filled:
                    opened[room].append((first + filled, bins - filled))
                if not opened[room]:
                    del opened[room]

    def arrays(self) -> list[np.ndarray]:
        """Columns length, first, count, first sequence, each, offset, ordered by length and first."""
        table = np.array(sorted(self.runs), np.int64).reshape(-1, 6)
        return list(table.T)


def locate(runs: list[np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of the pieces with these lengths and numbers within the length."""
    sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
    for size in np.unique(length):
        own = slice(*np.searchsorted(runs[0], [size, size + 1]))
        first, to, each, at = runs[1][own], runs[3][own], runs[4][own], runs[5][own]
        here = length == size
        run = np.searchsorted(first, rank[here], "right") - 1
        within = rank[here] - first[run]
        sequence[here] = to[run] + within // each[run]
        offset[here] = at[run] + within % each[run] * size
    return sequence, offset


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` (doc_id, piece, start, length and whatever else) with sequence_id and offset.

    ``rows`` must be a table that reads alike each time. Lengths lie between 1 and
    ``capacity``. Equal rows are told apart only by the place they get.
    """
    number = max(1, -(-rows.count() // ROWS_PER_SALT))
    salt = F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(number))
    salted = rows.withColumn("salt", salt)
    counts = materialize(salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")), "lengths")
    lengths = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = Plan(lengths, capacity).arrays()
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "salt").orderBy(*rows.columns)
    ranked = salted.withColumn("rank", F.row_number().over(order)).join(base, ["length", "salt"])
    placed = ranked.withColumn("rank", F.col("rank") - 1 + F.col("base")).drop("salt", "base")
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema)}, sequence_id long, offset long"

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence, offset = locate(runs, batch["length"].to_numpy(), batch["rank"].to_numpy())
            yield batch.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    return placed.select(*rows.columns, "rank").mapInPandas(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: (sequence_id, length, doc_ids, ids) from packed pieces with their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return (
        packed.groupBy("sequence_id")
        .agg(parts.alias("parts"), F.sum("length").alias("length"))
        .select(
            "sequence_id",
            "length",
            F.col("parts.doc_id").alias("doc_ids"),
            F.aggregate("parts.ids", F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"),
        )
    )


def packed_digests(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Place of every piece, with the CRC-32 of its ids instead of the ids."""
    thin = pieces(docs, capacity).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return pack(materialize(thin, "pieces"), capacity)
