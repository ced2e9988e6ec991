"""Ranked lexical search by a hybrid of term-at-a-time and document-at-a-time.

The texts are indexed block by block: each block of whole documents has its own
inverted lists, packed, with the largest count of a term and the shortest document of
each list, which bound what the list can add to a score. Counts over all blocks give
the weights of the terms.

The queries come in batches of bounded size, and each batch is searched for in every
block. For a query and a block, the short lists are read whole and summed into
accumulators. From there on these are one more iterator, bounded by their largest sum,
beside the long lists. Iterators whose bounds together cannot lift a document over the
k-th best score so far drive nothing: their documents are passed over, and they are
only asked, by binary search, for documents that the others bring up and that can
still get over that score. Documents are taken in windows of rising position, and the
k-th best score rises from window to window and from block to block of a task.

A score sums w * ((SCALE * tf) div (1000 * tf + 12 * m)) over the terms of the query,
repeats included; w = floor(1000 ln((2 N + 2) / (2 df + 1))), m = 75 + (25 n N) div L,
in 64-bit integers. N counts the documents with a term, L all their terms, n those of
one document, df the documents that hold a term, tf its occurrences in one.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapelake.llm.columns import inputs, utf8
from tapelake.llm.language_model import packed, unpacked
from tapelake.workspace import materialize

TOP = 20
BLOCK_TERMS = 2_000_000
BATCH_QUERIES = 1_000
BATCH_BYTES = 8_000_000
SCALE = 1_000_000_000
SHORT_SHARE = 16  # a list is short that holds less than one of so many documents of a block
WINDOW = 1_024
NO_ID = np.iinfo(np.int64).max  # a missing id comes last among equal scores

# The ASCII characters that are part of a term; beyond ASCII all are.
TERM_BYTES = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
TO_TERMS = bytes(b if b in TERM_BYTES or b > 127 else 32 for b in range(256)).lower()

BLOCK = "docs long, terms long, size long, ids binary, sizes binary, vocabulary array<binary>, held array<long>, places binary, counts binary, most binary, least binary"
FOUND = "query long, doc_id long, score long"

Query = list[tuple[bytes, int]]  # term, weight times its repeats


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TO_TERMS).split()


class Numbers(dict):
    """Numbers of terms in order of first appearance."""

    def __missing__(self, term: bytes) -> int:
        number = self[term] = len(self)
        return number


def index_block(doc_ids: list, texts: list[np.ndarray], vocabulary: Numbers) -> pa.RecordBatch:
    """Inverted lists of some documents: by term, rising places of documents with their counts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    place = np.repeat(np.arange(len(texts)), sizes)
    pairs, counts = np.unique(np.concatenate(texts).astype(np.int64) * len(texts) + place, return_counts=True)
    term, place = np.divmod(pairs, len(texts))
    starts = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.empty(0, np.int64)
    held = np.diff(np.append(starts, len(term)))
    most = np.maximum.reduceat(counts, starts) if len(term) else counts
    least = np.minimum.reduceat(sizes[place], starts) if len(term) else counts
    ids = np.array([NO_ID if i is None else i for i in doc_ids], np.int64)
    row = {
        "docs": (int((sizes > 0).sum()), pa.int64()),
        "terms": (int(sizes.sum()), pa.int64()),
        "size": (len(ids), pa.int64()),
        "ids": (packed(ids), pa.binary()),
        "sizes": (packed(sizes.astype(np.uint32)), pa.binary()),
        "vocabulary": (list(vocabulary), pa.list_(pa.binary())),
        "held": (held.tolist(), pa.list_(pa.int64())),
        "places": (packed(place.astype(np.uint32)), pa.binary()),
        "counts": (packed(counts.astype(np.uint32)), pa.binary()),
        "most": (packed(most.astype(np.uint32)), pa.binary()),
        "least": (packed(least.astype(np.uint32)), pa.binary()),
    }
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in row.values()], names=list(row))


def index_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of about BLOCK_TERMS terms; documents stay whole."""
    vocabulary, ids, texts, held = Numbers(), [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text")), strict=True):
            words = terms_of(text)
            ids.append(doc_id)
            texts.append(np.fromiter(map(vocabulary.__getitem__, words), np.uint32, len(words)))
            held += len(words) + 1
            if held >= BLOCK_TERMS:
                yield index_block(ids, texts, vocabulary)
                vocabulary, ids, texts, held = Numbers(), [], [], 0
    if ids:
        yield index_block(ids, texts, vocabulary)


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of a table, written to the shared folder, a row for each block."""
    rows = inputs(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return materialize(rows.mapInArrow(index_blocks, BLOCK), "lexical-index")


class Lists:
    """The inverted lists of one block."""

    def __init__(self, row: dict, n: int, total: int):
        held = np.array(row["held"], np.int64)
        docs = row["size"]
        self.ids = unpacked(row["ids"], docs, np.int64)
        sizes = unpacked(row["sizes"], docs, np.uint32).astype(np.int64)
        self.penalty = 12 * (75 + 25 * sizes * n // max(1, total))
        postings = int(held.sum())
        self.places = unpacked(row["places"], postings, np.uint32).astype(np.int64)
        self.counts = unpacked(row["counts"], postings, np.uint32).astype(np.int64)
        self.ends = np.cumsum(held)
        self.starts = self.ends - held
        most = unpacked(row["most"], len(held), np.uint32).astype(np.int64)
        least = unpacked(row["least"], len(held), np.uint32).astype(np.int64)
        self.bounds = SCALE * most // (1000 * most + 12 * (75 + 25 * least * n // max(1, total)))
        self.number = {term: i for i, term in enumerate(row["vocabulary"])}

    def impact(self, weight: int, at: np.ndarray | slice) -> np.ndarray:
        """What postings add to the scores of their documents."""
        tf = self.counts[at]
        return weight * (SCALE * tf // (1000 * tf + self.penalty[self.places[at]]))


class Best:
    """The k best (score, doc_id) of a query so far; equal scores by smaller id."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def least(self) -> int:
        """Scores below this one are of no use."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.append(self.scores, scores), np.append(self.ids, ids)
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def search(lists: Lists, query: Query, best: Best) -> None:
    """Add the documents of a block to the best ones of a query."""
    terms = [(lists.number[term], weight) for term, weight in query if weight and term in lists.number]
    if not terms:
        return
    docs = len(lists.ids)
    bounds = [weight * int(lists.bounds[t]) for t, weight in terms]
    if sum(bounds) < best.least:
        return
    held = [int(lists.ends[t] - lists.starts[t]) for t, _ in terms]
    short = [i for i, n in enumerate(held) if n * SHORT_SHARE <= docs]
    # Term at a time: the short lists become one iterator.
    sums = np.zeros(docs, np.int64)
    for i in short:
        t, weight = terms[i]
        at = slice(lists.starts[t], lists.ends[t])
        sums[lists.places[at]] += lists.impact(weight, at)
    reached = np.flatnonzero(sums)
    iterators = [(int(sums[reached].max()) if len(reached) else 0, None, 0)]
    iterators += [(bounds[i], *terms[i]) for i in set(range(len(terms))) - set(short)]
    iterators.sort(key=lambda x: (x[0], x[1] is not None))
    upto = np.cumsum([bound for bound, _, _ in iterators])  # of an iterator and all with smaller bounds
    start = 0
    while start < docs:
        driving = int(np.searchsorted(upto, best.least))
        if driving == len(iterators):
            return
        # Document at a time: what the driving iterators hold in the next window.
        stop, passed = min(docs, start + WINDOW), int(upto[driving - 1]) if driving else 0
        brought = []
        for bound, t, weight in iterators[driving:]:
            if t is None:
                a, b = np.searchsorted(reached, (start, stop))
                inside = reached[a:b]
                if driving == len(iterators) - 1:  # alone: skip to sums that can still get there
                    inside = inside[sums[inside] + passed >= best.least]
            else:
                a, b = lists.starts[t] + np.searchsorted(
                    lists.places[lists.starts[t] : lists.ends[t]], (start, stop)
                )
                inside = lists.places[a:b]
            brought.append(inside)
        places = brought[0] if len(brought) == 1 else np.unique(np.concatenate(brought))
        scores = np.zeros(len(places), np.int64)
        for i in range(len(iterators) - 1, -1, -1):
            bound, t, weight = iterators[i]
            possible = scores + int(upto[i]) >= best.least
            if not possible.all():
                places, scores = places[possible], scores[possible]
            if not len(places):
                break
            if t is None:
                scores = scores + sums[places]
                continue
            a, b = int(lists.starts[t]), int(lists.ends[t])
            at = a + np.searchsorted(lists.places[a:b], places)
            there = at < b
            there[there] = lists.places[at[there]] == places[there]
            scores[there] += lists.impact(weight, at[there])
        good = scores >= best.least
        if good.any():
            best.add(scores[good], lists.ids[places[good]])
        start = stop


def searcher(queries, k: int, n: int, total: int):
    """The k best documents of a task's blocks for every query of a batch."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries.value]
        for batch in batches:
            for at in range(len(batch)):
                lists = Lists(batch.slice(at, 1).to_pylist()[0], n, total)
                for found, (_, query) in zip(best, queries.value, strict=True):
                    search(lists, query, found)
        rows = [(q, found) for (q, _), found in zip(queries.value, best, strict=True) if len(found.ids)]
        if rows:
            ids = np.concatenate([found.ids for _, found in rows])
            arrays = [
                pa.array(np.repeat([q for q, _ in rows], [len(found.ids) for _, found in rows]), pa.int64()),
                pa.array(ids, pa.int64(), mask=ids == NO_ID),
                pa.array(np.concatenate([found.scores for _, found in rows]), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["query", "doc_id", "score"])

    return read


def batches_of(queries: Iterator[tuple[int, bytes]]) -> Iterator[list[tuple[int, Counter]]]:
    """Queries as counted terms, a bounded number and size at a time."""
    batch, size = [], 0
    for number, text in queries:
        batch.append((number, Counter(terms_of(text))))
        size += len(text)
        if len(batch) == BATCH_QUERIES or size >= BATCH_BYTES:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


def held_by(blocks: DataFrame, terms: set[bytes]) -> dict[bytes, int]:
    """Documents that hold each of a batch's terms."""
    spark = blocks.sparkSession
    wanted = spark.createDataFrame([(bytearray(t),) for t in sorted(terms)], "term binary")
    each = blocks.select(F.explode(F.arrays_zip("vocabulary", "held")).alias("it"))
    each = each.select(F.col("it.vocabulary").alias("term"), F.col("it.held").alias("held"))
    found = each.join(F.broadcast(wanted), "term").groupBy("term").agg(F.sum("held").alias("df"))
    return {bytes(term): df for term, df in found.collect()}  # at most the terms of a batch


def weights(counted: Counter, held: dict[bytes, int], n: int) -> Query:
    """Terms that some document holds, with floor(1000 ln((2 N + 2) / (2 df + 1))) times their repeats."""
    return [
        (term, repeats * math.floor(1000 * math.log((2 * n + 2) / (2 * held[term] + 1))))
        for term, repeats in counted.items()
        if term in held
    ]


def best_documents(
    blocks: DataFrame,
    queries: DataFrame,
    k: int = TOP,
    id_col: str = "item_id",
    text_col: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of an index for each row of ``queries``.

    Ranks count from 1, equal scores by ascending doc_id, rows without one last; a
    document scores only above 0. Queries without a known term, null texts among them,
    give no rows, and so does an empty index. A query row that is repeated gives its
    rows again. Other columns are ignored.
    """
    spark = blocks.sparkSession
    n, total = (x or 0 for x in blocks.agg(F.sum("docs"), F.sum("terms")).first())
    asked = inputs(queries, item_id=id_col, text=text_col)
    asked = materialize(asked.withColumn("query", F.monotonically_increasing_id()), "queries")
    found = spark.createDataFrame([], FOUND)
    texts = ((q, (text or "").encode()) for q, text in asked.select("query", "text").toLocalIterator())
    for batch in batches_of(texts):
        held = held_by(blocks, {term for _, counted in batch for term in counted})
        weighed = [(q, weights(counted, held, n)) for q, counted in batch]
        weighed = spark.sparkContext.broadcast([(q, query) for q, query in weighed if query])
        found = found.union(blocks.mapInArrow(searcher(weighed, k, n, total), FOUND))
    ordered = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = found.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= k)
    return top.join(asked.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
