"""N-gram Jaccard join by T-occurrence search.

A text is the set of its distinct word shingles, as 64-bit hashes. Two sets are linked
if 100 |A and B| >= percent |A or B|. A set of n shingles then shares at least
T = ceil(percent n / 100) of them with each partner, which is a T-occurrence problem
over inverted lists. It is solved as DivideSkip does: of the lists of a query the
longest are set aside, the short ones are merged on a heap that skips what cannot
reach the count that is left, and what does is looked up in the long lists by binary
search.

Which sets can meet follows from the same T: in any fixed order of all shingles, two
linked sets share k of their first n - T + k. The order is by a count sketch of
fixed size, rare shingles first, so shared passages come last. Shingles of this
prefix that only one set holds are dropped where they are counted, and then sets that
are left with fewer than k (that of the smallest partner they can have). Every other set
has one home, that of its remaining prefix shingles which most sets hold, so near
copies share few homes whatever the size of their group. For each shingle of its prefix
a set visits the homes that hold it (in one direction only), and there it is searched
for in the inverted lists of the sets at home. Homes of many sets are cut into tiles.

A tile keeps the links it finds as a forest and stops a search once everything left
is linked already, so a group of near copies never becomes all its pairs. Equal sets
are one set throughout: each task names a set once, whatever the number of its copies.

Two sets, or two shingles, of a corpus share a hash with a chance of about n^2 / 2^65.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from itertools import pairwise
from math import log2

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.columns import inputs, utf8
from tapelake.llm.components import components
from tapelake.llm.language_model import packed, unpacked
from tapelake.workspace import materialize

SHINGLE_WORDS = 5
PERCENT = 80
SKETCH_BITS = 22  # counters of the sketch: 2**22 numbers of 32 bits, whatever the corpus
SKETCH_CHUNK = 1 << 16
CROWDED_LIST = 100_000
TILE_SHINGLES = 2_000_000
HEAPED = 2_000  # more postings than this are merged as sorted runs at once
LONG_LISTS_COST = 0.01  # DivideSkip's mu: what a probe of a long list costs beside a merge step
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
TEXT_AT_ONCE = 1 << 20

SET = "doc_id long, rec long, n long, chunk int, counts binary"
POSTING = "token long, rec long, n long, salt long"
SHARED = "token long, rec long, n long"
FULL_SET = "rec long, tokens binary"


class WordHashes(dict):
    """Hashes of words, kept while a task has room for them."""

    ROOM = 100_000

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(self) < self.ROOM:
            self[word] = found
        return found


def rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words: a polynomial of their hashes."""
    n = len(hashes) - size + 1
    found = np.full(n, size, np.uint64)
    for at in range(size):
        found *= MULTIPLIER
        found += hashes[at : at + n]
    return found


def shingle_sets(texts: Iterator[bytes], size: int, known: WordHashes) -> Iterator[list[np.ndarray]]:
    """Sorted distinct hashes of the word shingles of each text, some texts at a time.

    A text of fewer words is one shingle, one without words has none.
    """
    words, ends, held = [], [0], 0
    for text in texts:
        words += text.lower().split()
        ends.append(len(words))
        held += len(text)
        if held >= TEXT_AT_ONCE:
            yield sets_of(words, ends, size, known)
            words, ends, held = [], [0], 0
    if len(ends) > 1:
        yield sets_of(words, ends, size, known)


def sets_of(words: list[bytes], ends: list[int], size: int, known: WordHashes) -> list[np.ndarray]:
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    runs = rolled(hashes, size) if len(hashes) >= size else hashes[:0]
    out = []
    for a, b in pairwise(ends):
        if b - a < size:
            out.append(rolled(hashes[a:b], b - a) if b > a else hashes[:0])
            continue
        own = runs[a : b - size + 1].copy()
        own.sort()
        new = np.empty(len(own), bool)
        new[0] = True
        np.not_equal(own[1:], own[:-1], out=new[1:])
        out.append(own[new])
    return out


def record_of(tokens: np.ndarray) -> int | None:
    """The name of a set: a hash of its shingles, as a signed number; none for the empty set."""
    if not len(tokens):
        return None
    return int(np.uint64(xxhash.xxh64_intdigest(tokens.tobytes())).astype(np.int64))


def needed(n, percent: int):
    """T: what a set of n shingles shares with any partner at least."""
    return -(-percent * n // 100)


def needed_column(n, percent: int):
    return F.ceil(n * percent / 100)


def certain(n):
    """Of the shingles that a set of n is dealt by, how many it shares with a partner as large or larger."""
    return n // 8 + 1


def cells(tokens: np.ndarray) -> np.ndarray:
    """Counter of each shingle."""
    return (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def sets_and_counts(size: int):
    """A row (doc_id, rec, n) of every text, and each task's counts of shingles, chunk by chunk."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = WordHashes(), np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            doc_ids, at = batch.column("doc_id"), 0
            for sets in shingle_sets(utf8(batch.column("text")), size, known):
                np.add.at(counts, cells(np.concatenate(sets)), 1)
                recs, none = [record_of(tokens) for tokens in sets], [None] * len(sets)
                yield rows(doc_ids.slice(at, len(sets)), recs, [len(tokens) for tokens in sets], none, none)
                at += len(sets)
        for chunk, part in enumerate(counts.reshape(-1, SKETCH_CHUNK)):
            if part.any():
                yield rows(pa.array([None], pa.int64()), [None], [None], [chunk], [packed(part)])

    def rows(doc_ids: pa.Array, *columns: list) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
        arrays = [doc_ids, *(pa.array(c, t) for c, t in zip(columns, types, strict=True))]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "rec", "n", "chunk", "counts"])

    return read


def add_chunks(parts: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(SKETCH_CHUNK, np.uint64)
    for part in parts["counts"]:
        total += unpacked(part, SKETCH_CHUNK, np.uint32)
    low = np.minimum(total, np.iinfo(np.uint32).max).astype(np.uint32)
    return pd.DataFrame({"chunk": parts["chunk"].iloc[:1], "counts": [packed(low)]})


def sketch(counted: DataFrame) -> np.ndarray:
    """The summed counters: an upper bound of how many texts hold a shingle. Its size is fixed."""
    two_steps = counted.where("chunk IS NOT NULL").select("chunk", "counts")
    for key in (("chunk", F.pmod(F.xxhash64("counts"), F.lit(16))), ("chunk",)):
        two_steps = two_steps.groupBy(*key).applyInPandas(add_chunks, "chunk int, counts binary")
    total = np.zeros(1 << SKETCH_BITS, np.uint32)
    for chunk, counts in two_steps.collect():  # 2**SKETCH_BITS numbers
        total[chunk * SKETCH_CHUNK : (chunk + 1) * SKETCH_CHUNK] = unpacked(counts, SKETCH_CHUNK, np.uint32)
    return total


def prefixes(size: int, percent: int, counts, crowded: int):
    """(token, rec, n, salt) for the first n - T + k shingles of every set that can have a partner.

    A task names a set once. The list of a shingle counted over ``crowded`` times is spread over salts from 1.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen, common = WordHashes(), set(), counts.value
        for batch in batches:
            for sets in shingle_sets(utf8(batch.column("text")), size, known):
                firsts, recs, sizes = [], [], []
                for tokens in sets:
                    n, rec = len(tokens), record_of(tokens)
                    # With 100 n < percent (n + 1) a set has no partner but its equals.
                    if 100 * n < percent * (n + 1) or rec in seen:
                        continue
                    seen.add(rec)
                    order = np.argsort(common[cells(tokens)], kind="stable")
                    firsts.append(tokens[order[: n - needed(n, percent) + certain(n)]])
                    recs.append(rec)
                    sizes.append(n)
                if recs:
                    yield postings(firsts, recs, sizes, common)

    def postings(firsts: list, recs: list, sizes: list, common: np.ndarray) -> pa.RecordBatch:
        lengths, token = [len(t) for t in firsts], np.concatenate(firsts)
        rec, n = (np.repeat(np.array(x, np.int64), lengths) for x in (recs, sizes))
        held = common[cells(token)].astype(np.uint64)
        salt = np.where(held > crowded, 1 + rec.view(np.uint64) % (held // np.uint64(crowded) + 1), 0)
        arrays = [pa.array(x) for x in (token.view(np.int64), rec, n, salt.astype(np.int64))]
        return pa.RecordBatch.from_arrays(arrays, names=["token", "rec", "n", "salt"])

    return read


def shared_only(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows sorted by token, salt and rec: those whose token several sets hold, each once.

    A salted list has more sets than one task should see, so its rows stay. A list may run
    over any number of batches: one row is held back until the next is known.
    """
    held, like_last = None, False
    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        token, rec = rows["token"].to_numpy(), rows["rec"].to_numpy()
        new = np.append(True, (token[1:] != token[:-1]) | (rec[1:] != rec[:-1]))
        rows, token = rows[new], token[new]
        same = token[1:] == token[:-1]
        before = np.append(like_last, same)
        shared = before | np.append(same, False) | (rows["salt"].to_numpy() > 0)
        yield rows[:-1][shared[:-1]][["token", "rec", "n"]]
        held, like_last = rows[-1:], bool(shared[-1])
    if held is not None and like_last:
        yield held[["token", "rec", "n"]]


def present(counts: np.ndarray, rec: int) -> bool:
    return bool(counts[(rec & 0xFFFFFFFFFFFFFFFF) >> (64 - SKETCH_BITS)])


def full_sets(size: int, wanted):
    """(rec, tokens) of the sets that may be wanted: a filter of fixed size, so more may come than are."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen, marks = WordHashes(), set(), wanted.value
        for batch in batches:
            for sets in shingle_sets(utf8(batch.column("text")), size, known):
                own = [(record_of(tokens), tokens) for tokens in sets]
                own = [(rec, tokens) for rec, tokens in own if rec is not None and present(marks, rec)]
                own = {rec: tokens.tobytes() for rec, tokens in own if rec not in seen}
                seen.update(own)
                arrays = [pa.array(list(own), pa.int64()), pa.array(list(own.values()), pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["rec", "tokens"])

    return read


def marks_of(recs: DataFrame) -> np.ndarray:
    """Which counters the named sets fall into, as a filter of fixed size."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            counts[cells(batch.column("rec").to_numpy().view(np.uint64))] = 1
        parts = [(i, packed(p)) for i, p in enumerate(counts.reshape(-1, SKETCH_CHUNK)) if p.any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in parts], pa.int32()), pa.array([p for _, p in parts], pa.binary())],
            names=["chunk", "counts"],
        )

    return sketch(recs.select("rec").mapInArrow(read, "chunk int, counts binary"))


NONE = np.empty(0, np.int64)


class Tile:
    """Inverted lists of the sets of one tile, and the links found so far.

    ``labels`` has the class of each set at home, ``visitors`` that of a set searched for.
    """

    def __init__(self, recs: list[int], sets: list[np.ndarray], percent: int):
        self.recs, self.percent = np.array(recs, np.int64), percent
        self.sizes = np.array([len(s) for s in sets])
        tokens = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), self.sizes)
        order = np.argsort(tokens, kind="stable")
        self.owners = owner[order]
        self.postings = memoryview(self.owners)
        tokens = tokens[order]
        starts = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
        self.tokens, self.bounds = tokens[starts], np.append(starts, len(tokens))
        self.labels = np.arange(len(sets))
        self.classes = len(sets)
        self.links: list[tuple[int, int]] = []

    def lists(self, tokens: np.ndarray) -> list[tuple[int, int]]:
        """(start, end) of the inverted list of each shingle that the tile knows."""
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        at = at[self.tokens[at] == tokens]
        return list(zip(self.bounds[at].tolist(), self.bounds[at + 1].tolist(), strict=True))

    def search(self, tokens: np.ndarray, label: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Sets of the tile that share T or more with a query, and how much; those of class ``label`` are passed by."""
        least = needed(len(tokens), self.percent)
        lists = sorted(self.lists(tokens), key=lambda x: x[1] - x[0])
        if len(lists) < least:
            return NONE, NONE
        longest = lists[-1][1] - lists[-1][0]
        aside = min(least - 1, int(least / (LONG_LISTS_COST * log2(longest + 1) + 1)))
        short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
        if sum(end - start for start, end in short) <= HEAPED:
            merged = np.array(list(self.merge(short, least - aside)), np.int64).reshape(-1, 2)
            found, counts = merged[:, 0], merged[:, 1]
        else:
            held = np.bincount(np.concatenate([self.owners[a:b] for a, b in short]), minlength=len(self.sizes))
            found = np.flatnonzero(held >= least - aside)
            counts = held[found]
        other = self.labels[found] != label
        found, counts = found[other], counts[other]
        for left, (start, end) in zip(range(aside, 0, -1), long, strict=True):
            possible = counts + left >= least
            if not possible.all():
                found, counts = found[possible], counts[possible]
            if not len(found):
                break
            own = self.owners[start:end]
            at = np.minimum(np.searchsorted(own, found), end - start - 1)
            counts = counts + (own[at] == found)
        enough = counts >= least
        return found[enough], counts[enough]

    def merge(self, lists: list[tuple[int, int]], least: int) -> Iterator[tuple[int, int]]:
        """(set, count) of the sets that stand in ``least`` lists or more, by a heap that skips."""
        postings = self.postings
        heads = [(postings[a], a, b) for a, b in lists]
        heapq.heapify(heads)
        while len(heads) >= least:
            top, popped = heads[0][0], []
            while heads and heads[0][0] == top:
                popped.append(heapq.heappop(heads))
            if len(popped) >= least:
                yield top, len(popped)
                target = top + 1
            else:
                # Sets before the next but (least - 1) head cannot reach the count.
                while heads and len(popped) < least - 1:
                    popped.append(heapq.heappop(heads))
                if not heads:
                    return
                target = max(heads[0][0], top + 1)
            for _, at, end in popped:
                at = bisect_left(postings, target, at, end)
                if at < end:
                    heapq.heappush(heads, (postings[at], at, end))

    def link(self, rec: int, tokens: np.ndarray, at: int | None = None) -> None:
        """Search the tile for a set, and keep those links that join two classes; ``at``: its place at home."""
        if at is not None and self.classes == 1:
            return
        found, overlap = self.search(tokens, -1 if at is None else self.labels[at])
        linked = found[100 * overlap >= self.percent * (len(tokens) + self.sizes[found] - overlap)]
        labels, first = np.unique(self.labels[linked], return_index=True)
        self.links += [(rec, int(other)) for other in self.recs[linked[first]]]
        joined = labels if at is None else np.append(labels, self.labels[at])
        if len(joined) > 1:
            self.labels[np.isin(self.labels, joined)] = joined.min()
            self.classes -= len(joined) - 1


def tile_links(percent: int):
    """Links of every tile. Rows come sorted by tile, those at home first; visitors are taken one by one."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, recs, sets, tile = None, [], [], None
        for batch in batches:
            found: list[tuple[int, int]] = []
            raw = batch.column("tokens")
            for i, (key, home, rec) in enumerate(
                zip(*(batch.column(c).to_pylist() for c in ("tile", "home", "rec")), strict=True)
            ):
                if key != name:
                    if tile is None and len(recs) > 1:
                        found += closed(recs, sets).links
                    elif tile is not None:
                        found += tile.links
                    name, recs, sets, tile = key, [], [], None
                tokens = np.frombuffer(raw[i].as_buffer(), "<u8")
                if home:
                    recs.append(rec)
                    sets.append(tokens.copy())
                elif recs:
                    tile = tile or closed(recs, sets)
                    tile.link(rec, tokens)
            if tile is not None:
                found += tile.links
                tile.links = []
            yield linked(found)
        if tile is None and len(recs) > 1:
            yield linked(closed(recs, sets).links)

    def linked(found: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"]
        )

    def closed(recs: list[int], sets: list[np.ndarray]) -> Tile:
        """The tile, searched for all its own sets."""
        tile = Tile(recs, sets, percent)
        for at, (rec, tokens) in enumerate(zip(recs, sets, strict=True)):
            tile.link(rec, tokens, at)
        return tile

    return read


def visits_of(postings: DataFrame, percent: int) -> DataFrame:
    """(home, rec, n, home_n): the homes at which each set is searched for, its own included."""
    least = needed_column(F.col("n"), percent)
    enough = postings.groupBy("rec").agg(F.count(F.lit(1)).alias("held"), F.first("n").alias("n"))
    enough = enough.where(F.col("held") >= F.floor(least / 8) + 1).select("rec")
    postings = materialize(postings.join(enough, "rec"), "postings")
    # The longest list of a set is one that most of its near copies are in as well.
    lengths = postings.groupBy("token").agg(F.count(F.lit(1)).alias("length"))
    longest = F.max_by("token", F.struct("length", F.xxhash64("token"))).alias("home")
    homes = postings.join(lengths.where("length > 1"), "token").groupBy("rec").agg(longest)
    placed = postings.join(homes, "rec")
    held = placed.groupBy("token", F.col("home").alias("other")).agg(
        F.min("n").alias("low"), F.max("n").alias("high")
    )
    # Of two homes that share a list the sets of the smaller one go to the larger one.
    near = (F.col("high") * 100 >= F.col("n") * percent) & (F.col("low") * percent <= F.col("n") * 100)
    met = placed.join(held, "token").where((F.col("other") >= F.col("home")) & near)
    return met.groupBy("rec", F.col("other").alias("home")).agg(
        F.first("n").alias("n"), F.bool_or(F.col("other") == F.col("home")).alias("at_home")
    )


def set_links(docs: DataFrame, size: int, percent: int, counts: np.ndarray) -> DataFrame:
    """Links (a, b) between sets, a forest from each tile, that connect all linked sets."""
    context = docs.sparkSession.sparkContext
    texts = docs.select("text")
    crowded = max(CROWDED_LIST, 4 * int(counts.mean()))
    dealt = texts.mapInArrow(prefixes(size, percent, context.broadcast(counts), crowded), POSTING)
    in_lists = dealt.repartition("token", "salt").sortWithinPartitions("token", "salt", "rec")
    shared = in_lists.mapInPandas(shared_only, SHARED)
    visits = materialize(visits_of(materialize(shared, "shared-shingles"), percent), "visits")
    at_home = F.when(F.col("at_home"), F.col("n"))
    tiles = visits.groupBy("home").agg(
        F.count(F.lit(1)).alias("sets"), F.ceil(F.sum(at_home) / TILE_SHINGLES).alias("cut")
    )
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("cut") - 1)).alias("part")
    own = F.pmod(F.xxhash64("rec"), F.col("cut"))
    # A set at home is indexed in one tile of its home and searched for in the others.
    dealt = materialize(
        visits.join(tiles.where("sets > 1"), "home")
        .select("home", "rec", "at_home", own.alias("own"), every)
        .select(
            F.xxhash64("home", "part").alias("tile"),
            "rec",
            (F.col("at_home") & (F.col("own") == F.col("part"))).alias("home"),
        ),
        "tiles",
    )
    wanted = context.broadcast(marks_of(dealt))
    full = texts.mapInArrow(full_sets(size, wanted), FULL_SET).repartition("rec")
    full = full.groupBy("rec").agg(F.first("tokens").alias("tokens"))
    return (
        dealt.join(full, "rec")
        .repartition("tile")
        .sortWithinPartitions("tile", F.col("home").desc())
        .mapInArrow(tile_links(percent), "a long, b long")
    )


def similar_texts(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Words are what spaces, tabs and line ends part, lower-cased in A-Z; a text of fewer
    words than a shingle is one shingle, one without words (or null) has none and is
    linked with nothing. ``component_id`` is the smallest doc_id that links reach.
    Rows without a doc_id link too, but never name a component; it is null if no row
    in it has an id. Repeated rows give repeated results, an empty table none. Other
    columns are ignored.
    """
    rows = inputs(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    read = materialize(rows.mapInArrow(sets_and_counts(shingle_words), SET), "shingle-sets")
    counts = sketch(read)
    texts = read.where("chunk IS NULL").select("doc_id", "rec", "n")
    classes = texts.where("rec IS NOT NULL").groupBy("rec").agg(F.min("doc_id").alias("least"))
    # Written first, so that no task runs the search and the first step on its links at once.
    links = materialize(set_links(rows, shingle_words, percent, counts), "set-links")
    found = components(links)
    rooted = classes.join(found, classes["rec"] == found["node"], "left").select(
        "rec", "least", F.coalesce("root", "rec").alias("root")
    )
    rooted = materialize(rooted, "rooted-sets")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(named, "root").select("rec", "component_id")
    alone = F.when(F.col("rec").isNull(), F.col("doc_id"))
    return texts.join(named, "rec", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", alone).alias("component_id")
    )
