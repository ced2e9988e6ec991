"""SimHash near-dedup by anchor-point covering.

Two fingerprints of 64 bits that differ in at most four bits differ in at most two
bits of their low or of their high half. A half is covered by a code of 2**18
anchors: a Golay [23,12] word (every word lies within 3 bits of exactly one
codeword), a Hamming [7,4] word (within 1 bit) and two free bits (within 0). Each
distinct fingerprint is at home at the anchor nearest to each half, and it is sent
on to every anchor within covering radius plus threshold, part by part: 57 on
average. Homes and visitors are compared anchor by anchor, on all 64 bits.

The links of an anchor are reduced to a forest where they are found, so a group of
near copies never becomes all its pairs. Anchors with many homes are cut into
tiles. Components come from the forests by alternating star steps.

Rows of an anchor agree in most of one half, so what tells them apart is the other one.
It is cut into blocks, t more than bits may differ; a pair within the threshold then
agrees in t blocks, and only rows that do are compared, with a larger t the more rows
an anchor has.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.columns import inputs, spare_name, utf8
from tapelake.llm.components import components
from tapelake.workspace import materialize

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
BITS = 64
HALF = 32
HALF_BITS = 2  # of MAX_BITS, what at least one half keeps to
COMPARED_AT_ONCE = 1 << 20
AGREEING_FROM = [512, 8_192, 131_072]  # rows of an anchor from which 1, 2, 3 blocks must agree
SHINGLES_AT_ONCE = 1 << 16
REPLICATED_AT_ONCE = 2048
TILE_HOMES = 4096
BROADCAST_ANCHORS = 10_000

# The generator polynomials of the perfect Golay and Hamming codes.
GOLAY_BITS, GOLAY_CHECKS, GOLAY_POLYNOMIAL, GOLAY_RADIUS = 23, 11, 0b101011100011, 3
HAMMING_BITS, HAMMING_CHECKS, HAMMING_POLYNOMIAL, HAMMING_RADIUS = 7, 3, 0b1011, 1
FREE_BITS = HALF - GOLAY_BITS - HAMMING_BITS


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of every word shingle of a text, repeats included."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    n = max(1, len(words) - size + 1)
    starts = (ends - lengths)[:n].tolist()
    stops = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], HASH_SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, n
    )


def fingerprint_of(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes."""
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), SHINGLES_AT_ONCE):
        part = np.ascontiguousarray(hashes[at : at + SHINGLES_AT_ONCE], "<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(set_bits * 2 > len(hashes), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprint_udf(size: int):
    @F.arrow_udf("long")
    def fingerprint(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(shingle_hashes(t, size)) for t in utf8(texts)], pa.int64())

    return fingerprint


def remainder(words: np.ndarray, bits: int, checks: int, polynomial: int) -> np.ndarray:
    """Remainder of each word, as a polynomial over GF(2), by the code's generator."""
    words = words.copy()
    for bit in range(bits - 1, checks - 1, -1):
        words ^= np.where(words >> bit & 1, polynomial << (bit - checks), 0)
    return words


@cache
def code_offsets(bits: int, checks: int, polynomial: int, radius: int) -> list[list[np.ndarray]]:
    """By remainder and by extra bits 0, 1, 2: what to flip to reach the codewords in reach.

    The flips of list e lead to all codewords at distance radius + e at most that no
    earlier list leads to; a word and a codeword differ by a pattern with the word's remainder.
    """
    found = [[[] for _ in range(HALF_BITS + 1)] for _ in range(1 << checks)]
    for weight in range(radius + HALF_BITS + 1):
        flips = np.array([sum(1 << b for b in c) for c in combinations(range(bits), weight)], np.int64)
        extra = max(0, weight - radius)
        for flip, rest in zip(flips, remainder(flips, bits, checks, polynomial), strict=True):
            found[rest][extra].append(flip)
    return [[np.array(level, np.int64) for level in levels] for levels in found]


def golay() -> list[list[np.ndarray]]:
    return code_offsets(GOLAY_BITS, GOLAY_CHECKS, GOLAY_POLYNOMIAL, GOLAY_RADIUS)


def hamming() -> list[list[np.ndarray]]:
    return code_offsets(HAMMING_BITS, HAMMING_CHECKS, HAMMING_POLYNOMIAL, HAMMING_RADIUS)


@cache
def free() -> list[np.ndarray]:
    return [
        np.array([sum(1 << b for b in c) for c in combinations(range(FREE_BITS), e)], np.int64)
        for e in range(HALF_BITS + 1)
    ]


@cache
def flips_of(golay_rest: int, hamming_rest: int) -> tuple[np.ndarray, int]:
    """All flips that lead a half with these remainders to its anchors; the home's flip comes first."""
    shift_h, shift_f = GOLAY_BITS, GOLAY_BITS + HAMMING_BITS
    g, h = golay()[golay_rest], hamming()[hamming_rest]
    flips = [
        (g[i][:, None, None] | h[j][None, :, None] << shift_h | free()[k][None, None, :] << shift_f).ravel()
        for i in range(HALF_BITS + 1)
        for j in range(HALF_BITS + 1 - i)
        for k in range(HALF_BITS + 1 - i - j)
    ]
    flips = np.concatenate(flips)
    return flips, int(flips[0])


def anchors(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, at home) for every anchor of every fingerprint. Bit 32 of an anchor names the half."""
    rows, found, home = [], [], []
    for half in (0, 1):
        words = (fingerprints.view(np.uint64) >> np.uint64(half * HALF)).astype(np.int64) & ((1 << HALF) - 1)
        rest_g = remainder(words & ((1 << GOLAY_BITS) - 1), GOLAY_BITS, GOLAY_CHECKS, GOLAY_POLYNOMIAL)
        h = words >> GOLAY_BITS & ((1 << HAMMING_BITS) - 1)
        rest_h = remainder(h, HAMMING_BITS, HAMMING_CHECKS, HAMMING_POLYNOMIAL)
        kind = rest_g << HAMMING_CHECKS | rest_h
        order = np.argsort(kind, kind="stable")
        for same in np.split(order, np.flatnonzero(np.diff(kind[order])) + 1):
            if not len(same):
                continue
            flips, own = flips_of(int(rest_g[same[0]]), int(rest_h[same[0]]))
            rows.append(np.repeat(same, len(flips)))
            found.append(((words[same][:, None] ^ flips) | half << HALF).ravel())
            home.append(np.tile(flips == own, len(same)))
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    return np.concatenate(rows), np.concatenate(found), np.concatenate(home)


def replicate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        whole = batch["fp"].to_numpy(np.int64)
        for at in range(0, len(whole), REPLICATED_AT_ONCE):
            values = whole[at : at + REPLICATED_AT_ONCE]
            row, anchor, home = anchors(values)
            yield pd.DataFrame({"anchor": anchor, "fp": values[row], "home": home})


def replicate_home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        _, anchor, home = anchors(batch["fp"].to_numpy(np.int64))
        yield pd.DataFrame({"anchor": anchor[home]})


@cache
def block_masks(agreeing: int, max_bits: int, shift: int) -> list[int]:
    """Masks over one half, so that words with at most ``max_bits`` differing bits agree under one of them."""
    blocks = max(1, max_bits + agreeing)
    bounds = [HALF * k // blocks for k in range(blocks + 1)]
    spans = [(1 << b) - (1 << a) << shift for a, b in zip(bounds, bounds[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(spans, agreeing)]


def compared(
    homes: np.ndarray, values: np.ndarray, max_bits: int, half: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (home, value) to compare, in bounded runs: those that agree in some blocks of the other half."""
    agreeing = sum(len(values) >= least for least in AGREEING_FROM)
    unsigned, own = values.view(np.uint64), homes.view(np.uint64)
    for mask in block_masks(agreeing, max_bits, HALF * (1 - half)):
        keys = unsigned & np.uint64(mask)
        order = np.argsort(keys, kind="stable")
        keys, sought = keys[order], own & np.uint64(mask)
        first = np.searchsorted(keys, sought, "left")
        counts = np.searchsorted(keys, sought, "right") - first
        ends = np.cumsum(counts)
        at = 0
        while at < len(homes):
            done = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + COMPARED_AT_ONCE, "right")))
            size = counts[at:stop]
            home = np.repeat(np.arange(at, stop), size)
            inside = np.arange(len(home)) - np.repeat(np.cumsum(size) - size, size)
            yield home, order[np.repeat(first[at:stop], size) + inside]
            at = stop


def merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray, kept: list[np.ndarray]) -> np.ndarray:
    """Labels after linking places ``a`` with ``b``; ``kept`` takes the pairs of roots that were joined."""
    while True:
        low, high = np.minimum(labels[a], labels[b]), np.maximum(labels[a], labels[b])
        apart = low != high
        if not apart.any():
            return labels
        a, b = a[apart], b[apart]
        parent = np.arange(len(labels))
        np.minimum.at(parent, high[apart], low[apart])
        hooked = np.flatnonzero(parent != np.arange(len(labels)))
        kept.append(np.stack([parent[hooked], hooked], axis=1))
        while (parent[parent] != parent).any():
            parent = parent[parent]
        labels = parent[labels]


def links_of_anchor(homes: np.ndarray, visitors: np.ndarray, max_bits: int, half: int = 0) -> np.ndarray:
    """A forest of the links between the homes of an anchor of ``half`` and its visitors, homes included."""
    values = np.unique(visitors)
    if len(values) < 2:
        return np.empty((0, 2), np.int64)
    at = np.searchsorted(values, homes)
    labels = np.arange(len(values))
    kept: list[np.ndarray] = []
    if len(values) < AGREEING_FROM[0]:  # most anchors: all at once
        near = np.bitwise_count((homes[:, None] ^ values[None, :]).view(np.uint64)) <= max_bits
        if int(near.sum()) > len(homes):
            home, value = near.nonzero()
            merge(labels, at[home], value, kept)
        return values[np.concatenate(kept)] if kept else np.empty((0, 2), np.int64)
    for home, value in compared(homes, values, max_bits, half):
        near = np.bitwise_count((homes[home] ^ values[value]).view(np.uint64)) <= max_bits
        labels = merge(labels, at[home[near]], value[near], kept)
    return values[np.concatenate(kept)] if kept else np.empty((0, 2), np.int64)


def anchor_links(max_bits: int):
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by tile; a tile may run on over any number of batches."""
        waiting: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            tile = batch["tile"]
            if waiting and tile.iloc[-1] == waiting[0]["tile"].iloc[0]:
                waiting.append(batch)
                continue
            last = int(np.searchsorted(tile.to_numpy(), tile.iloc[-1]))
            yield from linked(pd.concat([*waiting, batch.iloc[:last]], ignore_index=True))
            waiting = [batch.iloc[last:]]
        if waiting:
            yield from linked(pd.concat(waiting, ignore_index=True))

    def linked(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if not len(rows):
            return
        values, home = rows["fp"].to_numpy(np.int64), rows["home"].to_numpy(bool)
        key = rows["tile"].to_numpy()
        found: list[np.ndarray] = []
        starts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            at_home = home[a:b]
            if at_home.any() and b - a > 1:
                half = int(key[a]) >> HALF & 1
                found.append(links_of_anchor(values[a:b][at_home], values[a:b], max_bits, half))
        if found:
            yield pd.DataFrame(np.concatenate(found), columns=["a", "b"])

    return compare


def fingerprints(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fp): the SimHash of every text as a signed number. A text without words has 0."""
    rows = inputs(docs, doc_id=id_col, text=text_col)
    return rows.select("doc_id", fingerprint_udf(shingle_words)("text").alias("fp"))


def tiles(dealt: DataFrame, distinct: DataFrame) -> DataFrame:
    """Rows by tile: an anchor with over TILE_HOMES homes is cut, and its visitors go to all its tiles."""
    at_home = distinct.mapInPandas(replicate_home, "anchor long")
    crowded = materialize(
        at_home.groupBy("anchor")
        .agg(F.ceil(F.count(F.lit(1)) / TILE_HOMES).alias("cut"))
        .where("cut > 1"),
        "crowded-anchors",
    )
    number = crowded.count()
    if not number:
        return dealt.withColumn("tile", F.col("anchor"))
    small = F.broadcast(crowded) if number <= BROADCAST_ANCHORS else crowded
    every = F.explode(F.sequence(F.lit(0), F.coalesce("cut", F.lit(1)) - 1))
    own = F.pmod(F.xxhash64("fp"), F.coalesce("cut", F.lit(1)))
    return (
        dealt.join(small, "anchor", "left")
        .select("anchor", "fp", "home", own.alias("own"), every.alias("part"))
        .select(
            "fp",
            (F.col("home") & (F.col("own") == F.col("part"))).alias("home"),
            (F.col("anchor") + F.shiftleft(F.col("part").cast("long"), HALF + 1)).alias("tile"),
        )
    )


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` within ``max_bits``, a forest per anchor."""
    if not 0 <= max_bits <= 2 * HALF_BITS + 1:
        raise ValueError(f"the covering finds at most {2 * HALF_BITS + 1} differing bits")
    dealt = distinct.mapInPandas(replicate, "anchor long, fp long, home boolean")
    return (
        tiles(dealt, distinct)
        .repartition("tile")
        .sortWithinPartitions("tile")
        .mapInPandas(anchor_links(max_bits), "a long, b long")
    )


def rooted(
    docs: DataFrame, shingle_words: int, max_bits: int, id_col: str, text_col: str
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row, and (fp, least, root): least doc_id and component of each fingerprint."""
    rows = materialize(fingerprints(docs, shingle_words, id_col, text_col), "fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    found = components(fingerprint_links(distinct.select("fp"), max_bits))
    return rows, distinct.join(found, distinct["fp"] == found["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    Two rows are linked if their fingerprints differ in at most ``max_bits`` bits;
    ``component_id`` is the smallest doc_id reachable. Null texts count as empty,
    texts without words have fingerprint zero and are linked like others. Rows
    without a doc_id link too, but never name a component: it is null if no row in
    it has an id. Repeated rows give repeated results. Other columns are ignored.
    """
    rows, grouped = rooted(docs, shingle_words, max_bits, id_col, text_col)
    named = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = grouped.join(named, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row of ``docs`` for each component: of its smallest doc_id, or any if none has an id.

    Of rows that agree in doc_id and fingerprint, any one stays. Ids that no other row
    has are looked up alone; only rows without an id, or with a repeated one, are
    told apart by their fingerprints.
    """
    rows, grouped = rooted(docs, shingle_words, max_bits, id_col, text_col)
    key, mark = spare_name("key"), spare_name("fp")
    order = F.struct(F.col("least").isNull().alias("unnamed"), "least", "fp")
    chosen = grouped.groupBy("root").agg(F.min(order).alias("it"))
    chosen = materialize(chosen.select(F.col("it.least").alias(key), F.col("it.fp").alias(mark)), "chosen")
    uses = rows.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(key)).agg(F.count(F.lit(1)).alias("n"))
    again = materialize(uses.where("n > 1").select(key), "repeated-ids")
    named = chosen.where(F.col(key).isNotNull())
    kept = docs.join(named.join(again, key, "left_anti"), docs[id_col] == F.col(key), "left_semi")
    parts = []
    if not again.isEmpty():
        parts.append(docs.join(again, docs[id_col] == F.col(key), "left_semi"))
    if not chosen.where(F.col(key).isNull()).isEmpty():
        parts.append(docs.where(docs[id_col].isNull()))
    for part in parts:
        own = spare_name("fp")
        part = part.withColumn(own, fingerprint_udf(shingle_words)(part[text_col]))
        on = (part[own] == chosen[mark]) & part[id_col].eqNullSafe(chosen[key])
        kept = kept.union(part.join(chosen, on, "left_semi").dropDuplicates([own, id_col]).drop(own))
    return kept
