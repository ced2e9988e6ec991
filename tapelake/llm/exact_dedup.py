"""Exact dedup by a minimal perfect hash over historical distinct digests.

The distinct digests of the history and those of the new documents are dealt into the
same buckets, of about ``BUCKET_KEYS`` keys of either side at most. Each bucket gets
its own minimal perfect hash and one slot per history key, which holds the full digest
and where the winner lies. The digests of new documents meet the bucket that could
hold them; a slot whose bytes agree marks a repeat, and the others are classes of
their own. Index and digests are both dealt by bucket, so nothing is broadcast and no
task sees more than a bucket.

Copies are counted with a map-side combine before anything is dealt out, so a
text that makes up a third of all rows is one row per task from then on.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapelake.llm.columns import inputs, spare_name, utf8
from tapelake.workspace import materialize

BUCKET_KEYS = 4096
KEYS_PER_DISPLACEMENT = 4
DIGEST_BYTES = 32
MAX_DISPLACEMENT = 1 << 20
TRIED_TOGETHER = 64

GROUP = "digest binary, doc_id long, tag long, copies long"
INDEX = "bucket long, displacements binary, slots binary, doc_id binary, tag binary, copies binary"


@F.arrow_udf(T.BinaryType())
def text_digest(texts: pa.Array) -> pa.Array:
    """SHA-256 of the text with A-Z in lower case; null counts as empty."""
    return pa.array([hashlib.sha256(t.lower()).digest() for t in utf8(texts)], pa.binary())


def words_of(digests: np.ndarray) -> np.ndarray:
    """Digests (n x 32 bytes) as n x 4 little-endian numbers."""
    return np.ascontiguousarray(digests).view("<u8")


def shifted(words: np.ndarray, displacement: np.ndarray, slots: int) -> np.ndarray:
    """Slot of each key under a displacement: a hash of both."""
    mixed = words[:, 1] ^ (displacement.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    mixed = (mixed ^ (mixed >> np.uint64(30))) * (words[:, 2] | np.uint64(1))
    return ((mixed ^ (mixed >> np.uint64(31))) % np.uint64(slots)).astype(np.int64)


def place(words: np.ndarray, displacement: np.ndarray, slots: int) -> np.ndarray:
    """Slot of each key: the displacement names it if negative, and else shifts the key's hash."""
    return np.where(displacement < 0, -displacement - 1, shifted(words, displacement, slots))


def build_displacements(words: np.ndarray) -> np.ndarray:
    """One displacement per group of keys, such that all keys get different slots.

    Groups are served by falling size; a group takes the first displacement that
    leads all its keys to free slots, and a key alone takes any free slot.
    """
    n = len(words)
    groups = -(-n // KEYS_PER_DISPLACEMENT)
    group = (words[:, 0] % np.uint64(groups)).astype(np.int64)
    members = np.split(np.argsort(group, kind="stable"), np.cumsum(np.bincount(group, minlength=groups))[:-1])
    displacements = np.zeros(groups, np.int64)
    taken = np.zeros(n, bool)
    order = sorted(range(groups), key=lambda g: -len(members[g]))
    alone = [g for g in order if len(members[g]) == 1]
    for g in order:
        keys = words[members[g]]
        if len(keys) < 2:
            break
        for first in range(0, MAX_DISPLACEMENT, TRIED_TOGETHER):
            tried = np.arange(first, first + TRIED_TOGETHER)[:, None]
            slot = np.sort(shifted(keys, tried, n), axis=1)
            fits = ~taken[slot].any(axis=1) & (np.diff(slot, axis=1) > 0).all(axis=1)
            if fits.any():
                best = int(fits.argmax())
                taken[slot[best]] = True
                displacements[g] = first + best
                break
        else:
            raise ValueError("no displacement separates these digests")
    for g, slot in zip(alone, np.flatnonzero(~taken).tolist(), strict=False):
        displacements[g] = -slot - 1
    return displacements


def lookup(words: np.ndarray, displacements: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Slot of each digest, or -1 where the slot holds other bytes."""
    if not len(words) or not len(slots):
        return np.full(len(words), -1)
    group = (words[:, 0] % np.uint64(len(displacements))).astype(np.int64)
    slot = place(words, displacements[group], len(slots))
    return np.where((words_of(slots[slot]) == words).all(axis=1), slot, -1)


def as_rows(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint8).reshape(-1, DIGEST_BYTES)


def build_bucket(key: tuple, keys: pd.DataFrame) -> pd.DataFrame:
    digests = as_rows(keys["digest"])
    words = words_of(digests)
    displacements = build_displacements(words)
    group = (words[:, 0] % np.uint64(len(displacements))).astype(np.int64)
    slot = place(words, displacements[group], len(words))
    ordered = np.empty(len(keys), np.int64)
    ordered[slot] = np.arange(len(keys))
    row = {"bucket": key[0], "displacements": displacements.tobytes(), "slots": digests[ordered].tobytes()}
    row |= {c: keys[c].to_numpy(np.int64)[ordered].tobytes() for c in ("doc_id", "tag", "copies")}
    return pd.DataFrame([row])


def merge_bucket(key: tuple, index: pd.DataFrame, fresh: pd.DataFrame) -> pd.DataFrame:
    """Classes of a bucket: the history's, with their repeats counted in, and the new ones."""
    parts = []
    repeat = np.full(len(fresh), -1)
    if len(index):
        stored = index.iloc[0]
        slots = np.frombuffer(stored["slots"], np.uint8).reshape(-1, DIGEST_BYTES)
        held = {c: np.frombuffer(stored[c], np.int64).copy() for c in ("doc_id", "tag", "copies")}
        if len(fresh):
            displacements = np.frombuffer(stored["displacements"], np.int64)
            repeat = lookup(words_of(as_rows(fresh["digest"])), displacements, slots)
            found, at = fresh[repeat >= 0], repeat[repeat >= 0]
            held["copies"][at] += found["copies"].to_numpy()
            ids, tags = found["doc_id"].to_numpy(), found["tag"].to_numpy()
            later = (ids > held["doc_id"][at]) | ((ids == held["doc_id"][at]) & (tags > held["tag"][at]))
            held["doc_id"][at[later]] = ids[later]
            held["tag"][at[later]] = tags[later]
        parts.append(pd.DataFrame({"digest": [s.tobytes() for s in slots], **held}))
    if len(fresh):
        parts.append(fresh.loc[repeat < 0, ["digest", "doc_id", "tag", "copies"]])
    return pd.concat(parts, ignore_index=True)


# A missing doc_id is the smallest one while classes are formed.
NO_ID = -(2**63)


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (doc_id, digest, tag) per document. ``tag`` tells rows with equal doc_id apart."""
    rows = inputs(docs, doc_id=id_col, text=text_col)
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_digest("text").alias("digest"),
        F.monotonically_increasing_id().alias("tag"),
    )


def classes(rows: DataFrame) -> DataFrame:
    """Distinct digests with their winner and number of rows."""
    winner = F.max(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "tag")).alias("winner")
    return (
        rows.groupBy("digest")
        .agg(winner, F.count(F.lit(1)).alias("copies"))
        .select("digest", "winner.doc_id", "winner.tag", "copies")
    )


def build_index(history: DataFrame, buckets: int) -> DataFrame:
    """Perfect-hash index of the distinct digests of ``history`` (digest, doc_id, tag, copies)."""
    return _dealt(history, buckets).groupBy("bucket").applyInPandas(build_bucket, INDEX)


def merge(index: DataFrame, fresh: DataFrame, buckets: int) -> DataFrame:
    """Classes of history and new rows together, looked up bucket by bucket."""
    return (
        index.groupBy("bucket")
        .cogroup(_dealt(fresh, buckets).groupBy("bucket"))
        .applyInPandas(merge_bucket, GROUP)
    )


def _dealt(keys: DataFrame, buckets: int) -> DataFrame:
    return keys.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)))


def exact_duplicates(
    docs: DataFrame, history: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Class, winner and class size of every row of ``docs`` and ``history``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.
    Of equal texts the row with the largest doc_id stays. Rows without a doc_id
    rank below all others. Of rows that agree in text and doc_id exactly one
    stays, any of them. Empty inputs give an empty result. Other columns are
    ignored. Returns doc_id, keep_id, group_size, kept, digest.
    """
    def kind(rows: DataFrame, old: bool) -> DataFrame:
        return digest_rows(rows, id_col, text_col).withColumn("old", F.lit(old))

    rows = kind(docs, False)
    if history is not None:
        rows = rows.union(kind(history, True).withColumn("tag", -F.col("tag") - 1))
    rows = materialize(rows, "digests")
    old = materialize(classes(rows.where("old")), "history-digests")
    fresh = materialize(classes(rows.where(~F.col("old"))), "new-digests")
    buckets = max(1, -(-max(old.count(), fresh.count()) // BUCKET_KEYS))
    found = merge(build_index(old, buckets), fresh, buckets)
    winners = found.select("digest", F.col("doc_id").alias("keep_id"), F.col("tag").alias("keep_tag"), "copies")
    return rows.join(winners, "digest", "left").select(
        "doc_id",
        F.when(F.col("keep_id") != NO_ID, F.col("keep_id")).alias("keep_id"),
        F.col("copies").alias("group_size"),
        (F.col("tag") == F.col("keep_tag")).alias("kept"),
        "digest",
    )


def split_history(docs: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(new, history): documents from the middle of the id range on are the history."""
    key = docs[id_col].cast("long")
    low, high = docs.agg(F.min(key), F.max(key)).first()
    old = F.lit(False) if low is None else F.coalesce(key > (low + high) // 2, F.lit(False))
    return docs.where(~old), docs.where(old)


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The winners' rows with all their columns, in the same sense as ``exact_duplicates``."""
    new, history = split_history(docs, id_col)
    found = exact_duplicates(new, history, id_col, text_col)
    digest, key, copies = spare_name("digest"), spare_name("key"), spare_name("copies")
    same = found.where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    kept = same.groupBy(F.col("digest").alias(digest), F.col("doc_id").alias(key)).agg(
        F.count(F.lit(1)).alias(copies)
    )
    rows = docs.withColumn(digest, text_digest(docs[text_col]))
    on = (rows[digest] == kept[digest]) & rows[id_col].cast("long").eqNullSafe(kept[key])
    single = rows.join(kept.where(F.col(copies) == 1), on, "left_semi")
    repeated = rows.join(kept.where(F.col(copies) > 1), on, "left_semi")
    return single.union(repeated.dropDuplicates([digest, id_col])).drop(digest)
