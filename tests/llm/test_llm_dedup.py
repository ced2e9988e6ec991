"""Exact and SimHash dedup against plain loops."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import cases
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tapelake.llm import exact_dedup, simhash
from tapelake.llm.components import components


def plain_digest(text: str) -> bytes:
    return hashlib.sha256("".join(c.lower() if c.isascii() else c for c in text).encode()).digest()


def plain_classes(rows):
    classes = defaultdict(list)
    for doc_id, text in rows:
        classes[plain_digest(text)].append(doc_id)
    return classes


@pytest.mark.parametrize("cut", [None, 300, -5, 5000])
def test_exact_duplicates_with_any_history(spark, cut):
    docs = cases.documents(spark)
    if cut is None:
        found = exact_dedup.exact_duplicates(docs)
    else:
        old = docs["doc_id"] > cut
        found = exact_dedup.exact_duplicates(docs.where(~old | old.isNull()), docs.where(old))
    found = found.collect()
    classes = plain_classes(cases.with_ids())
    assert Counter((r["doc_id"], bytes(r["digest"])) for r in found) == Counter(
        (i, plain_digest(t)) for i, t in cases.with_ids()
    )
    for r in found:
        members = classes[bytes(r["digest"])]
        assert r["group_size"] == len(members)
        assert r["keep_id"] == max((m for m in members if m is not None), default=None)
    kept = [bytes(r["digest"]) for r in found if r["kept"]]
    assert sorted(kept) == sorted(classes)
    assert all(r["doc_id"] == r["keep_id"] for r in found if r["kept"])


def test_exact_dedup_keeps_whole_rows_and_takes_empty_tables(spark):
    docs = cases.documents(spark)
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    classes = plain_classes(cases.with_ids())
    got = [(r["doc_id"], plain_digest(r["text"] or "")) for r in kept.collect()]
    want = [(max((m for m in c if m is not None), default=None), d) for d, c in classes.items()]
    assert Counter(got) == Counter(want)
    assert exact_dedup.exact_duplicates(cases.empty(spark)).count() == 0
    assert exact_dedup.drop_exact_duplicates(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("ids", ["no history", "one outlying id", "no ids"])
def test_no_bucket_takes_all_new_digests(spark, monkeypatch, ids):
    dealt, merge = [], exact_dedup.merge
    monkeypatch.setattr(exact_dedup, "BUCKET_KEYS", 16)
    monkeypatch.setattr(exact_dedup, "merge", lambda *given: dealt.append(given) or merge(*given))
    rows = [(None if ids == "no ids" else i, f"text {i // 2}") for i in range(800)]
    if ids == "one outlying id":
        rows.append((10**12, "far above"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    new, history = (docs, None) if ids == "no history" else exact_dedup.split_history(docs)
    found = exact_dedup.exact_duplicates(new, history).collect()
    assert sum(r["kept"] for r in found) == len({text for _, text in rows})
    ((_, fresh, buckets),) = dealt
    sizes = [r["count"] for r in exact_dedup._dealt(fresh, buckets).groupBy("bucket").count().collect()]
    assert sum(sizes) == 400 and max(sizes) <= 48


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 700), st.integers(0, 10**6))
def test_perfect_hash_is_minimal_and_byte_checked(n, seed):
    digests = np.frombuffer(np.random.default_rng(seed).bytes(32 * 2 * n), np.uint8).reshape(-1, 32)
    members, others = digests[:n], digests[n:]
    words = exact_dedup.words_of(members)
    displacements = exact_dedup.build_displacements(words)
    group = (words[:, 0] % np.uint64(len(displacements))).astype(np.int64)
    slot = exact_dedup.place(words, displacements[group], n)
    assert sorted(slot.tolist()) == list(range(n))
    slots = np.empty_like(members)
    slots[slot] = members
    assert (exact_dedup.lookup(words, displacements, slots) == slot).all()
    assert (exact_dedup.lookup(exact_dedup.words_of(others), displacements, slots) == -1).all()


def plain_fingerprint(text: str) -> int:
    words = text.encode().lower().split()
    shingles = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values: list[int], bits: int) -> list[int]:
    """Index of the first value that each value is connected to."""
    up = list(range(len(values)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= bits:
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return [root(i) for i in range(len(values))]


def test_near_duplicates_match_brute_force(spark):
    rows = cases.with_ids()
    values = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(values, 4)
    least = {}
    for (doc_id, _), r in zip(rows, roots, strict=True):
        if doc_id is not None:
            least[r] = min(least.get(r, doc_id), doc_id)
    want = Counter((i, f"{v:016x}", least.get(r)) for (i, _), v, r in zip(rows, values, roots, strict=True))
    assert Counter(map(tuple, simhash.near_duplicates(cases.documents(spark)).collect())) == want
    kept = simhash.drop_near_duplicates(cases.documents(spark))
    assert kept.columns == cases.documents(spark).columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids >= set(least.values())
    assert simhash.near_duplicates(cases.empty(spark)).count() == 0


def test_near_dedup_keeps_one_row_of_each_component(spark):
    a, b, c = (" ".join(f"{name}{k}" for k in range(40)) for name in "abc")
    rows = [(1, a), (None, a), (None, b), (None, b), (2, c), (2, c), (2, a), (3, c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = simhash.drop_near_duplicates(docs).collect()
    assert Counter(map(tuple, kept)) == Counter([(1, a), (None, b), (2, c)])


@pytest.mark.parametrize("tile", [4, 4096])
def test_links_of_crowded_and_random_fingerprints(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE_HOMES", tile)
    rng = np.random.default_rng(5)
    far = rng.integers(-(2**63), 2**63 - 1, 150).tolist()
    near = [far[k % 3] ^ sum(1 << int(b) for b in rng.choice(40, 3, replace=False)) for k in range(150)]
    values = sorted(set(far + near))
    frame = spark.createDataFrame([(v,) for v in values], "fp long").repartition(4)
    found = dict(map(tuple, components(simhash.fingerprint_links(frame)).collect()))
    unsigned = [v & (2**64 - 1) for v in values]
    want = [values[r] for r in plain_components(unsigned, 4)]
    assert [found.get(v, v) for v in values] == want


@pytest.mark.parametrize("half", [0, 1])
@pytest.mark.parametrize("agreeing", [0, 1, 2, 3])
@pytest.mark.parametrize("max_bits", [0, 3, 4, 5])
def test_blocks_of_an_anchor_lose_no_link(monkeypatch, half, agreeing, max_bits):
    monkeypatch.setattr(simhash, "AGREEING_FROM", [0] * agreeing or [10**6])
    monkeypatch.setattr(simhash, "COMPARED_AT_ONCE", 50)
    rng = np.random.default_rng(agreeing)
    far = rng.integers(-(2**63), 2**63 - 1, 12)
    near = [int(far[k % 12]) ^ sum(1 << int(b) for b in rng.choice(63, k % 7, replace=False)) for k in range(200)]
    values = np.unique(np.array(near, np.int64))
    homes = values[::2]
    links = simhash.links_of_anchor(homes, values, max_bits, half)
    differ = np.bitwise_count((values[:, None] ^ values[None, :]).view(np.uint64))
    want = np.arange(len(values))
    at_home = np.isin(values, homes)
    direct = (differ <= max_bits) & (at_home[:, None] | at_home[None, :])
    for _ in values:
        want = np.array([want[row].min() for row in direct | np.eye(len(values), dtype=bool)])
    got = np.arange(len(values))
    kept = []
    got = simhash.merge(got, np.searchsorted(values, links[:, 0]), np.searchsorted(values, links[:, 1]), kept)
    assert np.array_equal(got, want)
    assert len(links) == len(values) - len(np.unique(want))  # a forest


def test_comparisons_of_an_anchor_do_not_grow_with_the_square():
    rng = np.random.default_rng(2)
    each = {}
    for rows in (2_000, 16_000, 256_000):
        values = np.unique(rng.integers(-(2**63), 2**63 - 1, rows))
        homes = values[rng.permutation(rows)[: rows // 18]]
        pairs = sum(len(home) for home, _ in simhash.compared(homes, values, 4, 0))
        each[rows] = pairs / len(homes)
    assert each[2_000] < 2_000 / 8 and each[16_000] < 16_000 / 64 and each[256_000] < 256_000 / 200, each
    assert each[256_000] < 8 * each[2_000], each


def test_every_near_fingerprint_visits_the_home(spark):
    rng = np.random.default_rng(0)
    a = rng.integers(-(2**63), 2**63 - 1, 500)
    flips = np.zeros(500, np.uint64)
    for k in range(500):
        for bit in rng.choice(64, 4, replace=False):
            flips[k] |= np.uint64(1) << np.uint64(bit)
    homes, visits = defaultdict(set), defaultdict(set)
    for row, anchor, home in zip(*simhash.anchors(a), strict=True):
        if home:
            homes[row].add(anchor)
    for row, anchor, _ in zip(*simhash.anchors((a.view(np.uint64) ^ flips).view(np.int64)), strict=True):
        visits[row].add(anchor)
    assert all(len(homes[k]) == 2 and homes[k] & visits[k] for k in range(500))


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5000, 5000)]
    frame = spark.createDataFrame(links, "a long, b long").repartition(7)
    found = dict(map(tuple, components(frame).collect()))
    assert found == {i: 0 for i in range(1, 301)} | {1000 + k: 1000 for k in range(1, 200)}
    assert components(frame.limit(0)).count() == 0
