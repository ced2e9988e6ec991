"""N-gram join, ranked search and whitening against plain loops and plain linear algebra."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import cases
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tapelake.llm import lexical_search, ngram_join, whitening


def lower(text: str | None) -> str:
    return "".join(c.lower() if c.isascii() else c for c in text or "")


# N-gram join -----------------------------------------------------------------


def shingles(text: str | None, size: int = 5) -> set[tuple]:
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower(text)) if w]
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def roots_of(sets: list[set], percent: int) -> list[int]:
    """Class of each set by comparing whatever shares a member."""
    up, holders = list(range(len(sets))), defaultdict(list)

    def root(x: int) -> int:
        while up[x] != x:
            x = up[x]
        return x

    for i, own in enumerate(sets):
        shared = Counter(j for s in own for j in holders[s])
        for j, n in shared.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                up[root(i)] = root(j)
        for s in own:
            holders[s].append(i)
    return [root(i) for i in range(len(sets))]


def plain_join(rows, percent: int = 80, size: int = 5) -> Counter:
    sets = [shingles(text, size) for _, text in rows]
    roots, least = roots_of(sets, percent), {}
    for root, (doc_id, _) in zip(roots, rows, strict=True):
        if doc_id is not None:
            least[root] = min(least.get(root, doc_id), doc_id)
    return Counter(
        (doc_id, len(own), least.get(root) if own else doc_id)
        for root, own, (doc_id, _) in zip(roots, sets, rows, strict=True)
    )


def near_copies(n: int = 150) -> list[tuple[int, str]]:
    """Copies of a few texts with a growing number of changed words, and texts made of shared passages."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    bases = [rng.choices(words, k=rng.randint(30, 120)) for _ in range(6)]
    out = []
    for i in range(n):
        text = list(rng.choice(bases))
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = rng.choice(words)
        out.append((i, " ".join(text)))
    passages = [" ".join(rng.choices(words, k=20)) for _ in range(4)]
    out += [(1000 + i, " ".join(rng.sample(passages, 2) + rng.choices(words, k=8))) for i in range(40)]
    return out


def test_join_of_hostile_rows(spark):
    found = ngram_join.similar_texts(cases.documents(spark)).collect()
    assert Counter(map(tuple, found)) == plain_join([(r[0], r[1]) for r in cases.rows()])
    assert ngram_join.similar_texts(cases.empty(spark)).count() == 0


@pytest.mark.parametrize(("percent", "size", "tile"), [(80, 5, 2_000_000), (80, 5, 400), (50, 3, 700), (100, 5, 400)])
def test_join_of_near_copies(spark, monkeypatch, percent, size, tile):
    monkeypatch.setattr(ngram_join, "TILE_SHINGLES", tile)
    monkeypatch.setattr(ngram_join, "CROWDED_LIST", 40 if tile < 1000 else 100_000)
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = ngram_join.similar_texts(docs, size, percent).collect()
    assert Counter(map(tuple, found)) == plain_join(rows, percent, size)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1, max_size=14), min_size=1, max_size=12), st.integers(30, 100))
def test_search_finds_every_set_with_the_needed_overlap(sets, percent):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    tile = ngram_join.Tile(list(range(len(sets))), arrays, percent)
    for own, tokens in zip(sets, arrays, strict=True):
        least = ngram_join.needed(len(own), percent)
        want = {i: len(own & s) for i, s in enumerate(sets) if len(own & s) >= least}
        assert dict(zip(*map(np.ndarray.tolist, tile.search(tokens)), strict=True)) == want
    for rec, tokens in enumerate(arrays):
        tile.link(rec, tokens, rec)
    roots = roots_of(sets, percent)
    assert tile.classes == len(set(roots)) == len(sets) - len(tile.links)
    assert all(roots[a] == roots[b] for a, b in tile.links)


@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 3))), st.lists(st.integers(1, 4), max_size=30))
def test_only_shared_shingles_stay(pairs, cuts):
    rows = pd.DataFrame(sorted(pairs), columns=["token", "rec"], dtype="int64").assign(n=1, salt=0)
    parts, at = [], 0
    for cut in [*cuts, len(rows)]:
        if at < len(rows):
            parts.append(rows[at : at + cut])
        at += cut
    found = Counter(tuple(r) for part in ngram_join.shared_only(iter(parts)) for r in part[["token", "rec"]].to_numpy())
    holders = defaultdict(set)
    for token, rec in pairs:
        holders[token].add(rec)
    assert found == Counter((t, r) for t, recs in holders.items() if len(recs) > 1 for r in recs)


# Ranked search ---------------------------------------------------------------


def plain_terms(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def plain_ranks(rows, items, k: int = 20) -> list[tuple]:
    docs = [(i, Counter(plain_terms(text))) for i, text in rows]
    docs = [(i, counted, sum(counted.values())) for i, counted in docs if counted]
    n, total = len(docs), sum(size for _, _, size in docs)
    df = Counter(t for _, counted, _ in docs for t in counted)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, counted, size in docs:
            m = 75 + 25 * size * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                * (10**9 * counted[t] // (1000 * counted[t] + 12 * m))
                for t in plain_terms(text)
                if t in counted
            )
            if score:
                scores.append((-score, doc_id is None, doc_id))
        out += [(item_id, r, d, -s) for r, (s, _, d) in enumerate(sorted(scores)[:k], 1)]
    return out


def items() -> list[tuple]:
    rng = random.Random(9)
    texts = [" ".join(rng.choices(cases.WORDS, k=rng.randint(1, 12))) for _ in range(12)]
    texts += ["the the the of", "MIT License!", "é", "İstanbul", "nowhere to be found zzz", "", None, " ... ", "x", "日本"]
    return [(i, t, "lang") for i, t in enumerate(texts)] + [(0, texts[0], "lang"), (None, "cat dog", None)]


def test_best_documents_of_hostile_rows(spark):
    asked = spark.createDataFrame(items(), "item_id long, text string, score string")
    blocks = lexical_search.index(cases.documents(spark))
    found = Counter(map(tuple, lexical_search.best_documents(blocks, asked).collect()))
    assert found == Counter(plain_ranks([(r[0], r[1]) for r in cases.rows()], [i[:2] for i in items()]))
    assert lexical_search.best_documents(lexical_search.index(cases.empty(spark)), asked).count() == 0
    assert lexical_search.best_documents(blocks, asked.limit(0)).count() == 0


def test_queries_in_several_batches(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "BATCH_QUERIES", 9)
    asked = spark.createDataFrame(items(), "item_id long, text string, score string")
    blocks = lexical_search.index(cases.documents(spark))
    found = Counter(map(tuple, lexical_search.best_documents(blocks, asked, 3).collect()))
    assert found == Counter(plain_ranks([(r[0], r[1]) for r in cases.rows()], [i[:2] for i in items()], 3))


@pytest.mark.parametrize(("share", "window", "block"), [(16, 1024, 2_000_000), (2, 8, 600), (1, 4, 300), (1000, 16, 900)])
def test_every_share_of_short_and_long_lists_gives_the_same_ranks(monkeypatch, share, window, block):
    monkeypatch.setattr(lexical_search, "SHORT_SHARE", share)
    monkeypatch.setattr(lexical_search, "WINDOW", window)
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", block)
    rng = random.Random(share)
    words = [f"t{i}" for i in range(60)]
    common = [1 / (i + 1) for i in range(60)]
    rows = [(i, " ".join(rng.choices(words, common, k=rng.randint(0, 40)))) for i in range(200)]
    asked = [(i, " ".join(rng.choices(words, k=rng.randint(1, 9)))) for i in range(30)]
    table = pa.RecordBatch.from_pylist([{"doc_id": i, "text": t} for i, t in rows])
    blocks = [b.to_pylist()[0] for b in lexical_search.index_blocks(iter([table]))]
    n, total = sum(b["docs"] for b in blocks), sum(b["terms"] for b in blocks)
    held = Counter()
    for b in blocks:
        held.update(dict(zip(b["vocabulary"], b["held"], strict=True)))
    lists = [lexical_search.Lists(b, n, total) for b in blocks]
    found = []
    for item_id, text in asked:
        query = lexical_search.weights(Counter(lexical_search.terms_of(text.encode())), held, n)
        best = lexical_search.Best(5)
        for own in lists:
            lexical_search.search(own, query, best)
        found += [(item_id, r, d, s) for r, (d, s) in enumerate(zip(best.ids.tolist(), best.scores.tolist()), 1)]
    assert found == plain_ranks(rows, asked, 5)


# Whitening -------------------------------------------------------------------


VECTORS = "vec_id long, embedding array<float>, n int, component string"


def vectors(n: int = 300, dims: int = 8, seed: int = 1) -> list[tuple]:
    rng = np.random.default_rng(seed)
    turn = rng.standard_normal((dims, dims))
    data = (rng.standard_normal((n, dims)) * np.arange(1, dims + 1) @ turn).astype(np.float32)
    return [(i, row.tolist(), 1, "c") for i, row in enumerate(data)]


def integers(rows: list[tuple]) -> np.ndarray:
    return np.array([[math.floor(64 * float(c)) + 1_000_000 for c in r[1]] for r in rows], np.int64)


def check_whitened(found: list, rows: list[tuple], components: int) -> None:
    x, n = integers(rows), len(rows)
    centred = x - x.sum(axis=0) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    want = centred @ axes[:, order] / np.sqrt(values[order])
    got = np.full((n, components), np.nan)
    place = {r[0]: i for i, r in enumerate(rows)}
    sums = [int(s) for s in x.sum(axis=0)]
    for r in found:
        got[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert math.isclose(r["explained"], values[order][r["component"] - 1] / values.sum(), rel_tol=1e-9)
        own = x[place[r["vec_id"]]].tolist()
        assert r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(own, sums, strict=True))
    assert len(found) == n * components
    signs = np.sign((got * want).sum(axis=0))
    assert np.allclose(got * signs, want, atol=1e-7)


@pytest.mark.parametrize("components", [3, 8])
def test_whitening_matches_eigenvectors(spark, components):
    rows = vectors()
    found = whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(4), components)
    check_whitened(found.collect(), rows, components)


def test_whitening_drops_bad_vectors_and_flat_components(spark):
    rows = vectors(60, 4)
    nan, inf = float("nan"), float("inf")
    bad = [(900, None, 1, "c"), (901, [1.0, None, 2.0, 3.0], 1, "c"), (902, [nan, 1.0, 1.0, 1.0], 1, "c")]
    bad += [(903, [inf, 1.0, 1.0, 1.0], 1, "c"), (904, [], 1, "c"), (905, [1.0, 2.0], 1, "c")]
    found = whitening.whiten(spark.createDataFrame(rows + bad, VECTORS)).collect()
    check_whitened(found, rows, 4)
    doubled = [(i, v + v + [5.0], 1, "c") for i, v, _, _ in rows]  # half of the dimensions vary
    found = whitening.whiten(spark.createDataFrame(doubled, VECTORS)).collect()
    assert {r["component"] for r in found} == {1, 2, 3, 4}
    check_whitened(found, doubled, 4)
    same = spark.createDataFrame([(i, [1.0, 2.0], 1, "c") for i in range(5)], VECTORS)
    assert whitening.whiten(same).count() == 0
    assert whitening.whiten(same.limit(0)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(None, [1e30, 2.0], 1, "c"), (1, [1.0, 3.0], 1, "c")], VECTORS)).count() == 2


def test_equal_variances_start_the_chain_again(spark):
    rows = [(i, [4.0 * (j == i // 2) * (1 - i % 2 * 2) for j in range(5)], 1, "c") for i in range(10)]
    found = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert len(found) == 50 and all(r["identity_error"] < 1e-9 for r in found)
    assert all(math.isclose(r["explained"], 0.2) for r in found)


def test_deviations_beyond_64_bits():
    x = np.array([[10**6, 2**52], [10**6 + 1, 5]], np.int64)
    sums = [int(s) for s in x.sum(axis=0)]
    assert whitening.exact_deviations(x, 2, sums) == [None, None]
    assert whitening.exact_deviations(x[:, :1], 2, sums[:1]) == [1, 1]
