"""Packing, license scans, SpotSigs, language model, SentencePiece: against plain versions."""

from __future__ import annotations

import hashlib
import heapq
import math
import random
import re
import time
import zlib
from collections import Counter

import cases
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tapelake.llm import language_model, licenses, packing, pieces, spotsigs


def lower(text: str) -> str:
    return "".join(c.lower() if c.isascii() else c for c in text)


# Packing -------------------------------------------------------------------------


def plain_best_fit(sizes: list[int], capacity: int) -> int:
    rooms: list[int] = []
    for size in sorted(sizes, reverse=True):
        fits = [r for r in rooms if r >= size]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else capacity) - size)
    return len(rooms)


def fewest(sizes: list[int], capacity: int) -> int:
    """Fewest sequences, by trying every place of every piece."""
    best = [len(sizes)]
    sizes = sorted(sizes, reverse=True)

    def place(at: int, rooms: tuple[int, ...]) -> None:
        if len(rooms) >= best[0]:
            return
        if at == len(sizes):
            best[0] = len(rooms)
            return
        for room in set(rooms):
            if room >= sizes[at]:
                rest = list(rooms)
                rest.remove(room)
                place(at + 1, tuple(sorted([*rest, room - sizes[at]])))
        place(at + 1, tuple(sorted([*rooms, capacity - sizes[at]])))

    place(0, ())
    return best[0]


def test_plan_places_every_piece_once_and_beats_best_fit():
    random.seed(1)
    for _ in range(200):
        capacity = random.choice([10, 30, 64])
        sizes = [random.randint(1, capacity) for _ in range(random.randint(1, 60))]
        plan = packing.Plan(Counter(sizes), capacity)
        filled: dict[int, list] = {}
        for size, n in Counter(sizes).items():
            sequence, offset = packing.locate(plan.arrays(), np.full(n, size), np.arange(n))
            for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
                filled.setdefault(s, []).append((o, size))
        for placed in filled.values():
            at = 0
            for offset, size in sorted(placed):
                assert offset == at
                at += size
            assert at <= capacity
        assert len(filled) == plan.sequences <= plain_best_fit(sizes, capacity)


def test_reduction_alone_never_costs_a_sequence(monkeypatch):
    monkeypatch.setattr(packing.Plan, "_best_fit", lambda self: None)
    random.seed(2)
    for _ in range(150):
        capacity = random.choice([12, 20])
        sizes = [random.randint(2, capacity) for _ in range(random.randint(1, 8))]
        plan = packing.Plan(Counter(sizes), capacity)
        rest = [size for size, n in plan.left.items() for _ in range(n)]
        assert plan.sequences + fewest(rest, capacity) == fewest(sizes, capacity), sizes


def test_packed_documents(spark):
    docs = cases.documents(spark)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole = packing.pieces(docs)
    found = packing.pack(whole).collect()
    ids = {}
    for doc_id, text in cases.with_ids():
        ids.setdefault(doc_id, []).append([*tokenizer.encode(text, add_special_tokens=False).ids, 2])
    want = Counter()
    for doc_id, copies in ids.items():
        for tokens in copies:
            for piece, (a, b) in enumerate(zip(*(lambda c: (c, c[1:]))(packing.cut(len(tokens), 1024)), strict=False)):
                want[doc_id, piece, a, b - a, tuple(tokens[a:b])] += 1
    got = Counter(
        (r["doc_id"], r["piece"], r["start"], r["length"], tuple(np.frombuffer(r["ids"], "<u4").tolist()))
        for r in found
    )
    assert got == want
    filled: dict[int, int] = {}
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(filled.values()) <= 1024
    assert len(filled) == -(-sum(filled.values()) // 1024)
    made = packing.sequences(packing.pack(whole)).collect()
    assert sum(len(r["ids"]) for r in made) == 4 * sum(filled.values())
    digests = {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in packing.packed_digests(docs).collect()}
    assert digests == {(d, p, zlib.crc32(np.array(t, "<u4").tobytes())) for d, p, _, _, t in want}
    assert packing.packed_digests(cases.empty(spark)).count() == 0


def test_word_by_word_tokens_equal_whole_text_tokens():
    random.seed(4)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = packing.word_ids(public_tokenizers.path(packing.VOCABULARY))
    parts = [" ", "  ", "\n", "\t", "a", "foo", "Bar", "'ll", "1", "é", "日本", "\xa0", " ", "\x1c", "\x85"]
    parts += ["<|endoftext|>", "!!", "."]
    for _ in range(3000):
        text = "".join(random.choices(parts, k=random.randint(0, 12)))
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == want, repr(text)


# Licenses ------------------------------------------------------------------------


def plain_places(text: str, known: list[licenses.Notice]) -> tuple[int, list[tuple]]:
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    weight = licenses.weights(known)
    found = []
    for n in known:
        for s in range(len(words) - len(n.key) + 1):
            if tuple(words[s : s + len(n.key)]) == n.key:
                first = s - n.key_at
                aligned = sum(
                    weight[w] for j, w in enumerate(n.words) if 0 <= first + j < len(words) and words[first + j] == w
                )
                score = min(1.0, aligned / sum(weight[w] for w in n.words))
                found.append((n.label, n.base, s, len(n.key), round(score, 9)))
    return len(words), sorted(found)


def test_license_places_and_summary(spark):
    extra = [(900, "permission is hereby granted, free of charge, to any person", *cases.rows()[0][2:])]
    extra += [(901, "cc by 4 0 CC-BY 4.0 cc by nc 4.0", *cases.rows()[0][2:])]
    extra += [(902, "license " * 500 + "mit license " * 300, *cases.rows()[0][2:])]
    rows = cases.rows() + extra
    known = licenses.notices()
    want = Counter((i, *map(str, plain_places(t, known))) for i, t in cases.with_ids(rows))
    places = licenses.license_places(cases.documents(spark, rows))
    got = Counter(
        (
            r["doc_id"],
            str(r["n_words"]),
            str(sorted((p["label"], p["base"], p["start"], p["words"], round(p["score"], 9)) for p in r["places"])),
        )
        for r in places.collect()
    )
    assert got == want
    summary = {r["doc_id"]: r for r in licenses.license_summary(places).collect() if r["doc_id"] is not None}
    for doc_id, text in cases.with_ids(rows):
        if doc_id is None:
            continue
        _, found = plain_places(text, known)
        base = [p for p in found if p[1]]
        r = summary[doc_id]
        assert r["n_base"] == len(base)
        assert r["first_word"] == min((p[2] for p in base), default=None)
        assert r["last_word"] == max((p[2] for p in base), default=None)
        assert r["base_labels"] == ",".join(sorted({p[0] for p in base}))
        assert r["labels"] == ",".join(sorted({p[0] for p in found}))
        assert math.isclose(r["score"], max((p[4] for p in found), default=0.0), abs_tol=1e-8)
    assert licenses.license_summary(licenses.license_places(cases.empty(spark))).count() == 0


def plain_texts(text: str) -> dict[str, float]:
    """Licences all of whose passages stand somewhere: key phrase and two indexed words around it."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    licences, passages = licenses.licence_texts()
    weight = licenses.weights(passages)
    best = {}
    for number, p in enumerate(passages):
        for s in range(len(words) - len(p.key) + 1):
            if tuple(words[s : s + len(p.key)]) == p.key:
                same = {j for j, w in enumerate(p.words)
                        if 0 <= s - p.key_at + j < len(words) and words[s - p.key_at + j] == w}
                if len([j for _, j in licenses.passage_words(p, weight) if j in same]) >= licenses.PASSAGE_VOTES:
                    aligned = sum(weight[p.words[j]] for j in same)
                    best[number] = max(best.get(number, 0.0), aligned)
    whole = {one.label: one for one in licences if all(part in best for part in one.parts)}
    return {
        label: round(sum(best[part] for part in one.parts)
                     / sum(weight[w] for part in one.parts for w in passages[part].words), 9)
        for label, one in whole.items() if one.unless not in whole
    }


def edited(text: str, key: str, rng: random.Random) -> str:
    """A text with one word in twenty changed, none of them in its key phrase."""
    words = text.split()
    return " ".join(w if w.lower().strip(".,;:()\"") in key.split() or rng.random() > 0.05 else "changed" for w in words)


def test_license_texts_are_found_whole_and_edited(spark):
    rng, texts = random.Random(3), []
    for label, _, parts in licenses.TEXTS:
        whole = " Copyright by me. ".join(text for text, _ in parts)
        texts += [(label, whole), (label, "x " * 50 + "\n * ".join(whole.upper().split()) + " y" * 50)]
        texts.append((label, " and ".join(edited(text, key, rng) for text, key in parts)))
        for text, key in parts:
            broken = re.sub(r"[\W_]+", " ", text.lower()).replace(key, "something else")
            texts.append((None, whole.replace(text, broken)))
    texts += [(None, ""), (None, None), (None, "the license of the software " * 4_000)]
    rows = [(i, text, *cases.rows()[0][2:]) for i, (_, text) in enumerate(texts)]
    found = licenses.license_places(cases.documents(spark, rows))
    got = {r["doc_id"]: {p["label"]: round(p["score"], 9) for p in r["texts"]} for r in found.collect()}
    summary = {r["doc_id"]: r for r in licenses.license_summary(found).collect()}
    for i, (label, text) in enumerate(texts):
        want = plain_texts(text or "")
        assert got[i].keys() == want.keys() and all(math.isclose(got[i][k], want[k], abs_tol=1e-8) for k in want)
        if label:
            assert label in got[i] and label in summary[i]["labels"].split(","), text
            assert got[i][label] > 0.4
    two = [i for i, (label, _) in enumerate(texts) if label == "bsd-2-clause"]
    assert all("bsd-3-clause" not in got[i] for i in two)


def test_license_plan_is_native(spark):
    plan = licenses.license_summary(licenses.license_places(cases.documents(spark)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


# SpotSigs ------------------------------------------------------------------------


def plain_signatures(text: str, chain: int = 2) -> frozenset:
    words = [w for w in re.split(spotsigs.SEPARATOR, text.lower()) if w]
    common = set(spotsigs.ANCHORS.split())
    found = set()
    for i, word in enumerate(words):
        if word in common and i + 1 < len(words) and words[i + 1] not in common:
            found.add(" ".join([w for w in words[i + 1 :] if w not in common][:chain]))
    return frozenset(found) or frozenset([("all", " ".join(words))])


def plain_likeness(a: frozenset, b: frozenset) -> float:
    return len(a & b) / len(a | b)


def test_spotsigs_of_edited_and_next_texts(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "ROWS_PER_RANGE", 9)
    rows = [r for r in cases.rows() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    found = {r["doc_id"]: r for r in spotsigs.edited_likeness(cases.documents(spark, rows)).collect()}
    ordered = sorted(cases.with_ids(rows), reverse=True)
    assert len(found) == len(ordered)
    by_sets = {}
    for (doc_id, text), (_, following) in zip(ordered, [*ordered[1:], ordered[0]], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = found[doc_id]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest(), doc_id
        own, changed, after = map(plain_signatures, (text, edited, following))
        assert math.isclose(r["near_edited"], plain_likeness(own, changed)), doc_id
        assert math.isclose(r["near_next"], plain_likeness(own, after)), doc_id
        assert by_sets.setdefault(own, r["fingerprint"]) == r["fingerprint"]
        assert by_sets.setdefault(changed, r["edited_fingerprint"]) == r["edited_fingerprint"]
    assert len(set(by_sets.values())) == len(by_sets)


def test_spotsigs_takes_missing_and_repeated_ids_and_empty_tables(spark):
    docs = cases.documents(spark)
    assert spotsigs.edited_likeness(docs).count() == len(cases.rows())
    assert spotsigs.edited_likeness(cases.empty(spark)).count() == 0
    alone = spotsigs.edited_likeness(cases.documents(spark, [cases.rows()[0]])).first()
    assert alone["near_next"] == 1.0
    plan = spotsigs.edited_likeness(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_similar_sets_find_all_pairs(spark):
    random.seed(6)
    sets = []
    for k in range(60):
        base = set(random.sample(range(400), random.randint(1, 40)))
        sets.append((2 * k, sorted(base)))
        sets.append((2 * k + 1, sorted(base - set(random.sample(sorted(base), len(base) // 8)) | {1000 + k})))
    frame = spark.createDataFrame(sets, "set_id long, signatures array<long>").repartition(3)
    for least in (0.5, 0.8):
        want = {
            (a, b): round(plain_likeness(frozenset(x), frozenset(y)), 9)
            for a, x in sets
            for b, y in sets
            if a < b and plain_likeness(frozenset(x), frozenset(y)) >= least
        }
        got = {(r["a"], r["b"]): round(r["likeness"], 9) for r in spotsigs.similar_sets(frame, least).collect()}
        assert got == want
    rows = spotsigs.near_duplicates(cases.documents(spark)).collect()
    assert len(rows) == len(cases.rows())
    copies = {}
    for r in rows:
        assert copies.setdefault(r["fingerprint"], r["component_id"]) == r["component_id"]


# Language model ------------------------------------------------------------------


def plain_scores(rows: list[tuple[int, str]], order: int) -> dict:
    """An automaton of dictionaries, read word by word with its state in hand."""

    def tokens(text):
        return [*text.encode().lower().split(), b" end"]

    out = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    arcs, uses, words = Counter(), Counter(), Counter()
    for (_, text), held in zip(rows, out, strict=True):
        if not held:
            words.update(tokens(text))
            line = (b" start", *tokens(text))
            for end in range(1, len(line)):
                for n in range(1, min(order - 1, end) + 1):
                    uses[line[end - n : end]] += 1
                    arcs[line[end - n : end + 1]] += 1
    total, types, m = sum(words.values()), len(words), language_model.PRIOR_WEIGHT

    def probability(context, word):
        if not context:
            return (words[word] + 0.1) / (total + 0.1 * (types + 1))
        return (arcs[(*context, word)] + m * probability(context[1:], word)) / (uses[context] + m)

    found = Counter()
    for (doc_id, text), held in zip(rows, out, strict=True):
        known = base = score = 0
        state = (b" start",) if order > 1 and uses[(b" start",)] else ()
        for word in tokens(text):
            known += words[word] > 0
            base += math.log10(probability((), word))
            here = state
            while here and not arcs[(*here, word)]:
                score += math.log10(m / (uses[here] + m))
                here = here[1:]
            score += math.log10(probability(here, word))
            state = (*state, word)[-(order - 1) :] if order > 1 else ()
            while state and not uses[state]:
                state = state[1:]
        found[doc_id, held, len(tokens(text)), known, total, round(base, 6), round(score, 6)] += 1
    return found


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_language_model_matches_plain_counts(spark, monkeypatch, order):
    for block, span in ((500, 300), (3_000_000, 1_500_000)):
        monkeypatch.setattr(language_model, "BLOCK_TOKENS", block)
        monkeypatch.setattr(language_model, "RANGE_TOKENS", span)
        found = language_model.score_texts(cases.documents(spark), order=order).collect()
        got = Counter((*r[:5], round(r["base_score"], 6), round(r["score"], 6)) for r in found)
        assert got == plain_scores(cases.with_ids(), order)
    assert language_model.score_texts(cases.empty(spark), order=order).count() == 0


def test_language_model_follows_chains_of_failure_arcs():
    # One text of four tokens; the last word is unknown behind every context.
    ends = {1: np.array([5, 4, 3, 0]), 2: np.array([2, 2, 2, 0]), 3: np.array([0, 1, 1, 0])}
    automaton = language_model.Automaton(ends, np.array([0]), 6, 12, 3)
    assert automaton.states().tolist() == [1, 2, 2, 2]
    m, root = language_model.PRIOR_WEIGHT, math.log10(0.1 / 12.4)
    want = math.log10(m / (2 + m)) + math.log10(m / (3 + m)) + root
    assert math.isclose(automaton.steps()[3], want)


def test_automaton_probabilities_add_up_to_one():
    # Every word read from the state of two words (a, b), as a text of its own after them.
    m, words = language_model.PRIOR_WEIGHT, np.array([5, 3, 2, 1])
    total, types = int(words.sum()), 4
    uses, longer = 4, 2  # of b and of (a, b) as contexts
    after_b, after_ab = np.array([2, 0, 1, 1]), np.array([1, 0, 1, 0])
    steps = 0.0
    for word in range(4):
        ends = {1: np.array([5, uses, words[word]]), 2: np.array([1, longer, after_b[word]]),
                3: np.array([0, 1, after_ab[word]])}
        steps += 10 ** language_model.Automaton(ends, np.array([0]), 3, total, types).steps()[2]
    unseen = 0.1 / (total + 0.1 * (types + 1))
    assert math.isclose(steps + m / (longer + m) * m / (uses + m) * unseen, 1)


def test_packed_arrays_come_back():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**64 - 1, 999, dtype=np.uint64))
    assert (language_model.unpacked_keys(language_model.packed_keys(keys), len(keys)) == keys).all()
    counts = rng.integers(0, 9, 77).astype(np.uint32)
    assert (language_model.unpacked(language_model.packed(counts), 77, np.uint32) == counts).all()


# SentencePiece -------------------------------------------------------------------


def all_segmentations(lattice: pieces.Lattice, word: str) -> list[tuple[float, tuple[int, ...]]]:
    if not word:
        return [(0.0, ())]
    found = []
    if word[0] not in lattice.pieces:
        head = tuple(lattice.bytes[b] for b in word[0].encode())
        found += [(lattice.unknown + s, head + x) for s, x in all_segmentations(lattice, word[1:])]
    for n in range(1, len(word) + 1):
        if word[:n] in lattice.pieces:
            score, piece = lattice.pieces[word[:n]]
            found += [(score + s, (piece, *x)) for s, x in all_segmentations(lattice, word[n:])]
    return found


def test_n_best_segmentations_against_all(spark):
    lattice = pieces.lattice(pieces.model_path(None))
    for text in ("the cat", "an  x\ny é", "日本 ☃ to", "a", " ", "Is and", "thine of"):
        plain = pieces.SPACE + text.replace(" ", pieces.SPACE)
        every = heapq.nlargest(6, all_segmentations(lattice, plain))
        ids, score, others = lattice.encode(text, 6)
        best = np.frombuffer(ids, "<u4").tolist()
        assert [round(s) for s, _ in every] == [round(s) for s in (score, *(s for s, _ in others))], text
        sequences = [tuple(best), *(tuple(pieces.edited(best, edits)) for _, edits in others)]
        assert len(set(sequences)) == len(sequences)
        scored = {ids: s for s, ids in all_segmentations(lattice, plain)}
        assert [round(scored[x]) for x in sequences] == [round(s) for s, _ in every]


def test_n_best_of_words_of_equal_letters():
    known = pieces.lattice(pieces.model_path(None))
    for letter in "xa-=":
        word = pieces.SPACE + letter * 9
        scores = [s for s, _ in known.search(word, 4)]
        assert np.allclose(scores, best_scores(known, word, 4))
        started = time.monotonic()
        _, best, others = known.encode(letter * 20_000, 4)
        assert time.monotonic() - started < 10
        assert len(others) == 3 and all(s <= best for s, _ in others)


def best_scores(known: pieces.Lattice, word: str, n: int) -> list[float]:
    """The n best scores by listing every segmentation."""
    found = [[] for _ in range(len(word) + 1)]
    found[0] = [0.0]
    for a in range(len(word)):
        for start, end, score, _ in known.edges(word):
            if start == a:
                found[end] += [s + score for s in found[a]]
    return sorted(found[-1], reverse=True)[:n]


def test_encoding_and_decoding_come_back(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    encoded = pieces.encode(cases.documents(spark)).withColumn("back", pieces.decode_udf()("ids"))
    found = encoded.collect()
    assert Counter((r["doc_id"], r["back"]) for r in found) == Counter(cases.with_ids())
    for r in found[:40]:
        assert model.decode(np.frombuffer(r["ids"], "<u4").tolist()) == r["back"]
        scores = [r["score"], *(x["score"] for x in r["alternatives"])]
        assert scores == sorted(scores, reverse=True) and len(scores) <= pieces.N_BEST
    assert pieces.encode(cases.empty(spark)).count() == 0
