"""Toxicity, quality, and the pipeline."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import cases
import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_dedup import plain_components, plain_digest, plain_fingerprint

from tapelake.llm import packing, quality, toxicity

PLAIN = "river stone window garden letter morning table paper winter market you the of and to it".split()
HOSTILE = "grumbot snorfel wretchek you your".split()
LABELS = "doc_id long, quality int, toxic int, text string"


def corpus(n: int, seed: int = 0):
    """(documents, labels): plain texts, hostile ones, and shouted junk."""
    random.seed(seed)
    docs, labels = [], []
    for i in range(n):
        words = random.choices(PLAIN, k=random.randint(8, 60))
        kind = i % 7
        if kind == 0:
            for _ in range(3):
                words.insert(random.randrange(len(words)), random.choice(HOSTILE[:3]))
        if kind == 1:
            words = [f"{w.upper()}!!" for w in words]
        docs.append((i, " ".join(words), "en", 1, "w", "d", 1, "g"))
        labels.append((i, int(kind != 1), int(kind == 0), "not a text"))
    return docs, labels


def rank_accuracy(scores, truth) -> float:
    """Share of pairs of unlike truth that the scores put in order; ties count half."""
    high = [s for s, t in zip(scores, truth, strict=True) if t]
    low = [s for s, t in zip(scores, truth, strict=True) if not t]
    return float(np.mean([(a > b) + 0.5 * (a == b) for a in high for b in low]))


def scored(spark, docs, labels):
    frame = cases.documents(spark, docs)
    rows = toxicity.toxicity(frame, toxicity.train(frame, spark.createDataFrame(labels, LABELS)))
    return {r["doc_id"]: r for r in rows.collect()}


def test_toxicity_features_do_not_jump_with_the_length():
    features = toxicity.Features({})
    short, long = (np.array(features.of(("Ab 1 " * 80)[:n])) for n in (399, 400))
    assert np.abs(short - long).max() < 0.01


def test_toxicity_of_held_out_documents(spark):
    docs, labels = corpus(1500)
    found = scored(spark, docs, labels)
    held = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in found}
    assert all(found[i]["held_out"] == held[i] for i in found)
    out = [i for i in found if held[i]]
    assert rank_accuracy([found[i]["score"] for i in out], [i % 7 == 0 for i in out]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found.values())
    turned = [(i, q, 1 - t if held[i] else t, x) for i, q, t, x in labels]
    again = scored(spark, docs, turned)
    assert all(again[i]["score"] == found[i]["score"] for i in found)
    other = scored(spark, [(*d[:2], "de", 5, "x", "y", 9, None) for d in docs], labels)
    assert all(other[i]["score"] == found[i]["score"] for i in found)


def test_toxicity_of_odd_rows_and_without_labels(spark):
    docs, labels = corpus(300)
    model_frame = cases.documents(spark, docs)
    model = toxicity.train(model_frame, spark.createDataFrame(labels, LABELS))
    odd = toxicity.toxicity(cases.documents(spark), model).collect()
    assert Counter(r["doc_id"] for r in odd) == Counter(r[0] for r in cases.rows())
    assert all(r["score"] is not None and r["predicted"] in (0, 1) for r in odd)
    assert toxicity.toxicity(cases.empty(spark), model).count() == 0
    kept = toxicity.drop_toxic(cases.documents(spark), model)
    assert kept.columns == cases.documents(spark).columns
    assert kept.count() == sum(not r["predicted"] for r in odd)
    nothing = spark.createDataFrame([(1, None, None, None), (None, 1, 1, None)], LABELS)
    bare = toxicity.toxicity(model_frame, toxicity.train(model_frame, nothing)).collect()
    assert {r["score"] for r in bare} == {0.0}


def test_features_see_disguise_distance_and_capitals():
    features = toxicity.Features({"grumbot": 4.0})
    plain, near, leet, loud = (
        features.of(t)
        for t in ("a b c d", "you are a grumbot", "a gr0mbot grumb0t b", "GRUMBOT AND SHOUT!")
    )
    assert plain[:8] == [0.0] * 8
    assert near[0] == 0.25 and near[7] == 1.0
    assert leet[13] > 0 and leet[14] > 0
    assert loud[9] > 0.5 and loud[10] == 1.0
    assert len(features.of("")) == len(plain)


def test_quality_of_held_out_documents(spark):
    docs, labels = corpus(1200)
    frame = cases.documents(spark, docs)
    model = quality.train(frame, spark.createDataFrame(labels, LABELS))
    assert (np.diff(model.thresholds) > 0).all()
    found = quality.grades(frame, model).collect()
    out = [r for r in found if r["held_out"]]
    assert 150 < len(out) < 350
    assert rank_accuracy([r["p_grade_1"] for r in out], [r["doc_id"] % 7 != 1 for r in out]) > 0.99
    assert rank_accuracy([r["expected_grade"] for r in out], [r["doc_id"] % 7 > 1 for r in out]) > 0.9
    for r in found:
        assert 1 >= r["p_grade_1"] >= r["p_grade_2"] >= 0
        assert r["expected_grade"] == pytest.approx(r["p_grade_1"] + r["p_grade_2"])
    kept = quality.select_quality(frame, model)
    assert kept.columns == frame.columns
    clean = {r["doc_id"] for r in kept.collect()}
    assert clean == {r["doc_id"] for r in found if r["selected"]}
    assert sum(i % 7 != 1 and i not in clean for i in range(1200)) <= 2
    odd = quality.grades(cases.documents(spark), model).collect()
    assert Counter(r["doc_id"] for r in odd) == Counter(r[0] for r in cases.rows())
    assert quality.grades(cases.empty(spark), model).count() == 0
    nothing = quality.train(frame, spark.createDataFrame([], LABELS))
    assert quality.select_quality(frame, nothing).count() == 1200


def test_ordinal_slopes_are_those_of_the_likelihood():
    rng = np.random.default_rng(2)
    model = quality.OrdinalModel(np.zeros(2), np.array([-0.4, 0.3, 1.1]))
    score, grade = rng.normal(size=40), rng.integers(0, 4, 40)

    def likelihood(score, thresholds):
        tail = quality.OrdinalModel(np.zeros(2), thresholds).tails(score)
        tail = np.column_stack([np.ones(len(score)), tail, np.zeros(len(score))])
        at = np.arange(len(score))
        return np.log(tail[at, grade] - tail[at, grade + 1])

    by_score, by_threshold = quality.slopes(model, score, grade)
    step = 1e-6
    up = likelihood(score + step, model.thresholds) - likelihood(score - step, model.thresholds)
    assert np.allclose(by_score, up / (2 * step), atol=1e-5)
    for k in range(3):
        move = np.eye(3)[k] * step
        up = likelihood(score, model.thresholds + move) - likelihood(score, model.thresholds - move)
        assert by_threshold[k] == pytest.approx(up.sum() / (2 * step), abs=1e-4)


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs, labels = corpus(900)
    docs += [(10_000 + d[0], d[1].upper() if d[0] % 2 else d[1], *d[2:]) for d in docs[:40]]
    long = " ".join(random.choices([f"w{k}" for k in range(3000)], k=1500))
    docs += [(20_000, long, *docs[0][2:]), (20_001, f"{long} tail", *docs[0][2:])]
    frame = cases.documents(spark, docs)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    state = {}
    current = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = current.collect()
        current = stage(spark, current, str(tmp_path))
        if name != "best_fit_packing":
            assert current.columns == frame.columns
            current.write.parquet(f"{tmp_path}/{name}")
            current = spark.read.parquet(f"{tmp_path}/{name}")
        state[name] = (before, current.collect())
    assert list(stages) == list(state) and len(stages) == 5

    before, after = state["quality"]
    assert {r["doc_id"] for r in before} - {r["doc_id"] for r in after} >= {i for i in range(900) if i % 7 == 1 and i > 40}
    before, after = state["toxicity"]
    left = {r["doc_id"] for r in after}
    assert sum(i % 7 == 0 for i in left if i < 900) <= 5
    assert sum(r["doc_id"] not in left and r["doc_id"] % 7 != 0 for r in before if r["doc_id"] < 900) <= 3
    before, after = state["exact_dedup"]
    classes: dict = {}
    for r in before:
        classes.setdefault(plain_digest(r["text"]), []).append(r["doc_id"])
    assert sorted(r["doc_id"] for r in after) == sorted(map(max, classes.values()))
    before, after = state["simhash_near_dedup"]
    roots = plain_components([plain_fingerprint(r["text"]) for r in before], 4)
    groups: dict = {}
    for r, root in zip(before, roots, strict=True):
        groups.setdefault(root, []).append(r["doc_id"])
    assert sorted(r["doc_id"] for r in after) == sorted(map(min, groups.values()))
    before, after = state["best_fit_packing"]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}
    filled = Counter()
    for r in sorted(after, key=lambda r: (r["sequence_id"], r["offset"])):
        assert filled[r["sequence_id"]] == r["offset"]
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= packing.CAPACITY
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert whole.select(F.sum("length")).first()[0] == sum(filled.values())
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("labelled", [True, False])
def test_pipeline_on_hostile_rows(spark, tmp_path, labelled):
    """Null texts and ids, repeated rows, names that clash; with labels, and with labels that say nothing."""
    docs, labels = corpus(300)
    docs = [(50_000 + d[0], *d[1:]) for d in docs]
    labels = [(50_000 + row[0], *row[1:]) for row in labels]
    odd = [(None, None, None, None), (docs[0][0], None, None, None), (-1, 1, 1, "no such document")]
    frame = cases.documents(spark, docs + cases.rows())
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels + odd if labelled else odd, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r["doc_id"] for r in frame.select("doc_id").collect()}
    assert packed and {r["doc_id"] for r in packed} <= ids
    rooms: dict = {}
    for r in packed:
        rooms.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in rooms.values():
        ends = 0
        for offset, length in sorted(pieces):
            assert offset == ends
            ends += length
        assert ends <= 1024
    if not labelled:
        stages = dict(corpus_pipeline.STAGES)
        for name in ("quality", "toxicity"):
            kept = stages[name](spark, frame, str(tmp_path))
            assert kept.count() == frame.count() and kept.columns == frame.columns


def test_pipeline_on_empty_tables(spark, tmp_path):
    cases.empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
