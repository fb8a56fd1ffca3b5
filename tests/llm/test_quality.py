from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.llm import quality

SCHEMA, LABELS = "doc_id long, text string", "doc_id long, quality int"


def corpus(n=600):
    draw = random.Random(8)
    good = [f"{a}{b}" for a in "bcdfg" for b in ("and", "ing", "ed", "or")]
    rows, labels = [], []
    for i in range(n):
        label = int(draw.random() < 0.7)
        words = [draw.choice(good) if label else draw.choice(good).upper() + "!!" for _ in range(draw.randint(5, 40))]
        rows.append((i, " ".join(words)))
        labels.append((i, label))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([*rows, (7000, None), (None, "x")], SCHEMA).repartition(4)
    table = spark.createDataFrame([*labels, (7000, None), (None, 1), (8000, 1), (3, labels[3][1])], LABELS)
    vectors = quality.word_vectors(docs)
    return docs, vectors, quality.fit(docs, table, vectors, F.col("doc_id") % 4 != 2), dict(labels)


def test_held_out_rows_are_told_apart(fitted):
    docs, vectors, network, labels = fitted
    found = {r.id: r.score for r in quality.score(docs, vectors, network).collect()}
    held = [i for i in labels if i % 4 == 2]
    assert np.mean([(found[i] >= 0.7) == bool(labels[i]) for i in held]) > 0.95
    assert len(found) == 602 and all(0 <= s <= 1 for s in found.values())


def test_word_vectors_are_context_sums(spark):
    docs = spark.createDataFrame([(1, "a bb a ccc"), (2, "bb"), (3, None), (4, "a bb")], SCHEMA).repartition(2)
    vectors = quality.word_vectors(docs)
    places, signs = quality.fixed_vectors()
    rows = quality._TokenRows()
    expected = np.zeros((quality.ROWS, quality.DIMENSIONS))
    fixed = np.zeros_like(expected)
    np.put_along_axis(fixed, places, signs, axis=1)
    for text in ("a bb a ccc", "bb", "a bb"):
        both = [rows[w.encode()] for w in text.split()]
        for i, x in enumerate(both):
            for j, y in enumerate(both):
                if i != j and abs(i - j) <= quality.REACH:
                    expected[x >> 16] += fixed[y >> 16] + fixed[quality.WORD_ROWS + (y & 0xFFFF)]
                    expected[quality.WORD_ROWS + (x & 0xFFFF)] += fixed[quality.WORD_ROWS + (y & 0xFFFF)]
    norms = np.linalg.norm(expected, axis=1, keepdims=True)
    assert np.allclose(vectors, expected / np.where(norms > 0, norms, 1), atol=1e-6)


def test_pooling_does_not_depend_on_the_batch(fitted, monkeypatch):
    _, vectors, _, _ = fitted
    draw = np.random.default_rng(1)
    lens = np.array([0, 5, 300, 1, 0, 80])
    words, shapes = draw.integers(0, quality.WORD_ROWS, 386), draw.integers(quality.WORD_ROWS, quality.ROWS, 386)
    whole = quality._pooled(lens, words, shapes, vectors)
    monkeypatch.setattr(quality, "CHUNK_WORDS", 10)
    assert np.allclose(quality._pooled(lens, words, shapes, vectors), whole, atol=1e-6)
    assert not whole[[0, 4]].any()


def test_edge_tables(spark):
    empty, none = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)
    vectors = quality.word_vectors(empty)
    network = quality.fit(empty, none, vectors, F.lit(True))
    assert quality.score(empty, vectors, network).count() == 0
    assert [r.score for r in quality.score(spark.createDataFrame([(1, None)], SCHEMA), vectors, network).collect()] == [0.5]


def test_temperature_calibrates():
    draw = np.random.default_rng(2)
    rows = draw.normal(size=(6000, quality.INPUTS)).astype(np.float32)
    labels = (draw.random(6000) < 1 / (1 + np.exp(-2 * rows[:, 0]))).astype(np.int64)
    network = quality.fit_network(rows, labels, rounds=30)
    fresh = draw.normal(size=(20000, quality.INPUTS)).astype(np.float32)
    scores, truth = network.scores(fresh), 1 / (1 + np.exp(-2 * fresh[:, 0]))
    for low in np.arange(0.1, 0.9, 0.2):
        inside = (scores >= low) & (scores < low + 0.2)
        assert abs(scores[inside].mean() - truth[inside].mean()) < 0.1
