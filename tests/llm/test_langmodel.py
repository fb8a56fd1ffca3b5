from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.llm import langmodel
from gristmill.llm.langmodel import CLASSES, PREVIOUS, SKIPPED, count_tokens, rows_of, score_texts, train
from gristmill.session import Scope

SCHEMA = "doc_id long, text string"


def held_out(i):
    return zlib.crc32(str(i).encode()) % 10 == 0


def training():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def brute(rows):
    counts = Counter(t for i, text in rows if i is not None and not held_out(i) for t in tokens(text))
    total, types = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (types + 1))) for t in own)
        out.append((i, len(own), sum(counts[t] > 0 for t in own), total, round(base, 6)))
    return sorted(out, key=repr)


def corpus(n=300):
    draw = random.Random(3)
    kinds = [[f"{c}{k}" for k in range(150)] for c in "ab"]
    weights = [1 / (k + 1) for k in range(150)]
    rows = []
    for i in range(n):
        words = draw.choices(kinds[i % 2], weights, k=draw.randint(0, 60))
        words += [f"once{i}"] * draw.randint(0, 2)
        rows.append((i, " ".join(w.upper() if draw.random() < 0.2 else w for w in words)))
    return rows + [(1001, None), (1002, ""), (None, "a1 a2 zzz"), (1003, "a1 b1"), (1003, "a1 b1")]


@pytest.fixture(scope="module")
def scored(spark):
    rows = corpus()
    return rows, score_texts(spark.createDataFrame(rows, SCHEMA).repartition(3), training())[0].collect()


def test_counts_and_base_are_exact(scored):
    rows, found = scored
    assert sorted(((r.id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found), key=repr) == brute(rows)


def test_rare_words_meet_their_counts_in_buckets(spark, monkeypatch):
    rows = corpus(120)
    original = count_tokens
    monkeypatch.setattr(langmodel, "count_tokens", lambda rows, scope: original(rows, scope, 40))
    found = score_texts(spark.createDataFrame(rows, SCHEMA).repartition(2), training(), rounds=2)[0].collect()
    assert sorted(((r.id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found), key=repr) == brute(rows)


def test_model_beats_the_base_on_held_out_rows(scored):
    rows, found = scored
    held = [r for r in found if r.id is not None and held_out(r.id)]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 for r in found)


def test_probabilities_add_up_to_one(spark):
    with Scope(spark) as scope:
        rows = rows_of(spark.createDataFrame(corpus(), SCHEMA), training(), "doc_id", "text")
        counts = count_tokens(rows, scope)
        model = train(rows, counts, scope, 2)
    classes = 10 ** (model.previous[:, None, :] + model.skipped[None, :, :] - model.log_z[:, :, None])
    assert np.allclose(classes.sum(axis=2), 1) and classes.shape == (PREVIOUS, SKIPPED, CLASSES + 1)
    own = np.zeros((SKIPPED, CLASSES))
    for rank in range(counts.frequent):
        own[:, rank % CLASSES] += 10 ** model.words[:, rank]
    assert np.allclose(own[:, : min(CLASSES, counts.frequent)], 1)
    rest = counts.counts[counts.ranks >= counts.frequent].sum() + 0.1 * (counts.types - counts.frequent)
    assert np.isclose(rest, counts.rest_mass())


def test_scores_do_not_depend_on_partitions(spark):
    rows, found, before = corpus(), [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in (8, 3):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            scored = score_texts(spark.createDataFrame(rows, SCHEMA).repartition(partitions), training(), rounds=2)[0].collect()
            found.append(sorted((r.id is None, r.id, r.n_tokens, r.n_known, r.score) for r in scored))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [r[:4] for r in found[0]] == [r[:4] for r in found[1]]
    assert np.allclose([r[4] for r in found[0]], [r[4] for r in found[1]], rtol=1e-9, atol=1e-6)


def test_pairs_of_any_bucket_keep_their_bits():
    pairs = langmodel._pairs(langmodel.mix(np.arange(5000, dtype=np.uint64)), np.array([0, 40]))
    assert np.array_equal(langmodel._widened(langmodel._narrow(pairs)) << np.uint64(16), pairs)
    # Keys of a sorted bucket stay sorted, as look-ups need.
    assert np.all(np.diff(langmodel._widened(langmodel._narrow(np.sort(pairs)))) > 0)


def test_empty_tables(spark):
    assert score_texts(spark.createDataFrame([], SCHEMA), training())[0].count() == 0
    nothing = score_texts(spark.createDataFrame([(1, "a b"), (2, None)], SCHEMA), F.lit(False))[0].collect()
    assert sorted((r.id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in nothing) == [(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)]


def test_word_pairs_of_rare_tokens_are_learned(spark):
    """4,000 words, most beyond the words of the class softmax; each is always followed by the same one."""
    draw, words = random.Random(8), 4000
    texts = {i: [draw.randrange(words)] for i in range(1200)}
    for text in texts.values():
        text.extend((text[0] + k) % words for k in range(1, 20))
    rows = [(i, " ".join(f"w{w}" for w in text)) for i, text in texts.items()]
    ordered = score_texts(spark.createDataFrame(rows, SCHEMA).repartition(3), training(), rounds=2)[0].collect()
    held = [r for r in ordered if held_out(r.id)]
    # After the first word, which is drawn from 4,000, nothing is open but where a text ends.
    assert sum(r.score for r in held) / len(held) > -20
    assert sum(r.base_score for r in held) / len(held) < -60
