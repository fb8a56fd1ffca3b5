"""Small-world graphs against all pairs of vectors."""

from __future__ import annotations

import math

import numpy as np
import pytest

from gristmill.llm import smallworld

SCHEMA = "vec_id long, embedding array<float>"


def families(seed: int, singles: int, sizes: list[int], spread: float, dimensions: int = 24) -> np.ndarray:
    """Vectors without structure, and families around a centre."""
    draw = np.random.default_rng(seed)
    parts = [draw.standard_normal((singles, dimensions))]
    for size in sizes:
        centre = draw.standard_normal(dimensions)
        parts.append(centre / np.linalg.norm(centre) + spread * draw.standard_normal((size, dimensions)))
    found = np.concatenate(parts).astype(np.float32)
    return found[draw.permutation(len(found))]


def expected(rows: list[tuple], cosine: float = 0.9) -> dict:
    """Links by all cosines; equal ids are one node of the components."""
    ids = [r[0] for r in rows]
    good = [
        bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)
        for v in (None if r[1] is None else list(r[1]) for r in rows)
    ]
    links = np.zeros((len(rows), len(rows)), bool)
    for size in {len(r[1]) for r, ok in zip(rows, good, strict=True) if ok}:
        at = np.array([k for k, r in enumerate(rows) if good[k] and len(r[1]) == size])
        matrix = np.array([rows[k][1] for k in at], np.float32).astype(np.float64)
        matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
        links[np.ix_(at, at)] = matrix @ matrix.T >= cosine
    np.fill_diagonal(links, False)
    label = np.array(ids)
    while True:
        new = np.minimum(label, np.where(links, label[None, :], label.max(initial=0)).min(axis=1, initial=label.max(initial=0)))
        for i in set(ids):
            same = np.array(ids) == i
            new[same] = new[same].min()
        if (new == label).all():
            break
        label = new
    return sorted((i, int(n), int(c), bool(i == c)) for i, n, c in zip(ids, links.sum(axis=1), label, strict=True))


def result(spark, rows, schema=SCHEMA, **options):
    found, _ = smallworld.near_vectors(spark.createDataFrame(rows, schema), **options)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize(("spread", "cells"), [(0.02, 1 << 20), (0.02, 6000), (0.07, 6000)])
def test_links_and_components_equal_all_pairs(spark, spread, cells):
    """Tight families are one ball, loose ones (with pairs on both sides of the threshold) several; one or many shards."""
    vectors = families(3, 500, [200, 40, 7, 2, 2], spread)
    rows = [(5000 - k, v.tolist()) for k, v in enumerate(vectors)]
    assert result(spark, rows, shard_cells=cells) == expected(rows)


def test_unusual_vectors_and_clashing_columns(spark):
    one = [1.0, 0.0, 0.0]
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 0.0]), (5, [float("nan"), 1.0, 0.0]), (6, [float("inf"), 1.0, 0.0]),
        (7, one), (8, one), (9, [2.0, 0.0, 0.0]), (9, [0.0, 5.0, 0.0]), (10, [0.0, 1.0, 0.1]), (11, [1.0, 0.0]), (12, [3e38, 1e38, 0.0]),
        (13, [-1.0, 0.0, 0.0]), (7, one), (14, [1e-30, 0.0, 0.0]),
    ]
    wider = [(*r, 1, "x", 2) for r in rows]
    found = result(spark, wider, SCHEMA + ", n_links int, component_id string, vec int")
    assert found == expected(rows)


def test_copies_of_one_vector_are_one_class(spark):
    """A third of all rows is one vector: it is one node, counted with its copies."""
    vectors = families(4, 200, [3], 0.02)
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)] + [(10_000 + k, vectors[0].tolist()) for k in range(100)]
    found, scope = smallworld.near_vectors(spark.createDataFrame(rows, SCHEMA))
    assert sorted(tuple(r) for r in found.collect()) == expected(rows)


def test_families_are_few_nodes():
    vectors = families(5, 300, [2000], 0.015, 64)
    units = smallworld._unit(vectors.astype(np.float64))
    graph, centres, ball = smallworld.build(units, np.zeros(len(units), int), math.cos(math.acos(0.9) / 2 - 1e-6))
    assert len(centres) < 310 and len(graph.vectors) == len(centres)
    assert ((units * units[centres[ball]]).sum(axis=1) > math.cos(math.acos(0.9) / 2)).all()


def test_recall_on_vectors_without_structure():
    """Links planted into vectors without structure are found with the beam that the audit chose."""
    draw = np.random.default_rng(6)
    units = smallworld._unit(draw.standard_normal((4000, 48)))
    levels = np.floor(-np.log(draw.random(len(units))) / math.log(smallworld.NEIGHBOURS)).astype(int)
    graph, centres, ball = smallworld.build(units, levels, 0.975)
    shard = smallworld.Shard(graph, units, ball, centres, 0.9)
    beam, recall = shard.audit()
    assert recall >= 0.99
    other = smallworld._unit(units[:1000] + draw.standard_normal((1000, 48)) * 0.06)
    true = other @ units[centres].T >= 0.9
    q, n = shard.hits(other, beam)
    found = np.zeros_like(true)
    found[q, n] = True
    assert (found & true).sum() / true.sum() >= 0.98


def test_beams_widen_where_hits_are_many():
    """More hits than the beam holds: it is widened for these queries until they fit."""
    draw = np.random.default_rng(7)
    centre = smallworld._unit(draw.standard_normal((1, 32)))
    units = smallworld._unit(centre + 0.055 * draw.standard_normal((600, 32)))
    graph, centres, ball = smallworld.build(units, np.zeros(600, int), 0.9999)
    shard = smallworld.Shard(graph, units, ball, centres, 0.9)
    q, n = shard.hits(units[:20], 32)
    true = units[:20] @ units[centres].T >= 0.9
    assert len(centres) == 600 and true.sum(axis=1).min() > 100
    found = np.zeros_like(true)
    found[q, n] = True
    assert (found & true).sum() / true.sum() >= 0.99


def test_threshold_must_be_an_angle(spark):
    assert result(spark, []) == []
    with pytest.raises(ValueError):
        result(spark, [], cosine=1.0)


def test_searches_grow_slower_than_with_the_square(spark):
    """A vector searches each shard: shards become larger and not only more, up to a size that a task can hold."""
    rows = [(many, 64) for many in (1, 10_000, 51_282, 1_000_000, 100_000_000)]
    found = spark.createDataFrame(rows, "many long, dimensions long").select("many", smallworld._shards(smallworld.SHARD_CELLS).alias("shards"))
    shards = {r.many: r.shards for r in found.collect()}
    assert [shards[many] for many, _ in rows[:4]] == [1, 1, 2, 8]
    assert 100_000_000 * 64 / shards[100_000_000] <= smallworld.MOST_CELLS
